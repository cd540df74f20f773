"""tollgate: a Spark-native data-quality gate for dated data-lake loads.

Checks: volumetry (did each source arrive, is it empty), schema (strict
verdict + field diff against the expected schema of the lake layer) and
pattern (declarative column rules compiled to Column expressions; rejected
rows are quarantined by load date).
"""

from .functions import SILVER_RULES, Rule, cast_regex, not_null, regex, rules_for, rules_from_dicts
from .operators import (
    annotate, expected_schema, folder_schema_report, rejects, rule_failure_counts,
    schema_diff, schema_report, valid, volumetry_gate, volumetry_report,
)
from .plans.run import RunResult, run_quality
from .sources.lake import read_quarantine

__all__ = [
    "Rule", "RunResult", "SILVER_RULES", "annotate", "cast_regex", "expected_schema",
    "folder_schema_report", "not_null", "read_quarantine", "regex", "rejects",
    "rule_failure_counts", "rules_for", "rules_from_dicts", "run_quality", "schema_diff",
    "schema_report", "valid", "volumetry_gate", "volumetry_report",
]
