from .metrics import (
    JOB_FAILURE_SCHEMA, RUN_METRICS_SCHEMA, append_rows, observe_rejects,
    record_failure,
)
from .patterns import (
    MissingRuleColumns, annotate, check_columns, failure_count_exprs,
    joined_failures, preview_rejects, rejects, rule_failure_counts, valid,
)
from .schemas import (
    EXPECTED_SCHEMAS, LAYERS, expected_schema, folder_schema_report, schema_diff, schema_report,
)
from .volumetry import (
    VolumetryError, emptiness, volumetry_gate, volumetry_report,
)

__all__ = [
    "EXPECTED_SCHEMAS", "JOB_FAILURE_SCHEMA", "LAYERS", "MissingRuleColumns",
    "RUN_METRICS_SCHEMA", "VolumetryError", "annotate", "append_rows",
    "check_columns", "emptiness", "expected_schema", "folder_schema_report", "failure_count_exprs",
    "joined_failures", "observe_rejects", "preview_rejects", "record_failure", "rejects",
    "rule_failure_counts", "schema_diff", "schema_report", "valid",
    "volumetry_gate", "volumetry_report",
]
