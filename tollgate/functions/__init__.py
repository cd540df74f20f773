from .review_rules import SILVER_RULES, rules_for
from .rules import (
    CAST_REGEX, FAILED_COLUMNS, MATCH, NO_MATCH, NOT_NULL, REGEX, VALIDATION,
    Rule, any_violation, cast_regex, classification, failed_columns, not_null,
    regex, rule_columns, rules_from_dicts, violated,
)

__all__ = [
    "CAST_REGEX", "FAILED_COLUMNS", "MATCH", "NO_MATCH", "NOT_NULL", "REGEX",
    "VALIDATION", "Rule", "SILVER_RULES", "any_violation", "cast_regex",
    "classification", "failed_columns", "not_null", "regex", "rule_columns",
    "rules_for", "rules_from_dicts", "violated",
]
