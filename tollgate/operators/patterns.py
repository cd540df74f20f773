"""Pattern check: annotate rows with the rules they fail, split rejects.

Every function here is a narrow (map-only) transformation: no shuffle, no
Python UDF, and the rule predicates stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import (
    FAILED_COLUMNS, MATCH, NO_MATCH, NOT_NULL, VALIDATION, Rule, any_violation,
    classification, failed_columns, rule_columns, violated,
)


class MissingRuleColumns(ValueError):
    """A rule names a column the source does not have."""

    def __init__(self, missing: Sequence[str], available: Sequence[str]):
        self.missing = list(missing)
        super().__init__(
            f"rule columns missing from source: {self.missing}; available: {list(available)}")


def check_columns(df: DataFrame, rules: Sequence[Rule]) -> None:
    have = set(df.columns)
    collide = [c for c in (FAILED_COLUMNS, VALIDATION) if c in have]
    if collide:
        raise ValueError(f"source already has reserved column(s) {collide}; rename them first")
    names = [r.name for r in rules]
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"several rules share the name(s) {dup}; give them distinct labels")
    missing = [c for c in rule_columns(rules) if c not in have]
    if missing:
        raise MissingRuleColumns(missing, df.columns)


def _cheap_first(rules: Sequence[Rule]) -> list[Rule]:
    """Order for the OR pre-filter: null checks, then shorter patterns.
    The OR (NULL folded to false) does not depend on the order, but a row
    that fails stops at its first true arm, so cheap arms go first. The
    order of names in ``failed_columns`` is unaffected."""
    return sorted(rules, key=lambda r: (r.kind != NOT_NULL, len(r.pattern or "")))


def annotate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Input columns + ``failed_columns array<string>`` + ``validation``.

    Two stacked projections: the list is built once per row and the
    classifier reads it (Catalyst does not inline the list twice).
    """
    check_columns(df, rules)
    return (df.select("*", failed_columns(rules).alias(FAILED_COLUMNS))
              .withColumn(VALIDATION, classification(F.col(FAILED_COLUMNS))))


def rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing at least one rule, annotated.

    A cheap OR of the violation predicates filters first (short-circuits on
    the first failing rule); the name list is built only for surviving rows
    and ``validation`` is the constant it must be.
    """
    check_columns(df, rules)
    return (df.filter(any_violation(_cheap_first(rules)))
              .select("*", failed_columns(rules).alias(FAILED_COLUMNS),
                      F.lit(NO_MATCH).alias(VALIDATION)))


def valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every rule, with the (constant) annotation columns."""
    check_columns(df, rules)
    return (df.filter(~any_violation(_cheap_first(rules)))
              .select("*", F.array().cast("array<string>").alias(FAILED_COLUMNS),
                      F.lit(MATCH).alias(VALIDATION)))


def joined_failures(col: str | Column = FAILED_COLUMNS, sep: str = ",") -> Column:
    """Failed names as one string (``''`` when none): the comparable form."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(c, sep)


def failure_count_exprs(rules: Sequence[Rule], col: str = FAILED_COLUMNS) -> list[Column]:
    """One ``count_if`` per rule over an annotated frame, for an Observation."""
    return [F.count_if(F.array_contains(F.col(col), r.name)).alias(f"failed_{r.name}")
            for r in rules]


def preview_rejects(quarantined: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Print the first ``n`` quarantined rows. Opt-in only: rejected rows
    carry personal data (document numbers, names, comments). Reads the
    written quarantine, so no rule is evaluated again."""
    quarantined.show(n, truncate=truncate)


def rule_failure_counts(df: DataFrame, rules: Sequence[Rule], source: str) -> DataFrame:
    """``source, column_name, n_failed`` per rule: one aggregate with a
    ``count_if`` per rule (map-side partial counts), unpivoted to one row
    per rule. No list is built and nothing is exploded."""
    check_columns(df, rules)
    wide = df.agg(*[F.count_if(violated(r)).alias(f"r{i}") for i, r in enumerate(rules)])
    long = wide.unpivot([], [f"r{i}" for i in range(len(rules))], "slot", "n_failed")
    names = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"r{i}"), F.lit(r.name))])
    return long.select(F.lit(source).alias("source"), names[F.col("slot")].alias("column_name"),
                       F.col("n_failed"))


def valid_invalid_counts(df: DataFrame, rules: Sequence[Rule], source: str) -> DataFrame:
    """``source, n_rows, n_valid, n_invalid``: one aggregate that evaluates the
    violations once per row."""
    check_columns(df, rules)
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(any_violation(_cheap_first(rules))).alias("n_invalid"))
    return counts.select(F.lit(source).alias("source"), "n_rows",
                         (F.col("n_rows") - F.col("n_invalid")).alias("n_valid"), "n_invalid")
