"""Declarative column rules compiled to native Spark Column expressions.

A rule is data: ``Rule(column, kind, pattern)``. It compiles to a *violation*
predicate, never to a "valid" predicate, so SQL three-valued logic is kept:

* ``regex``      violates when ``NOT col RLIKE p`` is true. A NULL value gives
                 NULL, which ``when`` and ``filter`` treat as "no violation",
                 so NULL passes every regex rule unless ``nullable=False``.
* ``cast_regex`` the same after ``CAST(col AS <cast>)`` (ratings are checked on
                 their string form: 4.0 -> "4.0" passes, 1.0E7 fails).
* ``not_null``   violates when the value is NULL; empty strings pass.

``rlike`` is Java regex ``find()``: ``$`` also matches before one final line
terminator and ``.`` excludes line terminators. Those semantics are kept on
purpose; nothing here rewrites the patterns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

REGEX = "regex"
CAST_REGEX = "cast_regex"
NOT_NULL = "not_null"
KINDS = (REGEX, CAST_REGEX, NOT_NULL)

FAILED_COLUMNS = "failed_columns"
VALIDATION = "validation"
MATCH = "match"
NO_MATCH = "no_match"


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    pattern: str | None = None
    cast: str = "string"
    nullable: bool = True
    label: str | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r}; expected one of {KINDS}")
        if self.kind != NOT_NULL and not self.pattern:
            raise ValueError(f"rule on {self.column!r} of kind {self.kind!r} needs a pattern")

    @property
    def name(self) -> str:
        return self.label or self.column

    def violation(self) -> Column:
        """Boolean Column: true = violated, false = passed, NULL = passed."""
        value = F.col(quote(self.column))
        if self.kind == NOT_NULL:
            return value.isNull()
        if self.kind == CAST_REGEX:
            value = value.cast(self.cast)
        bad = ~value.rlike(self.pattern)
        if not self.nullable:
            bad = value.isNull() | bad
        return bad


def rules_from_dicts(items) -> list[Rule]:
    """Rules from plain data, e.g. parsed JSON:
    ``[{"column": "id", "kind": "regex", "pattern": "^\\d+$"}, {"column": "os", "kind": "not_null"}]``.
    Optional keys: ``cast`` (default ``string``), ``nullable``, ``label``."""
    allowed = {"column", "kind", "pattern", "cast", "nullable", "label"}
    out = []
    for item in items:
        unknown = set(item) - allowed
        if unknown:
            raise ValueError(f"unknown rule field(s) {sorted(unknown)} in {item}")
        out.append(Rule(**item))
    return out


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def regex(column: str, pattern: str, **kw) -> Rule:
    return Rule(column, REGEX, pattern, **kw)


def cast_regex(column: str, pattern: str, cast: str = "string", **kw) -> Rule:
    return Rule(column, CAST_REGEX, pattern, cast=cast, **kw)


def not_null(column: str, **kw) -> Rule:
    return Rule(column, NOT_NULL, **kw)


def violated(rule: Rule) -> Column:
    """Rule verdict with NULL folded to false: the column a report shows."""
    return F.coalesce(rule.violation(), F.lit(False))


def any_violation(rules: Sequence[Rule]) -> Column:
    """True when at least one rule is violated. NULL arms fold to false, so
    the result is never NULL and ``~any_violation`` is the exact valid set."""
    if not rules:
        return F.lit(False)
    return reduce(lambda a, b: a | b, (violated(r) for r in rules))


def empty_names() -> Column:
    return F.array().cast("array<string>")


def failed_columns(rules: Sequence[Rule]) -> Column:
    """``array<string>`` of the names of violated rules, in rule order.

    Built as ``concat(when(bad, [name]) else [])``: same list as an array of
    nullable names filtered for NULLs, but the lambda-free form stays inside
    whole-stage code generation and the name arrays are constant-folded.
    """
    if not rules:
        return empty_names()
    parts = [F.when(r.violation(), F.array(F.lit(r.name))).otherwise(empty_names()) for r in rules]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def classification(failed: Column) -> Column:
    return F.when(F.size(failed) == 0, F.lit(MATCH)).otherwise(F.lit(NO_MATCH))


def rule_columns(rules: Iterable[Rule]) -> list[str]:
    seen: list[str] = []
    for r in rules:
        if r.column not in seen:
            seen.append(r.column)
    return seen
