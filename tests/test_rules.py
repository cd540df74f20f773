"""Rule unit tests: pass / fail / NULL / empty / line terminators (FIXTURES.md section 4)."""

import pytest

from tollgate.functions import Rule, cast_regex, not_null, regex, violated

EDGE = [
    # value, fails ^.+$, fails ^\d+$
    (None, False, False),
    ("", True, True),
    ("a", False, True),
    ("a\n", False, True),
    ("a\r", False, True),
    ("a\u0085", False, True),
    ("a\nb", True, True),
    ("a\rb", True, True),
    ("a\u0085b", True, True),
    ("a b", True, True),
    ("\n", True, True),
    (" ", False, True),
    ("5", False, False),
    ("5\n", False, False),
    ("١", False, True),  # Arabic-Indic digit one
]


def _verdicts(spark, values, rule, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["bad"] for r in df.select("i", violated(rule).alias("bad")).orderBy("i").collect()]


def test_dot_plus_and_digits_edges(spark):
    values = [e[0] for e in EDGE]
    assert _verdicts(spark, values, regex("v", r"^.+$")) == [e[1] for e in EDGE]
    assert _verdicts(spark, values, regex("v", r"^\d+$")) == [e[2] for e in EDGE]


@pytest.mark.parametrize("value,g3,m5", [
    (4.0, False, False), (5.9, False, False), (0.5, True, False),
    (6.0, True, True), (-1.0, True, True), (float("nan"), True, True),
    (1.0e7, True, True), (1.0e-5, True, True),
])
def test_double_ratings_checked_on_string_form(spark, value, g3, m5):
    assert _verdicts(spark, [value], cast_regex("v", r"^[1-5](\.\d+)?$"), "double") == [g3]
    assert _verdicts(spark, [value], cast_regex("v", r"^[0-5](\.\d+)?$"), "double") == [m5]


def test_null_passes_regex_unless_not_nullable(spark):
    assert _verdicts(spark, [None], regex("v", r"^x$")) == [False]
    assert _verdicts(spark, [None], regex("v", r"^x$", nullable=False)) == [True]


def test_not_null_accepts_empty_string(spark):
    assert _verdicts(spark, [None, "", "x"], not_null("v")) == [True, False, False]


def test_raw_violation_is_null_for_null_input(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(regex("v", "^a$").violation().alias("x")).first()["x"] is None


def test_rule_validation():
    with pytest.raises(ValueError):
        Rule("c", "bogus", "x")
    with pytest.raises(ValueError):
        Rule("c", "regex")


def test_column_names_with_dots_are_quoted(spark):
    df = spark.createDataFrame([("x",)], "`a.b` string")
    assert df.select(violated(regex("a.b", "^y$")).alias("bad")).first()["bad"] is True


def test_rules_from_plain_data():
    import json
    from tollgate.functions import SILVER_RULES, rules_from_dicts
    data = json.loads('[{"column": "id", "kind": "regex", "pattern": "^[a-f0-9]+$"},'
                      ' {"column": "customer_id", "kind": "not_null"},'
                      ' {"column": "rating", "kind": "cast_regex", "pattern": "^[0-5](\\\\.\\\\d+)?$"}]')
    assert rules_from_dicts(data) == [SILVER_RULES["mongodb"][0], SILVER_RULES["mongodb"][1],
                                      SILVER_RULES["mongodb"][4]]
    with pytest.raises(ValueError, match="unknown rule field"):
        rules_from_dicts([{"column": "a", "kind": "not_null", "severity": "high"}])
