"""Composite tests: failed-column order, several failures, classification, errors, splits."""

import pytest
from pyspark.sql import functions as F

from tollgate.functions import SILVER_RULES, cast_regex, not_null, regex
from tollgate.operators import MissingRuleColumns, annotate, joined_failures, rejects, valid
from tollgate.sources.reviews import review_source

from .conftest import SF01

RULES = [regex("a", r"^\d+$"), not_null("b"), cast_regex("c", r"^[0-5]$")]
ROWS = [
    (1, "12", "x", 3),      # passes all
    (2, "x", None, 9),      # fails all three, in rule order
    (3, None, "y", None),   # NULLs pass the regex rules
    (4, "1\n", None, 5),    # trailing newline passes; b fails
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k int, a string, b string, c int")


def test_failed_columns_in_rule_order(df):
    out = {r["k"]: (r["failed_columns"], r["validation"]) for r in annotate(df, RULES).collect()}
    assert out == {1: ([], "match"), 2: (["a", "b", "c"], "no_match"),
                   3: ([], "match"), 4: (["b"], "no_match")}


def test_rejects_and_valid_partition_the_input(df):
    rej = {r["k"]: r["failed_columns"] for r in rejects(df, RULES).collect()}
    ok = {r["k"] for r in valid(df, RULES).collect()}
    assert rej == {2: ["a", "b", "c"], 4: ["b"]}
    assert ok == {1, 3}
    assert set(rejects(df, RULES).columns) == set(annotate(df, RULES).columns)


def test_reserved_column_collision_raises(df):
    with pytest.raises(ValueError, match="reserved"):
        annotate(df.withColumn("validation", F.lit("x")), RULES)


def test_missing_rule_column_raises(df):
    with pytest.raises(MissingRuleColumns) as ei:
        annotate(df.drop("b"), RULES)
    assert ei.value.missing == ["b"]


def test_annotation_stays_in_whole_stage_codegen(spark):
    rev = review_source(spark, SF01, "mongodb")
    plan = rejects(rev, SILVER_RULES["mongodb"])._jdf.queryExecution().executedPlan().toString()
    # Filter and the annotating Project are fused in one codegen stage (*(n)); no lambda.
    assert "*(1) Filter" in plan and "*(1) Project" in plan
    assert "lambdafunction" not in plan.lower()


def test_fixture_reject_counts_match_recorded_totals(spark):
    expect = {"google_play": 966, "mongodb": 5491, "apple_store": 9243}
    for src, n in expect.items():
        assert rejects(review_source(spark, SF01, src), SILVER_RULES[src]).count() == n


def test_per_column_failure_counts_sf001(spark):
    rev = review_source(spark, SF01, "apple_store")
    ann = annotate(rev, SILVER_RULES["apple_store"])
    got = {r["c"]: r["n"] for r in ann.select(F.explode("failed_columns").alias("c"))
           .groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert got == {"im_rating": 3750, "title": 3000, "id": 2143, "im_version": 1667,
                   "content": 1500, "name_client": 1364, "app": 1154}


def test_joined_failures_empty_string(df):
    out = {r["k"]: r["f"] for r in annotate(df, RULES).select("k", joined_failures().alias("f")).collect()}
    assert out[1] == "" and out[2] == "a,b,c"


def test_rule_failure_counts_match_recorded_totals(spark):
    from tollgate.operators import rule_failure_counts
    got = {r["column_name"]: r["n_failed"] for r in
           rule_failure_counts(review_source(spark, SF01, "mongodb"), SILVER_RULES["mongodb"], "mongodb").collect()}
    assert got == {"rating": 3273, "id": 1429, "timestamp": 1112, "customer_id": 1000, "app": 834,
                   "cpf": 833, "comment": 715, "app_version": 625, "os_version": 556, "os": 500}
