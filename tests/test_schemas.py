"""Schema tests: strict verdict and field diff for every kind of drift."""

import json

import pytest
from pyspark.sql import types as T

from tollgate.operators import expected_schema, schema_diff, schema_report
from tollgate.sources.lake import read_parquet, write_leaf

SILVER_G = expected_schema("google_play", "silver")


def _variant(kind):
    f = list(SILVER_G.fields)
    if kind == "reordered":
        f[0], f[1] = f[1], f[0]
    elif kind == "upper":
        f[0] = T.StructField("ID", T.StringType())
    elif kind == "retyped":
        f[3] = T.StructField("rating", T.DoubleType())
    elif kind == "extra":
        f.append(T.StructField("extra", T.StringType()))
    elif kind == "front":
        f.insert(0, T.StructField("extra", T.StringType()))
    elif kind == "missing":
        f = f[:-2] + f[-1:]
    elif kind == "nested":
        hist = T.ArrayType(T.StructType([T.StructField("title", T.StringType())]))
        f[-1] = T.StructField("historical_data", hist)
    elif kind == "non_nullable":
        f[0] = T.StructField("id", T.StringType(), nullable=False)
    return T.StructType(f)


def _status(spark, schema):
    rows = schema_report(spark, {"google_play": schema}, {"google_play": SILVER_G}, "silver").collect()
    return rows[0]["validation_status"]


def _diff(spark, schema):
    d = schema_diff(spark, {"google_play": schema}, {"google_play": SILVER_G}, "silver")
    return {r["column_name"]: r["status"] for r in d.collect() if r["status"] != "match"}


def test_exact_schema_matches(spark):
    assert _status(spark, SILVER_G) == "match"
    assert _diff(spark, SILVER_G) == {}


@pytest.mark.parametrize("kind,expected_diff", [
    ("reordered", {"id": "moved", "app": "moved"}),
    ("upper", {"id": "missing", "ID": "unexpected"}),
    ("retyped", {"rating": "type_mismatch"}),
    ("extra", {"extra": "unexpected"}),
    ("missing", {"snippet": "missing"}),
    ("front", {"extra": "unexpected"}),
    ("nested", {"historical_data": "type_mismatch"}),
    ("non_nullable", {"id": "nullability_mismatch"}),
])
def test_variants_are_no_match_with_reason(spark, kind, expected_diff):
    s = _variant(kind)
    assert _status(spark, s) == "no_match"
    assert _diff(spark, s) == expected_diff


def test_nullability_does_not_survive_parquet_round_trip(spark, workdir):
    df = spark.range(3).selectExpr("cast(id as string) as id")  # id is non-nullable in memory
    assert df.schema["id"].nullable is False
    write_leaf(df, workdir)
    back = read_parquet(spark, workdir)
    exp = T.StructType([T.StructField("id", T.StringType())])
    assert schema_report(spark, {"s": back}, {"s": exp}, "silver").first()["validation_status"] == "match"


def test_missing_source_reported(spark):
    r = schema_report(spark, {"google_play": None}, {"google_play": SILVER_G}, "silver").first()
    assert r["validation_status"] == "missing_source" and r["current_schema"] is None
    d = schema_diff(spark, {"google_play": None}, {"google_play": SILVER_G}, "silver").collect()
    assert {r["status"] for r in d} == {"missing"}


def test_unknown_source_guard():
    with pytest.raises(ValueError, match="no expected schema"):
        expected_schema("tiktok", "silver")
    with pytest.raises(ValueError):
        expected_schema("google_play", "gold")


def test_report_columns_and_json(spark):
    r = schema_report(spark, {"google_play": SILVER_G}, {"google_play": SILVER_G}, "silver")
    assert r.columns == ["source", "layer", "validation_status", "expected_schema", "current_schema",
                         "differences"]
    assert T.StructType.fromJson(json.loads(r.first()["expected_schema"])) == SILVER_G
    assert json.loads(r.first()["differences"]) == []
    bad = schema_report(spark, {"google_play": _variant("retyped")}, {"google_play": SILVER_G}, "silver")
    assert json.loads(bad.first()["differences"]) == [{
        "column_name": "rating", "expected_position": 4, "actual_position": 4,
        "expected_type": "string", "actual_type": "double", "status": "type_mismatch"}]


def test_all_six_expected_schemas_parse():
    sizes = {(s, l): len(expected_schema(s, l).fields)
             for s in ("google_play", "mongodb", "apple_store") for l in ("bronze", "silver")}
    assert sizes == {("google_play", "bronze"): 9, ("mongodb", "bronze"): 13, ("apple_store", "bronze"): 14,
                     ("google_play", "silver"): 8, ("mongodb", "silver"): 12, ("apple_store", "silver"): 10}
    resp = expected_schema("google_play", "bronze")["response"].dataType
    assert isinstance(resp, T.MapType) and resp.valueContainsNull
