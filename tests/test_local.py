"""Metadata frames built from driver-side rows (one Arrow batch, one partition)."""

import pytest
from pyspark.sql import types as T

from tollgate.sources.local import local_frame


def test_rows_nulls_and_single_partition(spark):
    df = local_frame(spark, [("a", 1, None, True), ("b", None, 2.5, None)],
                     "s string, n bigint, x double, f boolean")
    assert df.rdd.getNumPartitions() == 1
    assert [tuple(r) for r in df.orderBy("s").collect()] == [("a", 1, None, True), ("b", None, 2.5, None)]
    assert dict(df.dtypes) == {"s": "string", "n": "bigint", "x": "double", "f": "boolean"}


def test_empty_rows_keep_the_schema(spark):
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("n", T.IntegerType())])
    df = local_frame(spark, [], schema)
    assert df.count() == 0 and df.schema.fieldNames() == ["source", "n"]


def test_nested_types_are_refused(spark):
    with pytest.raises(TypeError):
        local_frame(spark, [([1],)], T.StructType([T.StructField("a", T.ArrayType(T.IntegerType()))]))
