"""Local-collection source: small driver-side rows (report rows, metric
rows, schema fields) as a DataFrame.

Rows travel as one Arrow batch (no Python worker, no pickled RDD, one
round trip). Only ever used for metadata whose size is bounded by
sources x columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32(),
    T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
}


_DDL = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
        "double": T.DoubleType(), "boolean": T.BooleanType()}


def _arrow_type(dt: T.DataType) -> pa.DataType:
    for cls, at in _ARROW.items():
        if isinstance(dt, cls):
            return at
    raise TypeError(f"local_frame supports flat string/int/bigint/double/boolean, not {dt.simpleString()}")


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType([T.StructField(n, _DDL[t]) for n, t in
                               (part.split() for part in schema.split(","))])
    cols = list(zip(*rows)) if rows else [() for _ in schema.fields]
    table = pa.table({f.name: pa.array(list(c), type=_arrow_type(f.dataType))
                      for f, c in zip(schema.fields, cols)})
    # metadata-sized: one partition, so a write of it is one task and one file
    return spark.createDataFrame(table, schema=schema).coalesce(1)
