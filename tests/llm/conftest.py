import pytest
from pyspark.sql import types as T

from tollgate.session import ship_package

#: Columns of ``documents``, and some that clash with names used inside operators.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("_row", T.StringType()), T.StructField("_fp", T.StringType()), T.StructField("found", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("length", T.StringType()), T.StructField("w", T.StringType()),
])
LONG = "the mit of license under 12 +1 555 0100 " * 20_000
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (None, "Some text of nobody."), (None, None), (5, LONG),
    (6, "ÉCOLE ünïcode 你好 \U0001f600 KK"), (7, "<|endoftext|> x  <|endoftext|>"), (8, "two  spaces \n next\n\n end "),
    (9, "Released under the MIT License. Apache License, Version 2.0; CC BY-NC 4"), (10, "!!! ??? ..."),
    (11, "mail a.b@c-d.org or 10.1.2.255, card 4111 1111 1111 1111, call +49 (30) 1234-567"), (12, "one two three"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    ship_package(spark)
    rows = [(i, t, "en", "s", len(t or ""), "x", "x", "x", "x", "x", "x", "x") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
