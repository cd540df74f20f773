"""Review-shaped source tables derived from the driver's test tables.

The test tables hold no reviews and no NULLs, so each review source is a
plain projection of one table with deterministic corruption (the recipe in
FIXTURES.md section 3). One projection, no join, no shuffle: it scales with
the table it reads.

Every derived column is written once as a SQL expression template and
rendered for Spark (``selectExpr``) and for DuckDB (the oracle), so both
sides see identical inputs. ``{s}`` is the string type name; the uuid
back-reference syntax differs between the two regex engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schemas import expected_schema
from .lake import read_many

_UUID = ("regexp_replace(md5(cast(doc_id as {s})), "
         "'^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '{r1}-{r2}-{r3}-{r4}-{r5}')")

# --- fixed values: derived review tables (FIXTURES.md section 3) ---------------
# source -> (driver table, key column, [(column, expression template)])
REVIEW_FIXTURES: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "google_play": ("documents", "doc_id", [
        ("id", "case when doc_id % 7 = 0 then upper({uuid}) when doc_id % 11 = 0 then null else {uuid} end"),
        ("app", "case when doc_id % 13 = 0 then 'App Name' else source end"),
        ("rating", "cast(doc_id % 7 as {s})"),
        ("iso_date", "case when doc_id % 5 = 0 then '2024-01-01' when doc_id % 9 = 0 then null else '2024-01-01T00:00:00Z' end"),
        ("title", "case when doc_id % 17 = 0 then '' when doc_id % 19 = 0 then concat(lang, chr(10)) else lang end"),
        ("snippet", "text"),
    ]),
    "mongodb": ("events", "event_id", [
        ("id", "case when event_id % 7 = 0 then 'XYZ' else md5(cast(event_id as {s})) end"),
        ("customer_id", "case when event_id % 10 = 0 then null else cast(user_id as {s}) end"),
        ("cpf", "case when event_id % 6 = 0 then '123.456.789-09' when event_id % 8 = 0 then '12345' when event_id % 15 = 0 then null else lpad(cast(event_id as {s}), 11, '0') end"),
        ("app", "case when event_id % 12 = 0 then 'Bad App' else event_type end"),
        ("rating", "case when event_id % 4 = 0 then cast(value as {s}) else cast(event_id % 7 as {s}) end"),
        ("timestamp", "case when event_id % 9 = 0 then '2024-01-01T00:00:00Z' else '2024-01-01T00:00:00.123' end"),
        ("comment", "case when event_id % 14 = 0 then null else props end"),
        ("app_version", "case when event_id % 16 = 0 then 'v1.2' else '1.2.3' end"),
        ("os_version", "case when event_id % 18 = 0 then '13.' else '13' end"),
        ("os", "case when event_id % 20 = 0 then null else 'ios' end"),
    ]),
    "apple_store": ("orders", "o_orderkey", [
        ("id", "case when o_orderkey % 7 = 0 then concat('x', cast(o_orderkey as {s})) else cast(o_orderkey as {s}) end"),
        ("name_client", "case when o_orderkey % 11 = 0 then '' else concat('client ', cast(o_custkey as {s})) end"),
        ("app", "case when o_orderkey % 13 = 0 then 'A B' else 'app-1_x' end"),
        ("im_version", "case when o_orderkey % 9 = 0 then '1..2' else '1.2' end"),
        ("im_rating", "cast(o_orderkey % 8 as {s})"),
        ("title", "case when o_orderkey % 5 = 0 then concat('a', chr(10), 'b') else o_orderpriority end"),
        ("content", "case when o_orderkey % 10 = 0 then null else o_orderstatus end"),
    ]),
}
# Bronze-shaped copies (raw extracts: original types, one folder per app).
# source -> (driver table, app-folder expression, [(column, expression template)])
BRONZE_FIXTURES: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "google_play": ("documents", "source", [
        ("avatar", "concat('avatar/', source)"),
        ("date", "'2024-01-01'"),
        ("id", "{uuid}"),
        ("iso_date", "'2024-01-01T00:00:00Z'"),
        ("likes", "n_chars"),
        ("rating", "cast(doc_id % 6 as double)"),
        ("response", "map('lang', lang)"),
        ("snippet", "text"),
        ("title", "lang"),
    ]),
    "mongodb": ("events", "event_type", [
        ("id", "md5(cast(event_id as {s}))"),
        ("comment", "props"),
        ("votes_count", "cast(user_id % 100 as int)"),
        ("os", "'ios'"),
        ("os_version", "'13'"),
        ("country", "'BR'"),
        ("age", "cast(event_id % 80 as int)"),
        ("customer_id", "cast(user_id as {s})"),
        ("cpf", "lpad(cast(event_id as {s}), 11, '0')"),
        ("app_version", "'1.2.3'"),
        ("rating", "cast(event_id % 6 as int)"),
        ("timestamp", "cast(ts as {s})"),
        ("app", "event_type"),
    ]),
    "apple_store": ("orders", "o_orderstatus", [
        ("author_name", "concat('client ', cast(o_custkey as {s}))"),
        ("author_uri", "concat('client/', cast(o_custkey as {s}))"),
        ("content", "o_orderstatus"),
        ("content_attributes_label", "'Application'"),
        ("content_attributes_term", "'Application'"),
        ("id", "cast(o_orderkey as {s})"),
        ("im_rating", "cast(o_orderkey % 6 as {s})"),
        ("im_version", "'1.2'"),
        ("im_votecount", "'0'"),
        ("im_votesum", "'0'"),
        ("link_attributes_href", "concat('review/', cast(o_orderkey as {s}))"),
        ("link_attributes_related", "'related'"),
        ("title", "o_orderpriority"),
        ("updated", "cast(o_orderdate as {s})"),
    ]),
}
# Literal columns that complete the silver schema of the lake copies.
SEGMENTO = "retail"
APPLE_UPDATED = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")"
# --- end fixed values -----------------------------------------------------------

_DIALECTS = {
    "spark": {"s": "string", "r1": "$1", "r2": "$2", "r3": "$3", "r4": "$4", "r5": "$5"},
    "duckdb": {"s": "varchar", "r1": r"\1", "r2": r"\2", "r3": r"\3", "r4": r"\4", "r5": r"\5"},
}


def review_exprs(source: str, dialect: str) -> tuple[str, str, list[tuple[str, str]]]:
    table, key, cols = REVIEW_FIXTURES[source]
    d = _DIALECTS[dialect]
    uuid = _UUID.format(**d)
    return table, key, [(name, tpl.format(uuid=uuid, **d)) for name, tpl in cols]


def review_sql(source: str) -> str:
    """DuckDB SELECT producing the keyed review table (oracle side)."""
    table, key, cols = review_exprs(source, "duckdb")
    body = ",\n       ".join(f"{expr} as {name}" for name, expr in cols)
    return f"select {key},\n       {body}\nfrom {table}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    """Several driver tables, opened concurrently."""
    return read_many(spark, {n: f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names})


def review_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Keyed review table: key column first, then the rule-bearing columns."""
    tbl, key, cols = review_exprs(source, "spark")
    return table(spark, sf_dir, tbl).selectExpr(key, *[f"{e} as `{n}`" for n, e in cols])


def silver_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The same rows shaped exactly as the expected silver schema (no key):
    what an upstream job would land in ``<base>/silver/.../odate=D``."""
    tbl, key, cols = review_exprs(source, "spark")
    exprs = dict(cols)
    exprs["segmento"] = f"'{SEGMENTO}'"
    if source == "apple_store":
        exprs["updated"] = APPLE_UPDATED
    schema = expected_schema(source, "silver")
    out = table(spark, sf_dir, tbl).selectExpr(
        *[f"{exprs[f.name]} as `{f.name}`" for f in schema.fields if f.name in exprs])
    # a row's own values as its one earlier version: nested values are written,
    # quarantined and read back like the others
    hist = schema["historical_data"].dataType
    past = F.struct(*[F.col(f"`{n}`").cast("string").alias(n) for n in hist.elementType.names])
    return out.select(*[
        (F.array(past).cast(hist) if f.name == "historical_data" else F.col(f"`{f.name}`")).alias(f.name)
        for f in schema.fields
    ])


def bronze_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Bronze-shaped rows plus an ``app_folder`` column naming the app
    sub-folder each row lands in (it becomes the folder, not a data column)."""
    tbl, app_expr, cols = BRONZE_FIXTURES[source]
    d = _DIALECTS["spark"]
    uuid = _UUID.format(**d)
    exprs = [f"{tpl.format(uuid=uuid, **d)} as `{name}`" for name, tpl in cols]
    return table(spark, sf_dir, tbl).selectExpr(*exprs, f"{app_expr} as app_folder")
