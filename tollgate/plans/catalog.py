"""Query catalog: every operator as a (spark, sf_dir) -> DataFrame callable,
with its independent DuckDB SQL. Imported by ``__spark_entry__``.

All keys read the driver's tables (or review tables Spark projects from
them) in full. Keys that exercise lake I/O write under a fresh folder of
the shared directory named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.review_rules import SILVER_RULES
from ..functions.rules import (
    FAILED_COLUMNS, VALIDATION, cast_regex, not_null, regex, violated,
)
from ..operators.patterns import (
    annotate, joined_failures, rejects, rule_failure_counts, valid, valid_invalid_counts,
)
from ..operators.schemas import (
    DOUBLE, INT, LONG, STRING, expected_schema, fields, folder_schema_report, schema_diff, schema_report,
)
from ..operators.volumetry import emptiness, volumetry_report
from ..session import fresh_run_dir
from ..sources.lake import (
    land_by_app, pattern_out_path, read_many, read_parquet, read_quarantine, source_path, source_root,
    with_leaf_dir, write_leaf, write_leaves,
)
from ..sources.reviews import (
    BRONZE_FIXTURES, REVIEW_FIXTURES, bronze_source, review_source, review_sql, silver_source, table,
    tables,
)
from ..streaming.quarantine import drift_path, quarantine_stream
from . import oracle as O
from .run import job_failures_path, run_metrics_path, run_quality

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
REVIEWS = ("google_play", "mongodb", "apple_store")
RUN_ODATE = "20240101"

_TS, _F = T.TimestampNTZType(), T.FloatType()

# --- fixed values: column contracts of the driver tables (TESTDATA.md) ----------
TABLE_CONTRACTS: dict[str, T.StructType] = {
    "region": fields(("r_regionkey", INT), ("r_name", STRING)),
    "nation": fields(("n_nationkey", INT), ("n_name", STRING), ("n_regionkey", INT)),
    "customer": fields(("c_custkey", LONG), ("c_name", STRING), ("c_nationkey", INT), ("c_acctbal", DOUBLE),
                       ("c_mktsegment", STRING)),
    "supplier": fields(("s_suppkey", LONG), ("s_name", STRING), ("s_nationkey", INT), ("s_acctbal", DOUBLE)),
    "part": fields(("p_partkey", LONG), ("p_name", STRING), ("p_brand", STRING), ("p_type", STRING), ("p_size", INT),
                   ("p_retailprice", DOUBLE)),
    "orders": fields(("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderstatus", STRING), ("o_totalprice", DOUBLE),
                     ("o_orderdate", _TS), ("o_orderpriority", STRING)),
    "lineitem": fields(("l_orderkey", LONG), ("l_partkey", LONG), ("l_suppkey", LONG), ("l_linenumber", INT),
                       ("l_quantity", DOUBLE), ("l_extendedprice", DOUBLE), ("l_discount", DOUBLE), ("l_tax", DOUBLE),
                       ("l_returnflag", STRING), ("l_linestatus", STRING), ("l_shipdate", _TS)),
    "events": fields(("event_id", LONG), ("ts", _TS), ("user_id", LONG), ("event_type", STRING), ("value", DOUBLE),
                     ("props", STRING)),
    "documents": fields(("doc_id", LONG), ("text", STRING), ("lang", STRING), ("source", STRING), ("n_chars", LONG)),
    "embeddings": fields(("vec_id", LONG), ("embedding", T.ArrayType(_F, True)), ("label", INT)),
    "pages": fields(("page_id", LONG), ("url", STRING), ("html", STRING)),
    "benchmark": fields(("item_id", LONG), ("text", STRING)),
    "labels": fields(("doc_id", LONG), ("quality", INT), ("toxic", INT)),
    "conversations": fields(("conv_id", LONG), ("turn", LONG), ("role", STRING), ("text", STRING)),
}
CONTRACT_LAYER = "raw"
# Single-rule keys: priority codes "<1-3>-<WORD>"; a 0-5 rating read as string.
PRIORITY_RULE = regex("o_orderpriority", r"^[1-3]-[A-Z]+$")
VALUE_RULE = cast_regex("value", r"^[0-5](\.\d+)?$")
# --- end fixed values -------------------------------------------------------------

_KEYS = {s: REVIEW_FIXTURES[s][1] for s in REVIEWS}
# null-safe split: every order lands in exactly one app folder
_GLOB_APPS = (("app1", "o_orderstatus is not distinct from 'F'"),
              ("app2", "not (o_orderstatus is not distinct from 'F')"))


def _contract(name: str) -> T.StructType:
    return TABLE_CONTRACTS[name]


def _review(spark, sf, src):
    return review_source(spark, sf, src)


def _comparable(df: DataFrame) -> DataFrame:
    """Annotated frame with the failed list joined into one string."""
    return df.select(*[c for c in df.columns if c not in (FAILED_COLUMNS, VALIDATION)],
                     joined_failures().alias("failed"), VALIDATION)


# ---- scans ------------------------------------------------------------------------

def q_parquet_scan(spark, sf):
    return read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet")


def q_dated_scan(spark, sf):
    base = fresh_run_dir(spark, "dated_scan")
    write_leaf(table(spark, sf, "orders"), source_path(base, "silver", "orders", RUN_ODATE))
    return read_parquet(spark, source_path(base, "silver", "orders", RUN_ODATE))


def q_glob_scan(spark, sf):
    base = fresh_run_dir(spark, "glob_scan")
    orders = table(spark, sf, "orders")
    root = source_root(base, "bronze", "orders")
    write_leaves({f"{root}/{app}/odate={RUN_ODATE}": orders.filter(cond) for app, cond in _GLOB_APPS})
    return with_leaf_dir(read_parquet(spark, source_path(base, "bronze", "orders", RUN_ODATE)))


# ---- volumetry --------------------------------------------------------------------

def _all_sources(spark, sf):
    srcs = tables(spark, sf, TABLES)
    srcs.update({s: _review(spark, sf, s) for s in REVIEWS})
    return srcs


def q_volumetry_report(spark, sf):
    return volumetry_report(spark, tables(spark, sf, TABLES))


# rows that no table holds, for a source that arrives empty
_EMPTY_SOURCE = ("orders", "o_orderkey is null and o_orderkey is not null")


def q_volumetry_gate(spark, sf):
    srcs = _all_sources(spark, sf)
    name, nothing = _EMPTY_SOURCE
    return emptiness(spark, {**srcs, "derived_empty": srcs[name].filter(nothing), "never_landed": None})


# ---- schema -------------------------------------------------------------------------

def _schema_inputs(spark, sf):
    actual = tables(spark, sf, TABLES)
    expected = {t: _contract(t) for t in TABLES}
    return actual, expected


_landed: dict[tuple, dict[str, DataFrame]] = {}


def _landed_reviews(spark, sf):
    """The keyed review tables as a load lands them: written to their dated
    silver leaf and read back (schemas are checked on Parquet, where every
    field is nullable, never on an in-memory projection). Landed once for the
    three schema keys of a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _landed:
        base = fresh_run_dir(spark, "schema")
        leaves = {s: source_path(base, "silver", s, RUN_ODATE) for s in REVIEWS}
        write_leaves({leaves[s]: _review(spark, sf, s) for s in REVIEWS})
        _landed[key] = read_many(spark, leaves)
    return _landed[key]


def _schema_frames(spark, sf, fn):
    actual, expected = _schema_inputs(spark, sf)
    raw = fn(spark, actual, expected, CONTRACT_LAYER)
    rev_expected = {s: expected_schema(s, "silver") for s in REVIEWS}
    return raw.unionByName(fn(spark, _landed_reviews(spark, sf), rev_expected, "silver"))


def q_schema_report(spark, sf):
    return _schema_frames(spark, sf, schema_report).select("source", "layer", "validation_status")


def q_schema_report_mismatches(spark, sf):
    return (_schema_frames(spark, sf, schema_report)
            .filter("validation_status = 'no_match'")
            .select("source", "layer", "validation_status"))


def q_schema_diff(spark, sf):
    return _schema_frames(spark, sf, schema_diff)


# ---- single rules ---------------------------------------------------------------------

def q_rule_regex(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", violated(PRIORITY_RULE).alias("violated"))


def q_rule_not_null(spark, sf):
    return _review(spark, sf, "mongodb").select("event_id", violated(not_null("customer_id")).alias("violated"))


def q_rule_cast_regex(spark, sf):
    return table(spark, sf, "events").select("event_id", violated(VALUE_RULE).alias("violated"))


def q_rule_null_passes(spark, sf):
    iso = SILVER_RULES["google_play"][3]
    return _review(spark, sf, "google_play").select("doc_id", violated(iso).alias("violated"))


def q_failed_columns(spark, sf):
    ann = annotate(_review(spark, sf, "mongodb"), SILVER_RULES["mongodb"])
    return ann.select("event_id", joined_failures().alias("failed"))


def q_row_classification(spark, sf):
    ann = annotate(_review(spark, sf, "apple_store"), SILVER_RULES["apple_store"])
    return ann.select("o_orderkey", VALIDATION)


# ---- composites --------------------------------------------------------------------------

def _patterns(src):
    def q(spark, sf):
        ann = annotate(_review(spark, sf, src), SILVER_RULES[src])
        return ann.select(_KEYS[src], joined_failures().alias("failed"), VALIDATION)
    q.__name__ = f"q_{src}_patterns"
    return q


def _rejects(src):
    def q(spark, sf):
        return _comparable(rejects(_review(spark, sf, src), SILVER_RULES[src]))
    q.__name__ = f"q_{src}_rejects"
    return q


def q_google_play_valid(spark, sf):
    return valid(_review(spark, sf, "google_play"), SILVER_RULES["google_play"]).drop(FAILED_COLUMNS)


def q_valid_invalid_counts(spark, sf):
    frames = [valid_invalid_counts(_review(spark, sf, s), SILVER_RULES[s], s) for s in REVIEWS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def q_rule_failure_counts(spark, sf):
    frames = [rule_failure_counts(_review(spark, sf, s), SILVER_RULES[s], s) for s in REVIEWS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# ---- lake round trips ------------------------------------------------------------------------

def _write_apple_rejects(spark, sf, quality):
    rej = rejects(_review(spark, sf, "apple_store"), SILVER_RULES["apple_store"])
    write_leaf(rej, pattern_out_path(quality, "apple_store", RUN_ODATE))


def q_quarantine_roundtrip(spark, sf):
    quality = fresh_run_dir(spark, "quarantine")
    _write_apple_rejects(spark, sf, quality)
    return _comparable(read_parquet(spark, pattern_out_path(quality, "apple_store", RUN_ODATE)))


def q_odate_layout(spark, sf):
    quality = fresh_run_dir(spark, "odate_layout")
    _write_apple_rejects(spark, sf, quality)
    return _comparable(read_quarantine(spark, quality, "apple_store", [RUN_ODATE]))


def _silver_lake(spark, sf, label, sources=REVIEWS):
    root = fresh_run_dir(spark, label)
    base, quality = f"{root}/lake", f"{root}/quality"
    write_leaves({source_path(base, "silver", s, RUN_ODATE): silver_source(spark, sf, s) for s in sources})
    return base, quality


# the events that a day without high values would bring: none, or a load
_RARE_VALUE = "value > 1000000"


def q_failure_log_roundtrip(spark, sf):
    """mongodb lands only its rare events: whether the gate finds it empty, and
    what the failure log holds, depends on the table. apple_store never lands."""
    base, quality = _silver_lake(spark, sf, "failure_log", sources=("google_play",))
    keyed = table(spark, sf, "events").filter(_RARE_VALUE)
    write_leaf(keyed, source_path(base, "silver", "mongodb", RUN_ODATE))
    run_quality(spark, base, "silver", RUN_ODATE, quality, raise_on_failure=False)
    return read_parquet(spark, job_failures_path(quality)).select("layer", "odate", "stage", "error")


def q_quality_run_summary(spark, sf):
    base, quality = _silver_lake(spark, sf, "run_summary")
    res = run_quality(spark, base, "silver", RUN_ODATE, quality)
    return res.summary(spark).drop("elapsed_sec")


def q_run_metrics_roundtrip(spark, sf):
    """What a run appends to the metrics table, read back without clock and id;
    timed says that the row has its own elapsed time."""
    base, quality = _silver_lake(spark, sf, "run_metrics")
    run_quality(spark, base, "silver", RUN_ODATE, quality, write_valid=True)
    return read_parquet(spark, run_metrics_path(quality)).select(
        "odate", "layer", "source", "check", "status", "n_rows", "n_bad",
        F.coalesce(F.col("elapsed_sec") >= 0, F.lit(False)).alias("timed"))


def q_partial_run_summary(spark, sf):
    """google_play lands with a column that clashes with the annotation: it is
    recorded, the other two sources keep their counts."""
    base, quality = _silver_lake(spark, sf, "partial_run")
    leaf = source_path(base, "silver", "google_play", RUN_ODATE)
    write_leaf(silver_source(spark, sf, "google_play").withColumn(VALIDATION, F.lit("own")), leaf)
    res = run_quality(spark, base, "silver", RUN_ODATE, quality)
    return res.summary(spark).drop("elapsed_sec").withColumn("run_status", F.lit(res.status))


def _drifting_bronze(spark, sf, root):
    """Bronze apple_store, a folder per order status, and four late deliveries
    of the urgent orders: a column too few, columns reversed, another type, and
    a folder whose two files have different schemas."""
    src = bronze_source(spark, sf, "apple_store")
    land_by_app(src, root, "bronze", "apple_store", RUN_ODATE)
    urgent = src.filter("title = '1-URGENT'").drop("app_folder")
    late = {"short": urgent.drop("title"), "reversed": urgent.select(*reversed(urgent.columns)),
            "typed": urgent.withColumn("im_rating", F.col("im_rating").cast("int"))}
    folder = source_root(root, "bronze", "apple_store") + "/app_folder={}/odate=" + RUN_ODATE
    write_leaves({folder.format(name): df for name, df in late.items()})
    write_leaf(urgent.filter("content = 'F'"), folder.format("mixed"))
    urgent.filter("not (content <=> 'F')").drop("updated").write.mode("append").parquet(folder.format("mixed"))


def q_bronze_drift_folders(spark, sf):
    root = fresh_run_dir(spark, "bronze_drift")
    _drifting_bronze(spark, sf, root)
    return folder_schema_report(spark, source_path(root, "bronze", "apple_store", RUN_ODATE),
                                expected_schema("apple_store", "bronze"))


def q_bronze_drift_run(spark, sf):
    """The run over the same load: the verdict, and the clash of types on record."""
    root = fresh_run_dir(spark, "bronze_drift_run")
    _drifting_bronze(spark, sf, f"{root}/lake")
    res = run_quality(spark, f"{root}/lake", "bronze", RUN_ODATE, f"{root}/quality", sources=("apple_store",))
    failures = read_parquet(spark, job_failures_path(f"{root}/quality")).select("stage", "source", "error")
    return (res.summary(spark).select("source", "check", "status", "n_rows", "n_bad")
            .withColumn("run_status", F.lit(res.status)).join(failures, "source"))


def q_silver_two_schemas(spark, sf):
    """A silver leaf of two files, one without content and title: no match, though
    the footer that gives the frame its schema may be the whole one."""
    root = fresh_run_dir(spark, "silver_two")
    leaf = source_path(f"{root}/lake", "silver", "apple_store", RUN_ODATE)
    src = silver_source(spark, sf, "apple_store")
    write_leaf(src.filter("im_rating = '1'"), leaf)
    src.filter("not (im_rating <=> '1')").drop("content", "title").write.mode("append").parquet(leaf)
    return folder_schema_report(spark, leaf, expected_schema("apple_store", "silver"))


def q_dated_landings(spark, sf):
    """Two dates land, the second again without one app: both dates are there,
    and nothing of the first landing of the second is."""
    root = fresh_run_dir(spark, "dated_landings")
    src = bronze_source(spark, sf, "apple_store")
    land_by_app(src, root, "bronze", "apple_store", RUN_ODATE)
    land_by_app(src, root, "bronze", "apple_store", "20240102")
    land_by_app(src.filter("not (content <=> 'F')"), root, "bronze", "apple_store", "20240102")
    return (read_parquet(spark, source_root(root, "bronze", "apple_store")).groupBy("app_folder", "odate")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_bronze_run_summary(spark, sf):
    root = fresh_run_dir(spark, "bronze_run")
    base, quality = f"{root}/lake", f"{root}/quality"
    with ThreadPoolExecutor(max_workers=len(REVIEWS)) as pool:  # independent landings
        list(pool.map(lambda s: land_by_app(bronze_source(spark, sf, s), base, "bronze", s, RUN_ODATE),
                      REVIEWS))
    return run_quality(spark, base, "bronze", RUN_ODATE, quality).summary(spark).drop("elapsed_sec")


def q_bronze_folder_schemas(spark, sf):
    """Bronze apple_store landed per order status, plus a late delivery of
    the urgent orders in its own folder with one column added: the merged
    read hides where the drift is, the per-folder report names it."""
    root = fresh_run_dir(spark, "bronze_folders")
    src = bronze_source(spark, sf, "apple_store")
    land_by_app(src, root, "bronze", "apple_store", RUN_ODATE)
    late = (src.filter("title = '1-URGENT'").drop("app_folder")
               .withColumn("priority_rank", F.lit(1)))
    folder = f"{source_root(root, 'bronze', 'apple_store')}/app_folder=late/odate={RUN_ODATE}"
    write_leaf(late, folder)
    return folder_schema_report(spark, source_path(root, "bronze", "apple_store", RUN_ODATE),
                                expected_schema("apple_store", "bronze"))


def q_apple_store_rejects_stream(spark, sf):
    """The apple_store load lands as several files; a streaming query drains
    them in bounded micro-batches into the quarantine folder."""
    root = fresh_run_dir(spark, "stream")
    landing = f"{root}/landing"
    src = _review(spark, sf, "apple_store")
    # two landings (no shuffle): one folder per delivery, drained one file per trigger
    write_leaves({f"{landing}/delivery=1": src.filter("app is not distinct from 'A B'"),
                  f"{landing}/delivery=2": src.filter("not (app is not distinct from 'A B')")})
    q = quarantine_stream(spark, landing, src.schema, SILVER_RULES["apple_store"],
                          f"{root}/quarantine", f"{root}/checkpoint", max_files_per_trigger=1)
    q.awaitTermination()
    return _comparable(read_parquet(spark, f"{root}/quarantine").drop("batch_id"))


def q_stream_drift(spark, sf):
    """A third delivery lacks title: its rows are reported, not read as NULL, and
    the others are checked. One row per delivery: rejected rows, files reported."""
    root = fresh_run_dir(spark, "stream_drift")
    landing, out = f"{root}/landing", f"{root}/quarantine"
    src = _review(spark, sf, "apple_store")
    write_leaves({f"{landing}/delivery=1": src.filter("app is not distinct from 'A B'"),
                  f"{landing}/delivery=2": src.filter("not (app is not distinct from 'A B')").drop("title")})
    quarantine_stream(spark, landing, src.schema, SILVER_RULES["apple_store"], out, f"{root}/checkpoint",
                      max_files_per_trigger=1).awaitTermination()
    rejected = (read_parquet(spark, out).groupBy(F.lit("1").alias("delivery"))
                .agg(F.count(F.lit(1)).alias("n_rejected")).withColumn("missing", F.lit("")))
    reported = (read_parquet(spark, drift_path(out)).select(
        F.regexp_extract("file", "delivery=([0-9]+)", 1).alias("delivery"), F.lit(0).cast("long").alias("n_rejected"),
        F.array_join(F.transform("differences", lambda d: d["column_name"]), ",").alias("missing")).distinct())
    return rejected.unionByName(reported)


def q_stream_typed_delivery(spark, sf):
    """Of three deliveries the second holds im_rating as a number: a read with the
    declared schema fails on it. It is reported, and the third is checked like the
    first. One row per delivery: its rejected rows, and the types that were reported."""
    root = fresh_run_dir(spark, "stream_typed")
    landing, out = f"{root}/landing", f"{root}/quarantine"
    src = _review(spark, sf, "apple_store")
    for k in (1, 2, 3):  # one after the other: a file stream takes the oldest first
        df = src.filter(f"o_orderkey % 3 = {k - 1}")
        write_leaf(df.withColumn("im_rating", F.col("im_rating").cast("int")) if k == 2 else df, f"{landing}/delivery={k}")
    quarantine_stream(spark, landing, src.schema, SILVER_RULES["apple_store"], out, f"{root}/checkpoint",
                      max_files_per_trigger=1).awaitTermination()
    rejected = (read_parquet(spark, out).groupBy((F.col("o_orderkey") % 3 + 1).cast("string").alias("delivery"))
                .agg(F.count(F.lit(1)).alias("n_rejected")).withColumn("reported", F.lit("")))
    types = F.transform("differences", lambda d: F.concat_ws(" ", d["column_name"], d["expected_type"], d["actual_type"]))
    drift = read_parquet(spark, drift_path(out)).select(
        F.regexp_extract("file", "delivery=([0-9]+)", 1).alias("delivery"), F.lit(0).cast("long").alias("n_rejected"),
        F.array_join(types, ",").alias("reported")).distinct()
    return rejected.unionByName(drift)


def q_unregistered_source_run(spark, sf):
    """The events land as a source that no schema is registered for: its schema check
    raises and is on record, the other two sources keep all their rows and results."""
    base, quality = _silver_lake(spark, sf, "unregistered", sources=("google_play", "apple_store"))
    write_leaf(table(spark, sf, "events"), source_path(base, "silver", "event_feed", RUN_ODATE))
    res = run_quality(spark, base, "silver", RUN_ODATE, quality, sources=("google_play", "event_feed", "apple_store"))
    failed = read_parquet(spark, job_failures_path(quality)).select("stage", "source", "error")
    return (res.summary(spark).drop("elapsed_sec").withColumn("run_status", F.lit(res.status))
            .join(failed, "source", "left"))


def q_unreadable_files_log(spark, sf):
    """Beside mongodb's load lies a text file for each nation. The rows that can be
    read are checked, and every such file is a row of the failure log."""
    base, quality = _silver_lake(spark, sf, "unreadable", sources=("mongodb",))
    names = table(spark, sf, "nation").select(F.col("n_name").alias("value")).coalesce(1)
    names.write.mode("append").option("maxRecordsPerFile", 1).text(source_path(base, "silver", "mongodb", RUN_ODATE))
    res = run_quality(spark, base, "silver", RUN_ODATE, quality, sources=("mongodb",))
    log = (read_parquet(spark, job_failures_path(quality)).filter("error like '%.txt: %'")
           .groupBy("source", F.col("stage").alias("check")).agg(F.count_distinct("error").alias("n_logged")))
    return (res.summary(spark).drop("elapsed_sec").withColumn("run_status", F.lit(res.status))
            .join(log, ["source", "check"], "left"))


#: Java does not know this way to name a group: a job with the rule fails.
_BROKEN_RULE = regex("comment", "(?P<x>a)", label="broken")


def q_failed_rerun_keeps_rejects(spark, sf):
    """A second run of the day, whose write for mongodb fails: the rejects of the
    first run are still there, whole, and those of the other sources are new."""
    base, quality = _silver_lake(spark, sf, "failed_rerun")
    run_quality(spark, base, "silver", RUN_ODATE, quality)
    again = run_quality(spark, base, "silver", RUN_ODATE, quality, rules={"mongodb": [*SILVER_RULES["mongodb"], _BROKEN_RULE]})
    counts = [read_quarantine(spark, quality, s, [RUN_ODATE]).agg(F.count(F.lit(1)).alias("n_rejected")).select(
        F.lit(s).alias("source"), "n_rejected") for s in REVIEWS]
    second = again.summary(spark).filter("check = 'pattern'").select("source", F.col("status").alias("second_run"))
    return reduce(DataFrame.unionByName, counts).join(second, "source")


def q_silver_typed_variants(spark, sf):
    """Part of apple_store lands with its rating as a number: the load does not match,
    and the rows of both kinds of files are checked by the same rules."""
    root = fresh_run_dir(spark, "typed_variants")
    leaf = source_path(f"{root}/lake", "silver", "apple_store", RUN_ODATE)
    src = silver_source(spark, sf, "apple_store")
    number = F.coalesce(F.col("im_rating").isin("1", "2", "3"), F.lit(False))
    write_leaf(src.filter(number).withColumn("im_rating", F.col("im_rating").cast("int")), leaf)
    src.filter(~number).write.mode("append").parquet(leaf)
    res = run_quality(spark, f"{root}/lake", "silver", RUN_ODATE, f"{root}/quality", sources=("apple_store",))
    kept = (read_quarantine(spark, f"{root}/quality", "apple_store", [RUN_ODATE])
            .agg(F.count_if(number).alias("n_numbers"), F.count_if(~number).alias("n_others")))
    return (res.summary(spark).drop("elapsed_sec").withColumn("run_status", F.lit(res.status))
            .join(kept.withColumn("source", F.lit("apple_store")), "source"))


def q_rebalanced_run_summary(spark, sf):
    """Rejects go through an exchange before they are written; row totals come from
    the footers, so that no map stage counts."""
    base, quality = _silver_lake(spark, sf, "rebalanced")
    res = run_quality(spark, base, "silver", RUN_ODATE, quality, rebalance_rejects=True)
    return res.summary(spark).drop("elapsed_sec")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "parquet_scan": q_parquet_scan,
        "dated_scan": q_dated_scan,
        "glob_scan": q_glob_scan,
        "volumetry_report": q_volumetry_report,
        "volumetry_gate": q_volumetry_gate,
        "schema_report": q_schema_report,
        "schema_report_mismatches": q_schema_report_mismatches,
        "schema_diff": q_schema_diff,
        "rule_regex": q_rule_regex,
        "rule_not_null": q_rule_not_null,
        "rule_cast_regex": q_rule_cast_regex,
        "rule_null_passes": q_rule_null_passes,
        "failed_columns": q_failed_columns,
        "row_classification": q_row_classification,
        **{f"{s}_patterns": _patterns(s) for s in REVIEWS},
        **{f"{s}_rejects": _rejects(s) for s in REVIEWS},
        "google_play_valid": q_google_play_valid,
        "valid_invalid_counts": q_valid_invalid_counts,
        "rule_failure_counts": q_rule_failure_counts,
        "quarantine_roundtrip": q_quarantine_roundtrip,
        "odate_layout": q_odate_layout,
        "failure_log_roundtrip": q_failure_log_roundtrip,
        "quality_run_summary": q_quality_run_summary,
        "bronze_run_summary": q_bronze_run_summary,
        "bronze_folder_schemas": q_bronze_folder_schemas,
        "apple_store_rejects_stream": q_apple_store_rejects_stream,
        "stream_drift": q_stream_drift,
        "run_metrics_roundtrip": q_run_metrics_roundtrip,
        "partial_run_summary": q_partial_run_summary,
        "bronze_drift_folders": q_bronze_drift_folders,
        "bronze_drift_run": q_bronze_drift_run,
        "silver_two_schemas": q_silver_two_schemas,
        "dated_landings": q_dated_landings,
        "stream_typed_delivery": q_stream_typed_delivery,
        "unregistered_source_run": q_unregistered_source_run,
        "unreadable_files_log": q_unreadable_files_log,
        "failed_rerun_keeps_rejects": q_failed_rerun_keeps_rejects,
        "silver_typed_variants": q_silver_typed_variants,
        "rebalanced_run_summary": q_rebalanced_run_summary,
    }


# =============================== oracle SQL ===========================================

def _review_annotated_sql(src: str) -> str:
    return O.annotated_sql(review_sql(src), SILVER_RULES[src])


def _schema_oracle_inputs():
    expected = {(t, CONTRACT_LAYER): _contract(t) for t in TABLES}
    expected.update({(s, "silver"): expected_schema(s, "silver") for s in REVIEWS})
    tables = {(t, CONTRACT_LAYER): t for t in TABLES}
    tables.update({(s, "silver"): review_sql(s) for s in REVIEWS})
    return expected, tables


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["parquet_scan"] = "select * from orders"
    sql["dated_scan"] = "select * from orders"
    app_case = " ".join(f"when {cond} then '{app}'" for app, cond in _GLOB_APPS)
    sql["glob_scan"] = f"select *, case {app_case} end as app_dir from orders"
    sql["volumetry_report"] = "\nunion all\n".join(
        f"select '{t}' as source, count(*) as n_rows, "
        f"case when count(*) = 0 then 'empty' else 'ok' end as status from {t}" for t in TABLES)
    empty = "count(*) = 0 as is_empty, case when count(*) = 0 then 'empty' else 'ok' end as status"
    gate = [f"select '{t}' as source, {empty} from {t}" for t in TABLES]
    gate += [f"select '{s}' as source, {empty} from ({review_sql(s)}) r" for s in REVIEWS]
    gate += [f"select 'derived_empty' as source, {empty} from {_EMPTY_SOURCE[0]} where {_EMPTY_SOURCE[1]}",
             "select 'never_landed' as source, true as is_empty, 'missing' as status"]
    sql["volumetry_gate"] = "\nunion all\n".join(gate)
    exp, tabs = _schema_oracle_inputs()
    sql["schema_report"] = O.schema_report_sql(exp, tabs)
    sql["schema_report_mismatches"] = (
        f"select * from ({O.schema_report_sql(exp, tabs)}) r where validation_status = 'no_match'")
    sql["schema_diff"] = O.schema_diff_sql(exp, tabs)
    sql["rule_regex"] = f"select o_orderkey, {O.violated_sql(PRIORITY_RULE)} as violated from orders"
    sql["rule_not_null"] = (f"select event_id, {O.violated_sql(not_null('customer_id'))} as violated "
                            f"from ({review_sql('mongodb')}) r")
    sql["rule_cast_regex"] = f"select event_id, {O.violated_sql(VALUE_RULE)} as violated from events"
    sql["rule_null_passes"] = (f"select doc_id, {O.violated_sql(SILVER_RULES['google_play'][3])} as violated "
                               f"from ({review_sql('google_play')}) r")
    sql["failed_columns"] = f"select event_id, failed from ({_review_annotated_sql('mongodb')}) a"
    sql["row_classification"] = f"select o_orderkey, validation from ({_review_annotated_sql('apple_store')}) a"
    for s in REVIEWS:
        sql[f"{s}_patterns"] = f"select {_KEYS[s]}, failed, validation from ({_review_annotated_sql(s)}) a"
        sql[f"{s}_rejects"] = f"select * from ({_review_annotated_sql(s)}) a where validation = 'no_match'"
    sql["google_play_valid"] = (f"select * exclude (failed) from ({_review_annotated_sql('google_play')}) a "
                                f"where validation = 'match'")
    sql["valid_invalid_counts"] = "\nunion all\n".join(
        f"select '{s}' as source, count(*) as n_rows, count(*) filter (where not {O.any_violation_sql(SILVER_RULES[s])}) as n_valid, "
        f"count(*) filter (where {O.any_violation_sql(SILVER_RULES[s])}) as n_invalid from ({review_sql(s)}) r"
        for s in REVIEWS)
    sql["rule_failure_counts"] = "\nunion all\n".join(
        f"select '{s}' as source, '{r.name}' as column_name, "
        f"count(*) filter (where {O.violated_sql(r)}) as n_failed from ({review_sql(s)}) x"
        for s in REVIEWS for r in SILVER_RULES[s])
    sql["quarantine_roundtrip"] = sql["apple_store_rejects"]
    sql["apple_store_rejects_stream"] = sql["apple_store_rejects"]
    sql["odate_layout"] = (f"select *, cast({RUN_ODATE} as integer) as odate "
                           f"from ({_review_annotated_sql('apple_store')}) a where validation = 'no_match'")
    sql["failure_log_roundtrip"] = (
        f"select 'silver' as layer, '{RUN_ODATE}' as odate, 'volumetry' as stage, "
        f"'source load failed volumetry (' || case when (select count(*) from documents) = 0 then 'google_play: empty, ' else '' end "
        f"|| case when (select count(*) from events where {_RARE_VALUE}) = 0 then 'mongodb: empty, ' else '' end "
        f"|| 'apple_store: missing)' as error")
    summary = []
    for s in REVIEWS:
        r = review_sql(s)
        any_bad = O.any_violation_sql(SILVER_RULES[s])
        summary.append(f"select '{s}' as source, 'volumetry' as \"check\", 'ok' as status, count(*) as n_rows, "
                       f"cast(null as bigint) as n_bad from ({r}) r")
        summary.append(f"select '{s}' as source, 'schema' as \"check\", 'match' as status, "
                       f"cast(null as bigint) as n_rows, cast(0 as bigint) as n_bad")
        summary.append(f"select '{s}' as source, 'pattern' as \"check\", "
                       f"case when count(*) filter (where {any_bad}) > 0 then 'no_match' else 'match' end as status, "
                       f"count(*) as n_rows, count(*) filter (where {any_bad}) as n_bad from ({r}) r")
    sql["quality_run_summary"] = "\nunion all\n".join(summary)
    metrics = [f"select * from ({sql['quality_run_summary']}) s"]
    for s in REVIEWS:
        for r in SILVER_RULES[s]:
            bad = f"count(*) filter (where {O.violated_sql(r)})"
            metrics.append(f"select '{s}' as source, 'pattern.{r.name}' as \"check\", "
                           f"case when {bad} > 0 then 'no_match' else 'match' end as status, count(*) as n_rows, "
                           f"{bad} as n_bad from ({review_sql(s)}) r")
    sql["run_metrics_roundtrip"] = (
        f"select '{RUN_ODATE}' as odate, 'silver' as layer, source, \"check\", status, n_rows, n_bad, "
        f"not starts_with(\"check\", 'pattern.') as timed from ({' union all '.join(metrics)}) m")
    partial = f"select * from ({sql['quality_run_summary']}) s"
    own = "source = 'google_play'"
    sql["partial_run_summary"] = (
        f"select source, \"check\", case when {own} and \"check\" = 'schema' then 'no_match' "
        f"when {own} and \"check\" = 'pattern' then 'error' else status end as status, n_rows, "
        f"case when {own} and \"check\" = 'schema' then 1 when {own} and \"check\" = 'pattern' then null else n_bad end as n_bad, "
        f"'partial' as run_status from ({partial}) p")
    bronze = []
    for s in REVIEWS:
        tbl = BRONZE_FIXTURES[s][0]
        bronze.append(f"select '{s}' as source, 'volumetry' as \"check\", 'ok' as status, count(*) as n_rows, "
                      f"cast(null as bigint) as n_bad from {tbl}")
        bronze.append(f"select '{s}' as source, 'schema' as \"check\", 'match' as status, "
                      f"cast(null as bigint) as n_rows, cast(0 as bigint) as n_bad")
    sql["bronze_run_summary"] = "\nunion all\n".join(bronze)
    sql["bronze_folder_schemas"] = (
        "select distinct 'app_folder=' || o_orderstatus as folder, 'match' as validation_status, "
        "cast(0 as integer) as n_differences from orders\n"
        "union all\n"
        "select distinct 'app_folder=late' as folder, 'no_match' as validation_status, "
        "cast(1 as integer) as n_differences from orders where o_orderpriority = '1-URGENT'")
    urgent = "from orders where o_orderpriority = '1-URGENT'"
    # of 14 columns in reversed order none keeps its place
    drifted = (("short", 1), ("reversed", 14), ("typed", 1))
    sql["bronze_drift_folders"] = (
        "select distinct 'app_folder=' || o_orderstatus as folder, 'match' as validation_status, "
        "cast(0 as integer) as n_differences from orders\nunion all\n" + "\nunion all\n".join(
            f"select distinct 'app_folder={name}' as folder, 'no_match' as validation_status, "
            f"cast({n} as integer) as n_differences {urgent}" for name, n in drifted) +
        f"\nunion all\nselect 'app_folder=mixed' as folder, 'no_match' as validation_status, "
        f"cast(1 as integer) as n_differences {urgent} having count(*) filter (where o_orderstatus <> 'F') > 0")
    # short and mixed lack a column each, typed has one of another type, and every column is out of place in reversed
    sql["bronze_drift_run"] = (
        f"select 'apple_store' as source, c.\"check\", c.status, c.n_rows, c.n_bad, 'partial' as run_status, "
        f"'schema' as stage, 'files disagree on the type of a column: im_rating: int and string' as error from ("
        f"select 'volumetry' as \"check\", 'ok' as status, (select count(*) from orders) + 4 * (select count(*) {urgent}) as n_rows, "
        f"cast(null as bigint) as n_bad union all "
        f"select 'schema' as \"check\", 'no_match' as status, cast(null as bigint) as n_rows, cast(17 as bigint) as n_bad) c")
    sql["silver_two_schemas"] = (
        "select distinct 'appleStore' as folder, 'no_match' as validation_status, cast(2 as integer) as n_differences "
        "from orders where o_orderkey % 8 <> 1")
    sql["dated_landings"] = (
        f"select o_orderstatus as app_folder, {RUN_ODATE} as odate, count(*) as n_rows from orders group by 1\nunion all\n"
        f"select o_orderstatus as app_folder, 20240102 as odate, count(*) as n_rows from orders where o_orderstatus <> 'F' group by 1")
    sql["stream_drift"] = (
        f"select '1' as delivery, count(*) as n_rejected, '' as missing from ({_review_annotated_sql('apple_store')}) a "
        f"where validation = 'no_match' and app = 'A B'\nunion all\n"
        f"select distinct '2' as delivery, cast(0 as bigint) as n_rejected, 'title' as missing "
        f"from ({review_sql('apple_store')}) r where app <> 'A B'")
    bad = O.any_violation_sql(SILVER_RULES["apple_store"])
    sql["stream_typed_delivery"] = (
        f"select cast(o_orderkey % 3 + 1 as varchar) as delivery, count(*) as n_rejected, '' as reported "
        f"from ({_review_annotated_sql('apple_store')}) a where validation = 'no_match' and o_orderkey % 3 <> 1 group by 1\nunion all\n"
        f"select distinct '2' as delivery, cast(0 as bigint) as n_rejected, 'im_rating string int' as reported "
        f"from ({review_sql('apple_store')}) r where o_orderkey % 3 = 1")
    sql["unregistered_source_run"] = (
        f"select s.*, 'partial' as run_status, cast(null as varchar) as stage, cast(null as varchar) as error "
        f"from ({sql['quality_run_summary']}) s where source <> 'mongodb'\nunion all\n"
        f"select 'event_feed' as source, c.\"check\", c.status, case when c.\"check\" = 'volumetry' then n end as n_rows, "
        f"cast(null as bigint) as n_bad, 'partial' as run_status, 'schema' as stage, "
        f"'no expected schema is registered for ''event_feed'' in layer ''silver''' as error from (select count(*) as n from events) e, "
        f"(values ('volumetry', 'ok'), ('schema', 'error'), ('pattern', 'skipped')) c(\"check\", status)")
    sql["unreadable_files_log"] = (
        f"select source, \"check\", case when \"check\" = 'schema' then 'no_match' else status end as status, n_rows, n_bad, "
        f"'partial' as run_status, case when \"check\" = 'schema' then (select count(*) from nation) end as n_logged "
        f"from ({sql['quality_run_summary']}) s where source = 'mongodb'")
    sql["failed_rerun_keeps_rejects"] = (
        f"select source, n_bad as n_rejected, case when source = 'mongodb' then 'error' else status end as second_run "
        f"from ({sql['quality_run_summary']}) s where \"check\" = 'pattern'")
    number = "coalesce(im_rating in ('1', '2', '3'), false)"
    sql["silver_typed_variants"] = (
        f"select source, \"check\", case when \"check\" = 'schema' then 'no_match' else status end as status, n_rows, "
        f"case when \"check\" = 'schema' then 1 else n_bad end as n_bad, 'success' as run_status, k.* "
        f"from ({sql['quality_run_summary']}) s, (select count(*) filter (where {bad} and {number}) as n_numbers, "
        f"count(*) filter (where {bad} and not {number}) as n_others from ({review_sql('apple_store')}) r) k "
        f"where source = 'apple_store'")
    sql["rebalanced_run_summary"] = sql["quality_run_summary"]
    return sql
