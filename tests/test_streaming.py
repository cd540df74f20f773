"""Incremental pattern check over landed files."""

from tollgate.functions import SILVER_RULES
from tollgate.operators import rejects
from tollgate.sources.lake import read_parquet, write_leaf
from tollgate.sources.reviews import review_source
from tollgate.streaming import drift_path, quarantine_stream, rejected_rows

from .conftest import SF001


def test_stream_quarantine_equals_batch_and_restarts_cleanly(spark, workdir):
    rules = SILVER_RULES["mongodb"]
    src = review_source(spark, SF001, "mongodb")
    landing, out, ckpt = f"{workdir}/landing", f"{workdir}/out", f"{workdir}/ckpt"
    write_leaf(src.filter("event_id % 2 = 0").repartition(2), f"{landing}/part=a")
    q = quarantine_stream(spark, landing, src.schema, rules, out, ckpt)
    q.awaitTermination()
    # a second load lands; a restarted query only processes the new files
    write_leaf(src.filter("event_id % 2 = 1").repartition(2), f"{landing}/part=b")
    q2 = quarantine_stream(spark, landing, src.schema, rules, out, ckpt)
    q2.awaitTermination()
    expected = rejects(src, rules).count()
    back = read_parquet(spark, out)
    assert back.count() == rejected_rows(spark, out) == expected
    assert back.columns == src.columns + ["failed_columns", "validation", "batch_id"]
    assert read_parquet(spark, drift_path(out)).count() == 0


def test_rejects_are_counted_over_all_batches(spark, workdir):
    rules, landing, out = SILVER_RULES["apple_store"], f"{workdir}/landing", f"{workdir}/out"
    src = review_source(spark, SF001, "apple_store")
    write_leaf(src.repartition(6), landing)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        q = quarantine_stream(spark, landing, src.schema, rules, out, f"{workdir}/ckpt", max_files_per_trigger=1)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert rejected_rows(spark, out) == rejects(src, rules).count()


def test_files_without_a_declared_column_are_reported(spark, workdir):
    rules, landing, out = SILVER_RULES["apple_store"], f"{workdir}/landing", f"{workdir}/out"
    src = review_source(spark, SF001, "apple_store")
    write_leaf(src.filter("im_rating = '1'").coalesce(1), f"{landing}/part=a")
    write_leaf(src.filter("im_rating <> '1'").drop("title").coalesce(1), f"{landing}/part=b")
    quarantine_stream(spark, landing, src.schema, rules, out, f"{workdir}/ckpt").awaitTermination()
    assert rejected_rows(spark, out) == rejects(src.filter("im_rating = '1'"), rules).count()
    report = read_parquet(spark, drift_path(out)).collect()
    assert len(report) == 1 and "part=b" in report[0]["file"]
    assert [d["column_name"] for d in report[0]["differences"]] == ["title"]
