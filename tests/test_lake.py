"""Lake tests in fresh folders: leaf and glob reads, missing / empty sources,
drift hidden by glob reads, idempotent re-runs, several schema failures."""

import os

from pyspark.sql import functions as F

from tollgate.functions import SILVER_RULES
from tollgate.operators import rejects, volumetry_gate, volumetry_report
from tollgate.operators.volumetry import VolumetryError
from tollgate.sources.lake import (
    load_source, pattern_out_path, read_parquet, source_path,
    source_root, with_leaf_dir, write_leaf,
)
from tollgate.sources.reviews import review_source, silver_source

import pytest

from .conftest import SF001

D = "20240102"


def test_silver_leaf_read_has_no_odate(spark, workdir):
    write_leaf(silver_source(spark, SF001, "google_play"), source_path(workdir, "silver", "google_play", D))
    df = read_parquet(spark, source_path(workdir, "silver", "google_play", D))
    assert "odate" not in df.columns
    parent = read_parquet(spark, source_root(workdir, "silver", "google_play"))
    assert dict(parent.dtypes)["odate"] == "int"


def test_bronze_glob_reads_every_app(spark, workdir):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    root = source_root(workdir, "bronze", "apple_store")
    write_leaf(orders.filter("o_orderstatus = 'F'"), f"{root}/app1/odate={D}")
    write_leaf(orders.filter("o_orderstatus <> 'F'"), f"{root}/app2/odate={D}")
    got = with_leaf_dir(read_parquet(spark, source_path(workdir, "bronze", "apple_store", D)))
    assert got.count() == orders.count()
    assert {r["app_dir"] for r in got.select("app_dir").distinct().collect()} == {"app1", "app2"}


def test_missing_and_empty_sources(spark, workdir):
    missing = load_source(spark, source_path(workdir, "silver", "mongodb", D), "mongodb")
    assert missing.state == "missing" and missing.df is None
    empty_leaf = source_path(workdir, "silver", "apple_store", D)
    write_leaf(silver_source(spark, SF001, "apple_store").limit(0), empty_leaf)
    empty = load_source(spark, empty_leaf, "apple_store")
    assert empty.state == "present"
    rep = {r["source"]: (r["n_rows"], r["status"]) for r in
           volumetry_report(spark, {"mongodb": None, "apple_store": empty.df}).collect()}
    assert rep == {"mongodb": (None, "missing"), "apple_store": (0, "empty")}
    with pytest.raises(VolumetryError) as ei:
        volumetry_gate(spark, {"mongodb": None, "apple_store": empty.df,
                               "google_play": silver_source(spark, SF001, "google_play")})
    assert ei.value.failures == {"mongodb": "missing", "apple_store": "empty"}


def test_drift_in_one_app_is_seen(spark, workdir):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    root = source_root(workdir, "bronze", "apple_store")
    write_leaf(orders, f"{root}/app1/odate={D}")
    write_leaf(orders.withColumn("z", F.lit("drift")), f"{root}/app2/odate={D}")
    from tollgate.operators.schemas import folder_schema_report
    glob = source_path(workdir, "bronze", "apple_store", D)
    got = {r["folder"]: (r["validation_status"], r["n_differences"])
           for r in folder_schema_report(spark, glob, orders.schema).collect()}
    assert got == {"app1": ("match", 0), "app2": ("no_match", 1)}


def test_files_of_any_name_and_depth_are_judged(spark, workdir):
    from tollgate.operators.schemas import file_schema_report
    from tollgate.session import move_path
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    leaf = f"{source_root(workdir, 'bronze', 'apple_store')}/app1/odate={D}"
    write_leaf(orders.coalesce(1), f"{workdir}/other")
    name = next(f for f in os.listdir(f"{workdir}/other".replace("file:", "")) if f.endswith(".parquet"))
    move_path(spark, f"{workdir}/other/{name}", f"{leaf}/delivered data")
    orders.drop("o_orderstatus").coalesce(1).write.parquet(f"{leaf}/hour=7")
    got = {r["file"].rsplit("odate=", 1)[1]: r for r in
           file_schema_report(spark, "x", f"{leaf}", orders.schema).collect()}
    odd = got.pop(next(k for k in got if k.startswith(f"{D}/delivered")))
    below = list(got.values())
    assert odd["validation_status"] == "match" and odd["folder"] == "app1"
    assert [(r["folder"], sorted((d["column_name"], d["status"]) for d in r["differences"])) for r in below] == [
        ("app1", [("hour", "unexpected"), ("o_orderstatus", "missing")])]


def test_landing_replaces_its_own_date_only(spark, workdir):
    from tollgate.sources.lake import land_by_app
    from tollgate.sources.reviews import bronze_source
    src = bronze_source(spark, SF001, "apple_store")
    for d in ("20240101", "20240102", "20240102"):
        land_by_app(src, workdir, "bronze", "apple_store", d)
    n = src.count()
    for d in ("20240101", "20240102"):
        assert read_parquet(spark, source_path(workdir, "bronze", "apple_store", d)).count() == n


def test_rerun_without_rejects_clears_quarantine(spark, workdir):
    rules = SILVER_RULES["apple_store"]
    src = review_source(spark, SF001, "apple_store")
    out = pattern_out_path(workdir, "apple_store", D)
    write_leaf(rejects(src, rules), out)
    assert read_parquet(spark, out).count() > 0
    clean = src.filter("o_orderkey < 0")  # a later load with no bad rows
    write_leaf(rejects(clean, rules), out)
    assert read_parquet(spark, out).count() == 0


def test_folder_without_data_files_is_empty_not_missing(spark, workdir):
    from tollgate.plans.run import run_quality
    base, quality = f"{workdir}/lake", f"{workdir}/quality"
    for s in ("google_play", "apple_store"):
        write_leaf(silver_source(spark, SF001, s), source_path(base, "silver", s, D))
    # mongodb's folder exists but holds no data file, only a commit marker
    leaf = source_path(base, "silver", "mongodb", D)
    os.makedirs(leaf)
    open(os.path.join(leaf, "_SUCCESS"), "w").close()
    res = run_quality(spark, base, "silver", D, quality, raise_on_failure=False)
    vol = {r[0]: (r[2], r[3]) for r in res.summary_rows if r[1] == "volumetry"}
    assert res.status == "failed"
    assert vol["mongodb"][0] == "empty"
    assert vol["google_play"] == ("ok", None)


def test_corrupt_file_makes_the_source_unreadable(spark, workdir):
    from tollgate.plans.run import run_quality
    base, quality = f"{workdir}/lake", f"{workdir}/quality"
    for s in ("google_play", "apple_store"):
        write_leaf(silver_source(spark, SF001, s), source_path(base, "silver", s, D))
    spark.createDataFrame([("x",)], "v string").write.mode("overwrite").text(
        source_path(base, "silver", "mongodb", D))  # not Parquet
    res = run_quality(spark, base, "silver", D, quality, raise_on_failure=False)
    vol = {r[0]: r[2] for r in res.summary_rows if r[1] == "volumetry"}
    assert vol == {"google_play": "ok", "mongodb": "unreadable", "apple_store": "ok"}
    assert "mongodb: unreadable" in str(res.error)


def test_quarantine_history_prunes_partitions(spark, workdir):
    from tollgate.sources.lake import read_quarantine
    rules = SILVER_RULES["apple_store"]
    src = review_source(spark, SF001, "apple_store")
    for d in ("20240101", "20240102", "20240103"):
        write_leaf(rejects(src, rules), pattern_out_path(workdir, "apple_store", d))
    one = read_quarantine(spark, workdir, "apple_store", ["20240102"])
    assert all("odate=20240102" in f for f in one.inputFiles())  # the file index holds no other date
    assert one.schema["odate"].dataType.simpleString() == "int"
    assert one.count() == rejects(src, rules).count()
    assert read_quarantine(spark, workdir, "apple_store").select("odate").distinct().count() == 3
