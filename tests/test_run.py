"""End-to-end quality runs on a lake built from the test tables."""

import pytest

from tollgate.plans.run import job_failures_path, run_metrics_path, run_quality, validate_layer
from tollgate.sources.lake import (
    pattern_out_path, read_parquet, schema_out_path, source_path, write_leaf,
)
from tollgate.sources.reviews import silver_source

from .conftest import SF01

D = "20240103"
REVIEWS = ("google_play", "mongodb", "apple_store")


def _lake(spark, root, sources=REVIEWS, transform=None):
    base, quality = f"{root}/lake", f"{root}/quality"
    for s in sources:
        df = silver_source(spark, SF01, s)
        if transform:
            df = transform(s, df)
        write_leaf(df, source_path(base, "silver", s, D))
    return base, quality


def test_silver_run_counts_and_outputs(spark, workdir):
    base, quality = _lake(spark, workdir)
    res = run_quality(spark, base, "silver", D, quality, write_valid=True)
    assert res.status == "success"
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in res.summary_rows}
    assert got[("mongodb", "volumetry")] == ("ok", 10000, None)
    assert got[("apple_store", "schema")] == ("match", None, 0)
    assert got[("google_play", "pattern")] == ("no_match", 1000, 966)
    assert got[("mongodb", "pattern")] == ("no_match", 10000, 5491)
    assert got[("apple_store", "pattern")] == ("no_match", 15000, 9243)
    assert res.rule_failures["mongodb"]["rating"] == 3273
    assert res.rule_failures["google_play"]["snippet"] == 931
    for s, n in (("google_play", 966), ("mongodb", 5491), ("apple_store", 9243)):
        assert read_parquet(spark, pattern_out_path(quality, s, D)).count() == n
    assert read_parquet(spark, pattern_out_path(quality, "google_play", D, "valid")).count() == 34
    assert read_parquet(spark, schema_out_path(quality, D)).count() == 0
    m = read_parquet(spark, run_metrics_path(quality))
    assert m.filter("check = 'pattern'").count() == 3


def test_all_schema_failures_kept_and_pattern_error_recorded(spark, workdir):
    # every source lands with one rule column renamed: three schema mismatches
    base, quality = _lake(spark, workdir, transform=lambda s, df: df.withColumnRenamed("app", "App"))
    res = run_quality(spark, base, "silver", D, quality)
    assert res.status == "partial"
    rep = read_parquet(spark, schema_out_path(quality, D))
    assert sorted(r["source"] for r in rep.collect()) == sorted(REVIEWS)
    fails = read_parquet(spark, job_failures_path(quality)).collect()
    assert sorted(r["source"] for r in fails) == sorted(REVIEWS)
    assert all(r["stage"] == "pattern" for r in fails)


def test_missing_source_fails_run_and_is_logged(spark, workdir):
    base, quality = _lake(spark, workdir, sources=("google_play", "apple_store"))
    with pytest.raises(ValueError, match="mongodb: missing"):
        run_quality(spark, base, "silver", D, quality)
    row = read_parquet(spark, job_failures_path(quality)).first()
    assert row["stage"] == "volumetry" and "mongodb: missing" in row["error"]


def test_bronze_run_only_volumetry_and_schema(spark, workdir):
    base, quality = _lake(spark, workdir)
    # silver-shaped data under the bronze layer's app sub-folders
    bbase = f"{workdir}/bronze_lake"
    for s in REVIEWS:
        write_leaf(silver_source(spark, SF01, s),
                   source_path(bbase, "bronze", s, D).replace("/*/", "/app1/"))
    res = run_quality(spark, bbase, "bronze", D, quality)
    checks = {(r[0], r[1]): r[2] for r in res.summary_rows}
    assert {c for _, c in checks} == {"volumetry", "schema"}
    assert all(v == "no_match" for (s, c), v in checks.items() if c == "schema")


def test_layer_and_odate_validation():
    assert validate_layer("SILVER") == "silver"
    with pytest.raises(ValueError):
        validate_layer("gold")
    with pytest.raises(ValueError):
        run_quality(None, "/x", "silver", "2024-01-01", "/q")
    from tollgate.plans.run import validate_odate
    for bad in ("20241399", "20230229", "\u0662\u0660\u0662\u0664\u0660\u0661\u0660\u0661", "2024010"):
        with pytest.raises(ValueError):
            validate_odate(bad)


def test_bronze_merge_conflict_is_a_schema_failure(spark, workdir):
    from pyspark.sql import functions as F
    from tollgate.sources.lake import land_by_app, source_root
    from tollgate.sources.reviews import bronze_source
    from .conftest import SF001
    base, quality = f"{workdir}/lake", f"{workdir}/quality"
    for s in REVIEWS:
        land_by_app(bronze_source(spark, SF001, s), base, "bronze", s, D)
    # one extra app folder of google_play lands `likes` as a string
    odd = bronze_source(spark, SF001, "google_play").drop("app_folder").withColumn("likes", F.lit("many"))
    write_leaf(odd, f"{source_root(base, 'bronze', 'google_play')}/app_folder=odd/odate={D}")
    res = run_quality(spark, base, "bronze", D, quality)
    checks = {(r[0], r[1]): r[2] for r in res.summary_rows}
    assert checks[("google_play", "schema")] == "no_match"
    assert checks[("mongodb", "schema")] == "match"
    fails = read_parquet(spark, job_failures_path(quality)).collect()
    assert [(r["stage"], r["source"]) for r in fails] == [("schema", "google_play")]
    assert fails[0]["error"] == "files disagree on the type of a column: likes: bigint and string"
    assert res.status == "partial"
    report = read_parquet(spark, schema_out_path(quality, D)).first()
    assert '"likes"' in report["differences"] and "type_mismatch" in report["differences"]


def test_odate_defaults_to_today():
    from tollgate.plans.run import today_odate, validate_odate
    assert validate_odate(None) == today_odate()


def test_cli_runs_and_exit_codes(spark, workdir):
    from tollgate.cli import main
    base, quality = _lake(spark, workdir)
    assert main(["silver", "--base", base, "--quality", quality, "--odate", D]) == 0
    assert read_parquet(spark, pattern_out_path(quality, "mongodb", D)).count() == 5491
    assert main(["silver", "--base", f"{workdir}/nowhere", "--quality", quality, "--odate", D]) == 1
    assert main(["gold", "--base", base, "--quality", quality, "--odate", D]) == 1
    with pytest.raises(SystemExit) as usage:
        main(["silver", "--base", base])
    assert usage.value.code == 1


def test_valid_output_rebalance_and_preview(spark, workdir, capsys):
    base, quality = _lake(spark, workdir, sources=("apple_store",))
    res = run_quality(spark, base, "silver", D, quality, sources=("apple_store",),
                      write_valid=True, rebalance_rejects=True, preview=3)
    rej = read_parquet(spark, pattern_out_path(quality, "apple_store", D))
    ok = read_parquet(spark, pattern_out_path(quality, "apple_store", D, "valid"))
    assert rej.count() == 9243 and ok.count() == 15000 - 9243
    assert {r["validation"] for r in rej.select("validation").distinct().collect()} == {"no_match"}
    assert {r["validation"] for r in ok.select("validation").distinct().collect()} == {"match"}
    assert "only showing top 3 rows" in capsys.readouterr().out
    assert res.status == "success"
    # observations survive the extra exchange of the rebalance
    got = {(r[0], r[1]): (r[3], r[4]) for r in res.summary_rows}
    assert got[("apple_store", "pattern")] == (15000, 9243)
    assert res.rule_failures["apple_store"]["im_rating"] == 3750


def test_shared_dir_comes_from_session(spark):
    from tollgate.session import shared_dir
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None)
                                 or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_cluster_without_shared_dir_is_an_error():
    from types import SimpleNamespace as N
    from tollgate.session import shared_dir
    for master, fine in (("local[2]", True), ("spark://h:7077", False), ("yarn", False), ("local-cluster[1,1,1024]", False)):
        sc = N(master=master, getConf=lambda: N(get=lambda k, d: d), getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
        cluster = N(conf=N(get=lambda k, d: d), sparkContext=sc)
        if fine:
            assert shared_dir(cluster)
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                shared_dir(cluster)


def test_rerun_that_cannot_check_leaves_no_stale_rows(spark, workdir):
    base, quality = _lake(spark, workdir, sources=("apple_store",))
    run_quality(spark, base, "silver", D, quality, sources=("apple_store",), write_valid=True)
    write_leaf(silver_source(spark, SF01, "apple_store").drop("content"), source_path(base, "silver", "apple_store", D))
    res = run_quality(spark, base, "silver", D, quality, sources=("apple_store",))
    assert res.status == "partial"
    from tollgate.session import path_exists
    for kind in ("pattern", "valid"):
        assert not path_exists(spark, pattern_out_path(quality, "apple_store", D, kind))


def test_one_bad_source_leaves_the_others(spark, workdir):
    from pyspark.sql import functions as F
    base, quality = _lake(spark, workdir, transform=lambda s, df: df.withColumn("validation", F.lit(1)) if s == "google_play" else df)
    res = run_quality(spark, base, "silver", D, quality)
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in res.summary_rows}
    assert res.status == "partial"
    assert got[("google_play", "pattern")] == ("error", 1000, None)
    assert got[("mongodb", "pattern")] == ("no_match", 10000, 5491)
    assert set(res.rule_failures) == {"mongodb", "apple_store"}
    m = read_parquet(spark, run_metrics_path(quality)).filter("check = 'pattern'").collect()
    assert {r["source"]: r["status"] for r in m} == {"google_play": "error", "mongodb": "no_match", "apple_store": "no_match"}


def test_long_errors_are_stored_whole(spark, workdir):
    from tollgate.operators.metrics import record_failure
    text = "x" * 5000
    record_failure(spark, job_failures_path(workdir), run_id="r", odate=D, layer="silver", stage="s", source=None, error=text)
    assert read_parquet(spark, job_failures_path(workdir)).first()["error"] == text


def test_every_drifting_folder_is_a_row(spark, workdir):
    from tollgate.sources.lake import schema_folders_path, source_root
    from tollgate.sources.reviews import bronze_source
    base, quality = f"{workdir}/lake", f"{workdir}/quality"
    one = bronze_source(spark, "/root/testdata/sf0.001", "apple_store").drop("app_folder").limit(1).cache()
    for k in range(25):
        write_leaf(one.drop("title"), f"{source_root(base, 'bronze', 'apple_store')}/app{k}/odate={D}")
    res = run_quality(spark, base, "bronze", D, quality, sources=("apple_store",))
    rows = read_parquet(spark, schema_folders_path(quality, D)).filter("validation_status = 'no_match'").collect()
    assert len({r["folder"] for r in rows}) == len(rows) == 25
    assert all(r["variants"][0][0]["column_name"] == "title" for r in rows)
    assert res.status == "success" and res.summary_rows[1][2:5] == ("no_match", None, 1)


def test_failing_metrics_are_on_record(spark, workdir, monkeypatch):
    from tollgate.plans import run
    base, quality = _lake(spark, workdir, sources=("apple_store",))

    def broken(*a, **k):
        raise OSError("metrics table is locked")
    monkeypatch.setattr(run, "append_rows", broken)
    with pytest.raises(OSError, match="locked"):
        run_quality(spark, base, "silver", D, quality, sources=("apple_store",))
    row = read_parquet(spark, job_failures_path(quality)).first()
    assert (row["stage"], row["error"]) == ("metrics", "metrics table is locked")


def test_bad_arguments_are_on_record(spark, workdir):
    with pytest.raises(ValueError):
        run_quality(spark, workdir, "gold", D, workdir)
    assert read_parquet(spark, job_failures_path(workdir)).first()["stage"] == "arguments"


def test_custom_source_with_own_schema_and_rules(spark, workdir):
    from tollgate.functions import regex
    from tollgate.plans.catalog import TABLE_CONTRACTS
    base, quality = _lake(spark, workdir, sources=("google_play",))
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    write_leaf(orders, source_path(base, "silver", "orders", D))
    res = run_quality(spark, base, "silver", D, quality, sources=("google_play", "orders"),
                      expected={"orders": TABLE_CONTRACTS["orders"]},
                      rules={"orders": [regex("o_orderpriority", r"^[1-3]-[A-Z]+$")]})
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in res.summary_rows}
    assert got[("orders", "schema")] == ("match", None, 0)
    assert got[("orders", "pattern")] == ("no_match", 15000, 6016)
    assert got[("orders", "volumetry")] == ("ok", 15000, None)


def test_source_without_rules_skips_pattern(spark, workdir):
    base, quality = _lake(spark, workdir, sources=("apple_store",))
    res = run_quality(spark, base, "silver", D, quality, sources=("apple_store",),
                      rules={"apple_store": []})
    got = {(r[0], r[1]): r[2] for r in res.summary_rows}
    assert got[("apple_store", "pattern")] == "skipped"
    assert res.status == "success"


def test_rebalance_compacts_quarantine_files(spark, workdir):
    import glob
    base = f"{workdir}/lake"
    df = silver_source(spark, SF01, "apple_store")
    (df.write.mode("overwrite").option("maxRecordsPerFile", 500)
       .parquet(source_path(base, "silver", "apple_store", D)))  # 30 small files
    counts = {}
    for flag in (False, True):
        quality = f"{workdir}/quality_{flag}"
        run_quality(spark, base, "silver", D, quality, sources=("apple_store",), rebalance_rejects=flag)
        out = pattern_out_path(quality, "apple_store", D)
        counts[flag] = len(glob.glob(out.replace("file:", "") + "/*.parquet"))
        assert read_parquet(spark, out).count() == 9243
    assert counts[True] < counts[False]


def test_cli_exit_code_partial(spark, workdir):
    from tollgate.cli import main
    base, quality = _lake(spark, workdir, transform=lambda s, df: df.drop("os") if s == "mongodb" else df)
    assert main(["silver", "--base", base, "--quality", quality, "--odate", D]) == 2


def test_caller_job_group_is_restored(spark, workdir):
    base, quality = _lake(spark, workdir, sources=("apple_store",))
    sc = spark.sparkContext
    sc.setJobGroup("caller-group", "caller")
    res = run_quality(spark, base, "silver", D, quality, sources=("apple_store",))
    assert sc.getLocalProperty("spark.jobGroup.id") == "caller-group"
    ids = sc.statusTracker().getJobIdsForGroup(res.job_group)
    assert len(ids) >= 5  # load, gate, footers, schema report, pattern pass, metrics append
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_cli_rules_file(spark, workdir):
    import json
    from tollgate.cli import main
    base, quality = _lake(spark, workdir, sources=("google_play", "mongodb", "apple_store"))
    path = f"{workdir}/rules.json".replace("file:", "")
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump({"apple_store": [{"column": "content", "kind": "not_null"}]}, fh)
    assert main(["silver", "--base", base, "--quality", quality, "--odate", D, "--rules", path]) == 0
    assert read_parquet(spark, pattern_out_path(quality, "apple_store", D)).count() == 1500


def test_rerun_same_odate_replaces_outputs(spark, workdir):
    base, quality = _lake(spark, workdir, sources=("mongodb",))
    for _ in range(2):
        res = run_quality(spark, base, "silver", D, quality, sources=("mongodb",))
        assert res.status == "success"
    assert read_parquet(spark, pattern_out_path(quality, "mongodb", D)).count() == 5491
    m = read_parquet(spark, run_metrics_path(quality)).filter("check = 'pattern'")
    assert m.count() == 2 and m.select("run_id").distinct().count() == 2


def test_bronze_drift_names_the_app_folder(spark, workdir):
    from pyspark.sql import functions as F
    from tollgate.sources.lake import land_by_app, source_root
    from tollgate.sources.reviews import bronze_source
    from .conftest import SF001
    base, quality = f"{workdir}/lake", f"{workdir}/quality"
    for s in REVIEWS:
        land_by_app(bronze_source(spark, SF001, s), base, "bronze", s, D)
    # one extra app folder of apple_store carries an additional column
    extra = bronze_source(spark, SF001, "apple_store").drop("app_folder").withColumn("z", F.lit("new"))
    write_leaf(extra, f"{source_root(base, 'bronze', 'apple_store')}/app_folder=late/odate={D}")
    res = run_quality(spark, base, "bronze", D, quality)
    checks = {(r[0], r[1]): r[2] for r in res.summary_rows}
    assert checks[("apple_store", "schema")] == "no_match"
    from tollgate.sources.lake import schema_folders_path
    bad = read_parquet(spark, schema_folders_path(quality, D)).filter("validation_status = 'no_match'").collect()
    assert [(r["source"], r["folder"], r["n_differences"]) for r in bad] == [("apple_store", "app_folder=late", 1)]


def test_bronze_without_count_pass(spark, workdir):
    from tollgate.sources.lake import land_by_app
    from tollgate.sources.reviews import bronze_source
    from .conftest import SF001
    base, quality = f"{workdir}/lake", f"{workdir}/quality"
    for s in REVIEWS:
        land_by_app(bronze_source(spark, SF001, s), base, "bronze", s, D)
    res = run_quality(spark, base, "bronze", D, quality, count_rows=False)
    vol = {r[0]: (r[2], r[3]) for r in res.summary_rows if r[1] == "volumetry"}
    assert vol == {s: ("ok", None) for s in REVIEWS}
    assert {r[2] for r in res.summary_rows if r[1] == "schema"} == {"match"}
