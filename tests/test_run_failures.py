"""What a quality run leaves behind when something fails: one source, one file, one
write, or the run itself between two moves."""

import pytest
from pyspark.sql import functions as F

from tollgate.functions import SILVER_RULES, regex
from tollgate.operators.metrics import record_unreadable
from tollgate.operators.schemas import survey_files
from tollgate.plans import run
from tollgate.plans.run import job_failures_path, run_quality
from tollgate.session import folders_in, glob_escaped, path_exists, remove_path, remove_paths, write_text
from tollgate.sources.lake import (
    commit_leaves, pattern_out_path, read_parquet, recover_leaves, source_path, stage_split, staging_root, write_leaf,
)
from tollgate.sources.reviews import bronze_source, silver_source
from tollgate.sources.lake import land_by_app

from .conftest import SF001, SF01

D = "20240103"
REVIEWS = ("google_play", "mongodb", "apple_store")
BROKEN = regex("comment", "(?P<x>a)", label="broken")  # no Java pattern: the job fails


def lake(spark, root, sources=REVIEWS):
    for s in sources:
        write_leaf(silver_source(spark, SF01, s), source_path(f"{root}/lake", "silver", s, D))
    return f"{root}/lake", f"{root}/quality"


def summary(res):
    return {(r[0], r[1]): (r[2], r[3], r[4]) for r in res.summary_rows}


def test_footer_job_of_one_source_fails(spark, workdir, monkeypatch):
    base, quality = lake(spark, workdir)
    real = run.survey_files

    def survey(spark, source, *a):
        if source == "mongodb":
            raise OSError("listing of mongodb timed out")
        return real(spark, source, *a)
    monkeypatch.setattr(run, "survey_files", survey)
    res = run_quality(spark, base, "silver", D, quality)
    got = summary(res)
    assert res.status == "partial"
    assert got[("mongodb", "schema")] == ("error", None, None)
    assert got[("mongodb", "pattern")] == ("no_match", 10000, 5491)  # its rows can be read, and are
    assert got[("google_play", "pattern")] == ("no_match", 1000, 966)
    assert got[("apple_store", "pattern")] == ("no_match", 15000, 9243)
    log = read_parquet(spark, job_failures_path(quality)).collect()
    assert [(r["stage"], r["source"], r["error"]) for r in log] == [("schema", "mongodb", "listing of mongodb timed out")]


def test_rows_that_cannot_be_counted_end_no_run(spark, workdir, monkeypatch):
    """The pattern check fails and so does the count that would go to the record."""
    base, quality = lake(spark, workdir, ("mongodb", "apple_store"))
    real = run.survey_files
    monkeypatch.setattr(run, "survey_files", lambda spark, s, *a: real(spark, s, *a) if s != "mongodb" else 1 / 0)
    from pyspark.sql.classic.dataframe import DataFrame
    counted = DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda df: 1 / 0 if "cpf" in df.columns else counted(df))
    res = run_quality(spark, base, "silver", D, quality, sources=("mongodb", "apple_store"), rules={"mongodb": [BROKEN]})
    got = summary(res)
    assert got[("mongodb", "pattern")] == ("error", None, None)
    assert got[("apple_store", "pattern")] == ("no_match", 15000, 9243)


def test_unreadable_files_are_logged_by_one_job(spark, workdir):
    leaf = f"{workdir}/files/odate={D}"
    write_leaf(silver_source(spark, SF001, "mongodb"), leaf)
    spark.range(300).selectExpr("cast(id as string) as value").coalesce(2).write.mode("append").option(
        "maxRecordsPerFile", 1).text(leaf)
    found = survey_files(spark, "mongodb", leaf, silver_source(spark, SF001, "mongodb").schema, f"{workdir}/report")
    assert (found.n_files - found.n_unreadable >= 1, found.n_unreadable, found.exact) == (True, 300, False)
    assert found.n_rows == silver_source(spark, SF001, "mongodb").count()
    many = spark.range(10_000).selectExpr("'x' as source", "'f' || id as file", "if(id % 100 = 0, null, 'no footer') as error")
    many.write.parquet(f"{workdir}/many")
    sc, log = spark.sparkContext, f"{workdir}/job_failures"
    sc.setJobGroup("one-append", "failure rows")
    try:
        record_unreadable(spark, [f"{workdir}/many"], log, run_id="r", odate=D, layer="silver")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("one-append")) == 1
    back = read_parquet(spark, log)
    assert back.count() == back.select("error").distinct().count() == 9_900
    assert back.filter("error = 'f7: no footer' and stage = 'schema' and source = 'x'").count() == 1


def test_all_files_unreadable_or_some(spark, workdir):
    base, quality = lake(spark, workdir, ("mongodb",))
    bad = source_path(base, "silver", "apple_store", D)
    spark.range(3).selectExpr("cast(id as string) as value").write.mode("overwrite").text(bad)
    res = run_quality(spark, base, "silver", D, quality, sources=("mongodb", "apple_store"), raise_on_failure=False)
    assert summary(res)[("apple_store", "volumetry")][0] == "unreadable" and res.status == "failed"
    silver_source(spark, SF01, "apple_store").write.mode("append").parquet(bad)
    res = run_quality(spark, base, "silver", D, quality, sources=("mongodb", "apple_store"))
    assert summary(res)[("apple_store", "pattern")] == ("no_match", 15000, 9243) and res.status == "partial"


@pytest.mark.parametrize("write_valid", [False, True])
def test_failed_write_keeps_the_earlier_leaves(spark, workdir, write_valid):
    base, quality = lake(spark, workdir, ("mongodb",))
    only = {"sources": ("mongodb",), "write_valid": write_valid}
    run_quality(spark, base, "silver", D, quality, **only)
    res = run_quality(spark, base, "silver", D, quality, rules={"mongodb": [*SILVER_RULES["mongodb"], BROKEN]}, **only)
    assert res.status == "partial" and summary(res)[("mongodb", "pattern")] == ("error", 10000, None)
    assert read_parquet(spark, pattern_out_path(quality, "mongodb", D)).count() == 5491
    if write_valid:
        assert read_parquet(spark, pattern_out_path(quality, "mongodb", D, "valid")).count() == 10000 - 5491
    # the next run throws away what the failed one had written beside
    run_quality(spark, base, "silver", D, quality, **only)
    assert folders_in(spark, staging_root(quality, "silver", D, "mongodb")) == []


def test_decided_swap_is_ended_by_the_next_run(spark, workdir):
    """The driver dies after the first of two moves; another one died before it decided."""
    old, new = spark.range(3), spark.range(7).withColumn("ok", F.col("id") % 2 == 0)
    leaves = {"true": f"{workdir}/out/good", "false": f"{workdir}/out/bad"}
    for leaf in leaves.values():
        write_leaf(old, leaf)
    root = f"{workdir}/staging"
    staged = stage_split(new, "ok", ("true", "false"), f"{root}/died-late")
    stage_split(new, "ok", ("true", "false"), f"{root}/died-early")
    moves = {leaves[v]: staged[v] for v in leaves}
    import json

    from tollgate.session import move_path
    write_text(spark, f"{root}/died-late/_commit.json", json.dumps(moves))
    remove_path(spark, leaves["true"])
    move_path(spark, staged["true"], leaves["true"])
    found = recover_leaves(spark, root)
    assert {k.rsplit("/", 1)[1]: v for k, v in found.items()} == {"died-late": True, "died-early": False}
    assert (read_parquet(spark, leaves["true"]).count(), read_parquet(spark, leaves["false"]).count()) == (4, 3)
    assert folders_in(spark, root) == [] and recover_leaves(spark, root) == {} == recover_leaves(spark, f"{workdir}/none")


def test_leaf_without_new_rows_goes(spark, workdir):
    write_leaf(spark.range(3), f"{workdir}/a")
    write_leaf(spark.range(4), f"{workdir}/s/new")
    commit_leaves(spark, f"{workdir}/s", {f"{workdir}/a": None, f"{workdir}/b": f"{workdir}/s/new"})
    assert not path_exists(spark, f"{workdir}/a") and read_parquet(spark, f"{workdir}/b").count() == 4


def test_row_totals_come_from_footers(spark, workdir, monkeypatch):
    """No map stage counts rows, so losing one changes nothing."""
    base, quality = lake(spark, workdir, ("apple_store",))

    def counting(*a):
        raise AssertionError("rows are counted on the way")
    monkeypatch.setattr(run, "Observation", counting)
    for rebalance in (False, True):
        res = run_quality(spark, base, "silver", D, quality, sources=("apple_store",), rebalance_rejects=rebalance)
        assert summary(res)[("apple_store", "pattern")] == ("no_match", 15000, 9243)


def test_bronze_totals_cost_no_job(spark, workdir):
    base = f"{workdir}/lake"
    for s in REVIEWS:
        land_by_app(bronze_source(spark, SF001, s), base, "bronze", s, D)
    jobs, totals = [], []
    for count_rows in (True, False):
        res = run_quality(spark, base, "bronze", D, f"{workdir}/q{count_rows}", count_rows=count_rows)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(res.job_group)))
        totals.append([summary(res)[(s, "volumetry")][1] for s in REVIEWS])
    assert jobs[0] == jobs[1]
    assert totals == [[bronze_source(spark, SF001, s).count() for s in REVIEWS], [None] * 3]


def test_variants_of_silver_files(spark, workdir):
    """A number where a string is declared, and a column that is not declared at all
    in two types: rows of every kind are checked and kept."""
    src = silver_source(spark, SF01, "apple_store")
    leaf = source_path(f"{workdir}/lake", "silver", "apple_store", D)
    write_leaf(src.filter("im_rating = '1'").withColumn("im_rating", F.lit(1.0)).withColumn("extra", F.lit(5)), leaf)
    src.filter("not (im_rating <=> '1')").withColumn("extra", F.lit("five")).write.mode("append").parquet(leaf)
    res = run_quality(spark, f"{workdir}/lake", "silver", D, f"{workdir}/quality", sources=("apple_store",), write_valid=True)
    got = summary(res)[("apple_store", "pattern")]
    assert got[0:2] == ("no_match", 15000)
    back = [read_parquet(spark, pattern_out_path(f"{workdir}/quality", "apple_store", D, k)) for k in ("pattern", "valid")]
    assert back[0].count() == got[2] and back[1].count() == 15000 - got[2]
    both = back[0].unionByName(back[1])
    assert {r["im_rating"] for r in both.filter("extra = '5'").select("im_rating").distinct().collect()} == {"1.0"}
    assert both.filter("extra = 'five'").count() == src.filter("not (im_rating <=> '1')").count()


def test_names_with_glob_characters(spark, workdir):
    base, quality = lake(spark, workdir, ("mongodb",))
    odd = f"{workdir}/q[1]{{a,b}}*"
    for name in ("q1a", "q1b"):
        write_leaf(spark.range(1), f"{workdir}/{name}/schema_folders/odate={D}")
    run_quality(spark, base, "silver", D, odd, sources=("mongodb",))
    assert read_parquet(spark, glob_escaped(pattern_out_path(odd, "mongodb", D))).count() == 5491
    assert all(path_exists(spark, f"{workdir}/{n}/schema_folders/odate={D}") for n in ("q1a", "q1b"))
    assert remove_paths(spark, f"{workdir}/q1?") == 2
    assert remove_path(spark, odd) and not path_exists(spark, odd)


def test_stream_passes_over_files_it_cannot_read(spark, workdir):
    """One micro-batch with a file of another type and one that is not Parquet."""
    from tollgate.sources.reviews import review_source
    from tollgate.streaming import drift_path, quarantine_stream, rejected_rows
    src, rules = review_source(spark, SF001, "apple_store"), SILVER_RULES["apple_store"]
    landing, out = f"{workdir}/landing", f"{workdir}/out"
    write_leaf(src.filter("im_rating <> '2'").coalesce(1), f"{landing}/part=a")
    write_leaf(src.filter("im_rating = '2'").withColumn("im_rating", F.lit(2)).coalesce(1), f"{landing}/part=b")
    spark.range(1).selectExpr("'no footer' as value").write.text(f"{landing}/part=c")
    quarantine_stream(spark, landing, src.schema, rules, out, f"{workdir}/ckpt").awaitTermination()
    from tollgate.operators import rejects
    assert rejected_rows(spark, out) == rejects(src.filter("im_rating <> '2'"), rules).count()
    drift = {r["file"].split("part=")[1][0]: r for r in read_parquet(spark, drift_path(out)).collect()}
    assert set(drift) == {"b", "c"} and drift["c"]["error"] and drift["b"]["error"] is None
