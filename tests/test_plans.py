"""Plan regression tests: the physical shapes the design relies on."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tollgate.functions import SILVER_RULES
from tollgate.operators import observe_rejects, rejects, volumetry_report
from tollgate.plans import catalog as C
from tollgate.sources.lake import read_parquet, source_path, write_leaves
from tollgate.sources.reviews import silver_source

from .conftest import SF001

D = "20240104"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _silver(spark, workdir, source):
    leaf = source_path(workdir, "silver", source, D)
    write_leaves({leaf: silver_source(spark, SF001, source)})
    return read_parquet(spark, leaf)


def test_pattern_pass_has_no_exchange_and_is_codegen(spark, workdir):
    src = _silver(spark, workdir, "mongodb")
    seen = Observation()
    df, _ = observe_rejects(rejects(src.observe(seen, F.count(F.lit(1)).alias("n")),
                                    SILVER_RULES["mongodb"]), SILVER_RULES["mongodb"])
    plan = _plan(df)
    assert "Exchange" not in plan and "Sort" not in plan
    assert "BroadcastHashJoin" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
    # the filter stays above the row-total observation and inside codegen
    lines = plan.splitlines()
    filt = next(i for i, ln in enumerate(lines) if "Filter" in ln)
    metrics = [i for i, ln in enumerate(lines) if "CollectMetrics" in ln]
    assert len(metrics) == 2 and metrics[0] < filt < metrics[1]
    assert lines[filt].lstrip(" :+-").startswith("*(")


def test_single_rule_reads_two_columns(spark):
    plan = _plan(C.q_rule_regex(spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan


def test_volumetry_reads_no_data_columns(spark, workdir):
    frames = {s: _silver(spark, workdir, s) for s in ("google_play", "apple_store")}
    plan = _plan(volumetry_report(spark, frames))
    assert plan.count("ReadSchema: struct<>") == 2
    assert "partial_count" in plan


def test_rejects_write_reads_rule_columns_only_for_counts(spark, workdir):
    src = _silver(spark, workdir, "apple_store")
    from tollgate.functions import any_violation
    plan = _plan(src.agg(F.count_if(any_violation(SILVER_RULES["apple_store"]))))
    assert "historical_data" not in plan.split("ReadSchema:")[1].splitlines()[0]
