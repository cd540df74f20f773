"""Run metrics and failure records, kept as ordinary append-only tables.

Counts come from ``DataFrame.observe`` on the job that writes the output,
so measuring costs no extra pass over the data. Metric and failure rows are
a handful per run (one per source and check) and are appended as Parquet.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import FAILED_COLUMNS, NO_MATCH, VALIDATION, Rule
from ..session import glob_escaped
from ..sources.local import local_frame
from .patterns import failure_count_exprs

RUN_METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("odate", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("elapsed_sec", T.DoubleType()),
    T.StructField("recorded_at", T.StringType()),
])

JOB_FAILURE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("odate", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])


def now_iso() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def observe_rejects(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Attach an Observation counting rejected rows and per-rule failures to an
    annotated frame, with or without its valid rows. Values are available after
    the frame's action."""
    obs = Observation()
    exprs: list[Column] = [F.count_if(F.col(VALIDATION) == NO_MATCH).alias("n_bad")]
    exprs += failure_count_exprs(rules, FAILED_COLUMNS)
    return df.observe(obs, *exprs), obs


def append_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType, path: str) -> None:
    if rows:
        local_frame(spark, rows, schema).write.mode("append").parquet(path)


def record_failure(spark: SparkSession, path: str, *, run_id: str, odate: str, layer: str,
                   stage: str, source: str | None, error: BaseException | str) -> dict:
    """Append one failure row (replaces a metric document sent to a search
    index). The error is stored whole. Returns the row as a dict."""
    row = (run_id, odate, layer, stage, source, str(error), now_iso())
    append_rows(spark, [row], JOB_FAILURE_SCHEMA, path)
    return dict(zip(JOB_FAILURE_SCHEMA.names, row))


def record_unreadable(spark: SparkSession, reports: Sequence[str], path: str, *, run_id: str, odate: str, layer: str) -> None:
    """Appends a failure row for every file that the file reports (see
    ``schemas.survey_files``) say cannot be read: one job, whatever their number,
    and nothing of it comes to the driver."""
    files = spark.read.schema("source string, file string, error string").parquet(*map(glob_escaped, reports)).filter("error is not null")
    files.select(F.lit(run_id).alias("run_id"), F.lit(odate).alias("odate"), F.lit(layer).alias("layer"),
                 F.lit("schema").alias("stage"), "source", F.concat_ws(": ", "file", "error").alias("error"),
                 F.lit(now_iso()).alias("timestamp")).write.mode("append").parquet(path)
