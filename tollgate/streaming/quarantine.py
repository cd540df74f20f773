"""Incremental pattern check: the same rules over files as they land.

The row logic is stateless (one row in, at most one row out), so the batch
``rejects`` transformation applies unchanged to each micro-batch of a file
stream. Before a batch is checked, the footers of its files are compared with
the declared schema on the executors: a file that lacks a declared column would be
read as NULL and pass rules it was never held against, and one that holds it in
another type, or that is not Parquet, cannot be read with the declared schema at
all. Such a file becomes a row of the drift table and is not opened again; the
batch's other files are read by their names, and the stream goes on. A batch
replaces its own leaves (``batch_id=N``), so the output is exactly-once across
restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import Rule
from ..operators.patterns import rejects
from ..operators.schemas import footer_report
from ..session import glob_escaped
from ..sources.lake import write_leaf


def drift_path(out: str) -> str:
    """Where a stream that writes to ``out`` reports files it did not check."""
    return f"{out.rstrip('/')}_drift"


def quarantine_stream(spark: SparkSession, landing: str, schema: T.StructType,
                      rules: Sequence[Rule], out: str, checkpoint: str, *,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      processing_time: str | None = None) -> StreamingQuery:
    """Start a query writing rejected rows of every new Parquet file under
    ``landing`` to ``out/batch_id=N``, and files that do not have the declared
    columns to ``drift_path(out)``. ``available_now`` drains the backlog in
    bounded micro-batches and stops; otherwise the query runs on
    ``processing_time``. Columns beyond the declared ones are passed over.
    """
    # The stream is one of files: none is opened before its footer has been read.
    reader = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    names = [F.col(f"`{n}`") for n in schema.fieldNames()]
    landed = reader.load(landing).select(F.col("path").alias("file"))

    def check(batch: DataFrame, batch_id: int) -> None:
        drift = (footer_report(batch, "", schema).withColumn("broken", F.filter(
                     "differences", lambda d: ~d["status"].isin("unexpected", "moved", "nullability_mismatch")))
                 .filter("error is not null or size(broken) > 0")
                 .select("file", "error", F.col("broken").alias("differences")))
        report = f"{drift_path(out)}/batch_id={batch_id}"
        write_leaf(drift, report)
        # Spark's driver lists the files of a micro-batch too
        broken = {r.file for r in spark.read.schema(drift.schema).parquet(report).select("file").collect()}
        good = sorted({r.file for r in batch.collect()} - broken)
        whole = (spark.read.schema(schema).parquet(*map(glob_escaped, good)) if good else
                 spark.createDataFrame([], schema)).select(*names)
        write_leaf(rejects(whole, rules), f"{out.rstrip('/')}/batch_id={batch_id}")

    writer = landed.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def rejected_rows(spark: SparkSession, out: str) -> int:
    """Rejected rows that the stream has written, counted in its output (a
    query's progress reports are forgotten after a while)."""
    return spark.read.parquet(out).count()
