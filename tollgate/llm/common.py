"""Helpers shared by the corpus operators: table access, tables written to the
shared folder, and Arrow batches of bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_run_dir, ship_package

#: Upper case A-Z to lower case, and every byte that is not part of a word
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` to a space. UTF-8 bytes over 0x7F stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: lineage ends
    there, and every later reader sees the same rows after a lost executor."""
    spark = df.sparkSession
    path = f"{fresh_run_dir(spark, label)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows whose Python objects a worker holds at a time, and their bytes, about.
SLICE_ROWS, SLICE_BYTES = 1_000, 8 << 20


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices (views) of bounded rows and bytes, so that texts
    become Python objects a few megabytes at a time; a longer row is a slice."""
    for batch in batches:
        rows = max(1, min(SLICE_ROWS, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes)))
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()  # the worker lives on


_worker: dict[str, Any] = {"owner": None, "value": None}


def worker_cache(owner: object, make: Callable[[], Any]) -> Any:
    """What ``make`` gave for ``owner``, kept in this Python worker until another
    owner asks: a worker that runs several operators holds one's cache."""
    if _worker["owner"] != owner:
        _worker.update(owner=None, value=None)  # let go of the old one first
        _worker.update(owner=owner, value=make())
    return _worker["value"]


def forget_cache() -> None:
    """Lets go of what an earlier operator left in this Python worker."""
    worker_cache(None, lambda: None)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A string column of an Arrow batch; null is empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def id_text_crc32(id_col: str) -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def highest_hash(most: int, n: int) -> int:
    """The 64-bit hash up to which about ``most`` of ``n`` rows lie; the share
    is of the whole range, so it does not round to 0."""
    return 2**63 - 1 if n <= most else 2**64 * most // n - 2**63


def bounded_share(df: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows of ``df`` (all, if it has no more), chosen by a hash
    of ``key``: the documented bound of a classifier's training sample."""
    n = df.count()
    if n <= most:
        return df
    return df.filter(F.xxhash64(key) <= F.lit(highest_hash(most, n)))
