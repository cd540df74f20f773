"""Volumetry: did each source arrive, and does it hold rows?

``volumetry_report`` counts every source in one Spark job (a union of
count aggregates over column-free scans, with a map-side partial count).
``volumetry_gate`` and ``emptiness`` only need to know emptiness, so they
use ``DataFrame.isEmpty`` per source (about one split each) instead.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.local import local_frame

OK, EMPTY, MISSING, UNREADABLE = "ok", "empty", "missing", "unreadable"

_MISSING_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("status", T.StringType()),
])


class VolumetryError(ValueError):
    """Raised by the gate; names every source that is empty or missing."""

    def __init__(self, failures: Mapping[str, str]):
        self.failures = dict(failures)
        detail = ", ".join(f"{s}: {why}" for s, why in self.failures.items())
        super().__init__(f"source load failed volumetry ({detail})")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def volumetry_report(spark: SparkSession, sources: Mapping[str, DataFrame | None]) -> DataFrame:
    """``source, n_rows, status`` per source; ``None`` = missing source."""
    frames = []
    missing = []
    for name, df in sources.items():
        if df is None:
            missing.append((name, None, MISSING))
            continue
        frames.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                        .select(F.lit(name).alias("source"), "n_rows",
                                F.when(F.col("n_rows") == 0, EMPTY).otherwise(OK).alias("status")))
    if missing:
        frames.append(local_frame(spark, missing, _MISSING_SCHEMA))
    if not frames:
        return local_frame(spark, [], _MISSING_SCHEMA)
    return _union(frames)


def _is_empty_all(sources: Mapping[str, DataFrame | None], max_workers: int = 8) -> dict[str, bool]:
    """``DataFrame.isEmpty`` per present source, as concurrent jobs. Each
    fetches one row incrementally (one partition first, more only while
    the partitions read so far are empty), so a large source costs about
    one split, not a scan."""
    present = [n for n, df in sources.items() if df is not None]
    if not present:
        return {}
    with ThreadPoolExecutor(max_workers=max(1, min(len(present), max_workers))) as pool:
        return dict(zip(present, pool.map(lambda n: sources[n].isEmpty(), present)))


def gate_states(spark: SparkSession, sources: Mapping[str, DataFrame | None],
                absent: Mapping[str, str] | None = None) -> dict[str, str]:
    """``ok``, ``empty`` or, for a source that is ``None``, what ``absent`` says
    of it (default ``missing``); about one split read per source."""
    flags = _is_empty_all(sources)
    return {n: (absent or {}).get(n, MISSING) if df is None else EMPTY if flags[n] else OK
            for n, df in sources.items()}


def volumetry_gate(spark: SparkSession, sources: Mapping[str, DataFrame | None],
                   absent: Mapping[str, str] | None = None) -> dict[str, str]:
    """Raise ``VolumetryError`` naming each source that does not hold rows;
    else return the states (see ``gate_states``)."""
    states = gate_states(spark, sources, absent)
    failures = {n: st for n, st in states.items() if st != OK}
    if failures:
        raise VolumetryError(failures)
    return states


def emptiness(spark: SparkSession, sources: Mapping[str, DataFrame | None]) -> DataFrame:
    """``source, is_empty, status`` per source, as the gate judges them."""
    try:
        states = volumetry_gate(spark, sources)
    except VolumetryError as exc:
        states = {n: exc.failures.get(n, OK) for n in sources}
    return local_frame(spark, [(n, st != OK, st) for n, st in states.items()],
                       "source string, is_empty boolean, status string")
