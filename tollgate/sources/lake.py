"""Data-lake layout, dated reads and idempotent leaf writes.

Layout (paths are strings; ``odate`` is ``YYYYMMDD``)::

    <base>/<layer>/<prefix>/<SourceDir>/odate=D          silver: one leaf
    <base>/<layer>/<prefix>/<SourceDir>/*/odate=D        bronze: one leaf per app
    <quality>/schema/odate=D                                     schema mismatches
    <quality>/schema_folders/odate=D                             the verdict of every folder
    <quality>/schema_files/odate=D                               the footer of every file
    <quality>/pattern/<pattern dir>/odate=D                      rejected rows
    <quality>/valid/<pattern dir>/odate=D                        accepted rows (opt-in)

``prefix`` is the domain path between the layer and the source folders
(default ``reviews``; pass your lake's own, e.g. ``<domain>/reviews``).
A leaf is read as its own base path, so ``odate`` is not a column of a
source; reading the parent directory instead discovers ``odate`` as an
``int`` partition column.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import folders_in, glob_escaped, move_path, path_exists, read_text, remove_path, remove_paths, write_text

log = logging.getLogger("tollgate.lake")

# --- fixed values: lake folder names ------------------------------------------
SOURCE_DIRS = {"google_play": "googlePlay", "mongodb": "mongodb", "apple_store": "appleStore"}
PATTERN_DIRS = {"google_play": "google_play", "mongodb": "internal_databases", "apple_store": "apple_store"}
# --- end fixed values -----------------------------------------------------------
DEFAULT_PREFIX = "reviews"

SOURCES = tuple(SOURCE_DIRS)

#: Where a layer's dated leaves lie under a source's root.
LEAVES = {"silver": "odate={odate}", "bronze": "*/odate={odate}"}


def source_root(base: str, layer: str, source: str, prefix: str = DEFAULT_PREFIX) -> str:
    return f"{base.rstrip('/')}/{layer}/{prefix.strip('/')}/{SOURCE_DIRS.get(source, source)}"


def source_path(base: str, layer: str, source: str, odate: str, prefix: str = DEFAULT_PREFIX) -> str:
    """The path that holds a source's load of one date: a leaf, or for bronze a
    glob over the leaves of its app folders."""
    return source_root(base, layer, source, prefix) + "/" + LEAVES[layer].format(odate=odate)


def schema_out_path(quality: str, odate: str) -> str:
    return f"{quality.rstrip('/')}/schema/odate={odate}"


def schema_folders_path(quality: str, odate: str) -> str:
    return f"{quality.rstrip('/')}/schema_folders/odate={odate}"


def schema_files_path(quality: str, odate: str) -> str:
    return f"{quality.rstrip('/')}/schema_files/odate={odate}"


def pattern_root(quality: str, source: str, kind: str = "pattern") -> str:
    return f"{quality.rstrip('/')}/{kind}/{PATTERN_DIRS.get(source, source)}"


def pattern_out_path(quality: str, source: str, odate: str, kind: str = "pattern") -> str:
    return f"{pattern_root(quality, source, kind)}/odate={odate}"


def error_condition(exc: BaseException) -> str | None:
    for getter in ("getCondition", "getErrorClass"):
        fn = getattr(exc, getter, None)
        if fn is not None:
            try:
                return fn()
            except Exception:  # noqa: BLE001 - best effort only
                pass
    return None


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet`` that logs the path before re-raising."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:
        log.error("parquet read failed: path=%s error=%s", path, exc)
        raise


def read_many(spark: SparkSession, paths: Mapping[str, str], max_workers: int = 8) -> dict[str, DataFrame]:
    """``name -> DataFrame`` for several Parquet paths, opened concurrently:
    file listing and footer reads are driver-side latency that overlaps."""
    names = list(paths)
    with ThreadPoolExecutor(max_workers=max(1, min(len(names), max_workers))) as pool:
        return dict(zip(names, pool.map(lambda n: read_parquet(spark, paths[n]), names)))


@dataclass
class Loaded:
    source: str
    path: str
    df: DataFrame | None
    state: str  # "present" | "missing" | "empty_dir" | "unreadable"
    error: str | None = None


def load_source(spark: SparkSession, path: str, source: str) -> Loaded:
    """Read one dated source; never raises for the source's own state.

    ``missing``: no such path. ``empty_dir``: a folder without data files.
    ``unreadable``: the footer cannot be read (corrupt or foreign files); the
    whole error is kept. One footer gives the schema of the frame; whether all
    files have it is ``schemas.file_schema_report``'s to say.
    """
    try:
        return Loaded(source, path, read_parquet(spark, path), "present")
    except Exception as exc:  # noqa: BLE001 - footer failures surface as several types
        msg = (error_condition(exc) or "") + " " + str(exc)
        state = ("missing" if "PATH_NOT_FOUND" in msg else
                 "empty_dir" if "UNABLE_TO_INFER_SCHEMA" in msg else "unreadable")
        return Loaded(source, path, None, state, str(exc) or repr(exc))


def load_sources(spark: SparkSession, base: str, layer: str, odate: str, sources=SOURCES,
                 prefix: str = DEFAULT_PREFIX, before: Callable[[str], None] | None = None) -> dict[str, Loaded]:
    """All sources of one layer and date; file listing and footer reads of
    different sources overlap. ``before`` is called with the source in the
    thread that reads it (job group and description are set per thread)."""
    sources = list(sources)

    def load(s: str) -> Loaded:
        if before:
            before(s)
        return load_source(spark, source_path(base, layer, s, odate, prefix), s)

    with ThreadPoolExecutor(max_workers=max(1, min(len(sources), 8))) as pool:
        return dict(zip(sources, pool.map(load, sources)))


def write_leaf(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the leaf directory, always, even with zero rows: a re-run
    leaves nothing of an earlier run behind. Static overwrite is forced so a
    session in dynamic partition-overwrite mode cannot keep stale rows."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "static")
       .format(fmt).save(path))


def stage_split(df: DataFrame, column: str, values: Sequence[str], staging: str) -> dict[str, str]:
    """One pass over ``df`` into a folder under ``staging`` for each value of
    ``column``, a copy of which splits the rows; returns them. A value without
    rows has an empty one."""
    spark, tree = df.sparkSession, f"{staging}/split"
    (df.withColumn("_leaf", F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy("_leaf").parquet(tree))
    found = {value: f"{tree}/_leaf={value}" for value in values}
    for path in found.values():
        if not path_exists(spark, path):
            write_leaf(df.limit(0), path)
    return found


_COMMIT = "_commit.json"


def commit_leaves(spark: SparkSession, staging: str, leaves: Mapping[str, str | None]) -> None:
    """Replaces leaves by folders written under ``staging`` (None: the leaf just
    goes). Nothing is touched before the list of moves is in the store; from then
    on the swap is decided, and ``recover_leaves`` ends one that was broken off."""
    write_text(spark, f"{staging}/{_COMMIT}", json.dumps(dict(leaves)))
    _swap(spark, staging)


def _swap(spark: SparkSession, staging: str) -> None:
    for leaf, staged in json.loads(read_text(spark, f"{staging}/{_COMMIT}")).items():
        if staged is None:
            remove_path(spark, leaf)
        elif path_exists(spark, staged):  # else it was moved before
            remove_path(spark, leaf)
            move_path(spark, staged, leaf)
    remove_path(spark, staging)


def recover_leaves(spark: SparkSession, root: str) -> dict[str, bool]:
    """Ends what earlier runs left in the staging folders right under ``root``:
    a decided swap is carried out, anything else is thrown away. Returns
    folder -> whether it was carried out. Runs that share a root must not overlap."""
    found = {}
    for staging in folders_in(spark, root):
        found[staging] = path_exists(spark, f"{staging}/{_COMMIT}")
        if found[staging]:
            _swap(spark, staging)
        else:
            remove_path(spark, staging)
    return found


def staging_root(quality: str, layer: str, odate: str, source: str) -> str:
    """Where a run writes a source's leaves of one date before they are swapped in."""
    return f"{quality.rstrip('/')}/_staging/{layer}/odate={odate}/{source}"


def write_split(df: DataFrame, column: str, paths: Mapping[str, str], staging: str) -> None:
    """Replace several leaves from one pass over ``df``: rows whose ``column``
    has a key of ``paths`` go to that leaf; a value without rows leaves an empty
    leaf. The old leaves stay until everything is written (``commit_leaves``)."""
    staged = stage_split(df, column, list(paths), staging)
    commit_leaves(df.sparkSession, staging, {path: staged[value] for value, path in paths.items()})


def read_quarantine(spark: SparkSession, quality: str, source: str, odates=None,
                    kind: str = "pattern") -> DataFrame:
    """Quarantined (or valid) rows of ``source`` across load dates, with ``odate``
    as a partition column. With a list of dates only their leaves are listed:
    the history beside them is not looked at. Dates without a leaf are left out;
    none with one is ``PATH_NOT_FOUND``, as for a read of the parent."""
    root = pattern_root(quality, source, kind)
    if odates is None:
        return read_parquet(spark, root)
    wanted = [pattern_out_path(quality, source, str(d), kind) for d in odates]
    there = [p for p in wanted if path_exists(spark, p)]
    return spark.read.option("basePath", root).parquet(*(there or wanted[:1] or [f"{root}/odate=none"]))


def write_leaves(frames: Mapping[str, DataFrame], max_workers: int = 4) -> None:
    """Write several independent leaves (path -> frame) as concurrent jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(frames), max_workers))) as pool:
        list(pool.map(lambda kv: write_leaf(kv[1], kv[0]), frames.items()))


def with_leaf_dir(df: DataFrame, name: str = "app_dir") -> DataFrame:
    """Add the name of the sub-directory above ``odate=`` each row came from
    (a glob read loses it)."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/odate=[^/]+/", 1))


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """``file`` for every data file at or below ``path`` (which may be a glob),
    whatever its name, also those that a read passes over because folders beside
    them look like partitions. Listing goes through the binary-file source with
    its ``content`` column pruned, so no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("file")))


def land_by_app(df: DataFrame, base: str, layer: str, source: str, odate: str,
                app_col: str = "app_folder", prefix: str = DEFAULT_PREFIX) -> None:
    """Land one dated load split into one sub-folder per app, in one job:
    ``<root>/<app_col>=<name>/odate=D``. Every app folder matches the
    ``<root>/*/odate=D`` glob. Only that date is replaced: its leaves go first
    (also of apps that deliver nothing any more), other dates stay. Rows are
    dealt by app before the write, and AQE splits large apps, so files follow
    the data, not tasks times apps."""
    root = source_root(base, layer, source, prefix)
    remove_paths(df.sparkSession, f"{glob_escaped(root)}/*/odate={odate}")
    (df.withColumn("odate", F.lit(odate)).hint("rebalance", F.col(app_col))
       .write.mode("append").partitionBy(app_col, "odate").parquet(root))
