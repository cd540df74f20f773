"""Session helpers: a local session for tests and the bench, and the shared
work folder every lake write of the query catalog goes to."""

from __future__ import annotations

import atexit
import hashlib
import io
import logging
import os
import re
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import SparkSession

log = logging.getLogger("tollgate.session")


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tollgate", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller owns the
    session; nothing in the library creates one."""
    cpus = str(cpus)
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cpus == "*" else max(1, int(cpus))
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TOLLGATE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master may it be unset: a fresh local folder is then created
    and registered as the checkpoint directory. Elsewhere every executor would
    write to its own disk, so that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if conf_dir:
        return conf_dir.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
    local = tempfile.mkdtemp(prefix="tollgate-checkpoints-")
    sc.setCheckpointDir(local)
    return local


def fresh_run_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused folder under the shared directory for one run. It is
    removed when the driver ends: results read from it stay readable till then."""
    path = f"{shared_dir(spark)}/tollgate/{label}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


def scratch_folders() -> list[str]:
    """The folders that ``fresh_run_dir`` gave and that are still there, oldest first."""
    return [path for _, path in _scratch]


def release_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes scratch folders before the driver ends: nothing reads them any more."""
    for path in set(paths):
        if (spark, path) in _scratch:
            _scratch.remove((spark, path))
            remove_path(spark, path)


def _remove_scratch() -> None:
    for spark, path in _scratch:
        try:
            if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
                continue
            remove_path(spark, path)
        except Exception as exc:  # noqa: BLE001 - the driver is ending, maybe its JVM has gone
            log.debug("scratch folder %s stays: %s", path, exc)
    _scratch.clear()


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, store = _hadoop_path(spark, path)
    return store.exists(p)


def glob_escaped(path: str) -> str:
    """A path as a glob that matches it alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Removes one file or folder, in whatever store Spark reads; its name is
    taken as it is. Whether there was one."""
    p, store = _hadoop_path(spark, path)
    return store.delete(p, True)


def remove_paths(spark: SparkSession, pattern: str) -> int:
    """Removes what the glob ``pattern`` matches; returns how many entries that
    were. Names that may hold glob characters go through ``glob_escaped``."""
    p, store = _hadoop_path(spark, pattern)
    found = [st.getPath() for st in store.globStatus(p) or []]
    for one in found:
        store.delete(one, True)
    return len(found)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """The folders right under ``path``; none if it is not there."""
    p, store = _hadoop_path(spark, path)
    if not store.exists(p):
        return []
    return sorted(st.getPath().toString() for st in store.listStatus(p) if st.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside, then renamed."""
    p, store = _hadoop_path(spark, path + ".part")
    out = store.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    move_path(spark, path + ".part", path)


def read_text(spark: SparkSession, path: str) -> str:
    p, store = _hadoop_path(spark, path)
    found = store.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
    finally:
        found.close()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder in its store; the target must not exist."""
    p, store = _hadoop_path(spark, source)
    q, _ = _hadoop_path(spark, target)
    store.mkdirs(q.getParent())
    if not store.rename(p, q):
        raise OSError(f"could not move {source} to {target}")


#: Rows and bytes that Spark sends to a Python worker at a time: its defaults (10,000 rows, 64 MB)
#: are held several times over, by the JVM and by the worker of each task.
ARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of this session get the bounds above, but for those that the caller has set."""
    known = spark.conf.getAll
    for key, value in ARROW_BATCHES.items():
        if key not in known:
            spark.conf.set(key, value)


_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's modules to the executors, once per application, so
    that Python workers can import them wherever the driver was started. Threads
    that ask at a time wait for the one that ships; the archive is named by its
    content and holds no dates, so a second one of the same name is the same."""
    sc = spark.sparkContext
    with _shipping:
        if getattr(sc, "_tollgate_shipped", False):
            return
        root = Path(__file__).resolve().parent
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.writestr(zipfile.ZipInfo(str(f.relative_to(root.parent))), f.read_bytes())
        name = f"tollgate-modules-{hashlib.sha256(content.getvalue()).hexdigest()[:16]}.zip"
        folder = tempfile.mkdtemp(prefix="tollgate-modules-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, name)
        Path(path).write_bytes(content.getvalue())
        sc.addPyFile(path)
        sc._tollgate_shipped = True
