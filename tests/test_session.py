"""Shipping of the package's modules, and paths of the shared folder."""

import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

from tollgate.session import ship_package

#: A fresh application, whose first calls come from several threads at once.
FRESH = """
import sys
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier
from tollgate.session import local_session, ship_package
spark = local_session(2)
sc = spark.sparkContext
added = []
real = sc.addPyFile
sc.addPyFile = lambda path: (added.append(path), real(path))
for _ in range(50):
    sc._tollgate_shipped = False
    together = Barrier(8)
    def first():
        together.wait()
        ship_package(spark)
    with ThreadPoolExecutor(8) as pool:
        for done in [pool.submit(first) for _ in range(8)]:
            done.result()
assert len(added) == 50, len(added)
assert len({p.rsplit("/", 1)[1] for p in added}) == 1, added
print("shipped", len(added))
"""


def test_threads_ship_once_per_round():
    done = subprocess.run([sys.executable, "-c", FRESH], capture_output=True, text=True, timeout=300)
    assert done.stdout.strip() == "shipped 50", done.stderr[-2000:]


def test_shipping_again_does_nothing(spark):
    ship_package(spark)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda _: ship_package(spark), range(64)))
    assert spark.sparkContext._tollgate_shipped


def test_released_scratch_is_gone(spark):
    from tollgate.session import fresh_run_dir, path_exists, release_scratch, scratch_folders
    paths = [fresh_run_dir(spark, f"scratch-{k}") for k in range(3)]
    for path in paths:
        spark.range(2).write.parquet(path)
    release_scratch(spark, [paths[0], paths[2], "/never/registered"])
    assert [path_exists(spark, p) for p in paths] == [False, True, False]
    assert paths[1] in scratch_folders() and not set(scratch_folders()) & {paths[0], paths[2]}
