import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tollgate.session import fresh_run_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", os.environ.get("TOLLGATE_TEST_CHECKPOINTS") or tempfile.mkdtemp(prefix="tollgate-tests-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def workdir(spark, request):
    """A fresh folder under the shared checkpoint directory, never reused."""
    return fresh_run_dir(spark, "test-" + request.node.name[:40].replace("[", "_").replace("]", ""))
