import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from goalcast.session import prepare
    ckpt = tempfile.mkdtemp(prefix="goalcast-test-ckpt-", dir="/tmp")
    s = (SparkSession.builder.master("local[4]").appName("goalcast-tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    prepare(s)
    yield s


@pytest.fixture()
def scratch(spark):
    from goalcast.session import scratch_path
    return lambda name: scratch_path(spark, name)
