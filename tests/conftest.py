import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("grist-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="grist-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="grist-test-")
