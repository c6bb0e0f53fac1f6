import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cadenza.session import prepare

    scratch = tempfile.mkdtemp(prefix="cadenza-test-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("cadenza-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF
