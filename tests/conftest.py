import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from obsflow.session import configure

    s = (
        SparkSession.builder.master("local[*]")
        .appName("obsflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="obsflow-warehouse-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="obsflow-tests-")
        s.conf.set("spark.checkpoint.dir", root)
    configure(s)
    yield s


@pytest.fixture
def tmp_root(spark):
    from obsflow.session import scratch_dir

    return scratch_dir(spark, "test")
