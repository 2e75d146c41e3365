import os
import sys
import tempfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import feedwell  # noqa: E402

# Tasks get the package as the test has it, with parameters that it changed.
cloudpickle.register_pickle_by_value(feedwell)


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-")
    session = (
        SparkSession.builder.master("local[8]").appName("feedwell-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
