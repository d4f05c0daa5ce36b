import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="tessera-test-warehouse-")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.warehouse.dir", warehouse)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tessera-test-")
