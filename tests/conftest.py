import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="pagelake-wh-")
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("pagelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", warehouse)
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagelake-ckpt-"))
    yield session
    session.stop()


def make_pages(spark, pages):
    """pages: list of (page, status, body)."""
    from pagelake.operators.pages import PAGE_SCHEMA

    return spark.createDataFrame(pages, PAGE_SCHEMA)
