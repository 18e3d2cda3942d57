from __future__ import annotations

import logging
import uuid

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    logging.disable(logging.CRITICAL)
    yield session
    session.stop()


@pytest.fixture
def out(tmp_path):
    """A path that does not exist yet."""
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
