from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from haulage.session import BASE_SETTINGS

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    builder = SparkSession.builder.master("local[4]").appName("tests")
    settings = {
        **BASE_SETTINGS,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(root),
        "spark.sql.warehouse.dir": str(root / "warehouse"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("test tables are not here")
    return TESTDATA
