import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("moraine-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A fresh database in a fresh folder."""
    from workload.scratch import new_database

    name, _ = new_database(spark, "test")
    return name


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
