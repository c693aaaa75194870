import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starloom.session import SETTINGS

    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.maxMetadataStringLength": "4000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def store(spark, tmp_path):
    from uuid import uuid4

    from starloom.sinks.store import StarStore

    return StarStore(spark, f"star_{uuid4().hex[:8]}", str(tmp_path / "store"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
