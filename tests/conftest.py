import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hazardlens.session import RECOMMENDED  # noqa: E402


def make_session(folder: str) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("hazardlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(str(tmp_path_factory.mktemp("spark")))
    yield session
    session.stop()
