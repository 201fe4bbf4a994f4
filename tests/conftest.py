from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from corpuslens.session import SESSION_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    for key, value in {**SESSION_CONF, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                       "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
