"""One small session for all tests."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tidemark.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session("local[4]", 4, **{"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF
