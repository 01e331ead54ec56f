"""A local Spark session for the tests."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from millrace.session import build_session


def local_session() -> SparkSession:
    spark = build_session(
        "millrace-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return local_session()
