from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from carelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("carelake-tests", 4, **{
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values: str) -> None:
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
