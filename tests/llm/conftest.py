from __future__ import annotations

import pytest

from carelake.llm.common import importable


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture
def parquet(spark, tmp_path):
    """Write rows as a table of a folder and return the folder; several files, so that rows come from several tasks."""
    def write(name: str, rows: list, schema: str, files: int = 3) -> str:
        spark.createDataFrame(rows, schema).repartition(files).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
