"""Run log: one appended row per event of a run."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from carelake import schemas
from carelake.sources.store import TableStore

# Step names and states.
SYNC, INGEST, SILVER, GOLD = "1_SYNC_LAKE", "2_INGEST_BRONZE", "3_TRANSFORM_SILVER", "4_TRANSFORM_GOLD"
DONE = "ALL_STEPS_COMPLETED"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
ERROR_CHARS = 1000


class RunLog:
    """K7: RUNNING when a run starts and after each step, then SUCCESS or FAILED."""

    def __init__(self, spark: SparkSession, root: str, trigger: str = "MANUAL"):
        self.store = TableStore(spark, root, {"pipeline_runs": schemas.RUN_LOG})
        self.spark = spark
        self.run_id = str(uuid.uuid4())
        self.started_at = _now()
        self._append(RUNNING, f"START ({trigger})")

    def step(self, name: str, files: Sequence[str] = (), ingested: int = 0, rejected: int = 0) -> None:
        self._append(RUNNING, name, files, ingested, rejected)

    def success(self, files: Sequence[str], ingested: int, rejected: int) -> None:
        self._append(SUCCESS, DONE, files, ingested, rejected, finished=True)

    def failure(self, step: str, error: BaseException) -> None:
        self._append(FAILED, step, finished=True, error=str(error)[:ERROR_CHARS])

    def read(self) -> DataFrame:
        return self.store.read("pipeline_runs")

    def _append(
        self, status: str, step: str, files: Sequence[str] = (), ingested: int = 0, rejected: int = 0,
        finished: bool = False, error: str | None = None,
    ) -> None:
        row = (
            self.run_id, self.started_at, _now() if finished else None, status, step,
            list(files), ingested, rejected, error)
        self.store.append_log("pipeline_runs", self.spark.createDataFrame([row], schemas.RUN_LOG))


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0)
