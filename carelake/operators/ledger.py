"""What is still to be loaded: anti joins against what was loaded before, by file and version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.lookup import lookup


def unseen(incoming: DataFrame, ingested: DataFrame, key: str = "source_file") -> DataFrame:
    """Rows of `incoming` whose file is not in the ledger.

    The ledger is reduced to its distinct keys first. Used on file listings by the warehouse, so old
    files are not even opened; it also works on rows.
    """
    return lookup(incoming, ingested.select(key).distinct(), key, "left_anti")


def dates_to_process(available: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Drop dates never synchronised, or whose last synchronisation did not succeed.

    `ledger` holds one row per attempt: source_date, synced_at, success.
    """
    dates = available.select("source_date").distinct()
    if not force:
        last = ledger.groupBy("source_date").agg(F.max_by("success", "synced_at").alias("success"))
        dates = dates.join(last.filter("success"), "source_date", "left_anti")
    return dates.orderBy("source_date")


def last_attempts(records: DataFrame) -> DataFrame:
    """The last attempt per file, whole. `records`: source_file, version, recorded_at, success, and more.

    One row per delivered file; of attempts recorded at the same time a success counts as the later one.
    """
    rest = [c for c in records.columns if c not in ("source_file", "recorded_at", "success")]
    last = records.groupBy("source_file").agg(F.max(F.struct("recorded_at", "success", *rest)).alias("last"))
    return last.select("source_file", "last.*")


def due_files(listed: DataFrame, records: DataFrame, force: bool = False) -> DataFrame:
    """K1, K3: files whose present version was not processed by their last attempt, or all with `force`.

    `listed` holds one row per file: source_file, version, and more. So a file is due when it is new, however late it
    comes for its day, when it was delivered again with other content, and when its last attempt failed.
    """
    if force:
        return listed
    done = last_attempts(records).filter("success").select(
        F.col("source_file").alias("_file"), F.col("version").alias("_version"))
    same = (F.col("source_file") == F.col("_file")) & (F.col("version") == F.col("_version"))
    return listed.join(done, same, "left_anti")


def whole_days(records: DataFrame) -> DataFrame:
    """Files whose last attempt succeeded, of the days of which no file's last attempt failed."""
    last = last_attempts(records)
    broken = last.filter(~F.col("success")).select("source_date").distinct()
    return last.filter("success").join(broken, "source_date", "left_anti")
