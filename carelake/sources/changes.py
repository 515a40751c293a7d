"""Which stays, patients and months the loads of bronze touched."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.session import exists

# Key and time of the rows of each table that silver derives facts from.
KEY_OF = {
    "patients": ("patient_pseudo_id", None), "sejours": ("stay_id", "admission_ts"), "diagnostics": ("stay_id", None),
    "monitoring": ("stay_id", "ts"), "actes": ("stay_id", "acte_ts"),
}
_ROWS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("load", T.StringType()),
    T.StructField("source_date", T.DateType()),
])


def month(stamp: str | Column) -> Column:
    return F.date_format(stamp, "yyyyMM")


class ChangeFeed:
    """The distinct keys and months of every load, by the day of the file they came in.

    Nothing is taken out: when a file is loaded again, the keys of the rows that this replaces are still there from the
    load that brought them. So what a day's files touched are the rows of that day, of all loads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def append(self, table: str, rows: DataFrame, load: str) -> None:
        """Note the rows about to be loaded; called before bronze changes, so that a load cut short leaves no gap."""
        key, stamp = KEY_OF[table]
        moment = month(stamp) if stamp else F.lit(None).cast("string")
        rows.select(F.col(key).alias("key"), moment.alias("month"), F.lit(load).alias("load"), "source_date").distinct().write.mode(
            "append").partitionBy("load", "source_date").parquet(f"{self.root}/{table}")

    def read(self, table: str, days: Iterable[date] | None = None) -> DataFrame:
        path = f"{self.root}/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], _ROWS)
        rows = self.spark.read.schema(_ROWS).parquet(path)
        return rows if days is None else rows.filter(F.col("source_date").isin(list(days)))

    def keys(self, table: str, days: Iterable[date]) -> DataFrame:
        """(key) of the rows that the files of these days have or had."""
        return self.read(table, days).select("key").distinct()

    def months(self, rows: DataFrame) -> list[str]:
        """The months of feed rows; a list as long as the calendar is."""
        return sorted(r[0] for r in rows.select("month").distinct().collect() if r[0] is not None)

    def days_of(self, table: str, months: Sequence[str]) -> list[date]:
        """The days of which a file has, or had, rows in one of the months."""
        found = self.read(table).filter(F.col("month").isin(list(months))).select("source_date").distinct()
        return sorted(r[0] for r in found.collect())
