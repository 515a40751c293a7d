"""Reference tables are delivered whole; the newest delivery replaces the earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_snapshot(deliveries: DataFrame) -> DataFrame:
    """Rows of the newest `source_date`. Empty deliveries have no rows, hence replace nothing.

    The joined side is one row, so it is broadcast whatever the table holds; on a table partitioned
    by `source_date` it also prunes the scan.
    """
    newest = deliveries.agg(F.max("source_date").alias("source_date"))
    return deliveries.join(F.broadcast(newest), "source_date", "left_semi")
