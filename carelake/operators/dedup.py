"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = ("source_date", "source_file")


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str] = VERSION) -> DataFrame:
    """Keep, per key, the whole row with the greatest version; the other columns settle ties.

    An aggregation, so a key that owns a large share of the rows is reduced to one row in each map
    task before the shuffle. It also sorts less than a ranking window: only by the key.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    rows = df.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("row"))
    return rows.select(*(c if c in keys else f"row.{c}" for c in df.columns))
