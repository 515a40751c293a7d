"""Joins of large facts to an index of unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, index: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join facts to an index that holds one row per text `key`, whatever share of the facts one key owns.

    AQE splits the partition of a key with many facts, but only where both sides were shuffled for
    this join. An index that comes straight out of an aggregation by the same key is not: Spark would
    reuse its partitioning, and the large key would stay in one task. Asking for the length of the
    key to be equal as well, which it always is, makes that partitioning unfit, so the index, the
    smaller side, is shuffled for the join. An index read from a written table costs nothing extra.
    """
    index = index.withColumnRenamed(key, "_key")
    same = (F.col(key) == F.col("_key")) & (F.length(key) == F.length("_key"))
    return facts.join(index, same, how).drop("_key")
