"""Valid rows, rejected rows and why, from one pass over the input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def tag(df: DataFrame, **rules: Column) -> DataFrame:
    """Add the name of the first rule a row breaks, NULL for a valid row.

    A rule is the condition a valid row meets; a condition that is NULL counts as broken.
    """
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    reason = F.coalesce(*broken, F.lit(None).cast("string"))
    return df.withColumn(REASON, reason)


def valid(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def count_by_reason(table: str, tagged: DataFrame, state: Column) -> DataFrame:
    """(table_name, reason, nb_rows); rows without reject reason are counted under their `state`."""
    reason = F.coalesce(F.col(REASON), state).alias("reason")
    counts = tagged.groupBy(reason).agg(F.count(F.lit(1)).alias("nb_rows"))
    return counts.select(F.lit(table).alias("table_name"), "reason", "nb_rows")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, nb_rows) of every table, as one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("nb_rows")).select(F.lit(name).alias("table_name"), "nb_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
