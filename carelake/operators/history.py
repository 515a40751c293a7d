"""Versions of a key over time, and the version valid on a day.

One key may own a large share of the rows on either side. So both sides are reduced to one row per key and day first, by
aggregations that combine in the map tasks: what meets in one window are days of one key, as many as the calendar
has, not rows. The facts themselves meet their version in a join that AQE can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.operators.dedup import VERSION, latest_per_key
from carelake.operators.lookup import lookup


def intervals(versions: DataFrame, key: str, columns: Sequence[str], version: Sequence[str] = VERSION) -> DataFrame:
    """(key, columns, valid_from, valid_to): one row per key and run of days on which the columns stay the same.

    `version` begins with the day; of the versions of one day the greatest counts, as in `latest_per_key`. A version
    holds until the day of the next different one, which is not part of it; the last one has no end (null).
    """
    day, *ties = version
    daily = latest_per_key(versions.select(key, *version, *columns), [key, day], ties)
    by_day = Window.partitionBy(key).orderBy(day)
    values = F.struct(*columns)
    changes = daily.select(key, *columns, F.col(day).alias("valid_from"), F.lag(values).over(by_day).alias("_before")).filter(
        F.col("_before").isNull() | ~values.eqNullSafe(F.col("_before")))
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return changes.select(key, *columns, "valid_from", following.alias("valid_to"))


def as_of(facts: DataFrame, history: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """The facts with the columns of the version valid on their `day` (a date). Facts of unknown keys are left out.

    history: `intervals`. The first version also holds before it was delivered, as nothing earlier is known. A fact
    without a day has the last version.
    """
    given = history.select(key, F.col("valid_from").alias("_day"), F.struct(*columns).alias("_values"))
    asked = facts.select(key, day).distinct().select(
        key, F.coalesce(day, F.lit("9999-12-31").cast("date")).alias("_day"), F.lit(None).cast(given.schema["_values"].dataType).alias("_values"))
    # a version counts from its day on: on that day it stands before the facts that ask
    days = Window.partitionBy(key).orderBy("_day", F.col("_values").isNull())
    until, all_ = days.rowsBetween(Window.unboundedPreceding, 0), days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = asked.unionByName(given).select(
        key, "_day", "_values", F.last("_values", ignorenulls=True).over(until).alias("_last"),
        F.first("_values", ignorenulls=True).over(all_).alias("_first"))
    valid = ordered.filter("_values is null").select(
        _place(key, "_day").alias("_at"), F.coalesce("_last", "_first").alias("_valid")).filter("_valid is not null")
    located = facts.withColumn("_at", _place(key, day))
    return lookup(located, valid, "_at").select(*facts.columns, *(F.col(f"_valid.{c}").alias(c) for c in columns))


def _place(key: str, day: str) -> Column:
    """Key and day as one text, null for a null key; the day has a fixed length, so no two pairs share one."""
    return F.concat(F.coalesce(day, F.lit("9999-12-31").cast("date")).cast("string"), F.col(key).cast("string"))
