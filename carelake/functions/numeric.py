"""Rounding and guarded division on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int = 2) -> Column:
    """Round a double to `digits` decimals, exact halves to the even neighbour.

    Spark's own `round` sends halves away from zero, which moves values such as 0.125.
    """
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL where whole is 0 (ANSI mode would raise)."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_even(ratio(F.lit(100.0) * part, whole), digits)


def hundredths(value: Column) -> Column:
    """A value that already has two decimals, as an integer.

    Integer sums do not depend on the order rows arrive in; sums of doubles do.
    """
    return F.rint(value * F.lit(100.0)).cast("long")
