"""Stay, vital-sign and age rules as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.numeric import round_even

# ---- stays ---------------------------------------------------------------------------------------


def is_coherent(admission: Column, discharge: Column) -> Column:
    """A stay is ongoing or ends no earlier than it starts."""
    return discharge.isNull() | (discharge >= admission)


def ongoing_flag(discharge: Column) -> Column:
    return discharge.isNull().cast("int")


def length_of_stay(admission: Column, discharge: Column, unit_seconds: int) -> Column:
    """Length in hours (3600) or days (86400), two decimals, NULL while the stay is ongoing."""
    seconds = F.unix_timestamp(discharge) - F.unix_timestamp(admission)
    return round_even(seconds / F.lit(float(unit_seconds)))


# ---- vital signs ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vital:
    """One vital sign: plausible range (inclusive) and normal range."""

    column: str
    flag: str
    reason: str
    lowest: float
    highest: float
    normal_from: float | None
    normal_to: float | None
    normal_to_included: bool = True

    @property
    def plausible(self) -> Column:
        return F.col(self.column).isNull() | F.col(self.column).between(self.lowest, self.highest)

    @property
    def abnormal(self) -> Column:
        """NULL for a missing measure, so it never raises an alert."""
        value, outside = F.col(self.column), F.lit(False)
        if self.normal_from is not None:
            outside = outside | (value < self.normal_from)
        if self.normal_to is not None:
            above = value > self.normal_to if self.normal_to_included else value >= self.normal_to
            outside = outside | above
        return outside


# Fixed values of the clinical rules: limits, flag columns and reason words.
VITALS = (
    Vital("heart_rate", "is_alert_fc", "FC_ANORMALE", 20, 250, 50, 120),
    Vital("spo2", "is_alert_spo2", "HYPOXIE", 50, 100, 92, None),
    Vital("temp_c", "is_alert_temp", "TEMP_ANORMALE", 30.0, 45.0, 36.0, 38.5, normal_to_included=False),
)


def vitals_plausible() -> Column:
    condition = F.lit(True)
    for vital in VITALS:
        condition = condition & vital.plausible
    return condition


def alert_flags() -> list[Column]:
    """`is_alert` and one 0/1 flag per vital sign."""
    flags = {v.flag: F.when(v.abnormal, 1).otherwise(0) for v in VITALS}
    return [F.greatest(*flags.values()).alias("is_alert"), *(c.alias(n) for n, c in flags.items())]


def alert_reasons(compact: bool = False) -> Column:
    """Reason words joined by commas.

    By default every vital sign keeps its place, so a row without alert reads `,,`. `compact` leaves
    out the empty places.
    """
    blank = F.lit(None) if compact else F.lit("")
    return F.concat_ws(",", *(F.when(v.abnormal, F.lit(v.reason)).otherwise(blank) for v in VITALS))


# ---- ages ----------------------------------------------------------------------------------------

UNKNOWN_BAND = "inconnu"
_OLDEST_BAND = 100


def age_at(event: Column, year_of_birth: Column) -> Column:
    """Age in calendar years, never negative; NULL when the year of birth is unknown."""
    years = F.year(event) - F.nullif(year_of_birth, F.lit(0))
    return F.when(years.isNotNull(), F.greatest(F.lit(0), years)).cast("int")


def age_band_start(age: Column) -> Column:
    """First age of the ten-year band (100 for everyone older); the order bands should be listed in."""
    start = F.least((F.floor(age / 10) * 10).cast("int"), F.lit(_OLDEST_BAND))
    return F.when(age.isNotNull(), start)  # least() ignores NULL


def age_band(age: Column) -> Column:
    """Band label: `0-9 ans` ... `90-99 ans`, `100+ ans`, or `inconnu`."""
    start = age_band_start(age)
    decade = F.concat_ws("-", start.cast("string"), (start + 9).cast("string"))
    return (
        F.when(age.isNull(), F.lit(UNKNOWN_BAND))
        .when(start == _OLDEST_BAND, F.lit(f"{_OLDEST_BAND}+ ans"))
        .otherwise(F.concat(decade, F.lit(" ans")))
    )


# ---- reference defaults --------------------------------------------------------------------------


def blank_to(text: Column, default: str) -> Column:
    """`default` for a missing or blank text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))
