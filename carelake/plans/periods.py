"""G1, G5, G6 for any period from stored states, one row per key and day, that are merged at query time.

Three kinds of state, none of which needs the facts again:

* counted lengths of stay: exact, the default of `dms_between`;
* KLL sketches of the lengths (A5): bounded in size whatever the number of stays, quantiles with a rank error;
* theta sketches of the patients (A7): distinct counts of any union of days, codes and bands, and of intersections, which
  exact counts per day cannot give. Exact up to 2 ** `LG_ENTRIES` patients, then with a relative error.

A state is additive: states of newly admitted days are appended, and a day's states of several loads are merged by the query.
A stay delivered again must not be in two of them, so corrected months are computed anew and swapped (`PeriodStore.replace_months`).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import clinical
from carelake.functions.numeric import hundredths
from carelake.plans import gold
from carelake.session import delete

LG_ENTRIES = 14  # theta: exact to 16 384 patients a sketch, then a standard error of 1 / sqrt(16 384), 0.8 %
KLL_K = 400  # KLL: a quantile lies within 0.7 % of its rank, at 99 % confidence


def _day() -> Column:
    return F.to_date("admission_ts").alias("day")


# ---- states --------------------------------------------------------------------------------------


def length_state(stays: DataFrame) -> DataFrame:
    """Counted lengths of `fact_sejours` per service and day of admission."""
    return gold.length_counts(stays, _day())


def length_sketches(stays: DataFrame, k: int = KLL_K) -> DataFrame:
    """KLL sketch of the lengths of the finished stays, in hundredths of a day, per service and day of admission.

    A service without a finished stay on a day has no row that day.
    """
    finished = stays.filter((F.col("is_ongoing") == 0) & F.col("duree_sejour_jours").isNotNull())
    return finished.groupBy("service_code", _day()).agg(
        F.kll_sketch_agg_bigint(hundredths(F.col("duree_sejour_jours")), k).alias("lengths"))


def patient_sketches(diagnoses: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Theta sketch of the patients per pathology, age band and day of admission. diagnoses: `fact_diagnostics` with `admission_ts`."""
    return diagnoses.groupBy(
        "code_cim10", clinical.age_band_start(F.col("age_at_diagnostics")).alias("band_start"), _day(),
    ).agg(F.theta_sketch_agg(F.concat(F.lit("="), "patient_pseudo_id"), lg_entries).alias("patients"))  # a sketch skips empty text


class PeriodStore:
    """One state as Parquet by month of admission, so that a period reads its months and a corrected day swaps one of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def write(self, state: DataFrame) -> None:
        """Replace everything."""
        self._by_month(state).write.mode("overwrite").partitionBy("month").parquet(self.folder)

    def append(self, state: DataFrame) -> None:
        """Add states of stays that no state here holds yet."""
        self._by_month(state).write.mode("append").partitionBy("month").parquet(self.folder)

    def replace_months(self, state: DataFrame, months: Sequence[int]) -> None:
        """Put the states in `state` in place of all that these months (`yyyymm`) held; states of other months in it are ignored.

        Months are swapped one by one, as the writer's commit renames them. What is read must be the facts, not this store.
        """
        anew = self._by_month(state).filter(F.col("month").isin(list(months)))
        anew.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(self.folder)
        filled = {row.month for row in anew.select("month").distinct().collect()}  # at most the months asked for
        for month in set(months) - filled:
            delete(self.spark, f"{self.folder}/month={month}")

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """States of the days from `first` to `last`, both included; stays without admission only without bounds."""
        table = self.spark.read.parquet(self.folder)
        if first is not None:
            table = table.filter((F.col("month") >= _month(F.lit(first))) & (F.col("day") >= F.lit(first)))
        if last is not None:
            table = table.filter((F.col("month") <= _month(F.lit(last))) & (F.col("day") <= F.lit(last)))
        return table.drop("month")

    @staticmethod
    def _by_month(state: DataFrame) -> DataFrame:
        # rebalanced, so a month with many keys is several files and a small one is a single file
        return state.withColumn("month", F.coalesce(_month(F.col("day")), F.lit(0))).hint("rebalance", F.col("month"))


def _month(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


# ---- queries -------------------------------------------------------------------------------------


def dms_between(state: DataFrame, services: DataFrame) -> DataFrame:
    """G1 of the stays admitted on the days of a counted state: the mart's columns and values, the median exact."""
    return gold.dms_of_lengths(state, services)


def length_quantiles(sketches: DataFrame, ranks: Sequence[float]) -> DataFrame:
    """Quantiles of the lengths per service in days, from the merged sketches, and the number of stays in them."""
    merged = sketches.groupBy("service_code").agg(F.kll_merge_agg_bigint("lengths").alias("lengths"))
    quantiles = F.kll_sketch_get_quantile_bigint("lengths", F.array(*(F.lit(float(r)) for r in ranks)))
    return merged.select(
        "service_code", F.kll_sketch_get_n_bigint("lengths").alias("nb_sejours_termines"),
        F.transform(quantiles, lambda q: q / 100.0).alias("quantiles_jours"))


def patients_by(sketches: DataFrame, *keys: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Distinct patients per `keys`, of all days, codes and bands that the rest of the sketch rows stand for."""
    return sketches.groupBy(*keys).agg(
        F.theta_sketch_estimate(F.theta_union_agg("patients", lg_entries)).alias("nb_patients"))


def patients_with_both(sketches: DataFrame, pairs: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Patients that have both pathologies, for each of the asked `pairs` (code_a, code_b); 0 where a code has no row.

    Sketches are united per code first, so each pair joins two rows. Beyond the exact range the error is relative to
    the union of both codes, not to the shared patients.
    """
    per_code = sketches.groupBy("code_cim10").agg(F.theta_union_agg("patients", lg_entries).alias("patients"))
    one, other = (per_code.select(F.col("code_cim10").alias(f"code_{c}"), F.col("patients").alias(f"of_{c}")) for c in "ab")
    shared = F.theta_sketch_estimate(F.theta_intersection("of_a", "of_b"))
    asked = pairs.select("code_a", "code_b").distinct()
    return asked.join(one, "code_a", "left").join(other, "code_b", "left").select(
        "code_a", "code_b", F.coalesce(shared, F.lit(0)).alias("nb_patients"))
