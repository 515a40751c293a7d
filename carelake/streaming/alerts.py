"""B7, G4 in event time: alerts per sliding window from vital signs that arrive late, twice and in any order.

Two steps, each a start that takes what is new and stops. `divert` scores the measures and sets those apart that lie at
or before the frontier, the newest time of all earlier batches less the lateness: no window may still change by them, so they
are kept with a flag and counted on their own. `count_windows` counts the others with Spark's watermark: equal measures
once, each window written when it can no longer change. The frontier is the watermark, so the second step drops nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake import schemas
from carelake.functions.numeric import percent
from carelake.plans import gold, silver
from carelake.session import exists
from carelake.streaming.readmissions import STATE_STORE

MEASURE = ("stay_id", "ts", "heart_rate", "spo2", "temp_c")
_COUNTS = "debut timestamp, fin timestamp, nb_mesures_totales bigint, nb_alertes_totales bigint, nb_alertes_fc bigint, " \
          "nb_alertes_spo2 bigint, nb_alertes_temp bigint"


def frontier(spark: SparkSession, folder: str, batch: int, lateness: str) -> Column:
    """The time up to which the batches before `batch` have settled what they counted; NULL if there is none."""
    path = f"{folder}/newest"
    if not exists(spark, path):
        return F.lit(None).cast("timestamp")
    newest = spark.read.schema("newest timestamp, batch int").parquet(path).filter(F.col("batch") < batch).agg(
        F.max("newest").alias("newest")).first().newest
    return F.lit(newest).cast("timestamp") - F.expr(f"interval {lateness}")


def divert(monitoring: DataFrame, stays: DataFrame, folder: str, lateness: str) -> StreamingQuery:
    """Score the measures of the files not seen before, flag the late ones, then stop.

    Plausible measures of known stays go to `folder`/fact_monitoring/batch=n/late=true|false; a measure without time counts as late,
    because no window holds it. A batch is written by its number, and its frontier depends on the batches before it only, so one
    that was cut short gives the same again. `folder`/newest has one row a batch.
    """
    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        # streams switch adaptive execution off for the sake of state; there is none here
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        late = F.coalesce(F.col("ts") <= frontier(spark, folder, batch, lateness), F.col("ts").isNull())
        place = f"{folder}/fact_monitoring/batch={batch}"
        silver.fact_monitoring(rows, stays).withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(place)
        spark.read.schema(schemas.SILVER["fact_monitoring"]).parquet(place).agg(F.max("ts").alias("newest")).write.mode(
            "overwrite").parquet(f"{folder}/newest/batch={batch}")

    query = monitoring.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint-divert").trigger(
        availableNow=True).start()
    query.awaitTermination()
    return query


def count_windows(spark: SparkSession, folder: str, lateness: str, window: str = "1 day", slide: str | None = None) -> StreamingQuery:
    """Count the measures that `divert` found in time per window of `window`, one beginning every `slide`, then stop.

    `lateness` is that of `divert`. A measure delivered again counts once as long as it is not late. A window is written to
    `folder`/windows once, when the watermark has passed its end; later ones stay in the state for the next start. All of a
    start's rows are one batch: rows of one batch of `divert` never meet a watermark that the same batch has moved.
    """
    spark.conf.set(*STATE_STORE)
    found = spark.readStream.schema(schemas.SILVER["fact_monitoring"]).parquet(f"{folder}/fact_monitoring/batch=*/late=false")
    counts = found.withWatermark("ts", lateness).dropDuplicates(MEASURE).groupBy(
        F.window("ts", window, slide).alias("w")).agg(*gold.alert_counts())
    query = counts.select("w.start", "w.end", *counts.columns[1:]).toDF(*_names()).writeStream.format("parquet").option(
        "checkpointLocation", f"{folder}/checkpoint-windows").option("path", f"{folder}/windows").outputMode("append").trigger(
        availableNow=True).start()
    query.awaitTermination()
    return query


def late_measures(spark: SparkSession, folder: str) -> DataFrame:
    """The measures that came too late, as often as they came."""
    flags = [T.StructField("batch", T.IntegerType()), T.StructField("late", T.BooleanType())]
    table = spark.read.schema(T.StructType(schemas.SILVER["fact_monitoring"].fields + flags)).parquet(f"{folder}/fact_monitoring")
    return table.filter("late").drop("late")


def alerts_by_window(spark: SparkSession, folder: str, window: str = "1 day", slide: str | None = None) -> DataFrame:
    """Alerts of the closed windows, and the late measures of each (`nb_tardives`), also of windows that have nothing else."""
    late = late_measures(spark, folder).groupBy(F.window("ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("nb_tardives"))
    closed = spark.read.schema(_COUNTS).parquet(f"{folder}/windows")
    both = closed.join(late.select(F.col("w.start").alias("debut"), F.col("w.end").alias("fin"), "nb_tardives"), ["debut", "fin"], "full")
    return both.select("debut", "fin", *(F.coalesce(c, F.lit(0)).alias(c) for c in [*_names()[2:], "nb_tardives"])).withColumn(
        "taux_alertes_pct", percent(F.col("nb_alertes_totales"), F.col("nb_mesures_totales")))


def _names() -> list[str]:
    return [field.split()[0] for field in _COUNTS.split(", ")]
