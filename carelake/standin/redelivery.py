"""A query that drives the real readers and writers of the lake and of bronze through three deliveries.

Drops are written from the driver's tables: customers as patients, orders as stays, events as vital signs, dealt over
four days. `redeliveries` returns what bronze holds in the end.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.plans.warehouse import Folders, Warehouse
from carelake.session import shared_folder

_DAYS = tuple(f"2026-08-0{d}" for d in range(1, 5))


def _stay_of_user() -> Column:
    """Some users are stays of the first delivery, some of the second, some of none."""
    return F.concat(F.lit("S"), (F.col("user_id") * 101).cast("string"))


class _Drops:
    """Delivers rows of the driver's tables as files of a day, in place of what lay there."""

    def __init__(self, spark: SparkSession, folder: str, root: str):
        self.spark, self.folder, self.root = spark, folder, root

    def _table(self, name: str, key: str, modulus: int, rest: int) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return rows.filter(F.pmod(F.col(key), F.lit(modulus)) == rest)

    def patients(self, day: str, modulus: int, rest: int, born: str) -> None:
        key = F.col("c_custkey").cast("string")
        rows = self._table("customer", "c_custkey", modulus, rest).select(
            F.concat(F.lit(" IPP"), key).alias("patient_id"), F.lit("1 85").alias("nir"), F.lit("Du, \"pont\"").alias("nom"),
            F.lit("Zoé").alias("prenom"), F.lit(born).alias("birth_date"), F.lit(" f").alias("sex"),
            F.concat(F.lit("R"), key, F.lit(" ")).alias("region_code"))
        self._csv(rows, f"patients/{day}/patients.csv")

    def stays(self, day: str, modulus: int, rest: int, services: int = 25) -> None:
        stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
        rows = self._table("orders", "o_orderkey", modulus, rest).select(
            F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("stay_id"),
            F.concat(F.lit("IPP"), F.col("o_custkey").cast("string")).alias("patient_id"),
            F.concat(F.lit("N"), (F.col("o_orderkey") % services).cast("string")).alias("service_code"),
            stamp.alias("admission_ts"), F.lit("").alias("discharge_ts"), F.lit("urgence").alias("admission_mode"),
            F.lit("").alias("discharge_mode"))
        self._csv(rows, f"sejours/{day}/sejours.csv")

    def vitals(self, day: str, rest: int, stay: Column | None = None, rates: int = 200) -> None:
        event = F.col("event_id")
        self._table("events", "event_id", 4, rest).select(
            (F.concat(F.lit("E"), event.cast("string")) if stay is None else stay).alias("stay_id"), F.col("ts").cast("timestamp").alias("ts"),
            (event % rates).cast("smallint").alias("heart_rate"), F.lit(98).cast("smallint").alias("spo2"),
            F.lit(37.0).cast("float").alias("temp_c"),
        ).write.mode("overwrite").parquet(f"{self.root}/monitoring/{day}/monitoring.parquet")

    def damaged_vitals(self, day: str) -> None:
        self.spark.createDataFrame([("no table",)], "value string").write.mode("overwrite").text(
            f"{self.root}/monitoring/{day}/monitoring.parquet")

    def _csv(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{self.root}/{path}")


def redeliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged, corrected, late and emptied files, each day loaded when all its files are sound."""
    root = f"{shared_folder(spark)}/redeliveries-{uuid.uuid4().hex}"
    warehouse, given = Warehouse(spark, Folders(f"{root}/drops", f"{root}/warehouse"), "a key for the check"), _Drops(spark, folder, f"{root}/drops")

    def taken() -> None:
        warehouse.sync_lake()
        warehouse.load_bronze()

    for rest, day in enumerate(_DAYS):
        given.patients(day, 4, rest, "1950-01-01")
        given.stays(day, 4, rest)
    given.vitals(_DAYS[0], 0)
    given.damaged_vitals(_DAYS[1])  # the second day waits
    given.vitals(_DAYS[2], 2)
    taken()

    given.patients(_DAYS[0], 8, 0, "1960-01-01")  # corrected: other years, fewer rows
    given.patients(_DAYS[1], 4, 1, "1970-01-01")
    given.vitals(_DAYS[1], 1)
    given.vitals(_DAYS[3], 3)  # late for a day that was loaded
    taken()

    given.stays(_DAYS[2], 1, -1)  # emptied: a header and no row
    given.damaged_vitals(_DAYS[0])  # the first day waits with what was loaded of it
    given.stays(_DAYS[0], 8, 0)
    taken()

    def rows(table: str, key: Column, detail: Column) -> DataFrame:
        return warehouse.bronze.read(table).select(
            F.lit(table).alias("table_name"), key.alias("key"), detail.cast("string").alias("detail"), "source_date", "source_file")

    return reduce(DataFrame.unionByName, (
        rows("patients", F.concat("region_code", "sex"), F.col("birth_year")),
        rows("sejours", F.col("stay_id"), F.col("service_code")),
        rows("monitoring", F.col("stay_id"), F.col("heart_rate")),
    ))


def silver_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Silver brought up to date after each of three deliveries, without a rebuild: stays per service and vital signs.

    The second delivery brings stays whose vital signs are there already, the third moves stays of the first to other
    services, takes some back, and replaces the vital signs of one day.
    """
    root = f"{shared_folder(spark)}/silver-incremental-{uuid.uuid4().hex}"
    warehouse, given = Warehouse(spark, Folders(f"{root}/drops", f"{root}/warehouse"), "a key for the check"), _Drops(spark, folder, f"{root}/drops")

    def taken() -> dict[str, DataFrame]:
        warehouse.sync_lake()
        warehouse.load_bronze()
        return warehouse.update_silver()

    given.stays(_DAYS[0], 2, 0)
    for rest, day in enumerate(_DAYS):
        given.vitals(day, rest, _stay_of_user())
    taken()
    given.stays(_DAYS[1], 2, 1)
    taken()
    given.stays(_DAYS[0], 4, 0, 7)
    given.vitals(_DAYS[3], 3, _stay_of_user(), 50)
    found = taken()
    stays = found["fact_sejours"].groupBy("service_code").agg(F.count("*").alias("nb")).select(
        F.lit("stays").alias("kind"), F.lit(None).cast("string").alias("stay_id"), "service_code",
        F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("smallint").alias("heart_rate"), F.lit(None).cast("int").alias("is_alert"), "nb")
    vitals = found["fact_monitoring"].groupBy("stay_id", "service_code", "ts", "heart_rate", "is_alert").agg(
        F.count("*").alias("nb")).select(F.lit("vitals").alias("kind"), "stay_id", "service_code", "ts", "heart_rate", "is_alert", "nb")
    return stays.unionByName(vitals)


QUERIES = {"redeliveries": redeliveries, "silver_incremental": silver_incremental}

SQL = {
    "redeliveries": """
        with dealt as (
            select 'patients' as table_name, 'R' || c_custkey || 'F' as key,
                   case c_custkey % 4 when 0 then '1960' when 1 then '1970' else '1950' end as detail,
                   c_custkey % 4 as day, 'patients/' as folder, '/patients.csv' as file
            from customer where c_custkey % 8 <> 4
            union all
            select 'sejours', 'S' || o_orderkey, 'N' || (o_orderkey % 25), o_orderkey % 4, 'sejours/', '/sejours.csv'
            from orders where o_orderkey % 4 <> 2
            union all
            select 'monitoring', 'E' || event_id, cast(event_id % 200 as varchar), event_id % 4, 'monitoring/', '/monitoring.parquet'
            from events)
        select table_name, key, detail, cast(date '2026-08-01' + cast(day as integer) as date) as source_date,
               folder || cast(date '2026-08-01' + cast(day as integer) as date) || file as source_file
        from dealt""",
    "silver_incremental": """
        with stays as (
            select 'S' || o_orderkey as stay_id,
                   'N' || case when o_orderkey % 4 = 0 then o_orderkey % 7 else o_orderkey % 25 end as service_code
            from orders where o_orderkey % 4 <> 2),
        vitals as (
            select 'S' || (user_id * 101) as stay_id, ts,
                   cast(case when event_id % 4 = 3 then event_id % 50 else event_id % 200 end as smallint) as heart_rate
            from events)
        select 'stays' as kind, cast(null as varchar) as stay_id, service_code, cast(null as timestamp) as ts,
               cast(null as smallint) as heart_rate, cast(null as integer) as is_alert, count(*) as nb
        from stays group by service_code
        union all
        select 'vitals', stay_id, service_code, ts, heart_rate, case when heart_rate < 50 or heart_rate > 120 then 1 else 0 end, count(*)
        from vitals join stays using (stay_id) where heart_rate between 20 and 250 group by all""",
}
