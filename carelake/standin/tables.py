"""The driver's tables in the shape of the bronze tables.

Hospital files are not among the driver's tables, so orders stand in for stays and patient versions,
line items for diagnoses and procedures, events for vital signs, and nation, region and part for the
reference data. Every table is used whole. `carelake.standin.oracle` says the same in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.plans import silver
from carelake.session import configure
from carelake.sources.diagnostics import flatten


def _prefixed(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _drop(entity: str, day: Column, file: Column | str) -> list[Column]:
    """Lineage of a row delivered on `day`."""
    file = F.lit(file) if isinstance(file, str) else file
    date = day.cast("date")
    path = F.concat_ws("/", F.lit(entity), date.cast("string"), file)
    return [date.alias("source_date"), path.alias("source_file")]


def _pick(selector: Column, *values: str) -> Column:
    """The value at the selector's place."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (selector + 1).cast("int"))


class Standin:
    """Bronze-shaped DataFrames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- raw drops -------------------------------------------------------------------------------

    @cached_property
    def raw_patients(self) -> DataFrame:
        """Customers with direct identifiers, untidy on purpose."""
        key = F.col("c_custkey")
        birth = _pick(
            key % 5, "1950-04-12", " 1985-11-30", "85-04-12", "", "2001")
        return self.table("customer").select(
            F.concat(F.lit(" IPP"), key.cast("string"), F.lit("\t")).alias("patient_id"),
            _prefixed("1 85 ", key).alias("nir"),
            F.col("c_name").alias("nom"),
            F.col("c_mktsegment").alias("prenom"),
            F.when(key % 7 != 0, birth).alias("birth_date"),
            _pick(key % 3, " f", "M ", "m").alias("sex"),
            F.concat(F.lit(" R"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("region_code"),
        )

    @cached_property
    def raw_diagnostics(self) -> DataFrame:
        """One nested record per line item: two diagnoses, one without type, or none."""
        first = F.struct(
            _prefixed("C", F.col("l_partkey") % 41).alias("code_cim10"),
            F.when(F.col("l_linenumber") == 1, "principal")
            .when(F.col("l_linenumber") != 2, "associe").alias("type"),
        )
        second = F.struct(
            _prefixed("C", F.col("l_suppkey") % 41).alias("code_cim10"), F.lit("associe").alias("type"))
        return self.table("lineitem").select(
            _prefixed("S", F.col("l_orderkey")).alias("stay_id"),
            F.when(F.col("l_quantity") >= 10, F.array(first, second))
            .when(F.col("l_returnflag") != "N", F.array(first))
            .otherwise(F.array().cast("array<struct<code_cim10:string,type:string>>")).alias("diagnostics"),
            *_drop("diagnostics", F.col("l_shipdate"), "diagnostics.json"),
        )

    # ---- bronze ----------------------------------------------------------------------------------

    @cached_property
    def sejours(self) -> DataFrame:
        """Orders as stays; every tenth is delivered a second time a month later, finished."""
        key = F.col("o_orderkey")
        deliveries = self.table("orders").withColumn(
            "version", F.explode(F.when(key % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        first = F.col("version") == 1
        service = F.when(key % 26 == 0, F.lit("URGENCES")).otherwise(_prefixed("NATION_", key % 26))
        admission = F.timestamp_seconds(
            F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + (key * 37 % 1440) * 60)
        hours = F.when(first, key * 7 % 241 - 5).otherwise(key * 7 % 241 + 1)
        ongoing = first & (F.col("o_orderstatus") == "P")
        discharge = F.timestamp_seconds(F.unix_timestamp("admission_ts") + hours * 3600)
        outcome = _pick(F.col("o_custkey") % 4, "domicile", "mutation", "transfert", "deces")
        priority = F.col("o_orderpriority")
        delivered = F.when(first, F.col("o_orderdate").cast("date")).otherwise(
            F.date_add(F.col("o_orderdate").cast("date"), 30))
        return deliveries.withColumn("admission_ts", admission).select(
            _prefixed("S", key).alias("stay_id"),
            _prefixed("P", F.col("o_custkey")).alias("patient_pseudo_id"),
            service.alias("service_code"),
            "admission_ts",
            F.when(~ongoing, discharge).alias("discharge_ts"),
            F.when(priority.startswith("1") | priority.startswith("2"), "urgence")
            .when(priority.startswith("3"), "mutation").otherwise("programme").alias("admission_mode"),
            F.when(ongoing, F.lit("")).otherwise(outcome).alias("discharge_mode"),
            *_drop("sejours", delivered, "sejours.csv"),
        )

    @cached_property
    def patients(self) -> DataFrame:
        """Every order is a version of its customer."""
        patient, version = F.col("o_custkey"), F.col("o_orderkey")
        return self.table("orders").select(
            _prefixed("P", patient).alias("patient_pseudo_id"),
            F.when(patient % 37 != 0, 1920 + patient % 90).otherwise(0).cast("int").alias("birth_year"),
            _pick(version % 2, "F", "M").alias("sex"),
            _prefixed("R", version % 13).alias("region_code"),
            *_drop("patients", F.col("o_orderdate"), "patients.csv"),
        )

    @cached_property
    def diagnostics(self) -> DataFrame:
        return flatten(self.raw_diagnostics)

    @cached_property
    def monitoring(self) -> DataFrame:
        return self.monitoring_of(self.table("events"))

    @staticmethod
    def monitoring_of(events: DataFrame) -> DataFrame:
        """Events as vital signs, some missing, some implausible, some of unknown stays."""
        event = F.col("event_id")
        return events.select(
            _prefixed("S", F.col("user_id") * 101).alias("stay_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.when(event % 17 != 0, F.floor("value") + 30).cast("short").alias("heart_rate"),
            F.when(event % 19 != 0, 100 - event % 60).cast("short").alias("spo2"),
            ((350 + event % 120) / 10.0).cast("float").alias("temp_c"),
            *_drop("monitoring", F.col("ts"), "monitoring.parquet"),
        )

    @cached_property
    def actes(self) -> DataFrame:
        """Line items as procedures; the first line of an order is delivered twice."""
        line = F.col("l_linenumber")
        copies = F.when(line == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        unknown = (line == 7) & (F.col("l_returnflag") == "R")
        return self.table("lineitem").withColumn("copy", F.explode(copies)).select(
            F.concat(F.when(unknown, "X").otherwise("S"), F.col("l_orderkey").cast("string")).alias("stay_id"),
            _prefixed("A", F.col("l_partkey")).alias("code_ccam"),
            F.col("l_shipdate").cast("timestamp").alias("acte_ts"),
            *_drop("actes", F.date_add(F.col("l_shipdate").cast("date"), F.col("copy")), "actes.parquet"),
        )

    @cached_property
    def ref_services(self) -> DataFrame:
        nation = F.col("n_nationkey")
        return self.table("nation").select(
            F.when(nation == 0, "URGENCES").otherwise(F.col("n_name")).alias("service_code"),
            F.concat(F.lit("Service "), F.col("n_name")).alias("service_label"),
            *_drop("referentiels", F.lit("2026-08-01"), "services.csv"),
        )

    @cached_property
    def ref_description_service(self) -> DataFrame:
        """Nation 3 has no description, 5 no category, 7 no beds, 9 no pole."""
        nation = F.col("n_nationkey")
        joined = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return joined.filter(nation != 3).select(
            F.when(nation == 0, "URGENCES").otherwise(F.col("n_name")).alias("service_code"),
            F.when(nation == 5, "").otherwise(F.col("r_name")).alias("categorie"),
            F.when(nation == 7, 0).otherwise(10 + nation).cast("int").alias("capacite_lits"),
            F.when(nation == 9, "").otherwise(_prefixed("Pole ", F.col("n_regionkey"))).alias("pole"),
            *_drop("referentiels", F.lit("2026-08-29"), "description_service.csv"),
        )

    @cached_property
    def ref_cim10(self) -> DataFrame:
        """Parts as diagnosis labels, many per code; code C40 is never described."""
        return self.table("part").select(
            _prefixed("C", F.col("p_partkey") % 40).alias("code_cim10"),
            F.col("p_name").alias("libelle"),
            *_drop("referentiels", F.lit("2026-08-01"), "cim10.csv"),
        )

    @cached_property
    def ref_ccam(self) -> DataFrame:
        """Parts as tariffs."""
        return self.table("part").select(
            _prefixed("A", F.col("p_partkey")).alias("code_ccam"),
            F.col("p_name").alias("libelle"),
            F.floor("p_retailprice").cast("int").alias("tarif_euros"),
            *_drop("referentiels", F.lit("2026-08-29"), "ccam.csv"),
        )

    @cached_property
    def ref_ccam_deliveries(self) -> DataFrame:
        """Tariff deliveries over several days, one day per part size."""
        return self.table("part").select(
            _prefixed("A", F.col("p_partkey")).alias("code_ccam"),
            F.col("p_name").alias("libelle"),
            F.floor("p_retailprice").cast("int").alias("tarif_euros"),
            *_drop("referentiels", F.date_add(F.lit("2026-08-01").cast("date"), F.col("p_size")), "ccam.csv"),
        )

    @property
    def bronze(self) -> dict[str, DataFrame]:
        names = (
            "patients", "sejours", "diagnostics", "monitoring", "actes",
            "ref_services", "ref_cim10", "ref_description_service", "ref_ccam")
        return {name: getattr(self, name) for name in names}

    # ---- silver ----------------------------------------------------------------------------------

    @cached_property
    def stays(self) -> DataFrame:
        return silver.stay_index(self.sejours)

    @cached_property
    def silver(self) -> _LazySilver:
        return _LazySilver(self)


class _LazySilver(dict):
    """Silver tables built on first use, so a query only opens the driver tables it needs."""

    _INPUTS = {
        "dim_services": ("ref_services", "ref_description_service"),
        "dim_ccam": ("ref_ccam",),
        "dim_cim10": ("ref_cim10",),
        "dim_patients": ("patients",),
        "fact_sejours": ("sejours",),
        "fact_monitoring": ("monitoring", "stays"),
        "fact_acte": ("actes", "stays"),
    }

    def __init__(self, bronze: Standin):
        super().__init__()
        self._bronze = bronze

    def __missing__(self, name: str) -> DataFrame:
        if name == "fact_diagnostics":
            table = silver.fact_diagnostics(
                self._bronze.diagnostics, self._bronze.stays, self["dim_patients"])
        else:
            inputs = (getattr(self._bronze, i) for i in self._INPUTS[name])
            table = getattr(silver, name)(*inputs)
        self[name] = table
        return table
