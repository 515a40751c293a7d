"""Queries that drive the readers' rules and the delivery store over raw-shaped rows made from the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.operators import quality
from carelake.session import shared_folder
from carelake.sources import bronze, diagnostics, drops
from carelake.sources.store import DeliveryStore


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lineage(kind: str) -> list[Column]:
    return [F.to_date(F.lit("2026-08-01")).alias("source_date"), F.lit(drops.FILE_OF[kind]).alias("source_file")]


def _by_case(number: Column, *values) -> Column:
    """values[i] where the number leaves the remainder i."""
    picked = F.when(number % len(values) == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        picked = picked.when(number % len(values) == i, value)
    return picked


def bronze_patients(spark: SparkSession, folder: str) -> DataFrame:
    """S3: years of birth that are blank, padded, no number or missing, and records that were torn."""
    n = F.col("c_custkey")
    lake = _table(spark, folder, "customer").select(
        F.concat(F.lit("P"), n.cast("string")).alias("patient_pseudo_id"),
        _by_case(n, "", " 1985 ", "19x", F.lit(None).cast("string"), "2001").alias("birth_year"),
        F.lit("F").alias("sex"), F.col("c_nationkey").cast("string").alias("region_code"),
        F.when(n % 11 == 0, "record").alias("malformed"), *_lineage("patients"))
    return bronze.tagged("patients", lake).select("patient_pseudo_id", "birth_year", quality.REASON)


def bronze_sejours(spark: SparkSession, folder: str) -> DataFrame:
    """Admissions and discharges that are sound, blank or no timestamps, and short records."""
    n, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    lake = _table(spark, folder, "orders").select(
        F.concat(F.lit("S"), n.cast("string")).alias("stay_id"), F.lit("p").alias("patient_pseudo_id"),
        F.lit("A").alias("service_code"), _by_case(n, day, "", "soon", day).alias("admission_ts"),
        _by_case(F.floor(n / 4), day, "", "later").alias("discharge_ts"),
        F.lit("").alias("admission_mode"), F.lit("").alias("discharge_mode"),
        F.when(n % 13 == 0, "record").alias("malformed"), *_lineage("sejours"))
    return bronze.tagged("sejours", lake).select("stay_id", "admission_ts", "discharge_ts", quality.REASON)


def bronze_ccam(spark: SparkSession, folder: str) -> DataFrame:
    """Codes and labels with blanks around them, tariffs that are sound, blank, missing or no numbers."""
    n = F.col("p_partkey")
    lake = _table(spark, folder, "part").select(
        F.concat(F.lit(" A"), n.cast("string"), F.lit("\t")).alias("code_ccam"),
        F.when(n % 3 != 0, F.concat("p_name", F.lit(" "))).alias("libelle"),
        _by_case(n, " 450", "", F.lit(None).cast("string"), "4,5", "99999999999").alias("tarif_euros"),
        F.when(n % 7 == 0, "record").alias("malformed"), *_lineage("ccam"))
    return bronze.tagged("ccam", lake).select("code_ccam", "libelle", "tarif_euros", quality.REASON)


def _typed(raw: DataFrame, declared: T.StructType, *keys: str) -> DataFrame:
    typed, misfits = drops.typed_columns(declared, dict(raw.dtypes))
    return raw.select(*keys, *typed, F.coalesce(*misfits).alias("malformed"))


def bronze_monitoring(spark: SparkSession, folder: str) -> DataFrame:
    """Rates beyond their type, text for a temperature, missing times."""
    raw = _table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit("s").alias("stay_id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("ts"),
        (F.col("l_quantity") * 2000).alias("heart_rate"), (F.col("l_partkey") * 400).alias("spo2"),
        F.when(F.col("l_linenumber") == 3, "warm").otherwise("37.5").alias("temp_c"))
    lake = _typed(raw, schemas.RAW_MONITORING, "l_orderkey", "l_linenumber")
    return bronze.tagged("monitoring", lake).select(
        "l_orderkey", "l_linenumber", "ts", "heart_rate", "spo2", "temp_c", quality.REASON)


def bronze_actes(spark: SparkSession, folder: str) -> DataFrame:
    """Times in nanoseconds, and whole numbers that are no nanoseconds."""
    stamp = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    raw = _table(spark, folder, "orders").select(
        "o_orderkey", F.lit("s").alias("stay_id"), F.lit("c").alias("code_ccam"),
        _by_case(F.col("o_orderkey"), stamp * 1000 + 999, F.floor(stamp / 1_000_000), F.lit(None).cast("bigint")).alias("acte_ts"))
    lake = _typed(raw, schemas.RAW_ACTES, "o_orderkey")
    return bronze.tagged("actes", lake).select("o_orderkey", "acte_ts", quality.REASON)


def parse_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """The reader's parser on one text per line item, sound and damaged ones."""
    stay, code = F.concat(F.lit('"S'), "l_orderkey", F.lit('"')), F.concat(F.lit('[{"code_cim10": "C'), "l_partkey", F.lit('"}]'))
    one = F.concat(F.lit('{"stay_id": '), stay, F.lit(', "diagnostics": '), code, F.lit("}"))
    turned = F.concat(F.lit('{"diagnostics":'), code, F.lit(',\n "stay_id":'), stay, F.lit("}"))
    text = _by_case(
        F.col("l_linenumber"), F.concat(F.lit("[\n"), one, F.lit("\n]")), F.concat(F.lit("["), turned, F.lit(","), one, F.lit("]")),
        F.concat(F.lit("["), one, F.lit(', {"diagnostics": []}]')), F.concat(F.lit("["), one, F.lit(', {"stay_id": "S')),
        F.concat(F.lit("["), one, F.lit("] x")), F.concat(F.lit("["), one, F.lit("]["), one, F.lit("]")), F.lit("[]"))
    parsed = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", diagnostics.parse(text).alias("p"))
    bad, found = diagnostics.damaged(F.col("p")), diagnostics.records(F.col("p"))
    return parsed.select(
        "l_orderkey", "l_linenumber", bad.alias("damaged"), F.when(~bad, F.size(found)).alias("nb_records"),
        F.when(~bad & (F.size(found) > 0), found[0]["stay_id"]).alias("first_stay"))


_RANGE, _RANGE_TASKS = "16k", 512


def small_ranges(spark: SparkSession) -> SparkSession:
    """A session of its own that reads files in byte ranges of 16 KB, for their size is a setting.

    A task reads as many ranges as it takes for no more than `_RANGE_TASKS` tasks, as each one reports to the driver.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", _RANGE)
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.maxPartitionNum", _RANGE_TASKS)
    return own


def diagnosis_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as diagnoses of their orders, written as four JSON arrays and read back in byte ranges of 16 KB.

    Ids hold braces, quotes and backslashes, and records lie across the ranges.
    """
    key = F.col("l_orderkey")
    diagnosis = F.struct(F.concat(F.lit("C]["), "l_partkey").alias("code_cim10"), F.when(F.col("l_linenumber") > 1, "{").alias("type"))
    stays = _table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.collect_list(diagnosis).alias("diagnostics"))
    record = F.to_json(F.struct(F.concat(F.lit('S}"\\'), key).alias("stay_id"), "diagnostics"))
    order = Window.partitionBy("file").orderBy("l_orderkey")
    lines = stays.withColumn("file", F.pmod(key, F.lit(4))).select(
        "file", "l_orderkey", F.concat(
            F.when(F.lag("l_orderkey").over(order).isNull(), "[").otherwise(""), record,
            F.when(F.lead("l_orderkey").over(order).isNull(), "]").otherwise(",")).alias("line"))
    root = f"{shared_folder(spark)}/diagnosis-arrays-{uuid.uuid4().hex}"
    lines.repartition("file").sortWithinPartitions("file", "l_orderkey").select("file", "line").write.partitionBy("file").text(root)
    paths = [f"{root}/file={r.file}" for r in lines.select("file").distinct().orderBy("file").collect()]  # four at most
    return diagnostics.flatten(drops.read(small_ranges(spark), "diagnostics", paths)).select("stay_id", "code_cim10", "diag_type")


def delivery_reload(spark: SparkSession, folder: str) -> DataFrame:
    """K1: two deliveries, then one of them delivered again with fewer rows and one with none."""
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), *schemas.LINEAGE])
    day = F.date_add(F.to_date(F.lit("2026-08-01")), F.pmod("o_orderkey", F.lit(4)).cast("int"))
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", day.alias("source_date"),
        F.concat(F.lit("sejours/"), day.cast("string"), F.lit("/sejours.csv")).alias("source_file"))
    root = f"{shared_folder(spark)}/delivery-reload-{uuid.uuid4().hex}"
    store = DeliveryStore(spark, root, {"sejours": schema}, {"sejours": "sejours"})
    files = orders.select("source_date", "source_file").distinct().orderBy("source_date").collect()  # four at most
    early, late = files[:2], files[2:]
    store.replace_files("sejours", orders.filter("pmod(o_orderkey, 4) < 2"), early)
    store.replace_files("sejours", orders.filter("pmod(o_orderkey, 4) >= 2"), late)
    store.replace_files("sejours", orders.filter("pmod(o_orderkey, 4) = 0 and o_orderstatus = 'F'"), early)
    held = store.files(["sejours"]).select(F.col("source_file").alias("listed"))
    return store.read("sejours").join(held, F.col("source_file") == F.col("listed")).drop("listed")


QUERIES = {
    "bronze_patients": bronze_patients,
    "bronze_sejours": bronze_sejours,
    "bronze_monitoring": bronze_monitoring,
    "bronze_actes": bronze_actes,
    "bronze_ccam": bronze_ccam,
    "parse_diagnostics": parse_diagnostics,
    "diagnosis_arrays": diagnosis_arrays,
    "delivery_reload": delivery_reload,
}

SQL = {
    "bronze_patients": """
        select 'P' || c_custkey as patient_pseudo_id,
               case c_custkey % 5 when 0 then 0 when 1 then 1985 when 2 then null when 3 then 0 else 2001 end as birth_year,
               case when c_custkey % 11 = 0 then 'malformed_record' when c_custkey % 5 = 2 then 'malformed_birth_year' end
               as reject_reason
        from customer""",
    "bronze_sejours": """
        select 'S' || o_orderkey as stay_id,
               case when o_orderkey % 4 in (0, 3) then date_trunc('second', o_orderdate) end as admission_ts,
               case when (o_orderkey // 4) % 3 = 0 then date_trunc('second', o_orderdate) end as discharge_ts,
               case when o_orderkey % 13 = 0 then 'malformed_record' when o_orderkey % 4 = 1 then 'missing_admission'
                    when o_orderkey % 4 = 2 then 'malformed_admission'
                    when (o_orderkey // 4) % 3 = 2 then 'malformed_discharge' end as reject_reason
        from orders""",
    "bronze_monitoring": """
        select l_orderkey, l_linenumber, case when l_linenumber <> 7 then l_shipdate end as ts,
               case when l_quantity * 2000 < 32768 then cast(l_quantity * 2000 as smallint) end as heart_rate,
               case when l_partkey * 400 < 32768 then cast(l_partkey * 400 as smallint) end as spo2,
               case when l_linenumber <> 3 then cast(37.5 as float) end as temp_c,
               case when l_quantity * 2000 >= 32768 then 'malformed_heart_rate' when l_partkey * 400 >= 32768 then 'malformed_spo2'
                    when l_linenumber = 3 then 'malformed_temp_c' when l_linenumber = 7 then 'missing_ts' end as reject_reason
        from lineitem""",
    "bronze_actes": """
        select o_orderkey, case when o_orderkey % 3 = 0 then o_orderdate end as acte_ts,
               case o_orderkey % 3 when 1 then 'malformed_acte_ts' when 2 then 'missing_ts' end as reject_reason
        from orders""",
    "bronze_ccam": """
        select 'A' || p_partkey as code_ccam, case when p_partkey % 3 = 0 then '' else trim(p_name) end as libelle,
               case p_partkey % 5 when 0 then 450 when 1 then 0 when 2 then 0 end as tarif_euros,
               case when p_partkey % 7 = 0 then 'malformed_record' when p_partkey % 5 in (3, 4) then 'malformed_tariff' end
               as reject_reason
        from part""",
    "parse_diagnostics": """
        select l_orderkey, l_linenumber, l_linenumber % 7 in (3, 4, 5) as damaged,
               case l_linenumber % 7 when 0 then 1 when 1 then 2 when 2 then 2 when 6 then 0 end as nb_records,
               case when l_linenumber % 7 in (0, 1, 2) then 'S' || l_orderkey end as first_stay
        from lineitem""",
    "diagnosis_arrays": """
        select 'S}"\\' || l_orderkey as stay_id, 'C][' || l_partkey as code_cim10,
               case when l_linenumber > 1 then '{' else 'principal' end as diag_type
        from lineitem""",
    "delivery_reload": """
        select o_orderkey, o_orderstatus, cast(date '2026-08-01' + cast(o_orderkey % 4 as integer) as date) as source_date,
               'sejours/' || cast(date '2026-08-01' + cast(o_orderkey % 4 as integer) as date) || '/sejours.csv' as source_file
        from orders where o_orderkey % 4 >= 2 or (o_orderkey % 4 = 0 and o_orderstatus = 'F')""",
}
