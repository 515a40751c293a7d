"""The registered queries: name -> function of (spark, folder of driver tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.functions import clinical, privacy
from carelake.operators import ledger, quality
from carelake.operators.snapshot import newest_snapshot
from carelake.operators.suppression import suppress_small_cells
from carelake.plans import gold, periods, reports, runlog, silver
from carelake.plans.warehouse import write_silver
from carelake.session import shared_folder
from carelake.sources import drops
from carelake.sources import privacy as lake_rows
from carelake.sources.diagnostics import flatten
from carelake.sources.store import TableStore
from carelake.standin import loading, redelivery
from carelake.standin.oracle import SECRET
from carelake.standin.tables import Standin
from carelake.streaming import alerts, ingest, readmissions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _on_standin(name: str, build: Callable[[Standin], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: build(Standin(spark, folder))


# ---- silver and gold -----------------------------------------------------------------------------

for _table in (
    "dim_services", "dim_ccam", "dim_cim10", "dim_patients",
    "fact_sejours", "fact_diagnostics", "fact_monitoring", "fact_acte",
):
    _on_standin(_table, lambda s, table=_table: s.silver[table])



def _aging_patients(s: Standin) -> DataFrame:
    """Patient versions whose year of birth is corrected from one to the next."""
    return s.patients.withColumn("birth_year", (F.col("birth_year") + F.when(F.col("sex") == "M", 5).otherwise(0)).cast("int"))


_on_standin("dim_patients_history", lambda s: silver.dim_patients_history(s.patients))
_on_standin("diagnostics_as_of", lambda s: silver.fact_diagnostics_as_of(
    s.diagnostics, s.stays, silver.dim_patients_history(_aging_patients(s))))

GOLD = {
    "dms_by_service": gold.dms,
    "emergency_daily": gold.urgences,
    "readmission_30d": gold.readmissions_30j,
    "alerts_daily": gold.alertes,
    "prevalence": gold.prevalence,
    "cohorts": gold.cohortes,
    "research_summary": gold.synthese,
    "activity_by_category": gold.categories,
    "procedures_by_service": gold.actes_services,
    "procedures_by_code": gold.actes_ccam,
    "procedures_per_bed": gold.densite_plateau,
    "billing_by_service": gold.facturation_t2a,
}
for _name, _view in GOLD.items():
    _on_standin(_name, lambda s, view=_view: view(s.silver))

_on_standin("cohorts_suppressed", lambda s: suppress_small_cells(gold.cohortes(s.silver), "nb_patients"))


def _generalised(s: Standin) -> DataFrame:
    place = f"{shared_folder(s.spark)}/cohort-cells-{uuid.uuid4().hex}"
    gold.cohort_cells(s.silver).write.parquet(place)
    return gold.cohortes_generalisees(s.spark.read.parquet(place))


_on_standin("cohorts_generalised", _generalised)
_on_standin("age_band", lambda s: s.silver["fact_diagnostics"].groupBy(
    clinical.age_band(F.col("age_at_diagnostics")).alias("tranche_age"),
).agg(F.count(F.lit(1)).alias("nb_diagnostics")))

# ---- any period, from stored states ------------------------------------------------------------

_PERIOD = (date(1996, 3, 15), date(1998, 9, 14))


def _period_store(s: Standin, name: str, facts: DataFrame, state: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """States of the facts in two loads, each with half of the stays of every day, read for the period."""
    store = periods.PeriodStore(s.spark, f"{shared_folder(s.spark)}/{name}-{uuid.uuid4().hex}")
    half = F.pmod(F.xxhash64("stay_id"), F.lit(2))
    store.write(state(facts.filter(half == 0)))
    store.append(state(facts.filter(half == 1)))
    return store.read(*_PERIOD)


def _patients_of_period(s: Standin) -> DataFrame:
    facts = silver.fact_diagnostics(s.diagnostics, s.stays, s.silver["dim_patients"], ["admission_ts"])
    return _period_store(s, "patient-sketches", facts, periods.patient_sketches)


def _pairs(s: Standin) -> DataFrame:
    part = F.col("p_partkey")
    return s.table("part").select(F.concat(F.lit("C"), (part % 41).cast("string")).alias("code_a"),
                                  F.concat(F.lit("C"), (part * 7 % 43).cast("string")).alias("code_b"))


_on_standin("dms_period", lambda s: periods.dms_between(
    _period_store(s, "lengths", s.silver["fact_sejours"], periods.length_state), s.silver["dim_services"]))
_on_standin("prevalence_period", lambda s: periods.patients_by(_patients_of_period(s), "code_cim10", "band_start"))
_on_standin("comorbidity_period", lambda s: periods.patients_with_both(_patients_of_period(s), _pairs(s)))

# ---- reports -------------------------------------------------------------------------------------

for _name, _report in reports.REPORTS.items():
    _key = "alerts_rate_by_day" if _name == "apercu_alertes" else f"report_{_name}"
    _on_standin(_key, lambda s, report=_report: report(s.silver))

# ---- privacy -------------------------------------------------------------------------------------


def _customer_ids(s: Standin) -> DataFrame:
    return s.raw_patients.withColumn("c_custkey", F.regexp_extract("nir", r"(\d+)$", 1).cast("long"))


_on_standin("pseudonymize", lambda s: _customer_ids(s).select(
    "c_custkey",
    privacy.pseudonymize(F.col("patient_id"), privacy.pseudonym_key(s.spark, SECRET)).alias("patient_pseudo_id")))
_on_standin("birth_year", lambda s: _customer_ids(s).select(
    "c_custkey", F.coalesce(privacy.birth_year(F.col("birth_date")), F.lit(0)).alias("birth_year")))
_on_standin("identifier_purge", lambda s: lake_rows.patients(s.raw_patients, SECRET))
_on_standin("stay_pseudonyms", lambda s: lake_rows.sejours(s.table("orders").select(
    F.concat(F.lit(" S"), F.col("o_orderkey").cast("string")).alias("stay_id"),
    F.concat(F.lit("IPP"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("patient_id"),
    F.concat(F.lit("\t"), "o_orderpriority").alias("admission_mode"),
), SECRET))

# ---- ingestion -----------------------------------------------------------------------------------


def _nested_json(s: Standin) -> DataFrame:
    """The nested records written as JSON text and read back with the declared schema."""
    record = F.to_json(F.struct("stay_id", "diagnostics"))
    parsed = F.from_json(record, schemas.RAW_DIAGNOSTICS)
    return flatten(s.raw_diagnostics.select(parsed.alias("r"), "source_date", "source_file").select(
        "r.*", "source_date", "source_file"))


def _load_twice(s: Standin) -> DataFrame:
    """K1: a first load of the older drops, then a load of all drops; no file may be loaded twice."""
    first = s.sejours.filter(F.col("source_date") < "1998-01-01")
    second = ledger.unseen(s.sejours, first.select("source_file"))
    return first.unionByName(second)


def _stream_twice(s: Standin) -> DataFrame:
    """K1 as a stream: two starts over the same files; the second finds nothing new."""
    folder = f"{shared_folder(s.spark)}/ingest-stream-{uuid.uuid4().hex}"
    events = s.table("events").schema
    for _ in range(2):
        # a glob, because the table may be one file or a folder of files
        source = ingest.read_stream(s.spark, f"{s.folder}/events.parq[u]et", events)
        ingest.load_bronze(s.monitoring_of(source), "monitoring", folder)
    return ingest.read_batches(s.spark, f"{folder}/bronze", schemas.BRONZE["monitoring"])


def _readmission_stream(s: Standin) -> DataFrame:
    """W1, G3 as a stream: the stays in six files dealt by chance, two a batch, counted from keyed state."""
    folder = f"{shared_folder(s.spark)}/readmission-stream-{uuid.uuid4().hex}"
    s.silver["fact_sejours"].repartition(6, F.xxhash64("stay_id")).write.parquet(f"{folder}/stays")
    source = s.spark.readStream.schema(schemas.SILVER["fact_sejours"]).option("maxFilesPerTrigger", 2).parquet(f"{folder}/stays")
    readmissions.count_readmissions(source, f"{folder}/counts", "20000 days")
    return readmissions.readmissions_30j(s.spark, f"{folder}/counts")


def _alert_stream(s: Standin) -> DataFrame:
    """B7, G4 in event time: measures of eight days a delivery, some a delivery too late, some in two; windows of two days, one a day."""
    folder = f"{shared_folder(s.spark)}/alert-stream-{uuid.uuid4().hex}"
    second = F.unix_timestamp("ts")
    eighth = F.least(F.lit(3), F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 8))
    delivery = F.when(second % 10 == 0, F.array(eighth + 1)).when(second % 7 == 1, F.array(eighth, eighth + 1)).otherwise(F.array(eighth))
    dealt = s.monitoring.withColumn("delivery", F.explode(delivery))
    for k in range(5):
        dealt.filter(F.col("delivery") == k).drop("delivery").write.parquet(f"{folder}/in/d{k}")
        source = s.spark.readStream.schema(schemas.BRONZE["monitoring"]).option("recursiveFileLookup", True).parquet(f"{folder}/in")
        alerts.divert(source, s.stays, f"{folder}/out", "3 days")
        if k in (2, 4):
            alerts.count_windows(s.spark, f"{folder}/out", "3 days", "2 days", "1 day")
    return alerts.alerts_by_window(s.spark, f"{folder}/out", "2 days", "1 day")


def _dates_due(s: Standin) -> DataFrame:
    """K3: order dates against a ledger in which every line item is a synchronisation attempt."""
    available = s.table("orders").select(F.col("o_orderdate").cast("date").alias("source_date"))
    success = F.col("l_linestatus") == "F"
    attempts = s.table("lineitem").select(
        F.col("l_shipdate").cast("date").alias("source_date"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", success.alias("s")).alias("synced_at"),
        success.alias("success"),
    )
    return ledger.dates_to_process(available, attempts)


def _run_log(s: Standin) -> DataFrame:
    """K7: what the log says after a run over the stays, with the files and counts of the data."""
    log = runlog.RunLog(s.spark, f"{shared_folder(s.spark)}/run-log-{uuid.uuid4().hex}")
    # one name per delivered day
    files = [f.source_file for f in s.sejours.select("source_file").distinct().collect()]
    kept, bad = s.silver["fact_sejours"].count(), quality.rejected(silver.tagged_sejours(s.sejours)).count()
    log.step(runlog.INGEST, files, s.sejours.count())
    log.step(runlog.SILVER, files, kept, bad)
    log.success(files, kept, bad)
    return log.read().filter(~F.col("step_name").startswith("START")).select(
        "step_name", "status", F.size("files_processed").cast("bigint").alias("nb_files"),
        "records_ingested", "records_rejected")


def _alerts_written(s: Standin) -> DataFrame:
    """A mart on the vital signs as silver keeps them, by month."""
    store = TableStore(s.spark, f"{shared_folder(s.spark)}/silver-{uuid.uuid4().hex}", schemas.SILVER, starts_empty=False)
    for _ in range(2):  # the second build replaces the first
        write_silver(store, "fact_monitoring", s.silver["fact_monitoring"])
    return gold.alertes({"fact_monitoring": store.read("fact_monitoring")})


def _all_dates(s: Standin) -> DataFrame:
    flows = [s.bronze[t].select("source_date") for t in ("patients", "sejours", "diagnostics", "monitoring", "actes")]
    union = flows[0]
    for flow in flows[1:]:
        union = union.unionByName(flow)
    return drops.source_dates(union)


_on_standin("flatten_diagnostics", _nested_json)
_on_standin("source_dates", _all_dates)
_on_standin("ingest_idempotent", _load_twice)
_on_standin("ingest_stream", _stream_twice)
_on_standin("readmission_stream", _readmission_stream)
_on_standin("alerts_stream", _alert_stream)
_on_standin("ref_snapshot_replace", lambda s: newest_snapshot(s.ref_ccam_deliveries))
_on_standin("lake_dates_to_process", _dates_due)

QUERIES.update(loading.QUERIES)
QUERIES.update(redelivery.QUERIES)

# ---- quality and audit ---------------------------------------------------------------------------

_on_standin("rejects_by_reason", lambda s: silver.reject_counts(s.bronze, s.silver["fact_monitoring"]))
_on_standin("alerts_daily_written", _alerts_written)
_on_standin("table_counts", lambda s: quality.table_counts(s.bronze))
_on_standin("run_log", _run_log)
