"""The chain drop zone -> lake -> bronze -> silver -> gold over folders."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.functions.privacy import PSEUDONYM_HEX_CHARS
from carelake.operators import ledger, quality
from carelake.operators.snapshot import newest_snapshot
from carelake.plans import gold, incremental, runlog, silver
from carelake.session import configure, delete
from carelake.sources import bronze, drops, privacy
from carelake.sources.changes import ChangeFeed
from carelake.sources.store import DeliveryStore, TableStore

SECRET_SETTING = "spark.carelake.pseudonym.secret"  # "secret" in the name makes Spark redact it
SECRET_VARIABLE = "CARELAKE_PSEUDONYM_SECRET"

FLOW_KINDS = ("patients", "sejours", "diagnostics", "monitoring", "actes")

# One row per attempt to bring a version of a delivered file into the lake.
_LEDGER = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("source_date", T.DateType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("error", T.StringType()),
])
# One row per attempt to load a version of a lake file into its bronze table.
_LOADS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("success", T.BooleanType()),
])
# One row per finished build of silver; the last one is what is read.
_BUILDS = T.StructType([
    T.StructField("build", T.StringType()),
    T.StructField("built_at", T.TimestampType()),
])
# Conditions under which Spark reports that a delivered file, not the cluster, is at fault.
_FILE_FAULTS = (
    "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "MALFORMED_", "UNABLE_TO_INFER_SCHEMA", "PARQUET_",
    "FAILED_MERGE_SCHEMA", "CANNOT_MERGE_SCHEMAS",
)
# Causes below such a condition that are no fault of the file: the storage, the network, the machine.
_OUTAGES = (
    "java.net.", "javax.net.", "java.nio.file.", "java.io.InterruptedIOException", "java.io.FileNotFoundException",
    "java.lang.OutOfMemoryError", "org.apache.hadoop.security.", "org.apache.hadoop.ipc.", "org.apache.hadoop.net.",
)
# One row per file and load, written before bronze changes.
_CHANGES = T.StructType([
    T.StructField("load", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("source_date", T.DateType()),
])
_REJECTS = T.StructType([
    T.StructField("reason", T.StringType()),
    T.StructField("record", T.StringType()),
    *schemas.LINEAGE,
])

# Facts that queries filter by service or time lie in that order. The other two are read whole by
# every mart: ordering them costs a shuffle of all rows and saves none of the reading.
_CLUSTERING = {
    "fact_sejours": ("service_code", "admission_ts"),
    "fact_monitoring": ("service_code", "ts"),
}
_STAMPED = ("fact_sejours", "fact_diagnostics", "fact_acte")


def pseudonym_secret(spark: SparkSession) -> str:
    """The key comes from the submitted configuration or the environment; there is no default.

    A key set on the running session is refused: Spark writes such settings into the event log as
    they are, while it redacts the submitted ones.
    """
    submitted = spark.sparkContext.getConf().get(SECRET_SETTING)
    if not submitted and spark.conf.get(SECRET_SETTING, None):
        raise ValueError(f"give {SECRET_SETTING} when submitting, not on the running session")
    secret = submitted or os.environ.get(SECRET_VARIABLE)
    if not secret:
        raise ValueError(f"set {SECRET_SETTING} when submitting, or {SECRET_VARIABLE}")
    return secret


@dataclass(frozen=True)
class Folders:
    """Where the layers are. All must be on storage every executor reaches."""

    drops: str
    warehouse: str

    def under(self, layer: str) -> str:
        return f"{self.warehouse}/{layer}"


class Warehouse:
    def __init__(
        self, spark: SparkSession, folders: Folders, secret: str | None = None,
        pseudonym_chars: int = PSEUDONYM_HEX_CHARS,
    ):
        """`pseudonym_chars` is the width of the pseudonyms in hex digits; one warehouse keeps one width."""
        self.spark = configure(spark)
        self.folders, self.pseudonym_chars = folders, pseudonym_chars
        self.secret = secret or pseudonym_secret(spark)
        entity = {kind: path.split("/")[0] for kind, path in drops.FILE_OF.items()}
        self.lake = DeliveryStore(spark, folders.under("lake"), schemas.LAKE, entity)
        tables = {bronze.TABLE_OF[kind]: folder for kind, folder in entity.items()}
        self.bronze = DeliveryStore(spark, folders.under("bronze"), schemas.BRONZE, tables)
        self.rejects = DeliveryStore(
            spark, folders.under("rejects"), dict.fromkeys(schemas.BRONZE, _REJECTS), tables)
        self.admin = TableStore(
            spark, folders.under("admin"),
            {"lake_sync": _LEDGER, "bronze_loads": _LOADS, "silver_builds": _BUILDS, "bronze_changes": _CHANGES,
             **incremental.ADMIN})
        self.feed = ChangeFeed(spark, folders.under("changes"))

    # ---- lake ------------------------------------------------------------------------------------

    def sync_lake(self, force: bool = False) -> list[str]:
        """Pseudonymise the delivered files that are due; returns those that are in the lake now.

        A file is due in every version of it that was not synchronised yet, however old its day is, or if its
        last attempt failed. All files of a kind go through one job. If one cannot be read, the files of that
        kind are halved until the bad one stands alone: it is recorded as failed and tried again by the next
        run, what the lake had of it stays, and every other file is still written once. Any other error, such
        as a full disk, is raised at once.
        """
        files = drops.list_files(self.spark, self.folders.drops)
        due = ledger.due_files(files, self.admin.read("lake_sync"), force)
        # one row per delivered file that is due: file names, never file content
        listed = due.orderBy("source_date", "source_file").collect()
        if not listed:
            return []
        if force:  # until they are through again, these files don't count as synchronised
            self._record_sync(listed, dict.fromkeys((f.source_file for f in listed), "being synchronised again"))
        failed: dict[str, str] = {}
        for kind in drops.FILE_OF:
            failed |= self._to_lake(kind, [f for f in listed if f.kind == kind])
        self._record_sync(listed, failed)
        return [f.source_file for f in listed if f.source_file not in failed]

    def _to_lake(self, kind: str, files: list) -> dict[str, str]:
        """Write the lake rows of files of one kind; returns those that cannot be read, with the error."""
        if not files:
            return {}
        try:
            raw = drops.read(self.spark, kind, [f.path for f in files])
            rows = privacy.to_lake(kind, raw, self.secret, self.pseudonym_chars)
            self.lake.replace_files(kind, rows, files)
        except Exception as error:
            if not is_file_fault(error):
                raise
            if len(files) == 1:
                return {files[0].source_file: str(error)[:runlog.ERROR_CHARS]}
            middle = len(files) // 2
            return self._to_lake(kind, files[:middle]) | self._to_lake(kind, files[middle:])
        return {}

    def _record_sync(self, files: list, errors: dict[str, str]) -> None:
        rows = self.spark.createDataFrame(
            [(f.kind, f.source_date, f.source_file, f.version, f.source_file not in errors, errors.get(f.source_file)) for f in files],
            "kind string, source_date date, source_file string, version string, success boolean, error string")
        self.admin.append_log("lake_sync", rows.withColumn("recorded_at", F.current_timestamp()))

    # ---- bronze ----------------------------------------------------------------------------------

    def load_bronze(self, force: bool = False) -> list[str]:
        """Load the lake files that were not loaded yet in their present version; returns them, without reference files.

        A day is loaded when all its delivered files are sound: files of a day of which one could not be read wait
        until that one is corrected. A file counts as loaded only by its record, written after its rows and its rejects
        are: a load cut short anywhere is done again as a whole. `force` loads every lake file again, each
        replacing its own rows and rejects; until that is done its record says that it is not loaded.
        """
        synced = self.admin.read("lake_sync")
        due = ledger.due_files(ledger.whole_days(synced), self.admin.read("bronze_loads"), force)
        # one row per file that is due, names only
        files = due.select("kind", "source_date", "source_file", "version").orderBy("source_file").collect()
        load, loaded = uuid.uuid4().hex, []
        for kind in FLOW_KINDS:
            new = [f for f in files if f.kind == kind]
            if new:
                if force:
                    self._record_load(bronze.TABLE_OF[kind], new, False)
                # a kind has one file a day: a predicate on a partition column, so only these are scanned
                rows = self.lake.read(kind).filter(F.col("source_date").isin([f.source_date for f in new]))
                self.replace_bronze(kind, rows, new, load)
                self._record_load(bronze.TABLE_OF[kind], new, True)
                loaded += [f.source_file for f in new]
        for kind in drops.REFERENCE_KINDS:
            table, new = bronze.TABLE_OF[kind], [f for f in files if f.kind == kind]
            if new:  # K2: the table is left alone where nothing was delivered
                if force:
                    self._record_load(table, new, False)
                whole = ledger.whole_days(synced).filter(F.col("kind") == kind).select("source_date")
                snapshot = newest_snapshot(self.lake.read(kind).join(whole, "source_date", "left_semi"))
                if not snapshot.isEmpty():
                    tagged = bronze.tagged(kind, snapshot)
                    self._announce(table, new, load)
                    self.rejects.replace_table(table, bronze.rejects(tagged))
                    self.bronze.replace_table(table, quality.valid(tagged), stamp="ingested_at")
                self._record_load(table, new, True)
        return loaded

    def replace_bronze(self, kind: str, rows: DataFrame, files: list, load: str) -> None:
        """Replace the rows and rejects of `files` (source_date, source_file) by those typed from lake rows of these files.

        What the load touches is noted first, see `ChangeFeed`.
        """
        table, tagged, counted = bronze.TABLE_OF[kind], bronze.tagged(kind, rows), Observation()
        self.feed.append(table, quality.valid(tagged), load)
        self._announce(table, files, load)
        # the rejects are counted as the valid rows are written: without any, one scan is all
        bad = F.count(quality.REASON).alias("n")
        self.bronze.replace_files(table, quality.valid(tagged.observe(counted, bad)), files, stamp="ingested_at")
        if counted.get["n"]:
            self.rejects.replace_files(table, bronze.rejects(tagged), files)
        else:
            self.rejects.remove_files(table, files)

    def _announce(self, table: str, files: list, load: str) -> None:
        rows = self.spark.createDataFrame([(load, table, f.source_date) for f in files], _CHANGES)
        self.admin.append_log("bronze_changes", rows)

    def _record_load(self, table: str, files: list, success: bool) -> None:
        rows = self.spark.createDataFrame(
            [(table, f.source_file, f.version, success) for f in files],
            "table_name string, source_file string, version string, success boolean")
        self.admin.append_log("bronze_loads", rows.withColumn("recorded_at", F.current_timestamp()))

    def bronze_tables(self) -> dict[str, DataFrame]:
        return {name: self.bronze.read(name) for name in schemas.BRONZE}

    # ---- silver and gold -------------------------------------------------------------------------

    def build_silver(self) -> dict[str, DataFrame]:
        """Rebuild the star schema beside the former one, which is read until the new one is whole.

        The stay index is written first and read back: the three event facts look it up, and a lost
        executor then repeats a scan, not the deduplication of all stays. The build before stays for
        queries that began on it; older ones are removed.
        """
        build = uuid.uuid4().hex
        store, tables = self._build(build), self.bronze_tables()
        try:
            store.replace("stay_index", silver.stay_index(tables["sejours"]))
            write_silver(store, "dim_patients", silver.dim_patients(tables["patients"]))
            built = silver.build(tables, store.read("stay_index"), patients=store.read("dim_patients"))
            for name, rows in built.items():
                if name != "dim_patients":
                    write_silver(store, name, rows)
        except Exception:
            delete(self.spark, store.root)
            raise
        self.admin.append_log("silver_builds", self.spark.createDataFrame([(build,)], "build string").withColumn(
            "built_at", F.current_timestamp()))
        for old in self._builds()[2:]:
            delete(self.spark, self._build(old).root)
        return self.silver_tables()

    def update_silver(self) -> dict[str, DataFrame]:
        """K4, incremental: recompute only what the loads since the last update touched, see `plans/incremental.py`."""
        return incremental.update(self)

    def _build(self, build: str) -> TableStore:
        tables = {**schemas.SILVER, "stay_index": _stay_index_schema()}
        return TableStore(self.spark, f"{self.folders.under('silver')}/{build}", tables, starts_empty=False)

    def _builds(self) -> list[str]:
        """The newest three builds, newest first."""
        newest = self.admin.read("silver_builds").orderBy(F.desc("built_at")).limit(3)
        return [r.build for r in newest.collect()]

    @property
    def silver(self) -> TableStore:
        """The newest whole build."""
        builds = self._builds()
        if not builds:
            raise FileNotFoundError(f"silver was not built yet below {self.folders.under('silver')}")
        return self._build(builds[0])

    def silver_tables(self) -> dict[str, DataFrame]:
        store = self.silver
        return {name: store.read(name) for name in schemas.SILVER}

    def reject_counts(self, vitals: DataFrame | None = None) -> DataFrame:
        """Q9, over what is stored: rows that did not type, then rows the silver rules leave out.

        `vitals` is the vital signs' fact, that of the newest whole build by default.
        """
        untyped = reduce(DataFrame.unionByName, (
            self.rejects.read(table).groupBy("reason").agg(F.count(F.lit(1)).alias("nb_rows"))
            .select(F.lit(table).alias("table_name"), "reason", "nb_rows")
            for table in schemas.BRONZE
        ))
        counts = silver.reject_counts(
            self.bronze_tables(), self.silver.read("fact_monitoring") if vitals is None else vitals)
        return counts.unionByName(untyped)

    # ---- run -------------------------------------------------------------------------------------

    def run(self, force: bool = False, trigger: str = "MANUAL", incremental_silver: bool = False) -> str:
        """All steps, logged; returns the run id. A failing step is logged and raised.

        Silver is rebuilt whole, or with `incremental_silver` brought up to date.
        """
        log = runlog.RunLog(self.spark, self.folders.under("admin"), trigger)
        step = runlog.SYNC
        try:
            synced = self.sync_lake(force)
            log.step(step, synced)

            step = runlog.INGEST
            loaded = self.load_bronze(force)
            counts = quality.table_counts({"ingested": self._rows_of(self.bronze, loaded),
                                           "rejected": self._rows_of(self.rejects, loaded)})
            rows = {r.table_name: r.nb_rows for r in counts.collect()}
            log.step(step, loaded, rows["ingested"], rows["rejected"])

            step = runlog.SILVER
            tables = self.update_silver() if incremental_silver else self.build_silver()
            rejects = self.reject_counts(tables["fact_monitoring"]).filter(
                ~F.col("reason").isin("merged_duplicate", *silver.KEPT_STATES))
            nb_rejected = rejects.agg(F.coalesce(F.sum("nb_rows"), F.lit(0))).first()[0]
            nb_stays = tables["fact_sejours"].count()
            log.step(step, ingested=nb_stays, rejected=nb_rejected)

            step = runlog.GOLD
            gold.register_views(tables)
            log.step(step)
            log.success(loaded, nb_stays, nb_rejected)
        except Exception as error:
            log.failure(step, error)
            raise
        return log.run_id

    def _rows_of(self, store: DeliveryStore, files: list[str]) -> DataFrame:
        """The rows of loaded files; a kind has one file a day, so its partitions are picked by day."""
        def of(kind: str) -> DataFrame:
            entity = drops.FILE_OF[kind].split("/")[0]
            days = [date.fromisoformat(f.split("/")[1]) for f in files if f.startswith(f"{entity}/")]
            return store.read(bronze.TABLE_OF[kind]).filter(F.col("source_date").isin(days)).select("source_file")

        return reduce(DataFrame.unionByName, map(of, FLOW_KINDS))


def is_file_fault(error: Exception) -> bool:
    """Whether an error says that a delivered file cannot be read, and not that something else failed.

    What Spark says of a file it cannot read is only believed where no failure of storage, network or machine lies below.
    """
    if isinstance(error, drops.DamagedFile):
        return True
    if not isinstance(error, PySparkException | Py4JJavaError):
        return False
    condition = (isinstance(error, PySparkException) and error.getCondition()) or ""
    text = str(error)
    if "No space left on device" in text or any(c.startswith(_OUTAGES) for c in _causes(error)):
        return False
    return (
        condition.startswith(_FILE_FAULTS)
        or drops.DAMAGED in text
        or "CSV header does not conform" in text
        or any(f"[{fault}" in text for fault in _FILE_FAULTS)
    )


def _causes(error: Exception) -> list[str]:
    """Class names of the Java exceptions of an error, from the outermost to the cause."""
    below, names = getattr(error, "_origin", None) or getattr(error, "java_exception", None), []
    while below is not None and len(names) < 50:
        names.append(below.getClass().getName())
        below = below.getCause()
    return names


def write_silver(store: TableStore, name: str, rows: DataFrame) -> None:
    """Write one silver table: vital signs by month, filtered facts clustered by their filters."""
    by_month = name == "fact_monitoring"
    store.replace(
        name,
        rows.withColumn("mois", F.date_format("ts", "yyyyMM")) if by_month else rows,
        cluster_by=_CLUSTERING.get(name, ()),
        partition_by=("mois",) if by_month else (),
        stamp="created_at" if name in _STAMPED else None,
    )


def _stay_index_schema() -> T.StructType:
    stays = {f.name: f for f in schemas.BRONZE["sejours"]}
    names = ("stay_id", "patient_pseudo_id", "service_code", "admission_ts")
    return T.StructType([stays[n] for n in names] + [T.StructField("acte_service", T.StringType())])
