"""Silver brought up to date from what the loads of bronze touched (K4, D4), without a rebuild.

A table is made of parts: facts of months, dimensions and the stay index of one part each. From the changed files the
change feed gives the touched patients and stays; their dimension rows are computed anew, and only where these differ
do events of unchanged files follow them. The months all this lies in are recomputed from the files that have rows in
them, and swapped by naming their new version. Other months are neither read nor copied. The result is that of a
full rebuild, whatever was delivered, corrected or taken back in which order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.operators.lookup import lookup
from carelake.plans import silver
from carelake.session import delete
from carelake.sources.changes import month
from carelake.sources.store import PartStore

if TYPE_CHECKING:
    from carelake.plans.warehouse import Warehouse

# The parts that each update reads, one row per part, appended as one file: its commit. And the loads it has seen.
ADMIN = {
    "silver_parts": T.StructType([
        T.StructField("build", T.StringType()), T.StructField("table_name", T.StringType()), T.StructField("part", T.StringType()),
        T.StructField("version", T.StringType()), T.StructField("built_at", T.TimestampType())]),
    "silver_inputs": T.StructType([T.StructField("build", T.StringType()), T.StructField("load", T.StringType())]),
}
WHOLE = "all"
_KEPT_UPDATES = 2  # queries that began on the update before can go on

_DIMENSIONS = {
    "dim_services": ("ref_services", "ref_description_service"), "dim_ccam": ("ref_ccam",), "dim_cim10": ("ref_cim10",)}
_TIME = {"fact_sejours": "admission_ts", "fact_diagnostics": "admission_ts", "fact_monitoring": "ts", "fact_acte": "acte_ts"}
_CLUSTERING = {"fact_sejours": ("service_code", "admission_ts"), "fact_monitoring": ("service_code", "ts")}
_STAMPED = ("fact_sejours", "fact_diagnostics", "fact_acte")
_INDEX = ("patient_pseudo_id", "service_code", "admission_ts", "acte_service")

Parts = dict[str, dict[str, str]]


def update(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Bring silver up to date with bronze and return its tables; the first update builds all parts.

    Loads and updates of one warehouse run one after the other. An update that fails leaves the former one readable.
    """
    return _Update(warehouse).run()


def tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The tables of the last update."""
    (_, parts), = _updates(warehouse, 1)
    store = _store(warehouse)
    return {name: store.read(name, parts.get(name, {})) for name in schemas.SILVER}


def _store(warehouse: Warehouse) -> PartStore:
    stays = {f.name: f for f in schemas.BRONZE["sejours"]}
    index = T.StructType([stays["stay_id"], *(stays[c] for c in _INDEX[:3]), T.StructField("acte_service", T.StringType())])
    return PartStore(warehouse.spark, warehouse.folders.under("silver_parts"), {**schemas.SILVER, "stay_index": index})


def _updates(warehouse: Warehouse, most: int) -> list[tuple[str, Parts]]:
    """(build, parts) of the newest updates, newest first; a row per part comes to the driver."""
    rows = warehouse.admin.read("silver_parts")
    newest = rows.groupBy("build").agg(F.max("built_at").alias("built_at")).orderBy(F.desc("built_at")).limit(most).collect()
    found: dict[str, Parts] = {r.build: {} for r in newest}
    for r in rows.filter(F.col("build").isin(list(found))).collect() if found else []:
        found[r.build].setdefault(r.table_name, {})[r.part] = r.version
    return list(found.items())


def differing(old: DataFrame, new: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """(key, one flag per column) of the keys that `old` or `new` lacks or in whose columns they differ; one row a key in each."""
    before = old.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in columns))
    both = before.join(new.select(key, *columns), F.col("_key") == F.col(key), "full_outer")
    alone = F.col("_key").isNull() | F.col(key).isNull()
    flags = {c: alone | ~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns}
    rows = both.select(F.coalesce(key, "_key").alias(key), *(flag.alias(f"{c}_differs") for c, flag in flags.items()))
    return rows.filter(reduce(Column.__or__, (F.col(f"{c}_differs") for c in columns)))


class _Update:
    def __init__(self, warehouse: Warehouse):
        self.warehouse, self.feed, self.store, self.build = warehouse, warehouse.feed, _store(warehouse), uuid.uuid4().hex
        self.bronze = warehouse.bronze_tables()
        self.former = _updates(warehouse, _KEPT_UPDATES)
        self.parts: Parts = {t: dict(p) for t, p in self.former[0][1].items()} if self.former else {}
        self.work = f"{self.store.root}/work-{self.build}"

    def run(self) -> dict[str, DataFrame]:
        log = self.warehouse.admin.read("bronze_changes")
        if self.former:
            seen = self.warehouse.admin.read("silver_inputs").filter(F.col("build") == self.former[0][0])
            log = log.join(seen.select("load"), "load", "left_anti")
        # one row per file loaded since
        changed: dict[str, list[date]] = {}
        new = log.select("load", "table_name", "source_date").collect()
        for r in new:
            changed.setdefault(r.table_name, []).append(r.source_date)
        if self.former and not new:
            return tables(self.warehouse)
        try:
            self._apply(changed) if self.former else self._all()
        except Exception:
            for table, own in self.parts.items():  # what no update will name
                for part, version in own.items():
                    if version == self.build:
                        self.store.remove(table, part, version)
            raise
        finally:
            delete(self.warehouse.spark, self.work)
        self._commit({r.load for r in new})
        return tables(self.warehouse)

    # ---- parts -----------------------------------------------------------------------------------

    def _put(self, table: str, rows: DataFrame, months: list[str] | None = None) -> None:
        """Swap the parts of these months, or all parts, for those of the rows; months without rows are gone then."""
        part = month(_TIME[table]) if table in _TIME else F.lit(WHOLE)
        written = self.store.write(
            table, rows, part, self.build, cluster_by=_CLUSTERING.get(table, ()),
            stamp="created_at" if table in _STAMPED else None)
        own = self.parts.setdefault(table, {})
        for gone in list(own) if months is None else months:
            own.pop(gone, None)
        own |= dict.fromkeys(written, self.build)

    def _read(self, table: str) -> DataFrame:
        return self.store.read(table, self.parts.get(table, {}))

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        """Intermediate rows that several steps read, as a table that goes with the update."""
        rows.write.parquet(f"{self.work}/{name}")
        return self.warehouse.spark.read.schema(rows.schema).parquet(f"{self.work}/{name}")

    def _of_months(self, table: str, months: list[str]) -> DataFrame:
        """The bronze rows of these months, read only from the files that have some."""
        return rows_of_months(self.bronze[table], self.feed.days_of(table, months), _bronze_time(table), months)

    # ---- steps -----------------------------------------------------------------------------------

    def _all(self) -> None:
        for name in _DIMENSIONS:
            self._dimension(name)
        self._put("dim_patients", silver.dim_patients(self.bronze["patients"]))
        self._put("stay_index", silver.stay_index(self.bronze["sejours"]))
        index = self._read("stay_index")
        self._put("fact_sejours", silver.fact_sejours(self.bronze["sejours"]))
        self._put("fact_monitoring", silver.fact_monitoring(self.bronze["monitoring"], index))
        self._put("fact_acte", silver.fact_acte(self.bronze["actes"], index))
        self._put("fact_diagnostics", silver.fact_diagnostics(
            self.bronze["diagnostics"], index, self._read("dim_patients"), carry=["admission_ts"]))

    def _dimension(self, name: str) -> None:
        self._put(name, getattr(silver, name)(*(self.bronze[t] for t in _DIMENSIONS[name])))

    def _apply(self, changed: dict[str, list[date]]) -> None:
        for name, inputs in _DIMENSIONS.items():
            if any(t in changed for t in inputs):
                self._dimension(name)
        people = self._merge("dim_patients", "patients", "patient_pseudo_id", silver.dim_patients, ("birth_year",), changed)
        former_index = self._read("stay_index")
        moved = self._merge("stay_index", "sejours", "stay_id", silver.stay_index, _INDEX, changed)

        if "sejours" in changed:
            months = self.feed.months(self.feed.read("sejours", changed["sejours"]))
            if months:
                self._put("fact_sejours", silver.fact_sejours(self._of_months("sejours", months)), months)
        for fact, table, service in (("fact_monitoring", "monitoring", "service_code"), ("fact_acte", "actes", "acte_service")):
            touched = [self.feed.read(table, changed[table])] if table in changed else []
            if moved is not None:  # events of unchanged files whose stay has another service now
                others = moved.filter(f"{service}_differs").select(F.col("stay_id").alias("key"))
                touched.append(self.feed.read(table).join(others, "key", "left_semi"))
            months = sorted({m for rows in touched for m in self.feed.months(rows)})
            if months:
                self._put(fact, getattr(silver, fact)(self._of_months(table, months), self._read("stay_index")), months)
        self._diagnoses(changed, people, moved, former_index)

    def _merge(self, table: str, source: str, key: str, build, compared: tuple[str, ...], changed: dict) -> DataFrame | None:
        """Compute the touched keys' rows anew beside all others; returns the keys whose compared columns differ, if any may."""
        if source not in changed:
            return None
        touched = self._kept(self.feed.keys(source, changed[source]).select(F.col("key").alias(key)), f"{table}-touched")
        old = self._read(table)
        fresh = build(self.bronze[source].join(touched, key, "left_semi"))
        self._put(table, old.join(touched, key, "left_anti").unionByName(fresh))
        new = self._read(table)
        return self._kept(differing(
            old.join(touched, key, "left_semi"), new.join(touched, key, "left_semi"), key, compared), f"{table}-differing")

    def _diagnoses(self, changed: dict, people: DataFrame | None, moved: DataFrame | None, former: DataFrame) -> None:
        """Diagnoses lie in the month of their stay's admission and follow its patient's year of birth."""
        index, stays = self._read("stay_index"), []
        if "diagnostics" in changed:
            stays.append(self.feed.keys("diagnostics", changed["diagnostics"]).select(F.col("key").alias("stay_id")))
        if moved is not None:
            stays.append(moved.filter("patient_pseudo_id_differs or admission_ts_differs").select("stay_id"))
        if people is not None:
            # one row per patient, whose stays may be many
            known = self._kept(people.select("patient_pseudo_id"), "people")
            stays.append(lookup(index, known, "patient_pseudo_id", "left_semi").select("stay_id"))
        if not stays:
            return
        touched = self._kept(reduce(DataFrame.unionByName, stays).distinct(), "stays-touched")
        admitted = former.unionByName(index).join(touched, "stay_id", "left_semi").select(month("admission_ts").alias("month"))
        months = self.feed.months(admitted)
        if not months:
            return
        index = index.filter(month("admission_ts").isin(months))
        own = index.select(F.col("stay_id").alias("key"))
        days = [r[0] for r in self.feed.read("diagnostics").join(own, "key", "left_semi").select("source_date").distinct().collect()]
        rows = self.bronze["diagnostics"].filter(F.col("source_date").isin(days)).join(index.select("stay_id"), "stay_id", "left_semi")
        self._put("fact_diagnostics", silver.fact_diagnostics(rows, index, self._read("dim_patients"), carry=["admission_ts"]), months)

    # ---- commit ----------------------------------------------------------------------------------

    def _commit(self, loads: set[str]) -> None:
        admin, spark = self.warehouse.admin, self.warehouse.spark
        seen = {r.load for r in admin.read("silver_inputs").filter(F.col("build") == self.former[0][0]).collect()} if self.former else set()
        admin.append_log("silver_inputs", spark.createDataFrame([(self.build, x) for x in sorted(seen | loads)], ADMIN["silver_inputs"]))
        rows = [(self.build, t, p, v) for t, own in self.parts.items() for p, v in own.items()]
        admin.append_log("silver_parts", spark.createDataFrame(
            rows, "build string, table_name string, part string, version string").withColumn("built_at", F.current_timestamp()))
        newest = [self.parts, *(parts for _, parts in self.former[: _KEPT_UPDATES - 1])]
        for _, parts in self.former[_KEPT_UPDATES - 1:]:
            for t, own in parts.items():
                for p, v in own.items():
                    if all(kept.get(t, {}).get(p) != v for kept in newest):
                        self.store.remove(t, p, v)


def rows_of_months(rows: DataFrame, days: list[date], stamp: str, months: list[str]) -> DataFrame:
    """Rows of the months, from the files of these days only: the days are a partition column."""
    return rows.filter(F.col("source_date").isin(days)).filter(month(stamp).isin(months))


def _bronze_time(table: str) -> str:
    return {"sejours": "admission_ts", "monitoring": "ts", "actes": "acte_ts"}[table]
