from __future__ import annotations

import json
import os
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from carelake.plans import gold, silver
from carelake.plans.warehouse import SECRET_SETTING, SECRET_VARIABLE, Folders, Warehouse, is_file_fault, pseudonym_secret
from carelake.sources import arrays, drops
from test_functions import expected_pseudonym

SECRET = "test secret"

PATIENTS = '''patient_id,nir,nom,prenom,birth_date,sex,region_code
IPP1,185,Durand,Anne,1985-04-12, f ,R1
IPP2,186,"Martin, dit ""Le""",Paul,85-04-12,M,R2
 IPP3 ,187,Petit,Zoé,2001,m , R3
'''
SEJOURS = """stay_id,patient_id,service_code,admission_ts,discharge_ts,admission_mode,discharge_mode
S1,IPP1,CARDIO,2026-08-01 06:23:00,2026-08-07 13:23:00,mutation,domicile
S2 ,IPP2, URGENCES,2026-08-01 10:00:00,,urgence,
S3,IPP3,CARDIO,2026-08-01 10:00:00,2026-08-01 08:00:00,urgence,domicile
S4,IPP3,CARDIO,2026-08-01 10:00:00,tomorrow,urgence,domicile
S5,IPP3,CARDIO,,2026-08-02 10:00:00,urgence,domicile
"""
DIAGNOSTICS = [
    {"stay_id": "S1", "diagnostics": [{"code_cim10": "I21", "type": "principal"}, {"code_cim10": "E11"}]},
    {"stay_id": "S2", "diagnostics": []},
    {"stay_id": "S3", "diagnostics": [{"type": "associe"}]},
]


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, pd.DataFrame):
        pq.write_table(pa.Table.from_pandas(content, preserve_index=False), target)
    else:
        target.write_text(content, encoding="utf-8")


def first_delivery(root):
    put(root, "patients/2026-08-01/patients.csv", PATIENTS)
    put(root, "sejours/2026-08-01/sejours.csv", SEJOURS)
    put(root, "diagnostics/2026-08-01/diagnostics.json", json.dumps(DIAGNOSTICS, indent=1))
    put(root, "monitoring/2026-08-01/monitoring.parquet", pd.DataFrame({
        "stay_id": ["S1", "S1", "S9"], "ts": pd.to_datetime(["2026-08-01 07:00:00"] * 3).astype("datetime64[ns]"),
        "heart_rate": [130.0, np.nan, 70.0], "spo2": pd.array([98, None, 97], dtype="Int64"),
        "temp_c": [37.0, np.nan, 36.5], "device": ["x", "y", "z"]}))
    put(root, "referentiels/2026-08-01/services.csv", "service_code,service_label\nCARDIO,Cardiologie\n")
    put(root, "referentiels/2026-08-01/cim10.csv", 'code_cim10,libelle\nI21,"Infarctus, aigu"\n')
    put(root, "referentiels/2026-08-01/notes.csv", "a,b\n1,2\n")
    put(root, "sejours/not-a-date/sejours.csv", SEJOURS)
    put(root, "other/2026-08-01/sejours.csv", SEJOURS)


def second_delivery(root):
    put(root, "patients/2026-08-29/patients.csv", PATIENTS.replace("1985-04-12", "1986-04-12"))
    put(root, "referentiels/2026-08-29/services.csv",
        "service_code,service_label\nCARDIO,Cardio\nURGENCES,Urgences\n")
    put(root, "referentiels/2026-08-29/description_service.csv",
        "service_code,categorie,capacite_lits,pole\n CARDIO , medecine ,30, Coeur\nURGENCES,urgences,,\n")
    put(root, "referentiels/2026-08-29/ccam.csv", "code_ccam,libelle,tarif_euros\nX1, Acte ,450\nX2,b,\nX3,c,cher\n")
    put(root, "actes/2026-08-29/actes.parquet", pd.DataFrame({
        "stay_id": ["S1", "S1", "S9"], "code_ccam": ["X1", "X1", "X2"],
        "acte_ts": pd.to_datetime(["2026-08-02 10:00:00"] * 3).astype("datetime64[us]")}))


@pytest.fixture
def warehouse(spark, tmp_path):
    first_delivery(tmp_path / "drops")
    return Warehouse(spark, Folders(str(tmp_path / "drops"), str(tmp_path / "warehouse")), SECRET)


def test_listing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        drops.list_files(spark, str(tmp_path / "nothing"))
    assert drops.list_files(spark, str(tmp_path)).count() == 0
    first_delivery(tmp_path)
    files = drops.list_files(spark, str(tmp_path))
    assert rows(files, "kind", "source_file") == [
        ("cim10", "referentiels/2026-08-01/cim10.csv"),
        ("diagnostics", "diagnostics/2026-08-01/diagnostics.json"),
        ("monitoring", "monitoring/2026-08-01/monitoring.parquet"),
        ("patients", "patients/2026-08-01/patients.csv"),
        ("sejours", "sejours/2026-08-01/sejours.csv"),
        ("services", "referentiels/2026-08-01/services.csv"),
    ]
    assert [str(r[0]) for r in drops.source_dates(files).collect()] == ["2026-08-01"]


def test_listing_takes_a_folder_of_part_files_as_one_delivery(spark, tmp_path):
    spark.range(4, numPartitions=3).select(
        F.concat(F.lit("S"), "id").alias("stay_id"), F.lit("X").alias("code_ccam"),
        F.to_timestamp(F.lit("2026-08-01 10:00:00")).alias("acte_ts"),
    ).write.parquet(f"{tmp_path}/actes/2026-08-29/actes.parquet")
    files = drops.list_files(spark, str(tmp_path)).collect()
    assert [f.source_file for f in files] == ["actes/2026-08-29/actes.parquet"]
    read = drops.read(spark, "actes", [files[0].path])
    assert read.count() == 4
    assert rows(read.select("source_file").distinct()) == [("actes/2026-08-29/actes.parquet",)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    put(tmp_path, "sejours/2026-08-01/sejours.csv", "service_code,extra,stay_id\nA,x,S1\n")
    got = drops.read(spark, "sejours", [f"{tmp_path}/sejours/2026-08-01/sejours.csv"])
    assert rows(got, "stay_id", "service_code", "patient_id") == [("S1", "A", None)]


def test_csv_with_different_headers_is_refused(spark, tmp_path):
    put(tmp_path, "sejours/2026-08-01/sejours.csv", "stay_id,service_code\nS1,A\n")
    put(tmp_path, "sejours/2026-08-02/sejours.csv", "service_code,stay_id\nA,S2\n")
    paths = [f"{tmp_path}/sejours/2026-08-0{d}/sejours.csv" for d in (1, 2)]
    with pytest.raises(Exception, match="(?i)header"):
        drops.read(spark, "sejours", paths).collect()


def nested(n):
    """Records with up to three diagnoses; the codes hold the key as text, which JSON escapes."""
    return [
        {"stay_id": f"S{i}", "diagnostics": [
            {"code_cim10": f'C{i}-{k} "stay_id" é', "type": "associe"} for k in range(i % 4)]}
        for i in range(n)]


@pytest.mark.parametrize("indent", [None, 1])
def test_diagnoses_read_alike_whatever_the_split_size(spark, tmp_path, settings, indent):
    """Missing ids, other key orders, compact or indented: the same rows at every split size."""
    odd = [{"diagnostics": [{"type": "a", "code_cim10": "x"}], "stay_id": "S1"}, {"diagnostics": [{"code_cim10": "y"}]}, {"stay_id": "S2"}]
    put(tmp_path, "diagnostics/2026-08-01/diagnostics.json", json.dumps(nested(700), indent=indent))
    put(tmp_path, "diagnostics/2026-08-02/diagnostics.json", json.dumps(odd, indent=indent, ensure_ascii=False))
    put(tmp_path, "diagnostics/2026-08-03/diagnostics.json", "[]")
    paths = [f"{tmp_path}/diagnostics/2026-08-0{d}/diagnostics.json" for d in (1, 2, 3)]
    whole = rows(drops.read(spark, "diagnostics", paths))
    settings(files__maxPartitionBytes="1k", files__openCostInBytes="0")
    assert rows(drops.read(spark, "diagnostics", paths)) == whole
    assert len(whole) == 703
    assert {r[0] for r in whole if r[0] is None or not r[0][1:].isdigit()} == {None}


TRICKY = [
    {"stay_id": 'S}{][",\\\\', "diagnostics": [{"code_cim10": '\\\\"}', "type": "}{"}, {"code_cim10": "é}\\n\\u007d", "type": '"'}]},
    {"stay_id": "", "diagnostics": []}, {"diagnostics": None}, {}, {"stay_id": "[{", "extra": {"a": [{"b": "}"}, {}]}, "diagnostics": [{}]},
]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_in_any_number_of_ranges(spark, tmp_path, settings, indent):
    """One, seven and 211 byte ranges, and one for nearly every piece: the rows that the json module reads, in one file."""
    data = [*TRICKY, *nested(300), *TRICKY]
    text = json.dumps(data, indent=indent, ensure_ascii=False)
    put(tmp_path, "diagnostics/2026-08-01/diagnostics.json", text)
    path, size = f"{tmp_path}/diagnostics/2026-08-01/diagnostics.json", len(text.encode())
    wanted = sorted(((r.get("stay_id"), None if r.get("diagnostics") is None else [(d.get("code_cim10"), d.get("type")) for d in r["diagnostics"]]) for r in data), key=repr)
    seen = []
    for ranges in (1, 7, 211, size // 30):
        settings(files__maxPartitionBytes=str(-(-size // ranges)), files__openCostInBytes="0", files__minPartitionNum="1")
        seen.append(arrays.pieces(spark, [path]).select("block").distinct().count())
        got = drops.read(spark, "diagnostics", [path]).collect()
        assert sorted(((r.stay_id, None if r.diagnostics is None else [tuple(d) for d in r.diagnostics]) for r in got), key=repr) == wanted
    assert seen[:2] == [1, 7] and 150 < seen[2] <= 211 and seen[3] > seen[2]


@pytest.mark.parametrize("size", ["128m", "40"])
def test_damage_anywhere_fails_the_file_in_any_number_of_ranges(spark, tmp_path, settings, size):
    """Cut off at any place, or with one character too many, the file is never taken for a shorter sound one."""
    settings(files__maxPartitionBytes=size, files__openCostInBytes="0")
    text = json.dumps([*nested(3), TRICKY[0]], ensure_ascii=False)
    for k, wrong in enumerate([text[:-1], text[:-2], text[: len(text) // 2], text + "}", text + "]", "[" + text, text.replace("}, {", "} {", 1),
                               text.replace("}]", "},]"), text.replace('"', "", 1), text[1:], text + text, text.replace(": [", ": [}", 1)]):
        put(tmp_path, f"{k}/diagnostics/2026-08-01/diagnostics.json", wrong)
        with pytest.raises(Exception, match="not one sound JSON array"):
            drops.read(spark, "diagnostics", [f"{tmp_path}/{k}/diagnostics/2026-08-01/diagnostics.json"]).collect()


@pytest.mark.parametrize("text", [
    '[{"stay_id": "S1", "diagnostics": []}, {"stay_id": "S2", "diagn', '[{"stay_id": "S1"}] x', '[{"stay_id": "S1"}]\n[{"stay_id": "S2"}]',
    ' ', '{"stay_id": "S1"', '[{"stay_id": "S1", "diagnostics": "none"}]', '[{"stay_id": "S1",, "diagnostics": []}, {"stay_id": "S2"}]', "[1]", "null"])
def test_damaged_diagnoses_fail_their_date_and_never_vanish(spark, tmp_path, text):
    root = tmp_path / "drops"
    put(root, "diagnostics/2026-08-01/diagnostics.json", json.dumps(DIAGNOSTICS))
    put(root, "diagnostics/2026-08-02/diagnostics.json", text)
    warehouse = Warehouse(spark, Folders(str(root), str(tmp_path / "warehouse")), SECRET)
    assert warehouse.sync_lake() == ["diagnostics/2026-08-01/diagnostics.json"]
    (failed,) = warehouse.admin.read("lake_sync").filter("not success").collect()
    assert str(failed.source_date) == "2026-08-02" and "2026-08-02/diagnostics.json" in failed.error


def test_a_file_without_a_byte_is_not_delivered_yet(warehouse, tmp_path):
    """Alone on its day or beside a full file: it is taken up when it has content."""
    drops_ = tmp_path / "drops"
    put(drops_, "diagnostics/2026-08-02/diagnostics.json", "")
    put(drops_, "patients/2026-08-03/patients.csv", "")
    put(drops_, "sejours/2026-08-03/sejours.csv", SEJOURS)
    warehouse.sync_lake()
    warehouse.load_bronze()
    assert [str(r[0]) for r in rows(warehouse.admin.read("lake_sync").select("source_date").distinct())] == ["2026-08-01", "2026-08-03"]
    put(drops_, "diagnostics/2026-08-02/diagnostics.json", "[]")
    put(drops_, "patients/2026-08-03/patients.csv", PATIENTS)
    late = ["diagnostics/2026-08-02/diagnostics.json", "patients/2026-08-03/patients.csv"]
    assert warehouse.sync_lake() == late and sorted(warehouse.load_bronze()) == late
    assert warehouse.bronze.read("patients").filter("source_date = '2026-08-03'").count() == 3


def test_corrected_files_of_a_failed_day_reach_bronze(warehouse, tmp_path):
    """A day with a damaged file waits as a whole; its corrected files replace what was delivered first."""
    drops_, day = tmp_path / "drops", "2026-08-02"
    put(drops_, f"patients/{day}/patients.csv", PATIENTS.replace("1985", "1980"))
    put(drops_, f"diagnostics/{day}/diagnostics.json", '[{"stay_id": "S')
    assert f"patients/{day}/patients.csv" in warehouse.sync_lake()
    assert f"patients/{day}/patients.csv" not in warehouse.load_bronze()
    put(drops_, f"patients/{day}/patients.csv", PATIENTS.replace("1985", "1999"))
    put(drops_, f"diagnostics/{day}/diagnostics.json", json.dumps(DIAGNOSTICS))
    both = [f"diagnostics/{day}/diagnostics.json", f"patients/{day}/patients.csv"]
    assert warehouse.sync_lake() == both and sorted(warehouse.load_bronze()) == both
    of_day = F.col("source_date") == day
    assert rows(warehouse.bronze.read("patients").filter(of_day), "birth_year") == [(0,), (1999,), (2001,)]
    assert warehouse.sync_lake() == [] and warehouse.load_bronze() == []


def test_a_damaged_redelivery_leaves_what_was_loaded(warehouse, tmp_path):
    warehouse.sync_lake()
    warehouse.load_bronze()
    name = "monitoring/2026-08-01/monitoring.parquet"
    put(tmp_path / "drops", name, "no parquet")
    put(tmp_path / "drops", "sejours/2026-08-01/sejours.csv", SEJOURS.splitlines()[0] + "\n")
    assert warehouse.sync_lake() == ["sejours/2026-08-01/sejours.csv"] and warehouse.load_bronze() == []
    assert warehouse.lake.read("monitoring").count() == warehouse.bronze.read("monitoring").count() == 3
    assert warehouse.load_bronze(force=True) == []  # the day waits, also here
    put(tmp_path / "drops", name, pd.DataFrame({
        "stay_id": ["S1"], "ts": pd.to_datetime(["2026-08-01"]).astype("datetime64[us]"), "heart_rate": [70], "spo2": [98], "temp_c": [37.0]}))
    assert warehouse.sync_lake() == [name] and len(warehouse.load_bronze()) == 2  # the stays waited for it
    assert warehouse.bronze.read("monitoring").count() == 1
    assert warehouse.bronze.read("sejours").count() == warehouse.rejects.read("sejours").count() == 0


def test_versions_follow_every_part_of_a_delivery(spark, tmp_path):
    def version():
        return drops.list_files(spark, str(tmp_path)).first().version

    put(tmp_path, "actes/2026-08-29/actes.parquet/a", "x")
    put(tmp_path, "actes/2026-08-29/actes.parquet/b", "y")
    seen = [version(), version()]
    assert seen[0] == seen[1]
    os.utime(tmp_path / "actes/2026-08-29/actes.parquet/b", (1_700_000_000, 1_700_000_000))
    seen.append(version())
    put(tmp_path, "actes/2026-08-29/actes.parquet/c", "z")
    seen.append(version())
    assert len(set(seen)) == 3


def test_a_file_that_lacks_a_column_is_damaged(warehouse, tmp_path):
    put(tmp_path / "drops", "actes/2026-08-05/actes.parquet", pd.DataFrame({"stay_id": ["S1"], "code": ["X"]}))
    assert len(warehouse.sync_lake()) == 6
    (failed,) = warehouse.admin.read("lake_sync").filter("not success").collect()
    assert "code_ccam, acte_ts" in failed.error


def test_outages_are_no_fault_of_a_file(spark, tmp_path):
    """The same condition is a damaged file or not by what lies below it."""
    class Java:
        def __init__(self, name, cause=None):
            self.name, self.cause = name, cause

        def getClass(self):  # noqa: N802
            return self

        def getName(self):  # noqa: N802
            return self.name

        def getCause(self):  # noqa: N802
            return self.cause

    put(tmp_path, "monitoring/2026-08-01/monitoring.parquet", "no parquet")
    with pytest.raises(Exception) as caught:
        spark.read.schema("a int").parquet(f"{tmp_path}/monitoring/2026-08-01/monitoring.parquet").collect()
    assert is_file_fault(caught.value) and not is_file_fault(KeyError("a"))
    caught.value._origin = Java("org.apache.spark.SparkException", Java("java.net.SocketTimeoutException"))
    assert not is_file_fault(caught.value)
    with pytest.raises(Exception) as unresolved:
        spark.range(1).select("nothing")
    assert not is_file_fault(unresolved.value)


def test_torn_and_short_csv_records_are_rejected(warehouse, tmp_path):
    put(tmp_path / "drops", "patients/2026-08-02/patients.csv", PATIENTS + 'IPP8,187,"Pe\ntit",Zoé,2001-01-01,M,R3\nIPP9,1\nIPP10,1,a,b,1990-01-01,F,R1\n')
    put(tmp_path / "drops", "sejours/2026-08-02/sejours.csv", SEJOURS + "S8,IPP1\nS9,IPP1,CARDIO,2026-08-01 06:23:00,,urgence,,more\n")
    warehouse.sync_lake()
    warehouse.load_bronze()
    day = F.col("source_date") == "2026-08-02"
    assert warehouse.bronze.read("patients").filter(day).count() == 4
    assert rows(warehouse.rejects.read("patients").filter(day), "reason") == [("malformed_record",)] * 3
    assert warehouse.bronze.read("sejours").filter(day).count() == 3
    assert rows(warehouse.rejects.read("sejours").filter(day), "reason") == [
        ("malformed_discharge",), ("malformed_record",), ("malformed_record",), ("missing_admission",)]
    assert "Pe" not in "".join(r.record for r in warehouse.rejects.read("patients").collect())


def test_parquet_values_that_do_not_fit_are_rejected(warehouse, tmp_path):
    root = tmp_path / "drops"
    put(root, "monitoring/2026-08-02/monitoring.parquet", pd.DataFrame({
        "stay_id": ["a", "b", "c", "d"], "ts": pd.to_datetime(["2026-08-01 07:00:00"] * 3 + [None]).astype("datetime64[us]"),
        "heart_rate": [70_000, 70, 70, 70], "spo2": [98, -40_000, 98, 98], "temp_c": ["37.5", "37", "warm", "37"]}))
    put(root, "actes/2026-08-02/actes.parquet", pd.DataFrame({
        "stay_id": ["a", "b"], "code_ccam": ["X", "Y"], "acte_ts": ["2026-08-02 10:00:00", "garbage"]}))
    put(root, "actes/2026-08-03/actes.parquet", pd.DataFrame({
        "stay_id": ["s", "n"], "code_ccam": ["X", "Y"], "acte_ts": np.array([1_780_000_000, 1_785_578_400_000_000_999], dtype="int64")}))
    warehouse.sync_lake()
    warehouse.load_bronze()
    day = F.col("source_date") == "2026-08-02"
    assert warehouse.bronze.read("monitoring").filter(day).count() == 0
    assert rows(warehouse.rejects.read("monitoring").filter(day), "reason") == [
        ("malformed_heart_rate",), ("malformed_spo2",), ("malformed_temp_c",), ("missing_ts",)]
    assert rows(warehouse.bronze.read("actes"), "stay_id") == [("a",), ("n",)]
    assert rows(warehouse.rejects.read("actes"), "reason") == [("malformed_acte_ts",)] * 2
    stamp = warehouse.bronze.read("actes").filter("stay_id = 'n'").select(F.unix_micros("acte_ts")).first()[0]
    assert stamp == 1_785_578_400_000_000


class Cut(Exception):
    pass


@pytest.mark.parametrize("point", ["before", "between", "after"])
def test_a_load_cut_short_is_done_again(warehouse, monkeypatch, point):
    """A failure before, between or after the two writes; the next load gives what an undisturbed one gives."""
    warehouse.sync_lake()
    # the rejects of the files are removed, for every kind, after its valid rows are written
    store, step = {"before": (warehouse.bronze, "replace_files"), "between": (warehouse.rejects, "remove_files")}.get(
        point, (warehouse, "_record_load"))

    def cut(*_, **__):
        raise Cut

    with monkeypatch.context() as patch:
        patch.setattr(store, step, cut)
        with pytest.raises(Cut):
            warehouse.load_bronze()
    assert len(warehouse.load_bronze()) == 4
    assert warehouse.bronze.read("sejours").count() == 3 and warehouse.rejects.read("sejours").count() == 2
    assert warehouse.bronze.read("patients").count() == 3
    assert warehouse.load_bronze() == []


def test_a_forced_load_leaves_nothing_old(warehouse, tmp_path, monkeypatch):
    warehouse.sync_lake()
    warehouse.load_bronze()
    assert warehouse.rejects.read("sejours").count() == 2
    put(tmp_path / "drops", "sejours/2026-08-01/sejours.csv", "\n".join(SEJOURS.splitlines()[:2]) + "\n")
    put(tmp_path / "drops", "patients/2026-08-01/patients.csv", PATIENTS.splitlines()[0] + "\n")
    warehouse.sync_lake(force=True)
    with monkeypatch.context() as patch:  # cut short: the files are not taken for loaded
        patch.setattr(warehouse.bronze, "replace_files", lambda *_, **__: (_ for _ in ()).throw(Cut()))
        with pytest.raises(Cut):
            warehouse.load_bronze(force=True)
    warehouse.load_bronze(force=True)
    assert rows(warehouse.bronze.read("sejours"), "stay_id") == [("S1",)]
    assert warehouse.rejects.read("sejours").count() == 0
    assert warehouse.lake.read("patients").count() == 0


def test_file_listing_reads_no_rows(warehouse):
    warehouse.sync_lake()
    plan = warehouse.lake.files(["sejours"])._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower().replace("*.parquet", "") and "content" not in plan
    assert rows(warehouse.lake.files(["sejours"]), "kind", "source_file") == [("sejours", "sejours/2026-08-01/sejours.csv")]


def test_other_failures_are_raised_after_one_attempt(warehouse, tmp_path, monkeypatch):
    put(tmp_path / "drops", "sejours/2026-08-02/sejours.csv", SEJOURS)
    calls = []

    def full(*_, **__):
        calls.append(1)
        raise OSError("No space left on device")

    monkeypatch.setattr(warehouse.lake, "replace_files", full)
    with pytest.raises(OSError):
        warehouse.sync_lake()
    assert len(calls) == 1 and warehouse.admin.read("lake_sync").count() == 0


def test_lake_holds_no_identifier(warehouse):
    assert len(warehouse.sync_lake()) == 6
    patients = warehouse.lake.read("patients")
    assert patients.columns == [
        "patient_pseudo_id", "birth_year", "sex", "region_code", "malformed", "source_date", "source_file"]
    assert rows(patients, "patient_pseudo_id", "birth_year", "sex", "region_code") == sorted([
        (expected_pseudonym("IPP1", SECRET), "1985", "F", "R1"),
        (expected_pseudonym("IPP2", SECRET), "", "M", "R2"),
        (expected_pseudonym("IPP3", SECRET), "2001", "M", "R3"),
    ], key=repr)
    stays = warehouse.lake.read("sejours")
    assert rows(stays.filter("stay_id = 'S2'"), "patient_pseudo_id", "service_code", "discharge_ts") == [
        (expected_pseudonym("IPP2", SECRET), "URGENCES", "")]
    assert stays.join(patients, "patient_pseudo_id").count() == 5
    written = "".join(
        p.read_bytes().decode("latin-1") for p in _files(warehouse.folders.warehouse, "part-*.parquet"))
    assert "IPP1" not in written and "Durand" not in written


def _files(root, pattern):
    from pathlib import Path
    return Path(root).rglob(pattern)


def test_bronze_types_rejects_and_is_idempotent(warehouse):
    warehouse.sync_lake()
    assert len(warehouse.load_bronze()) == 4
    bronze = warehouse.bronze_tables()
    assert rows(bronze["patients"], "birth_year") == [(0,), (1985,), (2001,)]
    assert rows(bronze["sejours"], "stay_id") == [("S1",), ("S2",), ("S3",)]
    assert rows(bronze["sejours"].filter("discharge_ts is null"), "stay_id", "discharge_mode") == [("S2", "")]
    assert rows(bronze["diagnostics"], "stay_id", "code_cim10", "diag_type") == [
        ("S1", "E11", "principal"), ("S1", "I21", "principal"), ("S3", "", "associe")]
    assert rows(bronze["monitoring"], "stay_id", "heart_rate", "spo2", "temp_c") == [
        ("S1", 130, 98, 37.0), ("S1", None, None, None), ("S9", 70, 97, 36.5)]
    assert rows(warehouse.rejects.read("sejours"), "reason") == [("malformed_discharge",), ("missing_admission",)]
    assert rows(bronze["sejours"].select("source_date", "source_file").distinct())[0][1] == "sejours/2026-08-01/sejours.csv"

    assert warehouse.sync_lake() == []
    assert warehouse.load_bronze() == []
    assert warehouse.bronze.read("sejours").count() == 3
    assert warehouse.rejects.read("sejours").count() == 2


def test_redelivered_file_is_due_again(warehouse, tmp_path, monkeypatch):
    warehouse.sync_lake()
    warehouse.load_bronze()
    put(tmp_path / "drops", "sejours/2026-08-01/sejours.csv",
        "\n".join(SEJOURS.splitlines()[:2]) + "\n")
    replaced = []
    monkeypatch.setattr(warehouse.bronze, "replace_table", lambda table, *_, **__: replaced.append(table))
    assert warehouse.sync_lake() == ["sejours/2026-08-01/sejours.csv"]
    assert warehouse.load_bronze() == ["sejours/2026-08-01/sejours.csv"]
    assert rows(warehouse.bronze.read("sejours"), "stay_id") == [("S1",)]
    assert warehouse.rejects.read("sejours").count() == 0
    assert warehouse.bronze.read("patients").count() == 3
    assert warehouse.sync_lake() == [] and warehouse.load_bronze() == [] and replaced == []  # no reference file was delivered


def test_newest_reference_replaces_the_older(warehouse, tmp_path):
    warehouse.sync_lake()
    warehouse.load_bronze()
    assert rows(warehouse.bronze.read("ref_cim10"), "libelle") == [("Infarctus, aigu",)]
    second_delivery(tmp_path / "drops")
    put(tmp_path / "drops", "referentiels/2026-08-30/services.csv", "service_code,service_label\n")
    warehouse.sync_lake()
    warehouse.load_bronze()
    bronze = warehouse.bronze_tables()
    assert rows(bronze["ref_services"], "service_code", "service_label") == [
        ("CARDIO", "Cardio"), ("URGENCES", "Urgences")]
    assert rows(bronze["ref_cim10"], "code_cim10") == [("I21",)]
    assert rows(bronze["ref_description_service"], "service_code", "categorie", "capacite_lits", "pole") == [
        ("CARDIO", "medecine", 30, "Coeur"), ("URGENCES", "urgences", 0, "")]
    assert rows(bronze["ref_ccam"], "code_ccam", "libelle", "tarif_euros") == [("X1", "Acte", 450), ("X2", "b", 0)]
    assert rows(warehouse.rejects.read("ref_ccam"), "reason") == [("malformed_tariff",)]


def test_bad_date_is_recorded_and_tried_again(warehouse, tmp_path, monkeypatch):
    root = tmp_path / "drops"
    put(root, "sejours/2026-08-02/sejours.csv", SEJOURS)
    put(root, "monitoring/2026-08-03/monitoring.parquet", "this is not parquet")
    put(root, "sejours/2026-08-04/sejours.csv", SEJOURS)
    written, replace = [], warehouse.lake.replace_files

    def counted(table, lake_rows, files):
        replace(table, lake_rows, files)
        written.extend(f.source_file for f in files)

    monkeypatch.setattr(warehouse.lake, "replace_files", counted)
    synced = warehouse.sync_lake()
    assert {f.split("/")[1] for f in synced} == {"2026-08-01", "2026-08-02", "2026-08-04"}
    assert sorted(written) == sorted(synced)  # each good file once
    log = warehouse.admin.read("lake_sync")
    assert [str(r[0]) for r in rows(log.filter("not success"), "source_date")] == ["2026-08-03"]
    assert log.filter("not success").first().error
    first_delivery(root / "ignored")
    put(root, "monitoring/2026-08-03/monitoring.parquet", pd.DataFrame({
        "stay_id": ["S1"], "ts": pd.to_datetime(["2026-08-03"]).astype("datetime64[us]"),
        "heart_rate": np.array([70], dtype="int16"), "spo2": np.array([98], dtype="int16"),
        "temp_c": np.array([37], dtype="float32")}))
    assert warehouse.sync_lake() == ["monitoring/2026-08-03/monitoring.parquet"]
    assert warehouse.sync_lake() == []


def test_run_from_drops_to_gold(warehouse, tmp_path, spark):
    second_delivery(tmp_path / "drops")
    run_id = warehouse.run()
    tables = warehouse.silver_tables()
    assert rows(tables["fact_sejours"], "stay_id", "duree_sejour_jours") == [("S1", 6.29), ("S2", None)]
    assert rows(tables["dim_patients"], "birth_year") == [(0,), (1986,), (2001,)]
    assert rows(tables["fact_monitoring"], "stay_id", "is_alert") == [("S1", 0), ("S1", 1)]
    assert rows(tables["fact_acte"], "stay_id", "service_code", "code_ccam") == [
        ("S1", "CARDIO", "X1"), ("S9", "INCONNU", "X2")]
    assert [tuple(r) for r in gold.facturation_t2a(tables).collect()] == [
        ("CARDIO", "Cardio", "medecine", "Coeur", 1, 450)]
    assert spark.sql("select nb_sejours_termines from vue_pilotage_dms order by 1").first()[0] == 0

    log = spark.read.parquet(f"{warehouse.folders.warehouse}/admin/pipeline_runs").filter(F.col("run_id") == run_id)
    steps = {r.step_name: r for r in log.collect()}
    assert set(steps) == {
        "START (MANUAL)", "1_SYNC_LAKE", "2_INGEST_BRONZE", "3_TRANSFORM_SILVER", "4_TRANSFORM_GOLD",
        "ALL_STEPS_COMPLETED"}
    assert steps["ALL_STEPS_COMPLETED"].status == "SUCCESS"
    assert steps["ALL_STEPS_COMPLETED"].records_ingested == 2
    assert sorted(steps["2_INGEST_BRONZE"].files_processed) == [
        "actes/2026-08-29/actes.parquet", "diagnostics/2026-08-01/diagnostics.json",
        "monitoring/2026-08-01/monitoring.parquet", "patients/2026-08-01/patients.csv",
        "patients/2026-08-29/patients.csv", "sejours/2026-08-01/sejours.csv"]
    assert steps["2_INGEST_BRONZE"].records_ingested == 3 + 3 + 3 + 3 + 3 + 3
    assert steps["2_INGEST_BRONZE"].records_rejected == 2
    before = {name: df.count() for name, df in tables.items()}
    warehouse.run()
    assert {name: df.count() for name, df in warehouse.silver_tables().items()} == before


def test_failed_build_leaves_the_former_silver(warehouse, monkeypatch):
    with pytest.raises(FileNotFoundError, match="not built"):
        warehouse.silver_tables()
    warehouse.sync_lake()
    warehouse.load_bronze()
    former = {name: rows(df) for name, df in warehouse.build_silver().items()}
    assert former["fact_sejours"]

    def fail(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr(silver, "build", fail)
    with pytest.raises(OSError):
        warehouse.build_silver()
    assert {name: rows(df) for name, df in warehouse.silver_tables().items()} == former
    monkeypatch.undo()
    reading = warehouse.silver_tables()
    for _ in range(2):
        first, reading = reading, warehouse.build_silver()
        assert {name: rows(df) for name, df in first.items()} == former  # the build before is still there
    builds = Path(warehouse.folders.warehouse, "silver")
    assert len([p for p in builds.iterdir() if p.is_dir()]) == 2


def test_no_scan_for_rejects_where_there_are_none(warehouse, monkeypatch):
    warehouse.sync_lake()
    written = []
    replace = warehouse.rejects.replace_files
    monkeypatch.setattr(warehouse.rejects, "replace_files", lambda table, *a: (written.append(table), replace(table, *a)))
    warehouse.load_bronze()
    assert written == ["sejours"]  # the only kind of the first delivery with rows that do not type


def test_vital_signs_are_joined_once_a_run(warehouse):
    warehouse.sync_lake()
    warehouse.load_bronze()
    warehouse.build_silver()
    plan = warehouse.reject_counts()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_failing_step_is_logged(warehouse, monkeypatch, spark):
    def fail(*_):
        raise RuntimeError("x" * 5000)

    monkeypatch.setattr(warehouse, "build_silver", fail)
    with pytest.raises(RuntimeError):
        warehouse.run()
    log = spark.read.parquet(f"{warehouse.folders.warehouse}/admin/pipeline_runs")
    failed = log.filter("status = 'FAILED'").first()
    assert (failed.step_name, len(failed.error_message)) == ("3_TRANSFORM_SILVER", 1000)
    assert failed.finished_at is not None


def test_secret_is_required(spark, monkeypatch):
    monkeypatch.delenv(SECRET_VARIABLE, raising=False)
    with pytest.raises(ValueError):
        pseudonym_secret(spark)
    monkeypatch.setenv(SECRET_VARIABLE, "from the environment")
    assert pseudonym_secret(spark) == "from the environment"
    spark.conf.set(SECRET_SETTING, "on the running session")
    with pytest.raises(ValueError, match="when submitting"):
        pseudonym_secret(spark)
    spark.conf.unset(SECRET_SETTING)
