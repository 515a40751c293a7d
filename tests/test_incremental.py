"""Silver brought up to date equals silver rebuilt, for random deliveries in random order."""

from __future__ import annotations

import random
import re
from types import SimpleNamespace

import pytest
from helpers import at, day, rows
from pyspark.sql import functions as F

from carelake import schemas
from carelake.plans import incremental, silver
from carelake.plans.warehouse import Folders, Warehouse
from carelake.sources import drops

MONTHS = ("2026-05", "2026-06", "2026-07", "2026-08")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, Folders(str(tmp_path / "drops"), str(tmp_path / "warehouse")), "secret")


def deliver(warehouse, kind, day_text, data, load):
    """Load lake rows as the file of a day, in place of what it held."""
    name = drops.FILE_OF[kind].replace("/", f"/{day_text}/")
    fields = [f for f in schemas.LAKE[kind] if f.name not in ("source_date", "source_file", "malformed")]
    lake = warehouse.spark.createDataFrame(data, schemas.T.StructType(fields)).withColumns(
        {"malformed": F.lit(None).cast("string"), "source_date": F.lit(day(day_text)), "source_file": F.lit(name)})
    warehouse.replace_bronze(kind, lake, [SimpleNamespace(source_date=day(day_text), source_file=name)], load)


def some(chance, kind):
    """Rows of a kind about few stays and patients, so that deliveries meet."""
    stays, people, out = [f"S{i}" for i in range(9)], [f"P{i}" for i in range(4)], []
    for _ in range(chance.choice([0, 1, 3, 6])):
        stay, moment = chance.choice(stays), f"{chance.choice(MONTHS)}-1{chance.randrange(10)} 10:00:00"
        out.append({
            "patients": lambda: (chance.choice(people), chance.choice(["1950", "1990", "", "x"]), "F", "R1"),
            "sejours": lambda: (stay, chance.choice(people), chance.choice(["A", "B", ""]), moment, chance.choice(["", moment, "2020-01-01 00:00:00"]), "urgence", ""),  # noqa: B023
            "diagnostics": lambda: (stay, [(chance.choice(["C1", "C2"]), chance.choice(["principal", None]))]),  # noqa: B023
            "monitoring": lambda: (stay, at(moment), chance.choice([70, 130, 999]), 98, 37.0),  # noqa: B023
            "actes": lambda: (stay, "X1", at(moment)),  # noqa: B023
        }[kind]())
    return out


def same(warehouse, found):
    wanted = silver.build(warehouse.bronze_tables())
    for name in schemas.SILVER:
        columns = wanted[name].columns
        assert rows(found[name], *columns) == rows(wanted[name]), name


def test_random_deliveries_equal_a_rebuild(warehouse):
    """New files, files delivered again with other or no rows, and late ones, several between two updates."""
    chance, days = random.Random(11), ["2026-08-01", "2026-08-02", "2026-08-03"]
    for kind in ("patients", "sejours", "diagnostics", "monitoring", "actes"):
        deliver(warehouse, kind, days[0], some(chance, kind), "first")
    same(warehouse, warehouse.update_silver())
    for step in range(3):
        for kind in chance.sample(["patients", "sejours", "diagnostics", "monitoring", "actes"], chance.choice([1, 2, 4])):
            deliver(warehouse, kind, chance.choice(days), some(chance, kind), f"load{step}")
        same(warehouse, warehouse.update_silver())


def measures(n, month):
    return [(f"S{i}", at(f"{month}-10 10:00:00"), 70, 98, 37.0) for i in range(n)]


def stay(i, service, month="2026-05"):
    return (f"S{i}", "P1", service, f"{month}-01 10:00:00", "", "urgence", "")


def test_untouched_months_are_neither_read_nor_written(warehouse, monkeypatch):
    deliver(warehouse, "sejours", "2026-08-01", [stay(0, "A"), stay(1, "A")], "a")
    for k, m in enumerate(MONTHS):
        deliver(warehouse, "monitoring", f"2026-08-0{k + 1}", measures(2, m), "a")
    warehouse.update_silver()
    (_, before), = incremental._updates(warehouse, 1)
    read = []
    monkeypatch.setattr(incremental, "rows_of_months", lambda *a, f=incremental.rows_of_months: read.append(f(*a)) or read[-1])
    deliver(warehouse, "monitoring", "2026-08-02", measures(1, MONTHS[1]), "b")
    same(warehouse, warehouse.update_silver())
    (_, after), *_ = incremental._updates(warehouse, 2)
    assert {p for p, v in after["fact_monitoring"].items() if before["fact_monitoring"].get(p) != v} == {"202606"}
    assert after["fact_sejours"] == before["fact_sejours"] and after["stay_index"] == before["stay_index"]
    (source,) = read
    plan = source._jdf.queryExecution().executedPlan().toString()
    picked = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert re.findall(r"\d{4}-\d\d-\d\d", picked) == ["2026-08-02"]


def test_a_stay_that_moves_takes_its_events_along(warehouse):
    """A redelivered stay changes service, month and patient; a new year of birth changes ages in months of no new file."""
    deliver(warehouse, "patients", "2026-08-01", [("P1", "1950", "F", "R1"), ("P2", "1980", "F", "R1")], "a")
    deliver(warehouse, "sejours", "2026-08-01", [stay(0, "A"), stay(1, "A")], "a")
    deliver(warehouse, "monitoring", "2026-08-01", measures(2, "2026-06"), "a")
    deliver(warehouse, "actes", "2026-08-01", [("S0", "X", at("2026-07-01 10:00:00")), ("S7", "X", at("2026-07-02 10:00:00"))], "a")
    deliver(warehouse, "diagnostics", "2026-08-01", [("S0", [("C1", None)]), ("S1", [("C1", None)])], "a")
    warehouse.update_silver()
    deliver(warehouse, "sejours", "2026-08-02", [("S0", "P2", "B", "2026-08-01 10:00:00", "", "urgence", ""), stay(7, "Z")], "b")
    found = warehouse.update_silver()
    same(warehouse, found)
    assert rows(found["fact_monitoring"], "stay_id", "service_code") == [("S0", "B"), ("S1", "A")]
    assert rows(found["fact_acte"], "stay_id", "service_code") == [("S0", "B"), ("S7", "Z")]
    assert rows(found["fact_diagnostics"], "stay_id", "age_at_diagnostics") == [("S0", 46), ("S1", 76)]
    deliver(warehouse, "patients", "2026-08-03", [("P1", "1960", "F", "R1")], "c")
    found = warehouse.update_silver()
    assert rows(found["fact_diagnostics"], "stay_id", "age_at_diagnostics") == [("S0", 46), ("S1", 66)]
    deliver(warehouse, "patients", "2026-08-03", [], "d")  # taken back: the older version counts again
    same(warehouse, warehouse.update_silver())


def test_a_failed_update_leaves_the_former_and_old_versions_go(warehouse, monkeypatch):
    deliver(warehouse, "sejours", "2026-08-01", [stay(0, "A")], "a")
    former = rows(warehouse.update_silver()["fact_sejours"])
    assert warehouse.update_silver() and len(incremental._updates(warehouse, 9)) == 1  # nothing new, no update
    deliver(warehouse, "sejours", "2026-08-02", [stay(1, "B")], "b")
    with monkeypatch.context() as patch:
        patch.setattr(silver, "fact_sejours", lambda *_: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            warehouse.update_silver()
    assert rows(incremental.tables(warehouse)["fact_sejours"]) == former
    reading = warehouse.update_silver()["fact_sejours"]
    same(warehouse, incremental.tables(warehouse))
    for k in (3, 4):
        deliver(warehouse, "sejours", f"2026-08-0{k}", [stay(k, "B")], f"c{k}")
        first, reading = reading, warehouse.update_silver()["fact_sejours"]
        assert first.count() == k - 1  # the update before can still be read
    (_, parts), = incremental._updates(warehouse, 1)
    folder = incremental._store(warehouse).root + "/stay_index/part=all"
    assert warehouse.spark.read.parquet(folder).select("version").distinct().count() == 2
