"""What the plans must and must not contain."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from carelake import schemas
from carelake.plans import gold
from carelake.plans.warehouse import write_silver
from carelake.sources.store import TableStore
from carelake.standin.tables import Standin

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")

# every pair of rows, or rows sent to Python
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - {"ingest_stream"}))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    plan = physical(entry.queries()[name](spark, FOLDER))
    assert not [word for word in FORBIDDEN if word in plan]


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    built = Standin(spark, FOLDER).silver
    store = TableStore(spark, str(tmp_path_factory.mktemp("silver")), schemas.SILVER)
    for table in schemas.SILVER:
        write_silver(store, table, built[table])
    return {table: store.read(table) for table in schemas.SILVER}


def scanned(plan: str, column: str) -> list[str]:
    """Columns of the scans that read `column`."""
    return [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line and column in line]


def test_emergency_filter_reaches_the_scan(silver):
    plan = physical(gold.urgences(silver))
    assert "EqualTo(service_code,URGENCES)" in plan
    (columns,) = scanned(plan, "admission_ts")
    assert "stay_id" not in columns and "patient_pseudo_id" not in columns


def test_alerts_read_flags_only_and_prune_months(silver):
    plan = physical(gold.alertes(silver))
    (columns,) = scanned(plan, "is_alert")
    assert "heart_rate" not in columns and "alert_reasons" not in columns and "stay_id" not in columns
    month = {**silver, "fact_monitoring": silver["fact_monitoring"].filter("mois = 202401")}
    assert "PartitionFilters: [isnotnull(mois" in physical(gold.alertes(month))


def test_labels_are_joined_after_the_facts_are_reduced(silver):
    for mart, fact_column in (
        (gold.actes_ccam, "code_ccam"), (gold.facturation_t2a, "service_code"), (gold.dms, "service_code"),
        (gold.densite_plateau, "service_code"), (gold.categories, "service_code"),
    ):
        plan = mart(silver)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.rindex("Aggregate"), mart.__name__
        joined = plan[plan.index("Join"):]
        assert f"Aggregate [{fact_column}" in joined, mart.__name__


def test_length_of_stay_reads_three_columns(silver):
    (columns,) = scanned(physical(gold.dms(silver)), "duree_sejour_jours")
    assert columns.startswith("struct<service_code:string,is_ongoing:int,duree_sejour_jours:double>")
