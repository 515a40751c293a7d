"""Alerts in event time against the batch rules, for measures that come late, twice and in any order."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import helpers as h
import pytest
from helpers import rows
from pyspark.sql import functions as F

from carelake import schemas
from carelake.plans import gold, silver
from carelake.streaming import alerts, ingest

BEGIN = datetime(2026, 3, 1)


def measures(chance, n, first, days):
    return [(chance.choice(["s1", "s2", "s9", None]), BEGIN + timedelta(days=first, minutes=chance.randrange(days * 1440)),
             chance.choice([None, 40, 70, 130, 300]), chance.choice([None, 85, 97]), chance.choice([None, 35.0, 37.5, 39.0]),
             BEGIN.date(), "monitoring/2026-03-01/monitoring.parquet") for _ in range(n)]


def deliver(spark, folder, data, lateness, window, slide):
    spark.createDataFrame(data, schemas.BRONZE["monitoring"]).coalesce(2).write.mode("append").parquet(f"{folder}/in")
    source = ingest.read_stream(spark, f"{folder}/in", schemas.BRONZE["monitoring"])
    alerts.divert(source, stays(spark), f"{folder}/out", lateness)
    return alerts.count_windows(spark, f"{folder}/out", lateness, window, slide)


def stays(spark):
    return silver.stay_index(h.sejours(spark, ("s1", "p", "A", "2026-02-01", None), ("s2", "q", "B", "2026-02-01", None)))


def expected(spark, deliveries, lateness, window, slide):
    """By hand: the frontier before each delivery, equal measures in time once, closed windows, late measures per window."""
    newest, seen, late, taken = None, set(), [], []
    for data in deliveries:
        good = [tuple(r) for r in silver.fact_monitoring(spark.createDataFrame(data, schemas.BRONZE["monitoring"]), stays(spark)).collect()]
        for row in good:
            if row[2] is None or (newest and row[2] <= newest - lateness):
                late.append(row)
            elif (row[0], *row[2:6]) not in seen:
                seen.add((row[0], *row[2:6]))
                taken.append(row)
        newest = max([newest or datetime.min, *(r[2] for r in good if r[2])])
    table = spark.createDataFrame(taken, schemas.SILVER["fact_monitoring"])
    counts = table.groupBy(F.window("ts", window, slide).alias("w")).agg(*gold.alert_counts()).select("w.*", *alerts._names()[2:])
    closed = {tuple(r[:2]): tuple(r[2:]) for r in counts.collect() if r.end <= newest - lateness}
    per_window = spark.createDataFrame(late, schemas.SILVER["fact_monitoring"]).groupBy(F.window("ts", window, slide).alias("w")).count()
    tardy = {tuple(r.w): r["count"] for r in per_window.collect()}
    return {w: (*closed.get(w, (0,) * 5), tardy.get(w, 0)) for w in closed | tardy}, len(late)


@pytest.mark.parametrize(("window", "slide"), [("1 day", None), ("12 hours", "3 hours")])
def test_late_repeated_and_shuffled_measures(spark, tmp_path, window, slide):
    chance = random.Random(5)
    deliveries = [measures(chance, 60, 0, 6), measures(chance, 60, 4, 6), measures(chance, 60, 0, 20), measures(chance, 20, 0, 22)]
    deliveries[1] += deliveries[0][:20] + deliveries[1][:5]  # delivered again, in the same delivery and in the next
    deliveries[3] += [(*deliveries[3][0][:1], None, *deliveries[3][0][2:])] * 2  # without time
    deliveries[3][-1] = ("s1", None, 70, 97, 37.5, *deliveries[3][0][5:])
    for data in deliveries:
        query = deliver(spark, tmp_path, data, "2 days", window, slide)
        assert all(op.numRowsDroppedByWatermark == 0 for p in query.recentProgress for op in p.stateOperators)
    wanted, n_late = expected(spark, deliveries, timedelta(days=2), window, slide)
    found = alerts.alerts_by_window(spark, f"{tmp_path}/out", window, slide)
    assert {tuple(r[:2]): tuple(r[2:8]) for r in found.collect()} == wanted
    assert alerts.late_measures(spark, f"{tmp_path}/out").count() == n_late > 10
    assert sum(v[0] > 0 for v in wanted.values()) > 5 and any(v[0] and v[5] for v in wanted.values())


def test_equals_the_mart_where_nothing_is_late(spark, tmp_path):
    """Shuffled deliveries within the lateness: the closed days are the mart's."""
    chance = random.Random(7)
    data = list({(m[0], m[1], *m[2:]): m for m in measures(chance, 200, 0, 10)}.values())
    chance.shuffle(data)
    for part in (data[:80], data[80:], [("s1", BEGIN + timedelta(days=40), 70, 97, 37.0, *data[0][5:])]):
        deliver(spark, tmp_path, part, "12 days", "1 day", None)
    mart = gold.alertes({"fact_monitoring": silver.fact_monitoring(spark.createDataFrame(data, schemas.BRONZE["monitoring"]), stays(spark))})
    found = alerts.alerts_by_window(spark, f"{tmp_path}/out")
    assert rows(found.withColumn("jour", F.to_date("debut")).select(mart.columns)) == rows(mart)
    assert alerts.late_measures(spark, f"{tmp_path}/out").isEmpty()


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    """The frontier of a batch is that of the batches before it, whatever it wrote itself the first time."""
    deliver(spark, tmp_path, measures(random.Random(1), 30, 0, 3), "1 day", "1 day", None)
    first = spark.range(1).select(alerts.frontier(spark, f"{tmp_path}/out", 0, "1 day")).first()[0]
    then = spark.range(1).select(alerts.frontier(spark, f"{tmp_path}/out", 1, "1 day")).first()[0]
    assert first is None and BEGIN < then + timedelta(days=1) < BEGIN + timedelta(days=3)


def test_nothing_delivered(spark, tmp_path):
    for _ in range(2):
        deliver(spark, tmp_path, [], "1 day", "1 day", None)
    assert alerts.alerts_by_window(spark, f"{tmp_path}/out").isEmpty()
