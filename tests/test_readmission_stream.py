"""Readmissions on a stream against the mart, for stays in any order of arrival."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from helpers import rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from carelake import schemas
from carelake.plans import gold
from carelake.streaming import readmissions


def stays(chance, n):
    """Stays of few patients, several a day, ongoing ones, and some that end before another begins."""
    out = []
    for i in range(n):
        admission = datetime(2026, 1, 1) + timedelta(days=chance.randrange(400), hours=chance.randrange(24))
        discharge = None if chance.random() < 0.1 else admission + timedelta(hours=chance.choice([1, 30, 200, 900]))
        out.append((f"S{i}", chance.choice(["P1", "P2", "P3", "", None]), "A", admission, discharge, "", "", int(discharge is None), None, None))
    return out


def put(spark, data, folder, name):
    spark.createDataFrame(data, schemas.SILVER["fact_sejours"]).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder, files):
    source = spark.readStream.schema(schemas.SILVER["fact_sejours"]).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True)
    return source.parquet(f"{folder}/in")


def test_random_order_equals_the_mart(spark, tmp_path):
    """Two starts over shuffled files; after each, the sums are the mart of all that had arrived."""
    chance = random.Random(2)
    data = stays(chance, 120)
    chance.shuffle(data)
    for k, part in enumerate((data[:50], data[50:])):
        for i in range(2):
            put(spark, part[i::2], f"{tmp_path}/in", f"f{k}{i}")
        readmissions.count_readmissions(stream(spark, tmp_path, 1), f"{tmp_path}/out", "5000 days")
        so_far = spark.createDataFrame(data[: 50 + 70 * k], schemas.SILVER["fact_sejours"])
        wanted = gold.readmissions_30j({"fact_sejours": so_far})
        got = readmissions.readmissions_30j(spark, f"{tmp_path}/out")
        assert got.dtypes == wanted.dtypes and rows(got) == rows(wanted) and got.first().nb_readmissions_30j > 3


def test_state_is_dropped_when_no_stay_can_ask_for_it(spark, tmp_path):
    """In order of time, with little lateness: the same sums from a state of a few days."""
    chance = random.Random(3)
    data = sorted((s for s in stays(chance, 150) if s[1]), key=lambda s: s[3])
    for k in range(5):
        put(spark, data[k * 30 : k * 30 + 30], f"{tmp_path}/in", f"f{k}")
        readmissions.count_readmissions(stream(spark, tmp_path, 1), f"{tmp_path}/out", "10 days")
    wanted = gold.readmissions_30j({"fact_sejours": spark.createDataFrame(data, schemas.SILVER["fact_sejours"])})
    assert rows(readmissions.readmissions_30j(spark, f"{tmp_path}/out")) == rows(wanted)
    held = spark.read.format("statestore").option("stateVarName", "days").load(f"{tmp_path}/out/checkpoint").count()
    began = len({(s[1], s[3].date()) for s in data if s[4]})
    assert held < began / 2


def test_what_is_kept():
    micros, day = 86_400_000_000, 20_000
    held = {day: (1, 0, (day + 2) * micros), day + 50: (2, 0, (day + 60) * micros), day + 90: (1, 0, (day + 91) * micros)}
    assert readmissions.counted(held) == (4, 1)
    assert readmissions.kept(held, day) == held and set(readmissions.kept(held, day + 70)) == {day + 50, day + 90}
    assert set(readmissions.kept(held, day + 91)) == {day + 90} and readmissions.kept(held, day + 122) == {}


def test_a_patient_with_many_stays_reaches_the_state_as_days(spark):
    given = spark.range(1000).select(F.lit("P").alias("patient"), (F.col("id") % 3).cast("int").alias("day"), F.lit(1).cast("bigint").alias("n"),
                                     F.col("id").alias("admission"), (F.col("id") + 5).alias("discharge")).coalesce(1)
    found = given.mapInArrow(readmissions._combined, readmissions._DAYS)
    assert rows(found) == [("P", 0, 334, 999, 1004), ("P", 1, 333, 997, 1002), ("P", 2, 333, 998, 1003)]


def test_unfinished_streams_are_not_started_twice(spark, tmp_path):
    put(spark, stays(random.Random(1), 5), f"{tmp_path}/in", "f")
    for _ in range(2):  # nothing new: no change
        readmissions.count_readmissions(stream(spark, tmp_path, 1), f"{tmp_path}/out", "10 days")
    assert readmissions.readmissions_30j(spark, f"{tmp_path}/out").first().nb_sejours_total <= 5


def test_calls_for_a_bucket_are_not_multiplied_by_its_patients():
    """A state is read and written once for all its patients, timers are one a call, and each patient's days stay apart."""
    micros, calls, value = 86_400_000_000, [], []

    class Handle:
        def getValueState(self, name, schema):  # noqa: N802
            return self

        def get(self):
            calls.append("get")
            return value[-1] if value else None

        def update(self, new):
            calls.append("update")
            value.append(new)

        def clear(self):
            calls.append("clear")
            value.clear()

        def registerTimer(self, at):  # noqa: N802
            calls.append(("timer", at))

    class Now:
        def __init__(self, day):
            self.day = day

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return self.day * 86_400_000

    def row(patient, day, n=1, days=1):
        return Row(patient=patient, day=day, n=n, admission=day * micros, discharge=(day + days) * micros)

    days = readmissions._Days()
    days.init(Handle())
    first = list(days.handleInputRows((0,), iter([row(f"P{i}", 100) for i in range(50)]), Now(0)))
    assert first == [Row(nb_sejours=50, nb_readmissions=0)] and calls == ["get", "update", ("timer", 131 * 86_400_000)]
    again = list(days.handleInputRows((0,), iter([row("P3", 110), row("P4", 110, 2), row("P9", 300, 1, 60)]), Now(0)))
    assert again == [Row(nb_sejours=4, nb_readmissions=2)] and len(value[-1][0]) == 53
    del calls[:]
    assert list(days.handleExpiredTimer((0,), Now(132), None)) == []
    assert sorted(zip(*value[-1][:2], strict=True)) == [("P3", 110), ("P4", 110), ("P9", 300)]
    assert calls == ["get", "update", ("timer", 141 * 86_400_000)]
    list(days.handleExpiredTimer((0,), Now(340), None))  # the discharge of day 360 can be asked for until day 390
    assert value[-1][:2] == (["P9"], [300]) and calls[-1] == ("timer", 391 * 86_400_000)
    list(days.handleExpiredTimer((0,), Now(391), None))
    assert not value and calls[-1] == "clear"
