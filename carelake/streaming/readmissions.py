"""W1, G3 on a stream: readmissions counted as stays arrive, in any order, from keyed state with timers.

The state of a patient are the days on which a stay began, each with its number of stays and the last stay's times; a
batch only says by how much the counts change, so their sum is the mart of the batch world at any time. A stay that comes
late corrects what was counted before, both its own day and the one after it. When the watermark has passed a day by
thirty days, a timer drops what no later stay can ask for.

Patients are dealt to a fixed number of buckets by hash, and a bucket's patients are read and written together: what
a batch costs besides its rows are calls for each bucket, not for each patient.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from carelake.functions.numeric import percent
from carelake.plans.gold import READMISSION_DAYS

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_DAY_MICROS, _DAY_MILLIS = 86_400_000_000, 86_400_000
_DAYS = "patient string, day int, n bigint, admission bigint, discharge bigint"
_STATE = "patient array<string>, day array<int>, n array<bigint>, admission array<bigint>, discharge array<bigint>"  # an entry per patient and day
BUCKETS = 16_384  # patients are dealt to so many states: more patients make these larger, not more
_CHANGES = "nb_sejours bigint, nb_readmissions bigint"

Held = dict[int, tuple[int, int, int]]


def counted(held: Held) -> tuple[int, int]:
    """Stays, and days that follow the discharge of the day before them by 1 to 30 days. held: day -> (n, admission, discharge)."""
    days = sorted(held)
    gaps = (day - held[before][2] // _DAY_MICROS for before, day in zip(days, days[1:], strict=False))
    return sum(n for n, _, _ in held.values()), sum(READMISSION_DAYS[0] <= gap <= READMISSION_DAYS[1] for gap in gaps)


def kept(held: Held, now: int) -> Held:
    """What stays that begin on the day `now` or later can still ask for: these days, and the one before if a discharge is near."""
    later, past = {d: v for d, v in held.items() if d >= now}, [d for d in held if d < now]
    if past and held[max(past)][2] // _DAY_MICROS + READMISSION_DAYS[1] >= now:
        later[max(past)] = held[max(past)]
    return later


def due(held: Held, now: int) -> int:
    """The first day after `now` on which `kept` may drop something of what it keeps."""
    newest = max(held)
    first = newest + READMISSION_DAYS[1] + 1
    return first if first > now else max(now, held[newest][2] // _DAY_MICROS + READMISSION_DAYS[1]) + 1


class _Days(StatefulProcessor):
    """The days of a bucket's patients as one value: each access to the state is a call from Python to the JVM."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getValueState("days", _STATE)

    def _held(self) -> dict[str, Held]:
        held: dict[str, Held] = {}
        for patient, day, *rest in zip(*(self.days.get() or ()), strict=True):
            held.setdefault(patient, {})[day] = tuple(rest)
        return held

    def _put(self, held: dict[str, Held], now: int) -> None:
        rows = [(patient, day, *own[day]) for patient, own in held.items() for day in own]
        if not rows:
            self.days.clear()
            return
        self.days.update(tuple(map(list, zip(*rows, strict=True))))
        self.handle.registerTimer(min(due(own, now) for own in held.values()) * _DAY_MILLIS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self._held()
        new: dict[str, list[Row]] = {}
        for row in rows:
            new.setdefault(row.patient, []).append(row)
        n = readmitted = 0
        for patient, own_rows in new.items():
            own = held.setdefault(patient, {})
            before = counted(own)
            for row in own_rows:
                former = own.get(row.day, (0, 0, 0))
                last = max((row.admission, row.discharge), former[1:]) if former[0] else (row.admission, row.discharge)
                own[row.day] = (former[0] + row.n, *last)
            after = counted(own)
            n, readmitted = n + after[0] - before[0], readmitted + after[1] - before[1]
        self._put(held, timerValues.getCurrentWatermarkInMs() // _DAY_MILLIS)
        yield Row(nb_sejours=n, nb_readmissions=readmitted)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now, held = timerValues.getCurrentWatermarkInMs() // _DAY_MILLIS, self._held()
        later = {patient: kept(own, now) for patient, own in held.items()}
        self._put({patient: own for patient, own in later.items() if own}, now)
        return iter(())

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per patient and day of what a task has, so that a patient with very many stays reaches the state as days."""
    for batch in batches:
        out: dict[tuple, tuple] = {}
        for row in zip(*(batch.column(c).to_pylist() for c in ("patient", "day", "n", "admission", "discharge")), strict=True):
            own = out.get(row[:2], (0, row[3], row[4]))
            out[row[:2]] = (own[0] + row[2], *max(own[1:], row[3:]))
        yield pa.RecordBatch.from_pydict(
            {"patient": [k[0] for k in out], "day": [k[1] for k in out], "n": [v[0] for v in out.values()],
             "admission": [v[1] for v in out.values()], "discharge": [v[2] for v in out.values()]},
            schema=pa.schema([("patient", pa.string()), ("day", pa.int32()), ("n", pa.int64()), ("admission", pa.int64()), ("discharge", pa.int64())]))


def count_readmissions(stays: DataFrame, folder: str, lateness: str) -> StreamingQuery:
    """Count the finished stays of a stream (columns of `fact_sejours`) that arrived since the last start, then stop.

    Each micro-batch appends its changes to `folder`/changes; `folder`/checkpoint holds the state. Stays without patient
    are one patient's, as in the mart. A stay that began more than `lateness` before the newest one is too late and
    left out: the state it would need may be gone.
    """
    spark = stays.sparkSession
    spark.conf.set(*STATE_STORE)
    finished = stays.filter((F.col("is_ongoing") == 0) & F.col("discharge_ts").isNotNull()).select(
        F.coalesce(F.concat(F.lit("="), "patient_pseudo_id"), F.lit("")).alias("patient"), F.unix_date(F.to_date("admission_ts")).alias("day"),
        F.lit(1).cast("bigint").alias("n"), F.unix_micros("admission_ts").alias("admission"), F.unix_micros("discharge_ts").alias("discharge"))
    days = finished.mapInArrow(_combined, _DAYS).withColumn("began", F.timestamp_seconds(F.col("day").cast("bigint") * 86_400))
    days = days.withColumn("bucket", F.pmod(F.xxhash64("patient"), F.lit(BUCKETS)).cast("int"))
    changes = days.withWatermark("began", lateness).groupBy("bucket").transformWithState(
        statefulProcessor=_Days(), outputStructType=_CHANGES, outputMode="Append", timeMode="EventTime")
    query = changes.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option(
        "path", f"{folder}/changes").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def readmissions_30j(spark: SparkSession, folder: str) -> DataFrame:
    """G3 from the changes that `count_readmissions` wrote: nothing but their sums."""
    return spark.read.schema(_CHANGES).parquet(f"{folder}/changes").agg(
        F.coalesce(F.sum("nb_sejours"), F.lit(0)).alias("nb_sejours_total"),
        F.coalesce(F.sum("nb_readmissions"), F.lit(0)).alias("nb_readmissions_30j"),
    ).select("*", percent(F.col("nb_readmissions_30j"), F.col("nb_sejours_total")).alias("taux_readmission_pct"))
