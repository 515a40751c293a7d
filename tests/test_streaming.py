from __future__ import annotations

import helpers as h
from helpers import rows
from pyspark.sql import types as T

from carelake import schemas
from carelake.plans import silver
from carelake.sources import bronze
from carelake.operators import quality
from carelake.streaming import ingest

LAKE = schemas.LAKE["sejours"]


def lake_stays(spark, *stays):
    return spark.createDataFrame(
        [(s, "p", "A", start, end, "urgence", "", None, h.day("2026-08-01"), "sejours/2026-08-01/sejours.csv")
         for s, start, end in stays], LAKE)


def test_stream_and_batch_give_the_same_bronze_and_rejects_once(spark, tmp_path):
    drop, folder = (str(tmp_path / d) for d in ("drop", "loaded"))
    lake_stays(spark, ("s1", "2026-08-01 10:00:00", ""), ("s2", "nonsense", "")).write.parquet(drop)

    def load():
        ingest.load_bronze(ingest.read_stream(spark, drop, LAKE), "sejours", folder)
        stamped = T.StructType([*schemas.BRONZE["sejours"], T.StructField("ingested_at", T.TimestampType())])
        return ingest.read_batches(spark, f"{folder}/bronze", stamped)

    assert rows(load(), "stay_id") == [("s1",)]
    assert load().count() == 1  # nothing new
    lake_stays(spark, ("s3", "2026-08-01 10:00:00", "2026-08-02 10:00:00")).write.mode("append").parquet(drop)
    streamed = load()
    tagged = bronze.tagged("sejours", spark.read.schema(LAKE).parquet(drop))
    assert rows(streamed.drop("ingested_at")) == rows(quality.valid(tagged))
    assert streamed.count() == 2 and streamed.filter("ingested_at is null").isEmpty()
    assert rows(streamed, "source_file") == [("sejours/2026-08-01/sejours.csv",)] * 2
    rejects = ingest.read_batches(spark, f"{folder}/rejects", bronze.rejects(tagged).schema)
    assert rows(rejects) == rows(bronze.rejects(tagged))
    assert rows(rejects, "reason") == [("malformed_admission",)]


def test_vital_signs_are_scored_on_a_stream(spark, tmp_path):
    drop, folder = (str(tmp_path / d) for d in ("drop", "silver"))
    measures = h.monitoring(
        spark, ("s1", "2026-08-01 10:00", 130, 98, 37.0), ("s1", "2026-08-01 10:05", 300, 98, 37.0),
        ("s9", "2026-08-01 10:00", 70, 98, 37.0))
    measures.write.parquet(drop)
    stays = silver.stay_index(h.sejours(spark, ("s1", "p", "A", "2026-08-01", None)))
    ingest.score_vitals(ingest.read_stream(spark, drop, schemas.BRONZE["monitoring"]), stays, folder)
    scored = ingest.read_batches(spark, f"{folder}/fact_monitoring", schemas.SILVER["fact_monitoring"])
    assert rows(scored) == rows(silver.fact_monitoring(measures, stays))
    assert scored.count() == 1
