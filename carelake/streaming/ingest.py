"""File-stream variants: the same rules on files as they arrive.

The reference work is a nightly batch. `availableNow` keeps that rhythm: each start takes the files
that arrived since the last one, exactly once per path, and stops. Every micro-batch is written to a
folder of its own number, so one that was cut short and runs again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake.operators import quality
from carelake.plans import silver
from carelake.sources import bronze


def read_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files below `path`, new ones as they arrive."""
    return spark.readStream.schema(schema).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the micro-batches wrote to `path`."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def load_bronze(lake: DataFrame, kind: str, folder: str) -> StreamingQuery:
    """K1 as a stream: the lake rows of the files not seen before by the rules of the batch load, then stop.

    Typed rows with their lineage and `ingested_at` go to `folder`/bronze, the others with their
    reason to `folder`/rejects. `folder`/checkpoint is the ledger of the files.
    """
    def load(rows: DataFrame) -> dict[str, DataFrame]:
        tagged = bronze.tagged(kind, rows)
        return {
            "rejects": bronze.rejects(tagged),
            "bronze": quality.valid(tagged).withColumn("ingested_at", F.current_timestamp()),
        }

    return _by_batch(lake, folder, load)


def score_vitals(monitoring: DataFrame, stays: DataFrame, folder: str) -> StreamingQuery:
    """B7 as a stream: vital signs of the files not seen before to `folder`/fact_monitoring, then stop.

    The rules are stateless, so each micro-batch is scored as a batch, and a stay with very many
    measures is split in the join as it is there.
    """
    return _by_batch(monitoring, folder, lambda rows: {"fact_monitoring": silver.fact_monitoring(rows, stays)})


def _by_batch(
    source: DataFrame, folder: str, tables: Callable[[DataFrame], dict[str, DataFrame]],
) -> StreamingQuery:
    def write(rows: DataFrame, batch: int) -> None:
        # streams switch adaptive execution off for the sake of state; there is none here
        rows.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        for name, table in tables(rows).items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch}")

    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
