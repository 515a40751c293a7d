"""The training-data pipeline over `documents`: five stages, each written as Parquet and read again by the next.

quality rules   documents that fail go, failed lines are taken out of the others
exact dedup     one document of each text stays
near duplicates one document of each group of linked SimHash fingerprints stays
secret scan     secrets are replaced in the texts
packing         the documents as pieces of token sequences (the last stage returns these)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import line_quality, packing, secret_scan, simhash_trie, stream_dedup
from carelake.llm.common import importable, scratch, table


def _stage(run):
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, docs, sf_dir)

    return stage


STAGES = [
    ("quality_rules", _stage(line_quality.stage)),
    ("exact_dedup", _stage(stream_dedup.stage)),
    ("near_duplicates", _stage(simhash_trie.stage)),
    ("secret_scan", _stage(secret_scan.stage)),
    ("packing", _stage(packing.stage)),
]

#: Fingerprints, the forest and the tokens have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
