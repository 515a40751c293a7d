"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import (
    bpe, chat_parts, edit_counts, filter_audit, language_id, line_quality, ngram_jaccard, packing, prefix_trie, secret_scan,
    simhash_trie, stream_dedup, warc,
)
from carelake.llm.common import importable, table


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, sf_dir)

    return query


def _documents(run: Callable[[SparkSession, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return _query(lambda spark, sf_dir: run(spark, table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_byte_bpe": _query(bpe.op1),
    "op2_language_id": _query(language_id.op2),
    "op3_secret_scan": _documents(secret_scan.op3),
    "op4_warc_zstd": _query(warc.op4),
    "op5_line_quality": _documents(line_quality.op5),
    "op6_pattern_packing": _documents(packing.op6),
    "op7_stream_dedup": _documents(stream_dedup.op7),
    "op8_edit_counts": _query(edit_counts.op8),
    "op9_simhash_trie": _documents(simhash_trie.op9),
    "op10_chat_parts": _query(chat_parts.op10),
    "op11_prefix_trie": _query(prefix_trie.op11),
    "op12_filter_audit": _query(filter_audit.op12),
    "op13_ngram_jaccard": _documents(ngram_jaccard.op13),
}

SQL = {
    "op4_warc_zstd": warc.SQL,
    "op5_line_quality": line_quality.SQL,
    "op7_stream_dedup": stream_dedup.SQL,
    "op10_chat_parts": chat_parts.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
