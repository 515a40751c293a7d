"""Operator 7 against a plain Python version; the stream goes on where it stopped; texts that share a digest part."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from carelake.llm import stream_dedup
from carelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, digest string, n int, first string"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def rows():
    texts = ["a b", "a  b", "a\n\tb", " a b", None, "", "A b", "a\x1cb", "x" * 50_000, "x" * 50_000, "é", "é"]
    out = [(i * 7 % 12, t) for i, t in enumerate(texts)]
    out += [(500 + i, "hot  text") for i in range(300)] + [(3, "twice"), (3, "twice"), (None, "a b"), (None, "only")]
    return [(i, t, "d", 1, "f") for i, t in out]


def plain(given):
    groups = defaultdict(list)
    for i, t, *_ in given:
        groups[norm(t)].append(i)
    return groups


def check(got, given):
    groups = plain(given)
    assert len(got) == len(given)
    seen = defaultdict(list)
    for r in got:
        seen[r.text_sha256].append(r)
    for text, ids in groups.items():
        found = seen.pop(hashlib.sha256(text.encode()).hexdigest())
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        assert sorted(str(r.doc_id) for r in found) == sorted(map(str, ids))
        assert all(r.keep_id == keep and r.group_size == len(ids) for r in found)
        assert [r.doc_id for r in found if r.kept] == [keep]  # one row, also of rows that repeat it
    assert not seen


def test_query(spark, parquet):
    got = QUERIES["op7_stream_dedup"](spark, parquet("documents", rows(), SCHEMA, 5)).collect()
    check(got, rows())


def test_texts_that_share_a_digest_are_told_apart(spark):
    """With a digest of one hex digit, most groups hold several texts; the full texts part them."""
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    got = stream_dedup.deduplicate(docs, digest=lambda t: F.sha2(t, 256).substr(1, 1)).collect()
    groups = plain(rows())
    by_keep = defaultdict(list)
    for r in got:
        by_keep[(r.keep_id, r.group_size)].append(r.doc_id)
    wanted = defaultdict(list)
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        wanted[(min(known) if known else None, len(ids))] += ids
    order = lambda d: {k: sorted(map(str, v)) for k, v in d.items()}
    assert order(by_keep) == order(wanted)
    assert sum(r.kept for r in got) == len(groups)


def test_stage(spark, parquet):
    folder = parquet("documents", rows(), SCHEMA, 5)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stream_dedup.stage(spark, docs, folder)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted(norm(r.text) for r in kept) == sorted(plain(rows()))


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    """State outlives the query and never expires; a batch that adds to a digest replaces its entry."""
    folder, source = f"{tmp_path}/state", f"{tmp_path}/in"
    own = stream_dedup.state_session(spark)
    for ids in ([5, 6], [2], [9]):
        spark.createDataFrame([("d", i, "f", i) for i in ids], stream_dedup.ARRIVALS).coalesce(1).write.mode("append").parquet(source)
        stream_dedup.start(own.readStream.schema(stream_dedup.ARRIVALS).parquet(source), folder).awaitTermination()
    (r,) = stream_dedup.held(spark, folder).collect()
    assert (r.n, r["first"].doc_id) == (4, 2)
    stores = [p for p in tmp_path.rglob("*.zip")]
    assert stores, "the state was kept by RocksDB, whose snapshots are zip files"


def test_state_settings_stay_in_their_session(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stream_dedup.state_session(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_partitions_of_the_state_share_their_memory(spark):
    own, before = stream_dedup.state_session(spark), "spark.sql.streaming.stateStore.rocksdb."
    assert own.conf.get(before + "boundedMemoryUsage") == "true" and int(own.conf.get(before + "maxMemoryUsageMB")) <= 256
    assert spark.conf.get(before + "boundedMemoryUsage", "false") == "false"


def test_empty_table(spark, parquet):
    assert QUERIES["op7_stream_dedup"](spark, parquet("documents", [], SCHEMA)).collect() == []
