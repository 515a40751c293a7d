"""Operator 13 against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import ngram_jaccard
from carelake.llm.common import written
from carelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, n int, `key` string, `at` int, nid int, token string, file string"


def plain_set(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(rows, percent=85):
    """Sorted (doc_id, size, component) over all pairs."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    lows = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lows[find(i)] = min(doc, lows.get(find(i), doc))
    return sorted(((d, len(s), lows.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def crowd(seed, n, sizes):
    """Texts and chains of edited copies of them, of the sizes asked for, with passages that many share."""
    chance, texts = random.Random(seed), []
    passages = [[f"p{k}x{i}" for i in range(30)] for k in range(3)]
    while len(texts) < n:
        words = [f"w{chance.randrange(10**6)}" for _ in range(chance.choice(sizes))]
        if chance.random() < 0.3:
            words += chance.choice(passages)
        for _ in range(chance.choice([1, 1, 2, 4, 9])):
            texts.append(chance.choice([" ", "\n", " \x0b"]).join(words))
            words = list(words)
            for _ in range(chance.choice([0, 1, 1, 2, 3])):
                at = chance.randrange(len(words) + 1)
                words[at : at + chance.choice([0, 1])] = chance.choice([[], ["Neu"], [f"e{chance.randrange(99)}"]])
    return texts


def result(spark, folder):
    found = QUERIES["op13_ngram_jaccard"](spark, folder)
    assert found.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    return sorted(map(tuple, found.collect()), key=str)


def test_elements():
    for text in ("", " \n", "One", "a b", "a b c d", "À B c D e f g g g g g", "x\x0by\x1cz w q r", "word " * 70_000, "w x y z " * 9):
        got = ngram_jaccard.elements(text.encode(), 4)
        assert len(got) == len(plain_set(text)) and (np.diff(got.astype(object)) > 0).all()
    assert (ngram_jaccard.elements(b" One\ttwo ", 4) == ngram_jaccard.elements(b"oNE two", 4)).all()


def test_need_is_the_least_intersection():
    for a in range(1, 60):
        for b in range(a, 80):
            linked = [c for c in range(a + 1) if 100 * c >= 85 * (a + b - c)]
            assert ngram_jaccard.need(a, b) == (linked[0] if linked else ngram_jaccard.need(a, b)) and (bool(linked) == (ngram_jaccard.need(a, b) <= a))


def test_equals_all_pairs(spark, parquet):
    """Light, mixed and heavy sizes; nulls, empty texts, ties, repeated rows, equal sets of different texts."""
    texts = crowd(1, 150, range(3, 28)) + crowd(2, 120, [20, 22, 24, 26, 40, 90, 300])
    texts += [None, "", " \n", "a", "A", "a b", "a  b", "a a a a a a", "a a a a a"]
    chance = random.Random(7)
    rows = [(chance.choice([i, i, i, i, None, 5]), t) for i, t in enumerate(texts)] + [(3, texts[3])] * 3
    folder = parquet("documents", [(*r, 1, "k", 2, 3, "t", "f") for r in rows], SCHEMA)
    wanted = plain(rows)
    assert result(spark, folder) == wanted
    assert 20 < len({c for _, _, c in wanted}) < len(rows) - 60


def _nodes(spark, texts, percent=85):
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc bigint, words string").repartition(3), "test-docs")
    rows = docs.select("doc", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("at"),
                       F.col("words").cast("binary").alias("text"))
    marks = ngram_jaccard.marks(rows, ["doc", "at"], ngram_jaccard.frequencies(rows, 4), 4, percent)
    return rows, written(marks.filter("n > 0").withColumn("nid", F.col("doc")), "test-nodes")


def _roots(links, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("boundary", [1, 12, 20])
def test_every_boundary_gives_all_links(spark, monkeypatch, boundary):
    """Blocks of a few members, so that lists are cut; every link found is one, and together they give all components."""
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 4)
    texts = sorted({t for t in crowd(boundary, 300, [*range(8, 26), 40, 120])}, key=lambda t: (len(t) % 7, t))
    texts = list({frozenset(plain_set(t)): t for t in texts}.values())  # one text of each set
    rows, nodes = _nodes(spark, texts)
    light = ngram_jaccard.light_links(nodes, boundary, 85)
    heavy = ngram_jaccard.heavy_links(nodes, rows.select("at.file", "at.row", "text"), light, boundary, 4, 85)
    sets = [plain_set(t) for t in texts]
    links = [tuple(r) for r in light.unionByName(heavy).collect()]
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert all((max(x), min(x)) in set(linked) for x in links) and len(linked) > 30
    assert _roots(links, len(sets)) == _roots(linked, len(sets))


def test_boundary_is_chosen_by_cost(spark):
    cheap = spark.createDataFrame([(12, 5000.0)] * 50 + [(20, 1.0)] * 50, "n int, cost double")
    assert 13 <= ngram_jaccard.boundary_of(cheap, 85) <= 20
    assert ngram_jaccard.boundary_of(cheap.filter("n = 12"), 85) > 12 and ngram_jaccard.boundary_of(cheap.filter("n = 20"), 85) <= 20
    assert ngram_jaccard.boundary_of(cheap.limit(0), 85) == 1


def test_a_large_group_is_not_compared_pair_by_pair(spark):
    """Of 400 near copies with one word of 200 changed, all link; the scan after the stars has nothing left to compare."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join([*words[:k % 200], f"x{k}", *words[k % 200 + 1:]]) for k in range(400)]
    rows, nodes = _nodes(spark, texts)
    lists = ngram_jaccard.inverted(nodes, 10, 85)
    entries, most = lists.count(), lists.groupBy("token").count().agg(F.max("count")).first()[0]
    stars = lists.select("nid", F.explode(F.array("one", "two")).alias("c")).distinct().count()
    assert most > 300 and stars < entries / 5
    links = ngram_jaccard.heavy_links(nodes, rows.select("at.file", "at.row", "text"), spark.createDataFrame([], "src bigint, dst bigint"), 10, 4, 85)
    found = [tuple(r) for r in links.collect()]
    assert len(set(_roots(found, 400))) == 1 and len(found) < 400 * 40


def test_skewed_lists_can_be_split(spark):
    """The entries of a list meet their centers in a join whose sides both come from tables, after counts that combine first."""
    _, nodes = _nodes(spark, [f"one two three four five six {i}" for i in range(50)])
    entries = nodes.select("nid", "n", F.posexplode("prefix").alias("at", "token"))
    plan = entries.groupBy("token").agg(F.count("*"), F.min("nid"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    plan = ngram_jaccard.inverted(nodes, 2, 85)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_empty_table(spark, parquet):
    assert result(spark, parquet("documents", [], SCHEMA)) == []
    assert result(spark, parquet("documents", [(1, None, *[None] * 6), (1, "", *[None] * 6)], SCHEMA)) == [(1, 0, 1), (1, 0, 1)]


def test_rows_that_do_not_come_from_files(spark):
    docs = spark.createDataFrame([(9, "a b c d e f"), (4, "A  b c d e f"), (1, "z")], "id bigint, body string")
    assert sorted(map(tuple, ngram_jaccard.jaccard_components(docs, "id", "body").collect())) == [(1, 1, 1), (4, 3, 4), (9, 3, 4)]


def test_very_long_text():
    text = " ".join(f"w{i % 90_001}" for i in range(400_000)).encode()
    own = ngram_jaccard.elements(text, 4)
    assert len(own) == 90_001
    n, _, maps, prefix, whole, _ = ngram_jaccard.mark(own, np.ones(ngram_jaccard.BUCKETS, np.int64), 1.0, 85)
    assert n == 90_001 and len(maps) == ngram_jaccard.MAPS and whole is None and len(prefix) == n - ngram_jaccard.need(n, -(-85 * n // 100)) + 1
