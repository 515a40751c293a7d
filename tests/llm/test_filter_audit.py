"""Operator 12 against a plain version that applies the filters to lists of documents, order by order."""

from __future__ import annotations

import itertools
import random
import re

import duckdb
from pyspark.sql import functions as F

from carelake.llm import filter_audit
from carelake.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, source string, part int, mask string, digest int, doc string, n int"
LABELS = "doc_id bigint, quality int, toxic int, part string, good int"
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain_fails(doc, docs):
    text = doc[1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {x for x, failed in zip("ABCDE", (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search("[#$%&*|]", text)),
        doc[0] is not None and any(d[0] is not None and d[0] < doc[0] and (d[1] or "") == text for d in docs)), strict=True) if failed}


def plain(docs, labels):
    fails = [plain_fails(d, docs) for d in docs]
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    out = []
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], f) for d, f in zip(docs, fails, strict=True) if (d[2] or "") == part]
        rows, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone, before = [d for d in left if letter in d[1]], left
                left = [d for d in left if letter not in d[1]]
                total[letter] += len(gone)
                rows.append(["".join(order), step, letter, len(left), len(gone), sum(letter in f for _, f in own) - len(gone),
                             sum(f == {letter} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
                assert len(before) == len(left) + len(gone)
        out += [(part, r[0], r[1], *r[3:], total[r[2]]) for r in rows]
    return sorted(out)


def crowd(seed, n):
    """Texts that fail every set of filters, copies within and across parts, repeated rows, null and tied ids."""
    chance, docs = random.Random(seed), []
    for i in range(n):
        words = [f"w{k}" for k in range(chance.choice([3, 199, 200, 260]))]
        words = [w if chance.random() < 0.6 else "same" for w in words] if chance.random() < 0.5 else words
        text = chance.choice([" ", "\n", "\x0b "]).join(words) + chance.choice(["", "", " ABCDEF" * chance.choice([1, 60]), " #", "é\x1c"])
        if docs and chance.random() < 0.4:
            text = chance.choice(docs)[1]
        docs.append((chance.choice([i, i, i, i - 1, None]), chance.choice([text] * 20 + [None, ""]), chance.choice(["a", "a", "a", "b", "", None])))
        if chance.random() < 0.05:
            docs.append(docs[-1])
    labels = [(chance.choice([i, None]), chance.choice([0, 1, None]), chance.choice([0, 1])) for i in range(0, n, 2) for _ in range(chance.choice([1, 1, 2]))]
    return docs, labels


def tables(parquet, docs, labels):
    parquet("labels", [(*x, "p", 7) for x in labels], LABELS)
    return parquet("documents", [(*d, 1, "m", 2, "d", 3) for d in docs], DOCS)


def result(spark, folder):
    found = QUERIES["op12_filter_audit"](spark, folder)
    assert found.columns == list(COLUMNS) and [t for _, t in found.dtypes] == ["string", "string", "int"] + ["bigint"] * 7
    return sorted(map(tuple, found.collect()))


def test_equals_the_plain_version(spark, parquet):
    for seed in (1, 2):
        docs, labels = crowd(seed, 120)
        folder = tables(parquet, docs, labels)
        wanted = plain(docs, labels)
        assert result(spark, folder) == wanted and len({frozenset(plain_fails(d, docs)) for d in docs}) > 12
        own = duckdb.connect()
        for t in ("documents", "labels"):
            own.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
        sql = own.sql(filter_audit.SQL)
        assert sorted(tuple(r) for r in sql.project(", ".join(COLUMNS)).fetchall()) == wanted


def test_empty_tables(spark, parquet):
    assert result(spark, tables(parquet, [], [])) == []
    docs = [(1, None, None), (2, "", "x")]
    assert result(spark, tables(parquet, docs, [])) == plain(docs, [])


def test_very_long_texts():
    """Words are cut piece by piece; no piece ends inside of a word."""
    chance = random.Random(3)
    for word in (5, 3_000_000):
        text = " ".join("é" * chance.randint(1, word) + str(i % 1000) for i in range(2_500_000 // word + 3))
        fails = plain_fails((1, text), [])
        assert filter_audit.text_bits(text.encode()) == sum(1 << "ABCDE".index(x) for x in fails)


def test_more_parts_than_a_recursion_may_have_rows(spark):
    """Spark stops a recursion at a million rows by default; the levels hold 326 per part."""
    before, n = spark.conf.get(filter_audit.ROWS), 3500
    cells = spark.range(n).select(F.col("id").cast("string").alias("part"), F.expr(
        "array(named_struct('mask', cast(id % 32 as int), 'n', 2L, 'good', 1L, 'toxic', 0L))").alias("cells"))
    found = filter_audit.orders(cells)
    assert found.count() == 600 * n and spark.conf.get(filter_audit.ROWS) == before
    r = found.filter("part = '3' and filter_order = 'BACDE'").orderBy("step").collect()  # fails A and B
    assert [tuple(x)[3:] for x in r[:3]] == [(0, 2, 0, 0, 1, 0, 120), (0, 0, 2, 0, 0, 0, 120), (0, 0, 0, 0, 0, 0, 0)]


def test_other_letters(spark):
    cells = spark.createDataFrame([("p", [(0, 1, 0, 0), (3, 5, 1, 1)])], "part string, cells array<struct<mask: int, n: bigint, good: bigint, toxic: bigint>>")
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filter_audit.orders(cells, "XY").collect()}
    assert found == {("XY", 1): (1, 5, 0, 5), ("XY", 2): (1, 0, 5, 5), ("YX", 1): (1, 5, 0, 5), ("YX", 2): (1, 0, 5, 5)}


def test_copies_are_counted_before_they_are_shuffled(spark):
    """A text or part that most rows share leaves each map task once, and the rows to be marked can be split by AQE."""
    docs = spark.range(2000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same', cast(id as string)) as text", "'s' as source")
    rows = filter_audit.masked(docs, "doc_id", "text", "source")
    cells = filter_audit.mask_cells(rows, spark.createDataFrame([], LABELS))
    assert sum(c.n for c in cells.first().cells if c.mask & filter_audit.DUPLICATE) == 666
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1 and plan.count("partial_count") == 1 and "Window" not in plan
