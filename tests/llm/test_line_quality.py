"""Operator 5 against a plain Python version."""

from __future__ import annotations

import random
import re

import duckdb
from pyspark.sql import functions as F

from carelake.llm import line_quality
from carelake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def texts():
    chance = random.Random(4)
    out = [None, "", " \t\n", "one", "a b c d e", "a b c d e f a b c d e", "a a a a a a a", "x " * 3000, "é ü\x1cß 😀 |", "a\n\na\n b\nb\r\n"]
    for _ in range(150):
        pool = ["a", "b", "c\n", "d.", "é", "#", "\n", "| ", "\t"][: chance.randint(2, 9)]
        out.append(" ".join(chance.choice(pool) for _ in range(chance.randint(0, 80))))
    return out


def test_base_figures(spark, parquet):
    given = texts()
    folder = parquet("documents", [(i, t, 1, True) for i, t in enumerate(given)], "doc_id bigint, text string, n_words int, kept boolean")
    got = {r.doc_id: r for r in QUERIES["op5_line_quality"](spark, folder).collect()}
    for i, t in enumerate(given):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(t), repr(t)
        assert not (r.kept and r.base_failed)


GOOD = ["The committee met on Tuesday and agreed on the plan.", "Nobody had expected such a clear result so early.",
        "A longer report will follow in the spring, with figures."]


def test_line_rules(spark):
    bad = ["Home | News | Sports | Contact", "All rights reserved.", "*** --- ***", "Wow!! Great!! Buy!! Now!!", "We use cookies to improve."]
    fine = [*GOOD, "", "   ", "no end mark here", "3 < 4 and a | b", "Really?! Yes.", "12 34"]
    rows = spark.createDataFrame([(x,) for x in bad + fine], "line string")
    got = {r.line: r.fails for r in rows.select("line", line_quality.line_fails(rows.line).alias("fails")).collect()}
    assert all(got[x] for x in bad) and not any(got[x] for x in fine)


def test_a_phrase_does_not_fail_a_long_line(spark):
    article = f"{' '.join(GOOD)} The ministry published its privacy policy on the same day, and nobody took offence."
    docs = spark.createDataFrame([(1, article, 0), (2, f"{article}\nAll rights reserved.", 0)], "doc_id bigint, text string, n_chars bigint")
    assert [r.text for r in line_quality.stage(spark, docs, "").collect()] == [article] * 2
    several = "Click here to read our privacy policy and terms of use before you order."
    rows = spark.createDataFrame([(several,)], "line string")
    assert rows.select(line_quality.line_fails(rows.line)).first()[0]


def test_sql_states_the_rules_on_lines_with_phrases(spark, parquet):
    """A phrase in every share of a line's words around the quarter, alone, twice and in several lines."""
    phrases = ["privacy policy", "Click here to", "LOREM IPSUM", "terms of use and terms of service", "lorem ipsum lorem ipsum"]
    texts = [f"{' '.join(f'w{k}' for k in range(n))} {p} end\n{GOOD[0]}" for p in phrases for n in range(26)]
    texts += [f"{p}\n{'| a ' * n}\n{'word!! ' * n}x" for p in phrases for n in range(6)]
    folder = parquet("documents", [(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    own = duckdb.connect()
    own.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    wanted = own.sql(line_quality.SQL)
    got = QUERIES["op5_line_quality"](spark, folder).select(*wanted.columns).collect()
    assert sorted(map(tuple, got)) == sorted(wanted.fetchall())
    assert 0 < sum(r.kept for r in got) < len(got)


def test_very_long_texts(spark):
    """Lengths whose hundredfold needs more than 32 bits."""
    words, long = F.lit("a b c d e f g h i j k l m n "), F.repeat(F.lit("x"), F.col("id").cast("int"))
    two = F.concat(words, F.repeat(F.lit("x"), (F.col("id") - 21_000_000).cast("int")), F.lit("\n"), F.repeat(F.lit("#"), F.lit(22_000_000)))
    for text, wanted in ((F.concat(words, long), (15, 44_000_014, 0, True)), (two, (16, 45_000_014, 22_000_000, True))):
        r = line_quality.op5(spark, spark.range(44_000_000, 44_000_001).select(F.col("id").alias("doc_id"), text.alias("text"))).first()
        assert (r.n_words, r.word_chars, r.n_symbols, r.kept) == wanted


def test_stage(spark):
    keep, drop = "\n".join([*GOOD, "All rights reserved."]), "\n".join(["Home | News | Sports | Contact | About us"] * 1 + [f"A | b | c | d | e{i}" for i in range(9)])
    docs = spark.createDataFrame(
        [(1, keep, 0, 1, "q"), (2, drop, 0, 1, "q"), (3, None, 0, 1, None), (1, keep, 0, 1, "q"), (None, keep, 0, 1, "q")],
        "doc_id bigint, text string, n_chars bigint, kept int, _quality string")
    out = line_quality.stage(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert all(r.text == "\n".join(GOOD) and r.n_chars == len(r.text) and r._quality == "q" for r in rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark, parquet):
    assert QUERIES["op5_line_quality"](spark, parquet("documents", [], "doc_id bigint, text string")).collect() == []
