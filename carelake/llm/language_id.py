"""Operator 2: language of pages by Bayesian fusion of four kinds of evidence.

1. The text: byte trigrams under one model per language, counted over all labelled documents.
2. The language that the markup declares: how often pages of a language declare it.
3. The address suffix and 4. the host: priors smoothed down the hierarchy all pages > suffix > domain > host.

2 to 4 are learned from all pages by grouped aggregation of the posteriors that the text alone gives. A page's own
share is taken out of every sum it meets, so it never speaks for itself twice; a level's own pages are taken out of the
level above, so a host's pages speak once. Summed posteriors are whole millionths, so sums don't depend on the order of
rows; a page's own text counts with its unrounded log posterior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import table, text_of, written
from carelake.operators.lookup import lookup

BUCKETS = 1 << 14
#: Trigrams of one text depend on each other: n of them count as n * ENOUGH / (n + ENOUGH).
ENOUGH = 60.0
#: Weight of a parent's prior, in pages; of the overall share of a declared language, in pages.
KAPPA, BETA = 4.0, 2.0
ONE = 1_000_000

# What of a page is no text; the primary subtag of a language tag.
NO_TEXT = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w{1,10};"
DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b"
PRIMARY = r"^\s*([a-zA-Z]{2,3})(?:[-_][a-zA-Z0-9_-]*)?\s*$"
HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def buckets(text: str) -> np.ndarray:
    """Bucket numbers of the byte trigrams of the lower-cased text with single spaces."""
    data = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.uint32)
    key = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return (key * np.uint32(2654435761)) >> np.uint32(32 - 14)


def primary(lang: Column) -> Column:
    """The primary language subtag of a tag, in lower case. What has not the form of a tag is no label: null."""
    return F.nullif(F.lower(F.regexp_extract(lang, PRIMARY, 1)), F.lit(""))


def counts(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, bucket, n) over all labelled texts. A task sends one row per language and bucket at most."""
    texts = labelled.select(primary(F.col(lang_col)).alias("lang"), text_of(text_col).alias("text")).filter("lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                own = sums.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                own += np.bincount(buckets(text.as_py()), minlength=BUCKETS)
        for lang, own in sums.items():
            used = np.nonzero(own)[0]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(own[used], pa.int64())],
                ["lang", "bucket", "n"])

    return texts.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities of the buckets: `BUCKETS` numbers for each language."""

    def __init__(self, sums: dict[str, np.ndarray]):
        """`sums` holds the counts of all buckets by language."""
        self.langs = sorted(sums)
        n = np.full((BUCKETS, max(1, len(sums))), 0.5)
        for place, lang in enumerate(self.langs):
            n[:, place] += sums[lang]
        self.log = np.log(n / n.sum(0))

    def log_posterior(self, text: str) -> np.ndarray:
        """Of the text alone, languages being equally likely before; unrounded."""
        n = np.bincount(buckets(text), minlength=BUCKETS)  # memory of a text doesn't grow with the languages
        score = (n @ self.log) * (ENOUGH / (n.sum() + ENOUGH))
        score -= score.max()
        return score - np.log(np.exp(score).sum())

    def posterior(self, text: str) -> np.ndarray:
        """The same in millionths."""
        return millionths(self.log_posterior(text))


def millionths(log: np.ndarray) -> np.ndarray:
    return np.rint(ONE * np.exp(log)).astype(np.int64)


def fit(labelled: DataFrame, text_col: str, lang_col: str) -> Model:
    """The model of the labelled texts, by the primary subtags of their languages.

    Rows whose label is null or has not the form of a language tag count as unlabelled. One row per language comes to
    the driver, with two arrays of at most `BUCKETS` numbers.
    """
    each = counts(labelled, text_col, lang_col).groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    sums = {}
    for r in each.toLocalIterator():
        sums[r.lang] = np.zeros(BUCKETS, np.int64)
        sums[r.lang][np.array(r.b)] = np.array(r.n)
    return Model(sums)


def by_text(pages: DataFrame, model: Model, text_col: str) -> DataFrame:
    """The rows with `q`, the posterior of the text alone, and `log_q`, its unrounded logarithm, instead of the text."""
    rest = [c for c in pages.columns if c != text_col]
    schema = pages.select(*rest, F.array(F.lit(0).cast("bigint")).alias("q"), F.array(F.lit(0.0)).alias("log_q")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [model.log_posterior(t.as_py()) for t in batch.column(text_col)]
            q, log = pa.array(map(millionths, logs), pa.list_(pa.int64())), pa.array(logs, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), q, log], [*rest, "q", "log_q"])

    return pages.mapInArrow(run, schema)


def evidence(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, text, declared, and the levels of the address: suffix, domain, host. What is missing is the empty text."""
    html, url = text_of(html_col), text_of(url_col)
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return pages.select(
        F.col(id_col).alias("id"), F.regexp_replace(html, NO_TEXT, " ").alias("text"),
        F.lower(F.regexp_extract(html, DECLARED, 1)).alias("declared"),
        F.substring_index(host, ".", -1).alias("suffix"), F.substring_index(host, ".", -2).alias("domain"), host.alias("host"))


def _sums(rows: DataFrame, key: str, langs: int) -> DataFrame:
    return rows.groupBy(key).agg(
        F.array(*(F.sum(F.col("q")[k]) for k in range(langs))).alias(f"sum_{key}"), F.count("*").alias(f"n_{key}"))


def _without(sums: Column, own: Column) -> Column:
    return F.zip_with(sums, own, lambda s, q: (s - q) / ONE)


def fused(rows: DataFrame, langs: list[str]) -> DataFrame:
    """id, declared, text_lang, lang and posterior of rows with q, log_q, declared, suffix, domain and host."""
    n = len(langs)
    # one row of as many numbers as there are languages
    *sums, n_all = rows.agg(*(F.coalesce(F.sum(F.col("q")[k]), F.lit(0)) for k in range(n)), F.count("*")).first()
    sum_all, joined = F.array(*(F.lit(x).cast("bigint") for x in sums)), rows
    for key in ("suffix", "domain", "host", "declared"):
        joined = lookup(joined, _sums(rows, key, n), key, "left")
    joined = joined.withColumn("share", F.col("n_declared") / n_all)
    # each level without the pages of the level below, and the host without the page itself
    base = F.transform(_without(sum_all, F.col("sum_suffix")), lambda s: (s + 1) / (n_all - F.col("n_suffix") + n))
    below = {"suffix": ("sum_domain", F.col("n_domain")), "domain": ("sum_host", F.col("n_host")), "host": ("q", F.lit(1))}
    for key, (own, n_own) in below.items():
        name, others = f"prior_{key}", F.col(f"n_{key}") - n_own
        joined = joined.withColumn(name, F.zip_with(
            _without(F.col(f"sum_{key}"), F.col(own)), base, lambda s, p: (s + KAPPA * p) / (others + KAPPA)))  # noqa: B023
        base = F.col(name)
    given = F.zip_with(
        _without(F.col("sum_declared"), F.col("q")), _without(sum_all, F.col("q")),
        lambda s, a: (s + BETA * F.col("share")) / (a + BETA))
    log = F.zip_with(F.zip_with("log_q", base, lambda q, p: q + F.log(p)), given, lambda x, g: x + F.log(g))
    joined = joined.withColumn("log", log).withColumn("top", F.array_max("log"))
    joined = joined.withColumn("mass", F.aggregate("log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    names = F.array(*map(F.lit, langs))

    def first(values: str) -> Column:  # of languages equally likely, the first by name
        return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))

    return joined.select(
        "id", "declared", first("log_q").alias("text_lang"), first("log").alias("lang"), F.round(1 / F.col("mass"), 4).alias("posterior"))


def identify(pages: DataFrame, model: Model, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One row per page: id, declared, text_lang (by the text alone), lang, posterior.

    Null urls and texts count as empty, which is no evidence; repeated rows are one row each; an empty table gives no
    rows. A model without languages is an error.
    """
    if not model.langs:
        raise ValueError("no labelled text to learn languages from")
    return fused(written(by_text(evidence(pages, id_col, url_col, html_col), model, "text"), "op2-texts"), model.langs)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit(table(spark, sf_dir, "documents"), "text", "lang")
    return identify(table(spark, sf_dir, "pages"), model, "page_id", "url", "html").withColumnRenamed("id", "page_id")
