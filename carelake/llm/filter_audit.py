"""Operator 12: how filters interact, audited over every order of applying them.

One pass over the texts gives each document the bits of the filters that it fails. Documents are counted by part and
bits, so what is left of any corpus are at most 2^filters mask cells per part. A recursive CTE then extends prefixes of
filters by each letter not used yet, joins the part's mask cells, carries the applied bits along, and every level emits
the figures of its step.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import table, text_of, written
from carelake.operators.lookup import lookup

MIN_WORDS = 200
MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 50, 2
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

# The letters of the filters, their bits in this order; byte classes.
LETTERS = "ABCDE"
DUPLICATE = 1 << LETTERS.index("E")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
SYMBOL = re.compile(rb"[#$%&*|]")
UPPER, CONTINUED = bytes(range(65, 91)), bytes(range(128, 192))

ROWS = "spark.sql.cteRecursionRowLimit"


# ---- bits of the documents -----------------------------------------------------------------------


def text_bits(text: bytes) -> int:
    """Bits of the filters A to D that the UTF-8 text fails. Words are cut piece by piece and only distinct ones are held."""
    n_words, words, at = 0, set(), 0
    while at < len(text):
        cut = SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        piece = text[at:end].split()  # cuts bytes at the six ASCII white-space characters
        n_words += len(piece)
        words.update(piece)
        at = end
    n_chars, n_upper = len(text.translate(None, CONTINUED)), len(text) - len(text.translate(None, UPPER))
    failed = (n_words < MIN_WORDS, 100 * len(words) < MIN_DISTINCT_PERCENT * n_words,
              100 * n_upper > MAX_UPPER_PERCENT * n_chars, SYMBOL.search(text) is not None)
    return sum(1 << i for i, x in enumerate(failed) if x)


def masked(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc, part, mask) of every row. Null texts and parts are empty; a row without id is never a duplicate nor has any.

    Filter E compares the ids of equal texts, so rows that repeat an id with its text don't make each other fail.
    """
    given = docs.select(F.col(id_col).cast("bigint").alias("doc"), text_of(part_col).alias("part"), text_of(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), batch.column("part"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array(map(text_bits, texts), pa.int32())], ["doc", "part", "digest", "mask"])

    facts = written(given.mapInArrow(run, "doc bigint, part string, digest binary, mask int"), "op12-facts")
    lows = facts.filter("doc is not null").groupBy("digest").agg(F.min("doc").alias("low"))
    later = F.coalesce(F.col("doc") > F.col("low"), F.lit(False))
    return lookup(facts, lows, "digest", "left").select(
        "doc", "part", F.when(later, F.col("mask").bitwiseOR(DUPLICATE)).otherwise(F.col("mask")).alias("mask"))


def mask_cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): per part the counts of its masks, at most 2^filters structs (mask, n, good, toxic).

    labels: doc_id, quality, toxic. A document is good (toxic) if any of its labels says 1; unlabelled ones are neither.
    """
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    known = lookup(rows.withColumn("id", F.col("doc").cast("string")), said, "id", "left")
    counts = known.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("toxic"))
    return counts.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("mask", "n", "good", "toxic"))).alias("cells"))


# ---- the orders ----------------------------------------------------------------------------------

WALK = """
with recursive walk (part, prefix, applied, steps) as (
  select part, '', 0, cast(array() as array<struct<
    step: int, letter: string, kept: bigint, removed: bigint, redundant: bigint, unique_fails: bigint, good_lost: bigint, toxic_lost: bigint>>)
  from {cells}
  union all
  select w.part, w.prefix || w.l.letter, w.applied | w.l.bit, array_append(w.steps, named_struct(
    'step', length(w.prefix) + 1, 'letter', w.l.letter,
    'kept', aggregate(filter(c.cells, x -> x.mask & (w.applied | w.l.bit) = 0), 0L, (a, x) -> a + x.n),
    'removed', aggregate(filter(c.cells, x -> x.mask & w.applied = 0 and x.mask & w.l.bit <> 0), 0L, (a, x) -> a + x.n),
    'redundant', aggregate(filter(c.cells, x -> x.mask & w.applied <> 0 and x.mask & w.l.bit <> 0), 0L, (a, x) -> a + x.n),
    'unique_fails', aggregate(filter(c.cells, x -> x.mask = w.l.bit), 0L, (a, x) -> a + x.n),
    'good_lost', aggregate(filter(c.cells, x -> x.mask & w.applied = 0 and x.mask & w.l.bit <> 0), 0L, (a, x) -> a + x.good),
    'toxic_lost', aggregate(filter(c.cells, x -> x.mask & w.applied = 0 and x.mask & w.l.bit <> 0), 0L, (a, x) -> a + x.toxic)))
  from (select *, explode(filter({letters}, f -> applied & f.bit = 0)) as l from walk) w join {cells} c on c.part = w.part
)
select part, prefix as filter_order, steps from walk where length(prefix) = {size}"""


def orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all letters and step, with the step's figures; zeros are rows like others.

    The levels hold a row per part and prefix, so Spark's limit on the rows of a recursion is lifted while they are
    computed. Without parts there are no rows.
    """
    spark = cells.sparkSession
    bits = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, "-1")
    try:
        walk = WALK.replace("{letters}", f"array({bits})").replace("{size}", str(len(letters)))
        done = written(spark.sql(walk, cells=written(cells, "op12-cells")), "op12-orders")
    finally:
        spark.conf.set(ROWS, before)
    rows = done.select("part", "filter_order", F.explode("steps").alias("s")).select("part", "filter_order", "s.*")
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = masked(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return orders(mask_cells(docs, table(spark, sf_dir, "labels")))


SQL = r"""
with recursive letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as l(letter, bit)),
base as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
masked as (
  select doc_id, part, case when len(w) < 200 then 1 else 0 end + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
    + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as mask from base),
said as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as bad from labels group by doc_id),
cells as (
  select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(bad), 0) as toxic
  from masked left join said using (doc_id) group by part, mask),
walk as (
  select '' as prefix, '' as letter, 0 as before, 0 as bit
  union all select prefix || l.letter, l.letter, before | walk.bit, l.bit from walk join letters l on (before | walk.bit) & l.bit = 0),
figures as (
  select part, prefix, letter, coalesce(sum(n) filter (mask & (before | bit) = 0), 0) as kept,
    coalesce(sum(n) filter (mask & before = 0 and mask & bit <> 0), 0) as removed,
    coalesce(sum(n) filter (mask & before <> 0 and mask & bit <> 0), 0) as redundant,
    coalesce(sum(n) filter (mask = bit), 0) as unique_fails,
    coalesce(sum(good) filter (mask & before = 0 and mask & bit <> 0), 0) as good_lost,
    coalesce(sum(toxic) filter (mask & before = 0 and mask & bit <> 0), 0) as toxic_lost
  from walk, cells where prefix <> '' group by part, prefix, letter),
steps as (
  select f.part, o.prefix as filter_order, length(f.prefix) as step, f.* exclude (part, prefix)
  from walk o join figures f on starts_with(o.prefix, f.prefix) where length(o.prefix) = 5)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from steps
"""
