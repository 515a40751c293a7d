"""JSON arrays read in parallel: one file in as many byte ranges as Spark cuts it into.

Spark's text reader splits a file at every closing brace, wherever its byte ranges begin, which needs to know nothing of
JSON. Whether such a brace ends a record depends on all text before it: on being inside of a string, and on the depth. So

1. every piece tells how it changes both, once for a beginning inside of a string and once for one outside;
2. the changes of a range's pieces add up to those of the range, and those of the ranges before give the true state at
   its beginning; a file has as many ranges as it has blocks;
3. pieces up to a brace that closes a record are put together, also across ranges.

Nothing is taken on trust: the texts between records must be exactly the array's brackets and commas, and every record
must parse, so a file that is accepted is one sound array, whatever it was cut into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, size, block, place, text, turns, out, in): the texts between closing braces, in the order of `block` and `place`.

    `turns` is 1 where the piece ends in the other state than it began, inside of a string or outside; `out` and `in`
    are its changes of depth for either beginning, the brace behind it included where it counts.
    """
    cut = spark.read.option("lineSep", "}").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"))
    bare = F.regexp_replace("text", r"(?s)\\.", "")  # an escape cannot reach over a brace
    turns = (_count(bare, '"') % 2).alias("turns")

    def depth(begun: Column, closes: Column) -> Column:
        outside = F.regexp_replace(begun, '"[^"]*("|$)', "")
        return _count(outside, "{[") - _count(outside, "]") - F.when(closes, 1).otherwise(0)

    marked = cut.select("*", turns, bare.alias("bare"))
    return marked.select(
        "path", "size", "block", "place", "text", "turns",
        depth(F.col("bare"), F.col("turns") == 0).alias("out"),
        depth(F.concat(F.lit('"'), "bare"), F.col("turns") == 1).alias("in"))


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, first, last, text): the texts of the files' records with what stands before each, and what stands behind the last.

    `first` marks the text at the beginning of its file, `last` the one behind the last record. Both windows over pieces
    hold one byte range, those over ranges one row per range of a file.
    """
    own = Window.partitionBy("path", "block").orderBy("place")
    before, until = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("path").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    found = pieces(spark, paths)
    # inside or outside, if the range begins outside; the depth so far for either beginning of the range
    local = found.withColumn("turned", _zero(F.bit_xor("turns").over(before)))
    real = {"out": F.when(F.col("turned") == 0, F.col("out")).otherwise(F.col("in")), "in": F.when(F.col("turned") == 0, F.col("in")).otherwise(F.col("out"))}
    local = local.select("path", "size", "block", "place", "text", "turns", "turned", real["out"].alias("out"), real["in"].alias("in"))
    ranges = local.groupBy("path", "block").agg(
        F.bit_xor("turns").alias("turns"), F.sum("out").alias("out"), F.sum("in").alias("in"), F.max("place").alias("end"),
        F.max("size").alias("size"),
        F.sum(F.octet_length("text") + 1).alias("bytes"))
    begun = ranges.withColumn("inside", _zero(F.bit_xor("turns").over(earlier)))
    change = F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("in"))
    begun = begun.select(
        F.col("path").alias("_path"), F.col("block").alias("_block"), "inside", _zero(F.sum(change).over(earlier)).alias("depth"),
        F.when(F.lead("block").over(order).isNull(), F.col("end")).alias("final"),
        # pieces with a brace each make up one byte more than a file that does not end in a brace
        (F.sum("bytes").over(Window.partitionBy("path")) > F.col("size")).alias("open_end"))
    placed = local.join(begun, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))).drop("_path", "_block")
    change = F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("in"))
    after = F.col("depth") + F.sum(change).over(until)
    outside = F.col("inside").bitwiseXOR(F.col("turned")).bitwiseXOR(F.col("turns")) == 0
    last = F.coalesce(F.col("place") == F.col("final"), F.lit(False))
    closed = placed.select(
        "path", "block", "place", "text", last.alias("last"), "open_end", (~last & outside & (after == 1)).cast("int").alias("closes"))
    numbered = closed.withColumn("number", _zero(F.sum("closes").over(before)))

    # what stands before the first end of a range goes on with what the ranges before left open
    counts = closed.groupBy("path", "block").agg(F.sum("closes").alias("n"))
    ended = F.struct("block", F.col("n").alias("number"))
    counts = counts.select(
        F.col("path").alias("_path"), F.col("block").alias("_block"),
        F.last(F.when(F.col("n") > 0, ended), ignorenulls=True).over(earlier).alias("open"))
    joined = numbered.join(counts, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))).drop("_path", "_block")
    start = F.struct(F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("number"))
    key = F.when(F.col("number") > 0, F.struct(F.col("block"), F.col("number").cast("bigint").alias("number"))).otherwise(
        F.coalesce("open", start))
    groups = joined.groupBy("path", key.alias("record")).agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts"), F.max("last").alias("last"),
        F.max("open_end").alias("open_end"))
    text = F.array_join(F.transform("parts", lambda p: p.text), "}")
    return groups.select(
        "path", (F.col("record.block") == -1).alias("first"), "last",
        F.when(F.col("last") & F.col("open_end"), text).otherwise(F.concat(text, F.lit("}"))).alias("text"))


def sound(parts: DataFrame) -> DataFrame:
    """(path, record, damaged): every record of `records` alone, or null behind the last; damaged where what stands
    between is not the array's bracket or comma."""
    first, last = F.col("first"), F.col("last")
    begun = {True: r"(?s)^\s*\[\s*(\{.*)$", False: r"(?s)^\s*,\s*(\{.*)$"}
    alone = F.when(first, F.regexp_extract("text", begun[True], 1)).otherwise(F.regexp_extract("text", begun[False], 1))
    record = F.when(~last, F.nullif(alone, F.lit("")))
    closed = F.when(first, F.col("text").rlike(r"^\s*\[\s*\]\s*$")).otherwise(F.col("text").rlike(r"^\s*\]\s*$"))
    return parts.select("path", record.alias("record"), F.when(last, ~closed).otherwise(record.isNull()).alias("damaged"))
