"""Operator 11: prefix trie of conversations by whole-sequence collapse.

Every turn becomes a digest of its role and text and a number of words; texts are read once and never shuffled. The
digests of a conversation are chained, so that one digest stands for a whole prefix, which is a node of the trie. Then

1. identical conversations collapse: their last nodes are equal, so one weighted sequence with a list of the
   conversations that end there stands for all of them, and only its first conversation's path is kept;
2. a sequence whose last node no longer sequence passes through is a leaf: an anti join takes the proper prefixes out;
3. nodes are aggregated from the weighted paths. What a subtree holds is added up along the paths of its leaves: each
   node belongs to the smallest leaf below it, so no node is counted twice and no pair of nodes is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import table, text_of, written

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations of one block share the first turns of the block's first conversation, up to so many.
BLOCK, SHARED = 20, 4
#: A list of ends is kept in pieces of so many neighbouring ids at most.
PIECE_BITS = 12
ROOT = hashlib.sha256(b"").digest()


# ---- turns ---------------------------------------------------------------------------------------


def turns(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, turn, words): the digest of role and text and the words of the text, by place from 1.

    Turns are ordered by their number, null first; of equal numbers by the digest, so that ties and repeated rows, which
    are turns of their own, have a fixed order. Null roles and texts are empty. Messages without conversation id belong
    to no conversation and are left out.
    """
    role, text = text_of(role_col), text_of(text_col)
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = messages.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("number"),
        F.unhex(F.sha2(told, 256)).alias("turn"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    order = Window.partitionBy("conv").orderBy(F.col("number").asc_nulls_first(), "turn")
    return slim.select("conv", F.row_number().over(order).alias("pos"), "turn", "words")


def shared(conv: Column) -> Column:
    """How many first turns a conversation takes over."""
    return (F.crc32(conv.cast("string").cast("binary")) % SHARED).cast("int")


def rebuilt(own: DataFrame) -> DataFrame:
    """The turns with each conversation's first ones replaced by those of its block's first conversation, if there is one."""
    # at most `SHARED` - 1 rows of every first conversation, and a block has a fixed number of members
    heads = own.filter((F.col("pos") < SHARED) & (F.col("conv") % BLOCK == 0)).select(
        F.col("conv").alias("base"), F.col("pos").alias("at"), "turn", "words")
    convs = own.filter("pos = 1").select("conv", (F.col("conv") - F.col("conv") % BLOCK).alias("base"))
    taken = convs.join(heads, "base").filter(F.col("at") <= shared(F.col("conv")))
    return taken.select("conv", F.col("at").alias("pos"), "turn", "words").unionByName(
        own.filter(F.col("pos") > shared(F.col("conv"))))


# ---- paths ---------------------------------------------------------------------------------------

PATH = "conv bigint, depth int, node binary, parent binary, words bigint, last boolean"


def paths(given: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and prefix, the root included. given: turns; convs: every `conv`, also without turns.

    The turns of a conversation pass one task in their order, a few dozen bytes each, and nothing is held but the
    present node, however long the conversation is.
    """
    starts = convs.select("conv", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("bigint").alias("words"))
    rows = starts.unionByName(given.select("conv", "pos", "turn", "words"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits to know whether it is its conversation's last
        for batch in batches:
            out: list[tuple] = []
            for conv, turn, words in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "words")), strict=True):
                if held is None or held[0] != conv:
                    out += [(*held, True)] if held else []
                    held = (conv, 0, ROOT, None, 0)
                else:
                    out.append((*held, False))
                    held = (conv, held[1] + 1, hashlib.sha256(held[2] + turn).digest(), held[2], words)
            yield _batch(out)
        if held:
            yield _batch([(*held, True)])

    return rows.mapInArrow(run, PATH)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    columns = zip(*rows, strict=True) if rows else ((),) * len(kinds)
    names = [c.split()[0] for c in PATH.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def ends(walked: DataFrame) -> DataFrame:
    """(node, ids): the ends of every sequence as text pieces `ids`, ascending by `piece`; each holds a bounded number of ids."""
    last = walked.filter("last").select("node", "conv", F.shiftright("conv", PIECE_BITS).alias("piece"))
    return last.groupBy("node", "piece").agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))


def ends_digest(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256) of all ids of a sequence, joined by commas. Pieces stream through the hash, none is held."""
    rows = pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        for batch in batches:
            done: list[tuple] = []
            for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != node:
                    done += [(node, digest.hexdigest())] if node is not None else []
                    node, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    return rows.mapInArrow(run, "node binary, ends_sha256 string")


# ---- the trie ------------------------------------------------------------------------------------


def trie(given: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, pieces of the lists of ends) of the conversations. given: `turns` or `rebuilt` ones; convs: every `conv`.

    nodes: node, parent (null: root), conv_id (smallest member), depth, n_convs, n_children, n_leaves, parent_conv_id,
    saved_tokens (over the subtree, words of each node's last text times its members but one). An empty table gives no
    node, a conversation without turns is a member of the root alone.
    """
    walked = written(paths(given, convs), "op11-paths")
    # identical conversations end in the same node: one sequence, its weight and its smallest member
    sequences = walked.filter("last").groupBy(F.col("node").alias("end")).agg(F.count("*").alias("weight"), F.min("conv").alias("conv"))
    passed = walked.filter("not last").select(F.col("node").alias("end")).distinct()
    sequences = written(sequences, "op11-sequences")
    leaves = sequences.join(passed, "end", "left_anti").select(F.col("conv").alias("leaf"))
    collapsed = walked.select("conv", "depth", "node", "parent", "words").join(sequences, "conv")
    collapsed = written(collapsed.join(leaves, F.col("conv") == F.col("leaf"), "left").drop("end"), "op11-collapsed")

    nodes = collapsed.groupBy("node").agg(
        F.any_value("parent").alias("parent"), F.any_value("depth").cast("bigint").alias("depth"),
        F.any_value("words").alias("words"), F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"), F.min("leaf").alias("owner"))
    nodes = written(nodes, "op11-nodes")

    # a node's saving lies on the path of its owner, from where it counts for every node above it on that path
    value = nodes.select(F.col("node").alias("at"), "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    own = F.when(F.col("owner") == F.col("leaf"), F.col("saving")).otherwise(0)
    below = Window.partitionBy("leaf").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    on_leaves = collapsed.filter("leaf is not null").join(value, F.col("node") == F.col("at")).withColumn("own", own)
    saved = on_leaves.withColumn("saved", F.sum("own").over(below)).groupBy(F.col("node").alias("at")).agg(
        F.sum("saved").alias("saved_tokens"))

    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("up")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(saved, F.col("node") == F.col("at")).join(children, F.col("node") == F.col("up"), "left")
    # the last join's other side is read from a table, so that AQE can split the children of one node
    out = written(out.drop("at", "up", "owner", "words").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "op11-summed")
    return out.join(parents, F.col("parent") == F.col("above"), "left").drop("above"), ends(walked)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, rebuilt: every node of their trie with the digest of the conversations that end there."""
    own = written(turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"), "op11-turns")
    nodes, pieces = trie(rebuilt(own), own.filter("pos = 1").select("conv"))
    found = ends_digest(pieces).withColumnRenamed("node", "end")
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(found, F.col("node") == F.col("end"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


#: The rows of `op11`; CRC-32 is written out bit by bit.
SQL = r"""
with own as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first,
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
convs as (
  select distinct c, c - c % 20 as base, xor(list_reduce(
    flatten(list_transform(string_split(cast(c as varchar), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, e: case when e >= 0 then xor(a, e) else xor(a >> 1, 3988292384 * (a & 1)) end, 4294967295), 4294967295) % 4 as h
  from own),
rebuilt as (
  select convs.c, pos, role, text from convs join own on own.c = base and pos <= h
  union all select convs.c, pos, role, text from convs join own on own.c = convs.c and pos > h),
sequences as (
  select convs.c, coalesce(list({'role': role, 'text': text} order by pos) filter (pos is not null), []) as s
  from convs left join rebuilt on rebuilt.c = convs.c group by convs.c),
prefixes as (select c, s, unnest(range(len(s) + 1)) as d from sequences),
nodes as (
  select d, list_slice(s, 1, d) as p, min(c) as conv_id, count(*) as n_convs,
    string_agg(c, ',' order by c) filter (len(s) = d) as ends from prefixes group by d, p),
valued as (
  select *, case when d = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) end as saving,
    not exists (select 1 from nodes as o where o.d = nodes.d + 1 and list_slice(o.p, 1, nodes.d) = nodes.p) as leaf
  from nodes),
above as (select list_slice(p, 1, a) as top, saving, leaf from (select *, unnest(range(d + 1)) as a from valued)),
sums as (select top, sum(saving) as saved_tokens, count(*) filter (leaf) as n_leaves from above group by top),
children as (select list_slice(p, 1, d - 1) as top, count(*) as n from nodes where d > 0 group by top)
select nodes.conv_id, nodes.d as depth, parents.conv_id as parent_conv_id, nodes.n_convs, coalesce(children.n, 0) as n_children,
  n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(coalesce(nodes.ends, '')) as ends_sha256
from nodes join sums on sums.top = nodes.p left join children on children.top = nodes.p
  left join nodes as parents on parents.d = nodes.d - 1 and parents.p = list_slice(nodes.p, 1, nodes.d - 1)
"""
