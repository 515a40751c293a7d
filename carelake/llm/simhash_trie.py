"""Operator 9: near duplicates by SimHash, found with a self-join of the binary trie of all fingerprints.

The distinct 64-bit fingerprints form a binary trie. The join starts at the pair (root, root) and goes down both
nodes of a pair together, adding up the bits in which their prefixes differ; a pair over the error budget is dropped
with all that lies below it. As long as a pair holds many fingerprints it goes down `STEP` bits at a time, as a
DataFrame of node pairs; small pairs are finished by one task each, bit by bit over sorted arrays. No bit pattern is
treated apart, so the result is exact.

A finished pair of nodes returns no pairs of fingerprints but the forest of its components: at most one link per
fingerprint. The links are contracted by rounds of alternating stars over tables on shared storage.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import located, making_room, only, text_of, written
from carelake.operators.lookup import lookup

BITS = 64
STEP = 4
#: A pair of nodes with fewer fingerprints than this is finished by one task.
SMALL = 1 << 15
#: Pairs of fingerprints compared at a time within a task.
BLOCK = 1 << 20


# ---- fingerprints --------------------------------------------------------------------------------


def fingerprint(text: str, shingle: int, seed: int = 42) -> int:
    """SimHash of the word shingles, repeats included; a text without words has fingerprint zero.

    bytes.lower() only touches A-Z and bytes.split() cuts at the six ASCII white-space characters.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[:n].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends[-n:].tolist())])
    ones = np.zeros(BITS, np.int64)
    for block in range(0, len(hashes), 8 << 16):  # 65,536 hashes at a time, as bits 4 MB
        part = np.frombuffer(hashes[block : block + (8 << 16)], np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(texts: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """The rows with `fp` (the 64 bits as a signed number) instead of the text."""
    rest = [c for c in texts.columns if c != text_col]
    schema = texts.select(*rest, F.lit(0).cast("bigint").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(found.view(np.int64))], [*rest, "fp"])

    return texts.mapInArrow(run, schema)


# ---- the join of small subtrees ------------------------------------------------------------------


def linked(a: np.ndarray, b: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with at most `budget` differing bits between the sorted arrays a and b.

    All of a share their first `depth` bits, all of b theirs. The frontier holds node pairs as ranges of the two
    arrays; each round goes down one bit in both, or compares what lies in a pair if that is little.
    """
    out: list[tuple[np.ndarray, np.ndarray]] = []
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.array([[0, len(a), 0, len(b), 0]], np.int64)
    if depth:
        pairs[0, 4] = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(BITS - depth)))
    pairs = pairs[pairs[:, 4] <= budget]
    while len(pairs):
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        small = (sizes <= 32) | (depth == BITS)
        _compare(a, b, pairs[small], sizes[small], budget, out)
        pairs = pairs[~small]
        if not len(pairs):
            break
        bit = np.uint64(BITS - 1 - depth)
        cut_a, cut_b = _cut(a, pairs[:, 0], pairs[:, 1], bit), _cut(b, pairs[:, 2], pairs[:, 3], bit)
        below = []
        for one in (0, 1):
            for two in (0, 1):
                child = pairs.copy()
                child[:, 1 - one] = cut_a
                child[:, 3 - two] = cut_b
                child[:, 4] += one ^ two
                below.append(child[(child[:, 4] <= budget) & (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3])])
        pairs = np.concatenate(below)
        depth += 1
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _cut(values: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.uint64) -> np.ndarray:
    """In each range, which shares all higher bits: where the values with this bit begin."""
    first = values[low]
    edge = ((first >> bit) | np.uint64(1)) << bit
    cut = np.searchsorted(values, edge)
    return np.clip(cut, low, high)


def _compare(a, b, pairs, sizes, budget, out) -> None:
    """Compare all fingerprints within the pairs of ranges, a block at a time."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(pairs):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK)))
        p, n = pairs[at:stop], sizes[at:stop]
        which = np.repeat(np.arange(len(p)), n)
        place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        width = (p[:, 3] - p[:, 2])[which]
        i, j = p[which, 0] + place // width, p[which, 2] + place % width
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        out.append((i[near], j[near]))
        at = stop


def forest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the nodes that have a smaller one; left and right index nodes."""
    label = np.arange(len(nodes))
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        np.minimum.at(label, before[left], low)
        np.minimum.at(label, before[right], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _finish(depth: int, budget: int):
    """Task of a group that holds the fingerprints of both nodes of one pair."""
    shift = np.uint64(BITS - depth)

    def run(table: pa.Table) -> pa.Table:
        own = np.unique(table.column("fp").to_numpy().view(np.uint64))
        if depth:
            side = own >> shift
            a = own[side == side[0]]
            b = own[side == side[-1]]
        else:
            a = b = own
        i, j = linked(a, b, depth, budget)
        nodes, low = forest(own, np.searchsorted(own, a[i]), np.searchsorted(own, b[j]))
        return pa.table({"src": nodes.view(np.int64), "dst": low.view(np.int64)})

    return run


# ---- the join of large subtrees ------------------------------------------------------------------


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("fp", BITS - depth)


def _masks(budget: int) -> list[int]:
    return [m for m in range(1 << STEP) if m.bit_count() <= budget]


def links(fps: DataFrame, budget: int, small: int = SMALL) -> DataFrame:
    """(src, dst): forests that connect all fingerprints within `budget` bits of each other. fps: distinct `fp`."""
    if fps.count() <= small:  # the pair (root, root) is small
        root = F.lit(0).cast("bigint")
        return _finished(fps.select(root.alias("u"), root.alias("v"), "fp"), 0, budget)
    parts, depth, pairs = [], 0, None
    while depth < BITS:
        depth += STEP
        pairs = written(_descend(fps, pairs, depth, budget), "op9-nodes")
        done = (F.col("n") <= small) | F.lit(depth >= BITS)
        parts.append(_meet(fps, pairs.filter(done), depth, budget))
        pairs = pairs.filter(~done)
        if pairs.isEmpty():
            break
    return reduce(DataFrame.unionByName, parts)


def _descend(fps: DataFrame, pairs: DataFrame | None, depth: int, budget: int) -> DataFrame:
    """The pairs of nodes `STEP` bits below the given ones, or below the root, without those over the budget."""
    nodes = fps.groupBy(_prefix(depth).alias("node")).agg(F.count("*").alias("size"))
    nodes = written(nodes.withColumn("up", F.shiftrightunsigned("node", STEP)), "op9-level")
    masks = F.array(*(F.lit(m).cast("bigint") for m in _masks(budget)))
    if pairs is None:
        left = nodes.select(
            F.col("up").alias("u"), F.col("up").alias("v"), F.lit(0).alias("d"), F.col("node").alias("a"), F.col("size").alias("na"))
    else:
        left = pairs.join(nodes, pairs.u == nodes.up).select(
            "u", "v", "d", F.col("node").alias("a"), F.col("size").alias("na"))
    left = left.withColumn("mask", F.explode(masks)).filter(F.col("d") + F.bit_count("mask") <= budget)
    low = F.col("a").bitwiseAND(F.lit((1 << STEP) - 1))
    left = left.withColumn("b", F.shiftleft("v", STEP).bitwiseOR(low.bitwiseXOR(F.col("mask"))))
    other = nodes.select(F.col("node").alias("b2"), F.col("size").alias("nb"))
    # of a node with itself each pair of children once; whole fingerprints are signed, but share their sign there
    both = left.join(other, left.b == other.b2).filter("u <> v or a <= b")
    return both.select(
        F.col("a").alias("u"), F.col("b").alias("v"), (F.col("d") + F.bit_count("mask")).cast("int").alias("d"),
        F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb")).alias("n"))


def _meet(fps: DataFrame, pairs: DataFrame, depth: int, budget: int) -> DataFrame:
    """Bring the fingerprints of both nodes of each pair to one task and link them there."""
    ends = pairs.select("u", "v", F.explode(F.array_distinct(F.array("u", "v"))).alias("node"))
    here = fps.withColumn("p", _prefix(depth)).join(ends, F.col("p") == F.col("node")).select("u", "v", "fp")
    return _finished(here, depth, budget)


def _finished(groups: DataFrame, depth: int, budget: int) -> DataFrame:
    return groups.groupBy("u", "v").applyInArrow(_finish(depth, budget), "src bigint, dst bigint")


# ---- components ----------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, nodes without edges left out.

    Large stars and small stars take turns until nothing changes: every node links its neighbours to the smallest
    among them. Minima are combined in the map tasks and joined back by the skew-safe lookup, so a node with very
    many neighbours is never one task's work.
    """
    edges = written(edges.filter("src <> dst").distinct(), "op9-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        large = _star(both, F.col("dst") > F.col("src"))
        down = large.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        small = _star(down, F.lit(True)).unionByName(_low(down).select(F.col("key").alias("src"), F.col("low").alias("dst")))
        new = written(small.filter("src <> dst").distinct(), "op9-edges")
        if _sum(new) == _sum(edges):
            return new.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        edges = new


def _low(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("key")).agg(F.least(F.min("dst"), F.col("key")).alias("low"))


def _star(edges: DataFrame, which) -> DataFrame:
    """Each neighbour that `which` picks, linked to the smallest of its star."""
    lows = _low(edges).select(F.col("key").cast("string").alias("key"), "low")
    near = edges.filter(which).withColumn("key", F.col("src").cast("string"))
    return lookup(near, lows, "key").select(F.col("dst").alias("src"), F.col("low").alias("dst"))


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


# ---- the operator --------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, keep: list[str], shingle: int = 3, budget: int = 2) -> DataFrame:
    """One row per document: doc_id, the columns `keep`, fp, component_id (smallest id reachable, itself included).

    Null texts count as empty; texts without words have fingerprint zero and are linked like any other. Null ids
    come last; a component that has no other has component_id null. Repeated rows are one row each. A column of `keep` that is
    called like one of the four others goes by a free name (`root_`).
    """
    # by number on the way, so that no name of theirs meets one used here
    kept = [F.col(c).alias(f"_kept{i}") for i, c in enumerate(keep)]
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *kept, text_of(text_col).alias("norm"))
    marked = written(fingerprints(ids, "norm", shingle), "op9-marks")
    firsts = written(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "op9-prints")
    roots = components(links(firsts.select("fp"), budget))
    named = firsts.join(roots, firsts.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    named = written(named, "op9-named")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id")).select(
        F.col("root").cast("string").alias("key"), "component_id")
    named = lookup(named.select("fp", F.col("root").cast("string").alias("key")), lows, "key")
    named = named.select(F.col("fp").cast("string").alias("key"), F.col("key").alias("root"), "component_id")
    joined = lookup(marked.withColumn("key", F.col("fp").cast("string")), written(named, "op9-components"), "key")
    named = making_room(docs.select(*keep), ["doc_id", "fp", "root", "component_id"]).columns
    back = [F.col(f"_kept{i}").alias(c) for i, c in enumerate(named)]
    return joined.select("doc_id", *back, "fp", "root", "component_id")


def op9(spark: SparkSession, docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs, "doc_id", "text", [])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest doc_id, of rows that repeat it the first by locator."""
    rows, at = located(docs, True, "op9-stage")
    slim = rows.select("doc_id", "text", F.col(f"{at}.file").alias("file"), F.col(f"{at}.row").alias("row"))
    found = near_duplicates(slim, "doc_id", "text", ["file", "row"])
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "file", "row")).alias("first")
    keep = found.groupBy("root").agg(first).select("first.file", "first.row")
    return only(rows, at, keep)
