"""Operator 13: n-gram Jaccard join by sizes: subsets of small sets, inverted lists of large ones.

Every document is the set of hashes of its distinct word n-grams; documents with equal sets are one node. Sets of fewer
than `boundary` elements are light, the others heavy, where the boundary is the one of least cost by the sizes at hand.

Light pairs: two sets of sizes a <= b link if and only if they share need(a, b) elements, that is a subset of that fixed
size. So each light set lists all its subsets of the sizes that its possible partners ask for; sets that list the same
one link, without a comparison, and all of them to the first: a star, not all pairs.

Pairs with a heavy set: linked sets share one of their rarest elements (a prefix in a common order, rare first), so the
inverted lists of the prefixes are scanned. First every member of a list is held against two centers of the list, and
the sets found linked are contracted. Only lists in which members of different components remain are then scanned pair
by pair, in blocks of bounded size; members of one component need no comparison. Pairs that positions, sizes and the
parity bitmaps of the sets (a lower bound of their difference) leave over are verified on the whole sets. No filter
drops a linked pair, so the components are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import located, text_of, written
from carelake.llm.simhash_trie import components
from carelake.operators.lookup import lookup

SHINGLE, PERCENT = 4, 85
#: Elements are ordered by the frequency of one of so many buckets.
BUCKETS = 1 << 18
#: Sets from this size on are heavy whatever they cost, as the number of subsets grows beyond all lists.
MOST_LIGHT = 24
#: Numbers of 64 bits in a parity bitmap.
MAPS = 8
#: Members of an inverted list in a block of the scan, on average.
BLOCK = 256
#: Pairs compared at a time within a task.
PAIRS = 1 << 19

SPACES = re.compile(rb"[\x20\x09-\x0D]+")


def need(a: int, b: int, percent: int = PERCENT) -> int:
    """The least intersection of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def needed(a: Column, b: Column, percent: int) -> Column:
    total = (a.cast("bigint") + b) * percent + (100 + percent - 1)
    return ((total - total % (100 + percent)) / (100 + percent)).cast("bigint")


# ---- sets ----------------------------------------------------------------------------------------


def elements(text: bytes, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams; fewer words are one n-gram. bytes.lower() only touches A-Z."""
    joined = SPACES.sub(b" ", text).strip(b" ").lower()
    if not joined:
        return np.empty(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))
    n, digest = max(1, len(starts) - shingle + 1), xxhash.xxh3_64_intdigest
    starts, ends = starts[:n], ends[-n:]
    parts = []
    for at in range(0, n, 1 << 16):
        own = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)
        parts.append(np.array([digest(joined[a:b]) for a, b in own], np.uint64))
    return np.unique(np.concatenate(parts))


def _texts(batch: pa.RecordBatch, shingle: int) -> Iterator[np.ndarray]:
    for text in batch.column("text"):
        yield elements(text.as_py(), shingle)


def frequencies(texts: DataFrame, shingle: int) -> np.ndarray:
    """Number of elements in each bucket, over the sets of all rows of `text` (binary). A task sends `BUCKETS` rows at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, n = np.zeros(BUCKETS, np.int64), [], 0
        for batch in batches:
            for own in _texts(batch, shingle):
                waiting.append((own % np.uint64(BUCKETS)).astype(np.int64))
                n += len(own)
                if n > 1 << 20:
                    total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
                    waiting, n = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


MARKS = "n int, key binary, maps array<bigint>, prefix array<bigint>, whole array<bigint>, cost double"


def mark(own: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple:
    """Size, digest, parity bitmap, prefix (rarest first), the whole set if it may be light, and cost of scanning its lists.

    counts: of the buckets; usual: their mean, which an element that is no other set's would find in its bucket.
    """
    n = len(own)
    if not n:
        return 0, None, None, None, None, None
    seen = counts[(own % np.uint64(BUCKETS)).astype(np.int64)]
    length = n - need(n, -(-percent * n // 100), percent) + 1  # linked sets as small as can be ask for the longest prefix
    first = np.lexsort((own, seen))[:length]
    flips = np.bincount((own >> np.uint64(20)).astype(np.int64) % (64 * MAPS), minlength=64 * MAPS) % 2
    maps = np.packbits(flips.astype(np.uint8)).view(np.int64)
    lists = np.maximum(1, seen[first] - usual).sum()
    return (n, xxhash.xxh3_128_digest(own.tobytes()), maps, own[first].view(np.int64),
            own.view(np.int64) if n < MOST_LIGHT else None, float(lists))


def marks(docs: DataFrame, rest: list[str], counts: np.ndarray, shingle: int, percent: int) -> DataFrame:
    schema = ", ".join(f"{c} {t}" for c, t in docs.select(*rest).dtypes) + ", " + MARKS
    names = [c.split()[0] for c in MARKS.split(", ")]
    kinds = (pa.int32(), pa.binary(), *[pa.list_(pa.int64())] * 3, pa.float64())
    usual = counts.mean()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [mark(own, counts, usual, percent) for own in _texts(batch, shingle)]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], [*rest, *names])

    return docs.select(*rest, "text").mapInArrow(run, schema)


# ---- light sets ----------------------------------------------------------------------------------


@lru_cache(maxsize=None)
def partners(n: int, boundary: int, percent: int) -> tuple[tuple[int, int, int], ...]:
    """(a, b, c): sizes a <= b < boundary of linked sets of which one has n elements, and their least intersection."""
    sizes = [(min(n, m), max(n, m)) for m in range(1, boundary) if 100 * min(n, m) >= percent * max(n, m)]
    # equal sets are one node, so sets of one size whose intersection would have that size don't link
    return tuple((a, b, need(a, b, percent)) for a, b in sizes if need(a, b, percent) < b)


def boundary_of(nodes: DataFrame, percent: int) -> int:
    """The size from which on sets are heavy: least sum of subsets of the light and list entries of the heavy sets."""
    small = nodes.filter(F.col("n") < MOST_LIGHT).groupBy("n").agg(F.count("*").alias("sets"), F.sum("cost").alias("lists"))
    sizes = {r.n: r for r in small.collect()}  # fewer rows than MOST_LIGHT

    def cost(x: int) -> float:
        subsets = sum(r.sets * comb(n, c) for n, r in sizes.items() if n < x for _, _, c in partners(n, x, percent))
        return subsets + sum(r.lists for n, r in sizes.items() if n >= x)

    return min(range(1, MOST_LIGHT + 1), key=cost)


def light_links(nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(src, dst): of all sets below the boundary that list one subset, each with the first of the smaller size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nid, whole in zip(batch.column("nid").to_pylist(), batch.column("whole").to_pylist(), strict=True):
                keys, low, n = [], [], len(whole)
                for a, b, c in partners(n, boundary, percent):
                    head = bytes((a, b))
                    own = [xxhash.xxh3_128_digest(head + np.array(s, np.int64).tobytes()) for s in combinations(whole, c)]
                    keys += own
                    low += [n == a] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([nid] * len(keys), pa.int64()), pa.array(low, pa.bool_())], ["subset", "nid", "low"])

    light = nodes.filter(F.col("n") < boundary).select("nid", "whole")
    rows = written(light.mapInArrow(run, "subset binary, nid bigint, low boolean"), "op13-subsets")
    first = rows.groupBy("subset").agg(F.count("*").alias("sets"), F.min(F.when(F.col("low"), F.col("nid"))).alias("dst"))
    shared = first.filter("sets > 1 and dst is not null").select("subset", "dst")
    return lookup(rows, shared, "subset").filter("nid <> dst").select(F.col("nid").alias("src"), "dst").distinct()


# ---- inverted lists ------------------------------------------------------------------------------


def inverted(nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(token, nid, n, at, one, two): the entries of all lists that may hold a linked pair, with the list's two centers.

    A linked pair's smaller set has their first common element in the shorter prefix that equal sizes ask for, so the
    centers are of these entries. Counting combines in the map tasks; a long list is split by AQE in the join.
    """
    entries = nodes.filter(100 * F.col("n") >= percent * boundary).select("nid", "n", F.posexplode("prefix").alias("at", "token"))
    near = F.when(F.col("at") <= F.col("n") - needed(F.col("n"), F.col("n"), percent), F.col("nid"))
    lists = entries.groupBy("token").agg(F.count("*").alias("size"), F.min(near).alias("one"), F.max(near).alias("two"))
    lists = written(lists.filter("size > 1 and one is not null").select(F.col("token").alias("key"), "one", "two"), "op13-centers")
    return written(entries.join(lists, F.col("token") == F.col("key")).drop("key"), "op13-lists")


def _possible(a: Column, b: Column, boundary: int, percent: int) -> Column:
    """Whether sizes may link, one of them being heavy."""
    return (100 * F.least(a, b).cast("bigint") >= percent * F.greatest(a, b)) & (F.greatest(a, b) >= boundary)


def near_pairs(pairs: DataFrame, nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(x, y, need) of the distinct pairs (x, y) whose sizes and bitmaps allow a link."""
    slim = nodes.select("nid", "n", "maps")
    for side in ("x", "y"):
        own = slim.select(F.col("nid").alias(f"_{side}"), F.col("n").alias(f"n{side}"), F.col("maps").alias(f"m{side}"))
        pairs = pairs.join(own, F.col(side) == F.col(f"_{side}")).drop(f"_{side}")
    differ = F.aggregate(F.zip_with("mx", "my", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, k: s + k)
    least = needed(F.col("nx"), F.col("ny"), percent)
    return pairs.filter(_possible(F.col("nx"), F.col("ny"), boundary, percent)).filter(
        differ <= F.col("nx").cast("bigint") + F.col("ny") - 2 * least).select("x", "y", least.alias("need"))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(src, dst) of the pairs (x, y, need) whose whole sets share as many elements as they need.

    Only the texts of sets that occur in a pair are shingled again. docs: file, row, text (binary).
    """
    if pairs.isEmpty():
        return pairs.select(F.col("x").alias("src"), F.col("y").alias("dst"))
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("nid")).distinct()
    places = nodes.select("nid", F.col("at.file").alias("_file"), F.col("at.row").alias("_row")).join(wanted, "nid", "left_semi")
    texts = docs.join(places, (F.col("file") == F.col("_file")) & (F.col("row") == F.col("_row"))).select("nid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [own.view(np.int64) for own in _texts(batch, shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("nid"), pa.array(sets, pa.list_(pa.int64()))], ["nid", "own"])

    sets = written(texts.mapInArrow(run, "nid bigint, own array<bigint>"), "op13-sets")
    for side in ("x", "y"):
        # a center's many pairs can be split: both sides come from tables
        pairs = pairs.join(sets.select(F.col("nid").alias(f"_{side}"), F.col("own").alias(f"own_{side}")), F.col(side) == F.col(f"_{side}"))
    shared = F.size(F.array_intersect("own_x", "own_y"))
    return pairs.filter(shared >= F.col("need")).select(F.col("x").alias("src"), F.col("y").alias("dst"))


def scan(lists: DataFrame, labels: DataFrame, nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Distinct (x, y): pairs of different components in a list whose positions, sizes and bitmaps allow a link.

    labels: (node, root). The centers of a list were held against all its members before and are left out. A list is cut
    into blocks of some `BLOCK` members, and every pair of blocks is one small group.
    """
    rest = lists.filter("nid <> one and nid <> two").select("token", "nid", "n", "at")
    marked = rest.join(labels, F.col("nid") == F.col("node"), "left").select("token", "nid", "n", "at", F.coalesce("root", "nid").alias("root"))
    marked = written(marked, "op13-marked")
    mixed = marked.groupBy("token").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = written(mixed.filter("low <> high").select(F.col("token").alias("key"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "op13-mixed")
    rows = marked.join(mixed, F.col("token") == F.col("key")).drop("key")
    rows = rows.join(nodes.select(F.col("nid").alias("_n"), "maps"), F.col("nid") == F.col("_n")).drop("_n")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    rows = rows.select("token", "i", "j", "own", "nid", "n", "at", "root", "maps")
    return written(rows.mapInArrow(_scanner(boundary, percent), "x bigint, y bigint").distinct(), "op13-candidates")


def _scanner(boundary: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = _columns(batch)
            if held is not None:
                rows = [np.concatenate(c) for c in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            changed = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0) | (np.diff(rows[2]) != 0)) + 1
            last = changed[-1] if len(changed) else 0  # the last group may go on in the next batch
            yield from _found([c[:last] for c in rows], changed[:-1], boundary, percent)
            held = [c[last:] for c in rows]
        if held is not None:
            yield from _found(held, np.empty(0, np.int64), boundary, percent)

    return run


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    plain = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "i", "j", "own", "nid", "n", "at", "root")]
    return [*plain, batch.column("maps").flatten().to_numpy().reshape(-1, MAPS)]


def _found(rows: list[np.ndarray], cuts: np.ndarray, boundary: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Compare all rows of each group, a bounded number of pairs at a time."""
    _, i, j, own, nid, n, at, root, maps = rows
    if not len(nid):
        return
    ends = np.repeat(np.append(cuts, len(nid)), np.diff(np.concatenate(([0], cuts, [len(nid)]))))
    ahead = ends - np.arange(len(nid)) - 1  # each row with those after it in its group
    done, total = 0, np.cumsum(ahead)
    while done < len(nid):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS)))
        count = ahead[done:stop]
        a = np.repeat(np.arange(done, stop), count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        fits = (root[a] != root[b]) & ((i[a] == j[a]) | (own[a] != own[b]))
        a, b = a[fits], b[fits]
        small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        least = -(-percent * (small + large) // (100 + percent))
        fits = (100 * small >= percent * large) & (large >= boundary) & (at[a] <= n[a] - least) & (at[b] <= n[b] - least)
        a, b, most = a[fits], b[fits], (small + large - 2 * least)[fits]
        fits = np.bitwise_count(maps[a] ^ maps[b]).sum(1) <= most
        a, b = nid[a[fits]], nid[b[fits]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["x", "y"])
        done = stop


# ---- the operator --------------------------------------------------------------------------------


def heavy_links(nodes: DataFrame, docs: DataFrame, light: DataFrame, boundary: int, shingle: int, percent: int) -> DataFrame:
    """(src, dst): links that together with the light ones connect all linked sets of which one is heavy."""
    lists = inverted(nodes, boundary, percent)
    stars = lists.select("nid", F.explode(F.array_distinct(F.array("one", "two"))).alias("c")).filter("nid <> c").select(
        F.least("nid", "c").alias("x"), F.greatest("nid", "c").alias("y")).distinct()
    found = written(verified(written(near_pairs(stars, nodes, boundary, percent), "op13-stars"), nodes, docs, shingle), "op13-links")
    labels = components(found.unionByName(light))
    left = near_pairs(scan(lists, labels, nodes, boundary, percent), nodes, boundary, percent)
    return found.unionByName(written(verified(written(left, "op13-left"), nodes, docs, shingle), "op13-links"))


def jaccard_components(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT,
                       boundary: int | None = None, landed: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Null texts count as empty; texts without words are empty sets, which link with nothing. Repeated rows and equal sets
    are linked; rows are one each. Null ids come after all others: a component that has no other has component_id null.
    An empty table gives no rows. `boundary` sets the size from which on sets are heavy instead of choosing it by cost.
    `landed` says that the rows come straight from Parquet files.
    """
    given = docs.select(F.col(id_col).cast("bigint").alias("doc"), text_of(text_col).alias("words")) if not landed else docs
    given, at = located(given, landed, "op13-given")
    text = text_of(text_col) if landed else F.col("words")
    rows = given.select((F.col(id_col).cast("bigint") if landed else F.col("doc")).alias("doc"), F.col(at).alias("at"), text.cast("binary").alias("text"))
    counts = frequencies(rows, shingle)
    marked = written(marks(rows, ["doc", "at"], counts, shingle, percent), "op13-marks")
    same = marked.filter("n > 0").groupBy("key").agg(
        F.min("doc").alias("low"), F.first(F.struct("at", "n", "maps", "prefix", "whole", "cost")).alias("own"))
    nodes = written(same.select(F.monotonically_increasing_id().alias("nid"), "key", "low", "own.*"), "op13-nodes")
    x = boundary_of(nodes, percent) if boundary is None else min(boundary, MOST_LIGHT)
    light = written(light_links(nodes, x, percent), "op13-light")
    texts = rows.select("at.file", "at.row", "text")
    roots = components(light.unionByName(heavy_links(nodes, texts, light, x, shingle, percent)))
    named = nodes.select("nid", "key", "low").join(roots, F.col("nid") == F.col("node"), "left").select(
        "key", "low", F.coalesce("root", "nid").cast("string").alias("root"))
    named = written(named, "op13-named")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = written(lookup(named.select("key", "root"), lows, "root").select("key", "component_id"), "op13-components")
    # equal sets are linked, so any of their rows has the component of the node
    out = lookup(marked.select("doc", "n", "key"), named, "key", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").cast("bigint").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"))


def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return jaccard_components(docs, "doc_id", "text", landed=True)
