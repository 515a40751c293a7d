"""Operator 8: token counts that follow edits.

Each document keeps a segment tree over its pre-tokens: leaves are blocks of pre-tokens with their lengths and token
counts, inner nodes the sums. An edit goes down to its place by the sums of lengths, starts two pre-tokens before it
(the furthest that the pattern can look ahead), cuts and counts from there until a new boundary meets an old one behind
the edit, and updates the sums above the blocks it touched. Nothing else of the document is encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.bpe import read_ranks
from carelake.llm.common import making_room, table, text_of
from carelake.llm.pretokens import Memo, cuts, split

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pre-tokens in a leaf when a tree is built; a leaf four times as long makes the tree be built anew.
LEAF = 64
#: Pre-tokens before an edit that it can change, beside the one it touches.
CONTEXT = 2
#: Columns that `build` and `apply` add.
MADE = ("lengths", "counts", "n_pretokens", "n_tokens", "reencoded")
EDITS = "array<struct<pos: bigint, removed: bigint, inserted: string>>"


@cache
def counter(path: str) -> Memo:
    """Token count of a pre-token, remembered in each Python worker."""
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    return Memo(lambda piece: len(own.encode_ordinary(piece)))


class Tree:
    """Lengths (code points) and token counts of a text's pre-tokens under a binary tree of sums."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self._build(lengths, counts)

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        n = max(1, -(-len(lengths) // LEAF))
        self.leaves = [(lengths[i * LEAF : (i + 1) * LEAF], counts[i * LEAF : (i + 1) * LEAF]) for i in range(n)]
        self.size = 1 << (n - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (long, many) in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(long), sum(many)
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def flat(self) -> tuple[list[int], list[int]]:
        return [x for long, _ in self.leaves for x in long], [x for _, many in self.leaves for x in many]

    def _find(self, pos: int) -> tuple[int, int, int]:
        """(leaf, index, start) of the first pre-token whose end is at `pos` or behind it."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if self.chars[node] + start < pos:
                start += self.chars[node]
                node += 1
        leaf = min(node - self.size, len(self.leaves) - 1)
        for i, x in enumerate(self.leaves[leaf][0]):
            if start + x >= pos:
                return leaf, i, start
            start += x
        return leaf, len(self.leaves[leaf][0]), start

    def _back(self, leaf: int, i: int, start: int, steps: int) -> tuple[int, int, int]:
        while steps:
            while not i and leaf:
                leaf -= 1
                i = len(self.leaves[leaf][0])
            if not i:
                break
            i, steps = i - 1, steps - 1
            start -= self.leaves[leaf][0][i]
        return leaf, i, start

    def edit(self, text: str, pos: int, removed: int, inserted: str, count) -> tuple[str, int]:
        """The text after the edit, and how many pre-tokens were encoded again. Places beyond the text mean its end."""
        pos = max(0, min(pos, len(text)))
        end = max(pos, min(pos + removed, len(text)))
        new = text[:pos] + inserted + text[end:]
        shift = len(inserted) - (end - pos)
        leaf, i, start = self._back(*self._find(pos), CONTEXT)
        first, at = (leaf, i), start
        lengths: list[int] = []
        counts: list[int] = []
        old = start
        for piece in cuts(new, start):
            while leaf < len(self.leaves) and (old < end or old + shift < at):
                if i < len(self.leaves[leaf][0]):
                    old += self.leaves[leaf][0][i]
                    i += 1
                else:
                    leaf, i = leaf + 1, 0
            if old >= end and old + shift == at and old < len(text):
                break  # an old boundary: from here on the text and its pre-tokens are as before
            lengths.append(len(piece))
            counts.append(count[piece])
            at += len(piece)
        else:
            leaf, i = len(self.leaves), 0
        self._replace(first, (leaf, i), lengths, counts)
        return new, len(lengths)

    def _replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]) -> None:
        (a, i), (b, j) = first, last
        tail = ([], []) if b >= len(self.leaves) else (self.leaves[b][0][j:], self.leaves[b][1][j:])
        head = self.leaves[a]
        self.leaves[a] = (head[0][:i] + lengths + tail[0], head[1][:i] + counts + tail[1])
        for k in range(a + 1, min(b, len(self.leaves) - 1) + 1):
            self.leaves[k] = ([], [])
        if len(self.leaves[a][0]) > 4 * LEAF:
            self._build(*self.flat())
            return
        for k in range(a, min(b, len(self.leaves) - 1) + 1):
            node = self.size + k
            self.chars[node], self.tokens[node] = sum(self.leaves[k][0]), sum(self.leaves[k][1])
            while node > 1:
                node //= 2
                self._sum(node)


# ---- trees as rows -------------------------------------------------------------------------------


def _packed(values: list[int]) -> bytes:
    return np.array(values, "<u4").tobytes()


def _unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def build(texts: DataFrame, path: str, text_col: str) -> DataFrame:
    """The rows with `lengths` and `counts` (32-bit numbers, the leaves of the tree), n_pretokens and n_tokens.

    Null texts are empty: a tree without leaves. Every row gets a tree of its own, repeated ones too; an empty table gives none.
    Given columns of the names in `MADE` stay under a free name (`counts_`); `text_col` must not be one of them.
    """
    texts = making_room(texts, MADE)
    schema = texts.select(
        "*", F.lit(b"").alias("lengths"), F.lit(b"").alias("counts"), F.lit(0).cast("bigint").alias("n_pretokens"),
        F.lit(0).cast("bigint").alias("n_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                cut = [split(t.as_py() or "") for t in part.column(text_col)]
                many = [list(map(count.__getitem__, p)) for p in cut]
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array([_packed(list(map(len, p))) for p in cut], pa.binary()),
                    pa.array([_packed(m) for m in many], pa.binary()), pa.array([len(p) for p in cut], pa.int64()),
                    pa.array([sum(m) for m in many], pa.int64())], schema.names)

    return texts.mapInArrow(run, schema)


def gathered(edits: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """Edits (pos, removed, inserted) as one list a document, in order, for `apply`."""
    step = F.struct(order_col, "pos", "removed", "inserted")
    listed = edits.groupBy(id_col).agg(F.array_sort(F.collect_list(step)).alias("e"))
    return listed.select(id_col, F.transform("e", lambda x: F.struct(
        x.pos.alias("pos"), x.removed.alias("removed"), x.inserted.alias("inserted"))).alias("edits"))


def apply(trees: DataFrame, path: str, text_col: str, edits_col: str) -> DataFrame:
    """The rows after their edits (`EDITS`, in order): text, lengths, counts and n_pretokens and n_tokens follow them;
    `reencoded` pre-tokens were encoded again. Null edits are none; null numbers count as 0, null texts as empty. Rows are
    edited one by one, repeated ones alike; an empty table gives none."""
    rest = [c for c in trees.columns if c not in (text_col, edits_col, "lengths", "counts", "n_pretokens", "n_tokens")]
    names = [*rest, text_col, "lengths", "counts", "n_pretokens", "n_tokens", "reencoded"]
    schema = trees.withColumn("reencoded", F.lit(0).cast("bigint")).select(*names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out: list[tuple] = []
                given = (part.column(c) for c in (text_col, "lengths", "counts", edits_col))
                for text, lengths, counts, edits in zip(*given, strict=True):
                    text, tree, again = text.as_py() or "", Tree(_unpacked(lengths.as_py()), _unpacked(counts.as_py())), 0
                    for e in edits.as_py() or ():
                        text, n = tree.edit(text, e["pos"] or 0, e["removed"] or 0, e["inserted"] or "", count)
                        again += n
                    long, many = tree.flat()
                    out.append((text, _packed(long), _packed(many), len(long), tree.n_tokens, again))
                kinds = (pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                made = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *made], names)

    return trees.mapInArrow(run, schema)


# ---- the query -----------------------------------------------------------------------------------


def derived_edits(doc_id: Column, text: Column, edits: int = 4) -> Column:
    """Edits of a text that follow from its id: at scattered places a few characters give way to some of the text's own."""
    def one(k: int) -> Column:
        at = lambda salt, top: F.pmod(F.xxhash64(doc_id, F.lit(10 * k + salt)), F.lit(top) if isinstance(top, int) else top)
        place = at(0, F.length(text) + 1)
        return F.struct(
            place.cast("bigint").alias("pos"), at(1, 9).cast("bigint").alias("removed"),
            F.substring(text, (at(2, F.length(text) + 1) + 1).cast("int"), at(3, 12).cast("int")).alias("inserted"))

    return F.array(*(one(k) for k in range(edits)))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all documents, then a few edits to each; counts before and after, and how much was encoded again."""
    path = public_tokenizers.path(VOCABULARY)
    texts = table(spark, sf_dir, "documents").select("doc_id", text_of("text").alias("text"))
    trees = build(texts, path, "text").withColumns({
        "pretokens_before": F.col("n_pretokens"), "tokens_before": F.col("n_tokens"),
        "edits": derived_edits(F.col("doc_id"), F.col("text"))})
    return apply(trees, path, "text", "edits").select(
        "doc_id", "pretokens_before", "tokens_before", F.col("n_pretokens").alias("pretokens_after"),
        F.col("n_tokens").alias("tokens_after"), "reencoded", F.sha2("text", 256).alias("edited_sha256"))
