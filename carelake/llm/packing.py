"""Operator 6: best-fit packing by patterns that a non-negative least squares fit chooses.

Documents become pieces of at most `size` tokens. Only the histogram of piece lengths, `size` numbers whatever the
input, reaches the driver. There the patterns of up to three lengths that fill a sequence exactly are enumerated, their
repeat counts fitted to the histogram, rounded down, and what is left is packed best-fit decreasing by count. The plan,
bounded by `size` as well, goes back to the tasks, which look up the place of each piece by its rank among the pieces
of equal length. Ranks are counted within buckets, so a very common length isn't one task's work.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelake.llm.common import table, text_of, written
from carelake.llm.pretokens import places

VOCABULARY = "byte_bpe_50k.json"
SIZE = 1024
END = 2
#: Code points of the documents tokenised at a time; a longer document is taken alone.
CHUNK = 2_000_000
#: Pre-tokens that an encoder remembers; beyond that it begins anew.
KNOWN = 600_000
_END = END.to_bytes(4, "little")
ITERATIONS = 600


# ---- tokens --------------------------------------------------------------------------------------


def _byte_characters() -> np.ndarray:
    """The character by which byte-level vocabularies write a byte: printable ones themselves, the others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return np.array([b if b in printable else next(others) for b in range(256)], "<u2")


class _Encoder:
    """Ids by the tokenizers library's model, asked once for each pre-token it remembers.

    Of the texts encoded together, Arrow finds the distinct pre-tokens and puts the ids in the place of each. The model
    knows no special tokens, so their strings in a text are ordinary text.
    """

    def __init__(self, path: str):
        self.model = Tokenizer.from_file(path).model
        self.characters = _byte_characters()
        self.known: dict[str, bytes] = {}

    def _asked(self, pieces: pa.StringArray) -> list[bytes]:
        """The model's ids of pre-tokens."""
        _, offsets, data = pieces.buffers()
        ends = np.frombuffer(offsets, np.int32)[: len(pieces) + 1].tolist()
        written_out = self.characters[np.frombuffer(data, np.uint8)[: ends[-1]]].tobytes().decode("utf-16-le")
        tokenize = self.model.tokenize
        return [array("I", [t.id for t in tokenize(written_out[a:b])]).tobytes() for a, b in pairwise(ends)]

    def _ids(self, pieces: pa.StringArray) -> list[bytes]:
        """The ids of distinct pre-tokens."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            if len(self.known) + len(new) > KNOWN:
                self.known.clear()
            for i, ids in zip(new, self._asked(pieces.take(pa.array(new, pa.int32()))), strict=True):
                found[i] = ids
            self.known.update((names[i], found[i]) for i in new[:KNOWN])
        return found

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text and the end, as unsigned 32-bit numbers, little endian."""
        data, at, counts = places(texts)
        if not data:
            yield from [_END] * len(texts)
            return
        cut = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))
        pieces = cut.dictionary_encode()
        _, offsets, ids = pa.array(self._ids(pieces.dictionary), pa.binary()).take(pieces.indices).buffers()
        ends = np.frombuffer(offsets, np.int32)[np.cumsum(counts)].tolist()
        for begin, end in pairwise([0, *ends]):
            yield ids[begin:end].to_pybytes() + _END

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


@cache
def _encoder(path: str) -> _Encoder:
    """Once in each Python worker."""
    return _Encoder(path)


def _groups(lengths: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of at most `CHUNK` code points together, or of one text."""
    begin = end = held = 0
    for end, length in enumerate(lengths):
        if end > begin and held + length > CHUNK:
            yield begin, end
            begin, held = end, 0
        held += length
    yield begin, end + 1


def pieces(texts: DataFrame, path: str, text_col: str, size: int = SIZE) -> DataFrame:
    """One row per piece: the other columns, piece, start, length and ids (unsigned 32-bit, little endian).

    Only documents longer than `size` are cut, into whole pieces from the end; the first may be shorter.
    """
    rest = [c for c in texts.columns if c != text_col]
    schema = texts.select(
        *rest, F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"),
        F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("ids"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            for top, bottom in _groups(pc.utf8_length(batch.column(text_col)).fill_null(0).to_pylist()):
                part = batch.slice(top, bottom - top)
                row, piece, start, length, ids = [], [], [], [], []
                for i, found in enumerate(own.encode_all([t or "" for t in part.column(text_col).to_pylist()])):
                    n = len(found) // 4
                    for k, end in enumerate(range((n - 1) % size + 1, n + 1, size)):
                        begin = max(0, end - size) if k else 0
                        row.append(i)
                        piece.append(k)
                        start.append(begin)
                        length.append(end - begin)
                        ids.append(found[4 * begin : 4 * end])
                others = [part.column(c).take(pa.array(row, pa.int32())) for c in rest]
                yield pa.RecordBatch.from_arrays([
                    *others, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary())], schema.names)

    return texts.mapInArrow(run, schema)


# ---- the plan ------------------------------------------------------------------------------------


def patterns(size: int) -> np.ndarray:
    """All a >= b >= c (b and c may be 0) with a + b + c = size, one row each."""
    a, b = np.meshgrid(np.arange(1, size + 1), np.arange(0, size + 1), indexing="ij")
    c = size - a - b
    good = (c >= 0) & (a >= b) & (b >= c)
    return np.stack([a[good], b[good], c[good]], axis=1)


def fitted(histogram: np.ndarray, rows: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that minimise |A x - histogram|, by accelerated projected gradients.

    histogram[l] counts the pieces of length l; A[l, p] is how often pattern p holds length l.
    """
    size = len(histogram) - 1
    flat, n = rows.ravel(), len(rows)
    target = histogram.astype(float)
    target[0] = 0

    def forward(x: np.ndarray) -> np.ndarray:
        y = np.bincount(flat, np.repeat(x, rows.shape[1]), size + 1)
        y[0] = 0
        return y

    def back(y: np.ndarray) -> np.ndarray:
        return y[rows].sum(1)

    v = np.ones(n)
    norm = 1.0
    for _ in range(30):  # largest eigenvalue of A'A
        v = back(forward(v))
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    x = z = np.zeros(n)
    t = 1.0
    for _ in range(iterations):
        new = np.maximum(0, z - back(forward(z) - target) / (1.02 * norm))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences): uses up the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    rows = patterns(len(histogram) - 1)
    rows = rows[((left[rows] > 0) | (rows == 0)).all(1)]
    out: list[tuple[tuple[int, ...], int]] = []
    if len(rows):
        counts = fitted(left, rows)
        for p in np.argsort(-counts, kind="stable"):
            lengths = [int(x) for x in rows[p] if x]
            most = min(int(left[x]) // lengths.count(x) for x in lengths)
            times = min(int(counts[p]), most)
            if times:
                out.append((tuple(lengths), times))
                for x in lengths:
                    left[x] -= times
    return out + residual(left)


def residual(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: sequences with equal contents are one entry, so work doesn't grow with them."""
    size = len(left) - 1
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # free tokens -> contents -> sequences
    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            room = next((r for r in range(length, size) if open_.get(r)), None)
            if room is None:
                # new sequences, each filled with as many pieces of this length as fit
                each = size // length
                full, rest = divmod(count, each)
                for k, times in ((each, full), (rest, 1 if rest else 0)):
                    if times:
                        group = open_[size - k * length]
                        group[(length,) * k] = group.get((length,) * k, 0) + times
                count = 0
                continue
            contents, times = open_[room].popitem()
            put = min(count, times)
            if times > put:
                open_[room][contents] = times - put
            group, grown = open_[room - length], (*contents, length)
            group[grown] = group.get(grown, 0) + put
            count -= put
    return [(contents, times) for _, group in sorted(open_.items()) for contents, times in sorted(group.items())]


def _slots(chosen: list[tuple[tuple[int, ...], int]], size: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence and offset of the ranges of slots that the plan has for it."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    ranks, sequence = [0] * (size + 1), 0
    for lengths, times in chosen:
        offset = 0
        for x in lengths:
            found[x].append((ranks[x], sequence, offset))
            ranks[x] += times
            offset += x
        sequence += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for x, rows in found.items()}


# ---- the operator --------------------------------------------------------------------------------


def ranked(cut: DataFrame, order: list[str]) -> DataFrame:
    """The pieces with `rank`, from 0 among those of equal length."""
    spark = cut.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(
        F.col("length").alias("l"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy(*order)
    counted = keyed.withColumn("own", F.row_number().over(own) - 1)
    joined = counted.join(base, (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("b")))
    return joined.withColumn("rank", F.col("base") + F.col("own")).drop("l", "b", "base", "own", "bucket")


def placed(rows: DataFrame, slots: dict[int, tuple[np.ndarray, ...]]) -> DataFrame:
    """The ranked pieces with sequence_id and offset instead of the rank."""
    rest = [c for c in rows.columns if c != "rank"]
    schema = rows.select(*rest, F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                here = np.nonzero(length == x)[0]
                first, base, at = slots[int(x)]
                entry = np.searchsorted(first, rank[here], "right") - 1
                sequence[here] = base[entry] + rank[here] - first[entry]
                offset[here] = at[entry]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(sequence), pa.array(offset)], schema.names)

    return rows.mapInArrow(run, schema)


def pack(cut: DataFrame, order: list[str], size: int = SIZE) -> DataFrame:
    """The pieces (a table on shared storage with `length`) with sequence_id and offset.

    Each sequence is filled without gaps from 0. `order` breaks ties among pieces of equal length; rows equal in all of
    it are interchangeable. An empty table gives no rows.
    """
    histogram = np.zeros(size + 1, np.int64)
    for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `size` rows
        histogram[row.length] = row.n
    return placed(ranked(cut, order), _slots(plan(histogram), size))


def packed(docs: DataFrame, id_col: str, text_col: str, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, places of the pieces). A null text counts as empty and is one piece of one token."""
    path = public_tokenizers.path(VOCABULARY)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    cut = written(pieces(texts, path, "text", size).withColumn("ids_crc32", F.crc32("ids")), "op6-pieces")
    slim = cut.select("doc_id", "piece", "start", "length", "ids_crc32")
    return cut, pack(slim, ["doc_id", "piece", "start", "ids_crc32"], size)


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return packed(docs, "doc_id", "text")[1].select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6(spark, docs)
