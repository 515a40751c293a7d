"""Operator 1: byte-level BPE by backtracking over an Aho-Corasick automaton.

Bytes are mapped to Latin-1 characters, so the automaton over strings works on bytes. It gives the longest vocabulary
entry at every place of a pre-token. From left to right the longest entry is tried first; an entry may follow another
if the merges would leave just these two on their joined bytes, which is remembered for every pair. Where none fits,
the place is marked as impossible and the last token is shortened. Every place is given up once at most, so the work
is linear, and a sequence whose neighbours all fit is the one that the merges make.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import table, text_of
from carelake.llm.pretokens import Memo, split

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """The merges by definition: join the neighbours of lowest rank, leftmost first, as long as one is below."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Vocabulary:
    """Ranks with the automaton, the next shorter entry of each entry, and the pairs that may be neighbours."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.nothing = len(self.ranks) + max(self.ranks.values(), default=0) + 1
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.entries = ahocorasick.Automaton()
        reached = {}
        for entry, rank in self.ranks.items():
            # an entry that its own merges never reach only counts where it is a whole pre-token
            if len(entry) == 1 or merged(entry, self.ranks, self.nothing) == [entry]:
                reached[entry] = rank
                self.entries.add_word(entry.decode("latin-1"), rank)
        self.entries.make_automaton()
        self.shorter = {
            rank: next((reached[entry[:n]] for n in range(len(entry) - 1, 0, -1) if entry[:n] in reached), None)
            for entry, rank in reached.items()
        }
        self.fits: dict[int, bool] = {}
        self.ids = Memo(lambda piece: array("i", self.encode_piece(piece)).tobytes())

    def fit(self, left: int, right: int) -> bool:
        """Whether the merges leave exactly these two tokens on their joined bytes."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= 800_000:
                self.fits.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.fits[key] = merged(a + b, self.ranks, self.nothing) == [a, b]
        return known

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        length, shorter, fits, fit = self.length, self.shorter, self.fits, self.fit
        longest = [0] * n
        for end, token in self.entries.iter(data.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # ends ascend, so the longest is noted last
        blocked = bytearray(n + 1)
        ids: list[int] = []
        last, at, token = -1, 0, longest[0]
        while True:
            end = at + length[token]
            if not blocked[end] and (last < 0 or (f if (f := fits.get(last << 32 | token)) is not None else fit(last, token))):
                ids.append(token)
                if end == n:
                    return ids
                last, at, token = token, end, longest[end]
                continue
            less = shorter[token]
            while less is None:  # nothing fits here: give the place up and shorten the token before
                blocked[at] = 1
                token = ids.pop()
                at -= length[token]
                last = ids[-1] if ids else -1
                less = shorter[token]
            token = less

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids.__getitem__, split(text))), np.intc)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@cache
def vocabulary(path: str) -> Vocabulary:
    """Once in each Python worker."""
    return Vocabulary(path)


def encode(texts: DataFrame, path: str, text_col: str, ids_col: str) -> DataFrame:
    """The rows with the token ids (array<int>) instead of the text; a null text counts as empty."""
    rest = [c for c in texts.columns if c != text_col]
    schema = texts.select(*rest, F.array(F.lit(0)).alias(ids_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                found = [own.encode(t.as_py() or "") for t in part.column(text_col)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(found) if found else np.empty(0, np.int32))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), lists], [*rest, ids_col])

    return texts.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids_col: str, bytes_col: str) -> DataFrame:
    """The rows with one more column: the bytes (binary) of the token ids. An id that is not in the vocabulary fails."""
    schema = tokens.select("*", F.lit(b"").alias(bytes_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                lists = part.column(ids_col)
                ids, ends = lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())
                found = [own.decode(x.tolist()) for x in np.split(ids, ends[:-1])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], schema.names)

    return tokens.mapInArrow(run, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text. Repeated rows give repeated rows, an empty table none."""
    path = public_tokenizers.path(VOCABULARY)
    texts = table(spark, sf_dir, "documents").select("doc_id", text_of("text").alias("text"))
    both = decode(encode(texts, path, "text", "ids"), path, "ids", "decoded")
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
