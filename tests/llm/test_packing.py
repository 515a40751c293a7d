"""Operator 6: ids by the library, sequences without gaps, close to the fewest possible."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelake.llm import packing
from carelake.llm.pretokens import places, split
from carelake.llm.queries import QUERIES

PATH = public_tokenizers.path(packing.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids(text):
    assert np.frombuffer(packing._encoder(PATH).encode(text), "<u4").tolist() == ids(text)


def pretokens(texts):
    data, at, counts = places(texts)
    assert data == "".join(texts).encode() and at[0] == 0 and at[-1] == len(data) and len(counts) == len(texts)
    cut = iter([data[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)])
    return [[next(cut) for _ in range(n)] for n in counts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from(" \n\t\r\x1c\x85\xa0\u3000'sdmtrevlLx09_.!é½²日😀\u0301"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=6))
def test_texts_cut_together_are_cut_by_the_pattern(texts):
    assert pretokens(texts) == [split(t) for t in texts]


def test_contractions_spaces_and_every_code_point():
    pool = ["'", "'", "s", "ll", "l", "re", "ve", "v", "d", "m", "t", " ", " ", "\n", "x", "7", "!", "é"]
    chance = random.Random(12)
    texts = ["".join(chance.choice(pool) for _ in range(chance.randint(0, 25))) for _ in range(4000)]
    texts += [f"a{chr(c)}a {chr(c)} {chr(c)}0{chr(c)}.'s" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 61 == 0)]
    assert pretokens(texts) == [split(t) for t in texts]


def test_each_distinct_pretoken_is_looked_up_once_for_texts_together(monkeypatch):
    asked = []
    own = packing._Encoder(PATH)
    monkeypatch.setattr(own, "_ids", lambda pieces, f=own._ids: asked.append(len(pieces)) or f(pieces))
    texts = ["the thndou of the\n9 é"] * 300 + ["of it's the", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(texts)] == [ids(t) for t in texts]
    assert asked == [len({p for t in texts for p in split(t)})]


def test_what_is_remembered_is_bounded_and_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 20)
    chance = random.Random(13)
    own = packing._Encoder(PATH)
    for n in (3, 60, 5, 4, 7, 9):
        texts = [" ".join("".join(chance.choices("etaoiné", k=4)) for _ in range(n)) for _ in range(3)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(texts)] == [ids(t) for t in texts]
        assert len(own.known) <= 20


def test_groups():
    size = packing.CHUNK
    assert list(packing._groups([1, 0, size, 2, size - 2, 1, 2 * size, 0])) == [(0, 2), (2, 3), (3, 5), (5, 6), (6, 7), (7, 8)]
    assert list(packing._groups([0, 0])) == [(0, 2)]


def test_plan_uses_up_the_histogram():
    chance = random.Random(6)
    for size, n in ((8, 40), (64, 500), (64, 3), (16, 0)):
        lengths = [chance.randint(1, size) for _ in range(n)]
        histogram = np.bincount(lengths, minlength=size + 1)
        used = np.zeros(size + 1, int)
        sequences = 0
        for contents, times in packing.plan(histogram):
            assert sum(contents) <= size and times > 0
            sequences += times
            for x in contents:
                used[x] += times
        assert (used == histogram).all()
        least = -(-sum(lengths) // size)
        assert sequences <= max(least + 2, 1.1 * least + 1)


def test_fit_recovers_patterns():
    rows = packing.patterns(16)
    assert (rows.sum(1) == 16).all() and len({tuple(r) for r in rows}) == len(rows)
    histogram = np.zeros(17, int)
    histogram[[9, 7]] = 1000
    x = packing.fitted(histogram, rows, 2000)
    assert x[(rows == [9, 7, 0]).all(1)][0] > 950


def test_plan_does_not_grow_with_counts():
    histogram = np.arange(65)
    assert len(packing.plan(histogram * 10**9)) < 4 * len(packing.patterns(64))


def check(got, texts):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in texts.items():
        whole, rows = ids(text), sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        at = 0
        for r in rows:
            assert r.start == at and (r.length == 1024 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(whole) and len(rows) == -(-len(whole) // 1024)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_query(spark, parquet):
    chance = random.Random(8)
    texts = {i: " ".join(chance.choice(["the", "of", "thndou", "9", "é"]) for _ in range(chance.randint(0, 900))) for i in range(80)}
    texts |= {100: None, 101: "", 102: "word " * 9000, 103: "a" * 1023, 104: " the" * 1023, 105: " the" * 1024}
    folder = parquet("documents", [(i, t, 5) for i, t in texts.items()], "doc_id bigint, text string, length int")
    got = QUERIES["op6_pattern_packing"](spark, folder).collect()
    check(got, texts)
    total = sum(len(ids(t)) for t in texts.values())
    assert len({r.sequence_id for r in got}) <= -(-total // 1024) + 2


def test_repeated_rows_and_null_ids(spark, parquet):
    folder = parquet("documents", [(1, "a b")] * 5 + [(None, "c")] * 3, "doc_id bigint, text string")
    got = QUERIES["op6_pattern_packing"](spark, folder).collect()
    assert len(got) == 8 and len({(r.sequence_id, r.offset) for r in got}) == 8


def test_empty_table(spark, parquet):
    assert QUERIES["op6_pattern_packing"](spark, parquet("documents", [], "doc_id bigint, text string")).collect() == []
