"""Operator 1 against the tiktoken library."""

from __future__ import annotations

import hashlib
import random
import sys

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from carelake.llm import bpe
from carelake.llm.pretokens import split
from carelake.llm.queries import QUERIES

PATH = public_tokenizers.path(bpe.VOCABULARY)
OWN = bpe.vocabulary(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})


def same(text: str) -> None:
    ids = OWN.encode(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    same(text)


def test_texts_that_need_backtracking():
    chance = random.Random(1)
    for pool in ("ab", "aaab ", "etaoin shrdlu", "  \n\t'sdlltrem", "0123456789", "日本語", "éèüß", "!?.,-=_*#"):
        for _ in range(150):
            same("".join(chance.choice(pool) for _ in range(chance.randint(0, 120))))


def test_long_texts_without_spaces():
    same("ab" * 20_000)
    same("a" * 30_000)
    same("\n" * 5_000 + "x")


def test_every_code_point_is_cut_as_the_library_cuts():
    """Cut a text of all code points, each between letters, by the library: one id per byte, a letter ends a run."""
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    single = {bytes([i]): i for i in range(256)}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        library = tiktoken.Encoding("class", pat_str=f" ?(?:{name})+", mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(library.encode_ordinary("".join(map(chr, points)))).decode())
        like = {r"\p{L}": "a", r"\p{N}": "1", r"\s": "\t"}[name]
        sample = [c for c in points if c % 97 == 0 or c < 0x300]
        for c in sample:
            joined = len(split(f"{like}{chr(c)}{like}")) == 1
            assert joined == (chr(c) in theirs) or chr(c) == " ", hex(c)


def test_unreachable_entries_count_as_whole_pretokens_only(tmp_path):
    """An entry that no merges lead to is used where it is the whole pre-token, and nowhere else."""
    import base64
    entries = [bytes([i]) for i in range(256)] + [b"xyz"]
    path = tmp_path / "ranks"
    path.write_text("".join(f"{base64.b64encode(b).decode()} {i}\n" for i, b in enumerate(entries)))
    own = bpe.Vocabulary(str(path))
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for text in ("xyz", "xyzx", " xyz", "xyz xyz"):
        assert own.encode(text).tolist() == library.encode_ordinary(text)


def test_query(spark, parquet):
    texts = {1: "Hello's  world\n", 2: None, 3: "", 4: "ab" * 40_000, 5: "<|endoftext|> \x1c½²"}
    rows = [(k, v, 7) for k, v in texts.items()] + [(1, texts[1], 7), (None, "x", 7)]
    folder = parquet("documents", rows, "doc_id bigint, text string, ids int")
    found = QUERIES["op1_byte_bpe"](spark, folder).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "x" if r.doc_id is None else texts[r.doc_id] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark, parquet):
    assert QUERIES["op1_byte_bpe"](spark, parquet("documents", [], "doc_id bigint, text string")).collect() == []
