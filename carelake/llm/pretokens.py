"""Pre-tokens: the pieces that a byte-level tokenizer's pattern cuts a text into.

The cut runs in `re`, with a pattern of its own that cuts alike: its first alternative is the most common one, and no
character can begin both that and a contraction. `re` classes some code points unlike the tokenizer libraries; for the
cut only, these are replaced by one of the right class. Where many texts are cut at once, numpy compares the library's
classes of neighbouring code points instead (`places`).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken

# The pattern that the vocabularies come with, and the classes it is made of.
PATTERN = public_tokenizers.PATTERN
_SAME_CUT = re.compile(r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_CLASSES = {r"\p{L}": r"[^\W\d_]", r"\p{N}": r"\d", r"\s": r"\s"}
_LIKE = {r"\p{L}": "a", r"\p{N}": "0", r"\s": "\t", "": "§"}


def _points() -> str:
    """All code points that a text may hold."""
    return "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))


def _of_class(name: str, points: str) -> str:
    """Those of the code points that the tokenizer library puts in a class, found by asking it."""
    single = {bytes([i]): i for i in range(256)}
    library = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
    return bytes(library.encode_ordinary(points)).decode()


@cache
def _stand_ins() -> dict[int, str]:
    """Code points that the tokenizer library classes unlike `re`."""
    points = _points()
    theirs, ours = {}, {}
    for name, own in _CLASSES.items():
        theirs |= dict.fromkeys(_of_class(name, points), name)
        ours |= dict.fromkeys(re.findall(own, points), name)
    odd = (c for c in theirs.keys() | ours.keys() if theirs.get(c, "") != ours.get(c, ""))
    return {ord(c): _LIKE[theirs.get(c, "")] for c in odd}


@cache
def _maybe_odd():
    """Search for the odd code points, of those beyond the basic plane for any."""
    low = sorted(c for c in _stand_ins() if c < 0x10000)
    ranges: list[list[int]] = []
    for c in low:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return re.compile("[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges) + "\\U00010000-\\U0010ffff]").search


def _regular(text: str) -> str:
    """The text itself, or one of as many code points that `re` cuts as the library would cut the text."""
    return text.translate(_stand_ins()) if _maybe_odd()(text) else text


def split(text: str) -> list[str]:
    """The pre-tokens of a text, which together are the text."""
    regular = _regular(text)
    if regular is text or regular == text:
        return _SAME_CUT.findall(text)
    return [text[m.start() : m.end()] for m in _SAME_CUT.finditer(regular)]


def cuts(text: str, start: int) -> Iterator[str]:
    """The pre-tokens from code point `start` on, one at a time, as if the text began there."""
    return (text[m.start() : m.end()] for m in _SAME_CUT.finditer(_regular(text), start))


@cache
def _class_numbers() -> np.ndarray:
    """By code point the number of its class: 0 white space, 1 letters, 2 numbers, 3 all others."""
    numbers, points = np.full(sys.maxunicode + 1, 3, np.uint8), _points()
    for number, name in enumerate((r"\s", r"\p{L}", r"\p{N}")):
        numbers[np.frombuffer(_of_class(name, points).encode("utf-32-le"), "<u4")] = number
    return numbers


def places(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts in UTF-8, one after another; where each pre-token begins there, and the end; how many each text has."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    n = len(points)
    first = np.zeros(n + 1, bool)  # a text begins here, or all end
    first[0], first[ends] = True, True
    kind = _class_numbers()[points]
    begins = first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    # the last white space before something else stands alone, or begins it if it is a space
    after = 1 + np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~first[1:n])
    begins[after - 1] = True
    begins[after[points[after - 1] == 0x20]] = False
    # contractions: an apostrophe that begins a pre-token, and the letters behind it in the same text
    quote = np.flatnonzero((points == ord("'")) & begins[:n])
    if len(quote):
        stop = ends[np.searchsorted(ends, quote, "right")]
        for letters in ("s", "t", "m", "d", "re", "ve", "ll"):
            fits = quote[quote + len(letters) < stop]
            for k, letter in enumerate(letters, 1):
                fits = fits[points[fits + k] == ord(letter)]
            begins[fits + 1] = False
            begins[fits + 1 + len(letters)] = True
    at = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(at, ends), prepend=0)
    if joined.isascii():
        return joined.encode(), at, counts
    widths = np.ones(n + 1, np.uint8)
    for low in (0x80, 0x800, 0x10000):
        widths[1:] += points >= low
    widths[0] = 0
    return joined.encode(), np.cumsum(widths, dtype=np.int32)[at], counts


class Memo(dict):
    """Results by pre-token, filled on first use and emptied when it holds `most`; a task needs no more memory."""

    def __init__(self, make, most: int = 600_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece: str):
        if len(self) >= self.most:
            self.clear()
        value = self[piece] = self.make(piece)
        return value
