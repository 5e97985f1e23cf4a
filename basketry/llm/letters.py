"""Words of letters in many texts at once, with offsets in code points.

Texts are joined with line feeds and taken as one array of code points; lower
case is a code-point table (one to one, so offsets stay those of the text).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

from .flat import Words, mix, span_hashes, spans

#: Code points of one slice, unless a single text is longer.
SLICE = 1 << 19


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: is it a letter, a decimal digit, its lower case if one code point."""
    points = [chr(c) for c in range(0x110000)]
    letter = np.fromiter((c.isalpha() for c in points), bool, len(points))
    lower = np.arange(len(points), dtype=np.uint32)
    for c in np.flatnonzero(letter):
        low = points[c].lower()
        if len(low) == 1:
            lower[c] = ord(low)
    digit = np.fromiter((c.isdecimal() for c in points), bool, len(points))
    return letter, digit, lower


def text_slices(texts: list) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE`` characters (null counts as empty)."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        n = len(t) if t else 0
        if size + n > SLICE and j > i:
            yield i, j
            i, size = j, 0
        size += n
    if i < len(texts):
        yield i, len(texts)


class LetterWords:
    """Words of some texts: lowered code points, ranges, hashes, first word of each text.

    With ``digits``, words hold digits too, each taken as 0.
    """

    def __init__(self, texts: list, digits: bool = False):
        letter, digit, lower = tables()
        texts = [t or "" for t in texts]
        raw = "\n".join(texts).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        #: where each text starts among the code points (one line feed between texts)
        self.at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=self.at[1:])
        self.at[-1] -= bool(len(texts))
        self.codes = lower[codes]
        inside = letter[codes]
        if digits:
            number = digit[codes]
            self.codes[number] = ord("0")
            inside |= number
        w: Words = spans(self.codes, self.at, inside)
        self.starts, self.ends, self.first = w.starts, w.ends, w.first
        self.hashes = span_hashes(self.codes, self.starts, self.ends, mix(self.codes))
        self.count = np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[s:s + n]`` for each range."""
    return values[ranges(starts, sizes)]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + n)`` for each range."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)
