"""Splitting text into the pieces of a byte-level tokenizer, with array operations.

The split is that of `public_tokenizers.PATTERN`: contractions, then runs of
letters, numbers or other characters with at most one space before them, then
white space, whose last character is left to the following run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken

OTHER, LETTER, NUMBER, SPACE = range(4)
SEGMENT_CHARS = 1 << 18
_POINTS_AT_ONCE = 1 << 14
# a space after a plain letter or digit always begins a piece, so text may be cut there
_SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9])(?= )")
_ONE, _TWO = frozenset("stmd"), frozenset(("re", "ve", "ll"))


@lru_cache(1)
def kinds() -> np.ndarray:
    """Kind of every code point, by the Unicode classes the pattern names.

    The classes are asked of the tokenizer library itself, whose Unicode version
    counts: with single bytes as tokens it returns just what a pattern matches.
    """
    out = np.zeros(0x110000, np.uint8)
    points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        matcher = tiktoken.Encoding("class", pat_str=name, special_tokens={},
                                    mergeable_ranks={bytes([b]): b for b in range(256)})
        for at in range(0, len(points), _POINTS_AT_ONCE):
            matched = bytes(matcher.encode_ordinary(points[at:at + _POINTS_AT_ONCE])).decode()
            out[code_points(matched)] = kind
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that less of them is held as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def segments(text: str) -> Iterator[str]:
    """`text` in parts of bounded length, as far as it has a place where cutting changes no piece."""
    at = 0
    while len(text) - at > SEGMENT_CHARS:
        cut = _SAFE_CUT.search(text, at + SEGMENT_CHARS)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Places of `points` at which a piece begins."""
    if not len(points):
        return np.zeros(0, np.int64)
    kind = kinds()[points]
    start = np.empty(len(points), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    last_space = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
    start[last_space] = True
    start[last_space[points[last_space] == 32] + 1] = False
    quotes = np.flatnonzero(points == 39)
    for i in quotes[start[quotes]].tolist():
        ahead = "".join(map(chr, points[i + 1:i + 3].tolist()))
        size = 2 if ahead[:1] in _ONE else 3 if ahead in _TWO else 0
        if size:
            start[i + 1] = False
            if i + size < len(points) and kind[i + size] == LETTER:
                start[i + size] = True
    return np.flatnonzero(start)


def byte_widths(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each code point."""
    return (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)


def byte_pieces(text: str) -> list[bytes]:
    """The UTF-8 pieces of `text`."""
    if not text:
        return []
    data = text.encode()
    points = np.frombuffer(data, np.uint8) if len(data) == len(text) else code_points(text)
    starts = piece_starts(points)
    if len(data) != len(text):
        ends_of = np.concatenate(([0], np.cumsum(byte_widths(points))))
        starts = ends_of[starts]
    cuts = starts.tolist()
    return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
