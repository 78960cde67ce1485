"""Hashes of all words of a batch of texts, computed with array operations.

A running polynomial over the bytes of a block gives the hash of any stretch of
it from two of its values, so words and their prefixes are hashed without a
loop. Hashes are 64 bits wide and depend on the bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

# letters, digits and all bytes of characters beyond ASCII make words
WORD_BYTE = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    WORD_BYTE[_a:_b] = True


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, BLOCK_BYTES + 4096), base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Block:
    """Words of some texts: `doc`, `start` and `end` of each, and hashes of stretches."""

    def __init__(self, parts: list[tuple[int, bytes]]):
        data = b"\n".join(x for _, x in parts)
        self.raw = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = WORD_BYTE[self.raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        sizes = np.fromiter((len(x) + 1 for _, x in parts), np.int64, len(parts))
        first = np.cumsum(sizes) - sizes
        of = np.searchsorted(first, self.start, "right") - 1
        self.doc = np.fromiter((d for d, _ in parts), np.int64, len(parts))[of]
        self.run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data))[:len(data)],
                  out=self.run[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.run[end] - self.run[start])
                     * _power(_INVERSE, len(self.raw) + 1)[start])

    def words(self) -> np.ndarray:
        return self.hashes(self.start, self.end)


def _parts(text: str) -> Iterator[bytes]:
    """Lower-case UTF-8 of `text`, in parts that end between words where there is a place."""
    data = text.lower().encode()
    while len(data) > BLOCK_BYTES:
        cut = data.rfind(b" ", 1, BLOCK_BYTES) if b" " in data[1:BLOCK_BYTES] else BLOCK_BYTES
        yield data[:cut]
        data = data[cut:]
    yield data


def blocks(texts: list[str | None]) -> Iterator[Block]:
    """Blocks of about a megabyte with all words of `texts`; `doc` is the place in the list.

    Texts are taken whole; a word is cut only if it is longer than a block.
    """
    parts, size = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for part in _parts(text):
            parts.append((i, part))
            size += len(part)
            if size >= BLOCK_BYTES:
                yield Block(parts)
                parts, size = [], 0
    if parts:
        yield Block(parts)
