"""Exact token counts of every prefix of a text, by dynamic programming.

A sequence of tokens is what byte-pair encoding makes of its bytes if each two
neighbours are what it makes of theirs. So the last token of every prefix of a
piece is the one token that ends there and goes with the last token of the
prefix before it, and the count is one more than that prefix has. Counts of the
prefixes of a text follow by adding those of its pieces. They are stored as
steps from one character to the next, from which truncation and budget
questions are answered without encoding anything again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .bpe import Vocabulary
from .pieces import SPACE, byte_widths, code_points, kinds, piece_starts, segments, slices

CACHE_PIECES = 1_200_000
CACHE_PAIRS = 1_500_000
CACHED_CHARS = 32


def read_library_file(path: str) -> tuple[dict[bytes, int], list[str]]:
    """Ranks of the tokens of a byte-level BPE file in JSON, and its special strings.

    Bytes that are not printable stand as letters from U+0100 on in such files.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = [x["content"] for x in told["added_tokens"]]
    ranks = {bytes(byte_of[c] for c in token): rank
             for token, rank in told["model"]["vocab"].items() if token not in special}
    return ranks, special


class PrefixTable(dict):
    """Steps of the token count over the characters of pieces seen so far; emptied when full."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.vocabulary = Vocabulary(ranks)
        self.ranks = ranks
        self.tails = {token[i:] for token in ranks for i in range(1, len(token))}
        self.fits: dict[int, bool] = {}

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether the bytes of the two tokens are encoded as these two; left is -1 at the start."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            of = self.vocabulary.bytes_of
            told = [right] if left < 0 else [left, right]
            known = self.fits[key] = self.vocabulary.merge(b"".join(of[x] for x in told)) == told
        return known

    def byte_counts(self, piece: bytes) -> list[int]:
        """Tokens of piece[:i] for every i."""
        ranks, tails, fits = self.ranks.get, self.tails, self.pair_fits
        known = self.fits.get
        counts, last = [0] * (len(piece) + 1), [-1] * (len(piece) + 1)
        for end in range(1, len(piece) + 1):
            start, ending = end - 1, []
            while start >= 0:
                token = piece[start:end]
                rank = ranks(token)
                if rank is not None:
                    ending.append((start, rank))
                if token not in tails:
                    break  # no longer token ends with these bytes
                start -= 1
            for start, rank in reversed(ending):  # the longest is the likeliest
                before = last[start]
                fit = known(before << 32 | rank)
                if fits(before, rank) if fit is None else fit:
                    counts[end], last[end] = counts[start] + 1, rank
                    break
            else:
                raise ValueError("a byte is missing in the vocabulary")
        return counts

    def __missing__(self, piece: str) -> bytes:
        """Little-endian 16-bit steps of the count, one for each character of `piece`."""
        data = piece.encode()
        counts = self.byte_counts(data)
        if len(data) != len(piece):
            ends = np.cumsum(byte_widths(code_points(piece))).tolist()
            counts = [0, *[counts[e] for e in ends]]
        if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():
            # until its last letter comes, a contraction is a quote and a letter
            counts[2] = counts[1] + 1
        steps = pack(f"<{len(piece)}h", *[b - a for a, b in zip(counts, counts[1:])])
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = steps
        return steps

    def total(self, piece: str) -> int:
        return int(np.frombuffer(self[piece], "<i2").sum())


def _plain_steps(text: str, table: PrefixTable) -> np.ndarray:
    """Steps over a text without special strings."""
    if not text:
        return np.zeros(0, np.int16)
    points = code_points(text)
    starts = piece_starts(points)
    cuts = starts.tolist()
    steps = np.frombuffer(bytearray(b"".join(
        [table[text[a:b]] for a, b in zip(cuts, [*cuts[1:], len(text)])])), "<i2")
    # a prefix that ends with white space has that white space as one piece, also where
    # its last character belongs to what follows
    space = kinds()[points] == SPACE
    edges = np.flatnonzero(np.diff(np.concatenate(([False], space, [False])).view(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    wide = (ends - begins > 1) & (ends < len(points))
    for a, b in zip(begins[wide].tolist(), ends[wide].tolist()):
        more = table.total(text[a:b]) - table.total(text[a:b - 1]) - table.total(text[b - 1])
        steps[b - 1] += more
        steps[b] -= more
    return steps


def text_steps(text: str, table: PrefixTable, special: re.Pattern | None) -> np.ndarray:
    """Steps of the token count over all characters of `text`."""
    parts, at = [], 0
    for match in special.finditer(text) if special else ():
        before = text[at:match.start()]
        parts += [_plain_steps(part, table) for part in segments(before)]
        # inside a special string its beginning is ordinary text, which may join the last piece
        tail = before[int(piece_starts(code_points(before))[-1]):] if before else ""
        base = int(_plain_steps(tail, table).sum())
        joined = [int(_plain_steps(tail + match.group()[:i], table).sum()) - base
                  for i in range(1, len(match.group()))]
        parts.append(np.diff(np.array([0, *joined, 1])).astype(np.int16))
        at = match.end()
    parts += [_plain_steps(part, table) for part in segments(text[at:])]
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


class _Worker:
    """What a worker process keeps from task to task."""

    def __init__(self, ranks: dict[bytes, int], special: list[str]):
        self.ranks, self.special, self.table = ranks, special, None

    def ready(self) -> tuple[PrefixTable, re.Pattern | None]:
        if self.table is None:
            self.table = PrefixTable(self.ranks)
            longest_first = sorted(self.special, key=len, reverse=True)
            self.pattern = re.compile("|".join(map(re.escape, longest_first))) \
                if longest_first else None
        return self.table, self.pattern


def _count(batches: Iterator[pa.RecordBatch], worker) -> Iterator[pa.RecordBatch]:
    table, special = worker.value.ready()
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in slices(batches):
        sizes, totals, stored = [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            steps = text_steps(text, table, special)
            sizes.append(len(text.encode()))
            totals.append(int(steps.sum(dtype=np.int64)))
            stored.append(squeeze(steps.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
             pa.array(stored, pa.binary())], ["id", "n_bytes", "n_tokens", "prefix_steps"])


def prefix_counts(docs: DataFrame, library_path: str, text: str = "text",
                  id_column: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_tokens, prefix_steps) of every row.

    `prefix_steps` holds, compressed, by how much the token count changes with
    each character; `count_at` and `fitting_prefix` read it. A null text counts
    as empty (no bytes, no tokens); repeated rows are counted each; other
    columns are ignored. Special strings count as one token, as the library has
    it by default. The vocabulary is broadcast: its size is that of the file.
    """
    worker = docs.sparkSession.sparkContext.broadcast(_Worker(*read_library_file(library_path)))
    schema = T.StructType([docs.schema[id_column], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("prefix_steps", T.BinaryType())])
    return docs.select(id_column, text).mapInArrow(partial(_count, worker=worker), schema)


def _counts(stored: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(stored), "<i2"),
                     dtype=np.int64)


def count_at(steps: Column, chars: Column) -> Column:
    """Tokens of the first `chars` characters; all of them if the text is shorter."""
    @F.pandas_udf("long")
    def read(stored: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or pd.isna(n) else
                          0 if n <= 0 or not len(c := _counts(s)) else int(c[min(n, len(c)) - 1])
                          for s, n in zip(stored, wanted)], dtype="Int64")
    return read(steps, chars)


def fitting_prefix(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix that has at most `budget` tokens."""
    @F.pandas_udf("long")
    def read(stored: pd.Series, budgets: pd.Series) -> pd.Series:
        out = []
        for s, limit in zip(stored, budgets):
            if s is None or pd.isna(limit):
                out.append(None)
                continue
            fit = np.flatnonzero(_counts(s) <= limit)
            out.append(int(fit[-1]) + 1 if len(fit) else 0)
        return pd.Series(out, dtype="Int64")
    return read(steps, budget)
