"""Byte-level BPE encoding and decoding over documents.

Two tiers: a minimal perfect hash of the vocabulary resolves pieces that are
tokens as a whole; the other pieces are merged with a heap of ranked pairs over
a linked list of their bytes. Results of either tier are kept per worker in a
cache of bounded size, so frequent words are looked up once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, types as T

from .pieces import byte_pieces, segments, slices

CACHE_PIECES = 250_000
CACHED_BYTES = 64
_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash by displacement: every key has a slot of its own, none is empty."""

    def __init__(self, keys: Iterable[bytes]):
        keys = list(keys)
        self.size = len(keys)
        self.buckets = max(1, self.size)
        self.shift = [0] * self.buckets
        self.slots: list[bytes] = [b""] * self.size
        hashed: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            h = xxhash.xxh64_intdigest(key)
            hashed[h % self.buckets].append((h, key))
        taken = bytearray(self.size)
        order = sorted(range(self.buckets), key=lambda b: -len(hashed[b]))
        free = None
        for b in order:
            if not hashed[b]:
                break
            if len(hashed[b]) == 1:  # a single key takes any slot that is left
                free = free if free is not None else iter(
                    [i for i in range(self.size) if not taken[i]])
                places, self.shift[b] = [at := next(free)], -at - 1
            else:
                step = 0
                while True:
                    places = [self._slot(h, step) for h, _ in hashed[b]]
                    if len({*places}) == len(places) and not any(taken[p] for p in places):
                        break
                    step += 1
                self.shift[b] = step
            for place, (_, key) in zip(places, hashed[b]):
                taken[place], self.slots[place] = 1, key

    def _slot(self, h: int, step: int) -> int:
        mixed = ((h ^ step * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93) & _MASK
        return ((mixed >> 32) * self.size) >> 32

    def find(self, key: bytes) -> int:
        """Slot of `key`, or -1 if it is not one of the keys."""
        if not self.size:
            return -1
        h = xxhash.xxh64_intdigest(key)
        step = self.shift[h % self.buckets]
        slot = -step - 1 if step < 0 else self._slot(h, step)
        return slot if self.slots[slot] == key else -1


class Vocabulary:
    """Tokens by rank, with the lookups of both tiers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.whole = PerfectHash(ranks)
        self.rank_at = [ranks[token] for token in self.whole.slots]
        self.byte_rank = [ranks.get(bytes([b]), -1) for b in range(256)]
        # pairs are ranked by the token they form, however it is cut in two
        self.bits = bits = max(ranks.values(), default=0).bit_length()
        self.pairs = {
            ranks[token[:i]] << bits | ranks[token[i:]]: rank
            for token, rank in ranks.items() for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks}

        self.byte_pair = [-1] * 65536
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pair[token[0] << 8 | token[1]] = rank
        self.cache: PieceCache | None = None

    def worker_cache(self) -> PieceCache:
        """The cache of this worker process, kept from task to task."""
        if self.cache is None:
            self.cache = PieceCache(self)
        return self.cache

    def encode_piece(self, piece: bytes) -> list[int]:
        slot = self.whole.find(piece)
        return [self.rank_at[slot]] if slot >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked pair, leftmost first, until no pair is a token."""
        pairs, bits = self.pairs.get, self.bits
        ids = [self.byte_rank[b] for b in piece]
        n = len(ids)
        # rank of the pair that begins at each byte; a heap entry of another rank is out of date
        first = self.byte_pair
        ranked = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        ranked.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [rank << 32 | i for i, rank in enumerate(ranked) if rank >= 0]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if ranked[i] != rank:
                continue
            j = after[i]
            k = after[j]
            ids[i], ids[j], ranked[j] = rank, -1, -1
            after[i] = k
            if k < n:
                before[k] = i
                ranked[i] = new = pairs(rank << bits | ids[k], -1)
                if new >= 0:
                    heappush(heap, new << 32 | i)
            else:
                ranked[i] = -1
            h = before[i]
            if h >= 0:
                ranked[h] = new = pairs(ids[h] << bits | rank, -1)
                if new >= 0:
                    heappush(heap, new << 32 | h)
        return [x for x in ids if x >= 0]


class PieceCache(dict):
    """Little-endian ids of pieces seen so far; emptied when full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.vocabulary.encode_piece(piece)
        ids = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_text(text: str, cache: PieceCache) -> bytes:
    """Ids of `text` as little-endian unsigned 32-bit integers."""
    look = cache.__getitem__
    return b"".join([b"".join(map(look, byte_pieces(part))) for part in segments(text)])


def decode_ids(ids: bytes, bytes_of: dict[int, bytes]) -> bytes:
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _schema(docs: DataFrame, id_column: str, *fields: T.StructField) -> T.StructType:
    return T.StructType([docs.schema[id_column], *fields])


def _encode(batches: Iterator[pa.RecordBatch], vocabulary,
            decoded: bool) -> Iterator[pa.RecordBatch]:
    cache, bytes_of = vocabulary.value.worker_cache(), vocabulary.value.bytes_of
    for batch in slices(batches):
        ids = [encode_text(text or "", cache) for text in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                   pa.array(ids, pa.binary())]
        if decoded:
            columns.append(pa.array([hashlib.sha256(decode_ids(x, bytes_of)).hexdigest()
                                     for x in ids], pa.string()))
        yield pa.RecordBatch.from_arrays(
            columns, ["id", "n_tokens", "ids", "decoded_sha256"][:len(columns)])


def encode(docs: DataFrame, ranks_path: str, text: str = "text", id_column: str = "doc_id",
           decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids) of every row; `ids` holds little-endian unsigned 32-bit integers.

    `decoded` adds `decoded_sha256`, the digest of the bytes that the ids decode to.
    A null text counts as empty and has no ids; repeated rows are encoded each;
    other columns are ignored. Special-token strings are ordinary text. The
    vocabulary is broadcast: its size is that of the file. Texts are encoded
    whole, in parts cut only where no piece changes.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(ranks_path)))
    schema = _schema(docs, id_column, T.StructField("n_tokens", T.LongType()),
                     T.StructField("ids", T.BinaryType()),
                     *([T.StructField("decoded_sha256", T.StringType())] if decoded else []))
    return docs.select(id_column, text).mapInArrow(
        partial(_encode, vocabulary=vocabulary, decoded=decoded), schema)


def _decode(batches: Iterator[pa.RecordBatch], ranks) -> Iterator[pa.RecordBatch]:
    bytes_of = {rank: token for token, rank in ranks.value.items()}
    for batch in slices(batches):
        data = [None if ids is None else decode_ids(ids, bytes_of)
                for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())],
                                         ["id", "bytes"])


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids",
           id_column: str = "doc_id") -> DataFrame:
    """(id, bytes) of every row of ids as `encode` makes them; null ids give null."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = _schema(encoded, id_column, T.StructField("bytes", T.BinaryType()))
    return encoded.select(id_column, ids).mapInArrow(partial(_decode, ranks=ranks), schema)


def _round_trip(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    cache, bytes_of = vocabulary.value.worker_cache(), vocabulary.value.bytes_of
    for batch in slices(batches):
        rows = []
        for text in batch.column(1).to_pylist():
            ids = encode_text(text or "", cache)
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                         hashlib.sha256(decode_ids(ids, bytes_of)).hexdigest()))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(columns[0], pa.int64()),
             pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(docs: DataFrame, ranks_path: str, text: str = "text",
               id_column: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of their decoded bytes.

    Encodes and decodes in one pass, so that neither ids nor bytes leave the
    worker. Same rules for nulls and repeated rows as `encode`.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(ranks_path)))
    schema = _schema(docs, id_column, T.StructField("n_tokens", T.LongType()),
                     T.StructField("ids_sha256", T.StringType()),
                     T.StructField("decoded_sha256", T.StringType()))
    return docs.select(id_column, text).mapInArrow(
        partial(_round_trip, vocabulary=vocabulary), schema)
