"""Phrases whose words occur together more often than apart, from one word index per shard.

Texts are gathered into shards of one language. A shard's index holds the
Burrows-Wheeler transform of its word ids and that of the reversed ids, sorted
as deep as the longest phrase. A phrase is a range of rows in either; the words
in one transform's range are all its extensions to the left, those in the other
all extensions to the right, with their counts, and both ranges of an extended
phrase follow from them. So phrases grow at both ends, all of one length at a
time, and their counts are summed across shards.

Counts of phrases are first summed by hash: many more places than phrases, each
shard's part packed. A phrase whose place stays below the limit is not frequent;
of the others, the exact counts are summed, packed alike. What may be frequent goes to the
shards as a Bloom filter of bounded size. Both only spare work: what they let
through wrongly fails the exact counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import stored

LEAST_COUNT = 100
MOST_WORDS = 5
TOP = 2000
SHARD_BYTES = 8 << 20         # text gathered by a task before it writes its shards
FILTER_BITS = 1 << 30         # largest filter; 12 bits a phrase below that
_PLACE_BITS = 24              # places of one part of the counts by hash
_SHARDS_PER_PART = 4          # so many shards' phrases share a part, however many there are
_SEGMENT_BITS = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)

# bytes of words, blanks between words, and marks that end a piece
_BREAK, _BLANK, _WORD = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_KIND[list(b" \t")] = _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def symbols(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The texts as one sequence of word ids from 1 on, 0 between pieces, and the words."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _KIND[raw]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = kind == _WORD
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(2, np.int32), pa.array([], pa.binary())
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    told = pa.Array.from_buffers(
        pa.large_binary(), len(start),
        [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside[1:-1] == 1]])]
    ).dictionary_encode()
    piece = np.cumsum(kind == _BREAK)[start]
    place = np.arange(1, len(start) + 1)
    place[1:] += np.cumsum(piece[1:] != piece[:-1])
    out = np.zeros(place[-1] + 2, np.int32)
    out[place] = told.indices.to_numpy() + 1
    return out, told.dictionary.cast(pa.binary())


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The symbols before all suffixes, with the suffixes sorted by their first `depth` symbols."""
    ranks, length = {1: ids.astype(np.int64)}, 1
    while length < depth:
        step = max(n for n in ranks if n <= depth - length)
        after = np.append(ranks[step][length:], np.zeros(length, np.int64))[:len(ids)]
        _, joined = np.unique(ranks[length] * (after.max() + 1) + after, return_inverse=True)
        length += step
        ranks[length] = joined
    order = np.argsort(ranks[length], kind="stable")
    return ids[order - 1]


@dataclass
class Phrases:
    """Phrases of one length in one index: their words and row ranges in both transforms."""

    words: np.ndarray     # one row each
    lo: tuple[np.ndarray, np.ndarray]
    count: np.ndarray

    def only(self, some: np.ndarray) -> Phrases:
        return Phrases(self.words[some], (self.lo[0][some], self.lo[1][some]), self.count[some])


class Index:
    """Word index of a shard, searched at both ends: side 0 extends to the left, 1 to the right."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.side = left, right
        self._by_symbol: list[np.ndarray | None] = [None, None]
        self.counts = np.bincount(left)
        self.first = np.cumsum(self.counts) - self.counts

    @classmethod
    def of(cls, ids: np.ndarray, depth: int) -> Index:
        return cls(transform(ids, depth), transform(ids[::-1], depth))

    def single(self) -> Phrases:
        words = np.arange(1, len(self.counts))
        return Phrases(words[:, None], (self.first[1:], self.first[1:]), self.counts[1:])

    def extended(self, phrases: Phrases, side: int) -> Phrases:
        """Every phrase with one more word on `side`, for all its words there."""
        if self._by_symbol[side] is None:
            self._by_symbol[side] = np.argsort(self.side[side], kind="stable")
        by_symbol, near, far = self._by_symbol[side], phrases.lo[side], phrases.lo[1 - side]
        total = int(phrases.count.sum())
        owner = np.full(len(by_symbol), -1, np.int32)
        begin = np.cumsum(phrases.count) - phrases.count
        rows = np.arange(total) + np.repeat(near - begin, phrases.count)
        owner[rows] = np.repeat(np.arange(len(near), dtype=np.int32), phrases.count)
        # rows in order of their symbol: equal (symbol, phrase) lie together, and the place of
        # the first one is where the range of the extended phrase begins
        place = np.flatnonzero(owner[by_symbol] >= 0)
        of, symbol = owner[by_symbol[place]], self.side[side][by_symbol[place]]
        new = np.ones(len(place), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(place)))
        of, symbol, place = of[at], symbol[at], place[at]
        # in the other transform the range is split by the new word, in order
        order = np.lexsort((symbol, of))
        before = np.cumsum(count[order]) - count[order]
        opens = np.ones(len(order), bool)
        opens[1:] = of[order][1:] != of[order][:-1]
        head = np.flatnonzero(opens)
        smaller = np.empty_like(before)
        smaller[order] = before - np.repeat(before[head], np.diff(np.append(head, len(order))))
        lo = [place, far[of] + smaller]
        added, rest = symbol[:, None], phrases.words[of]
        grown = Phrases(np.hstack([added, rest] if side == 0 else [rest, added]),
                        (lo[0], lo[1]) if side == 0 else (lo[1], lo[0]), count)
        return grown.only(symbol > 0)


def _keys(hashes: np.ndarray, lang: str | None) -> np.ndarray:
    """One 64-bit key per row of word hashes; the language and all words count."""
    key = np.full(len(hashes), xxhash.xxh3_64_intdigest((lang or "").encode()), np.uint64)
    for i in range(hashes.shape[1]):
        key = (key ^ hashes[:, i]) * _STEP
        key ^= key >> np.uint64(29)
    return key


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _bits(places: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Segment of the filter, and the bits in it, that stand for each place."""
    mixed = (places.astype(np.uint64) + np.uint64(1)) * _STEP
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    segment = (mixed >> np.uint64(1)) % np.uint64(max(1, bits // _SEGMENT_BITS))
    size = np.uint64(min(bits, _SEGMENT_BITS))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return segment.astype(np.int64), [
        ((mixed >> np.uint64(shift)) % size).astype(np.int64) for shift in (0, 15, 30, 44)]


def _places(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys % np.uint64(parts << _PLACE_BITS)).astype(np.int64)


@dataclass
class Filter:
    """The places of phrases that may be frequent."""

    parts: int
    bits: int
    data: np.ndarray    # packed, eight to a byte

    def holds(self, keys: np.ndarray) -> np.ndarray:
        segment, bits = _bits(_places(keys, self.parts), self.bits)
        out = np.ones(len(keys), bool)
        for one in bits:
            bit = segment * min(self.bits, _SEGMENT_BITS) + one
            out &= (self.data[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        return out


def _segments(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    size = min(bits, _SEGMENT_BITS)
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        segment, places = _bits(batch.column(1).to_numpy(), bits)
        for s in np.unique(segment).tolist():
            data = held.setdefault(s, np.zeros(size // 8, np.uint8))
            for place in places:
                bit = place[segment == s]
                np.bitwise_or.at(data, bit >> 3, np.uint8(1) << (bit & 7).astype(np.uint8))
    for s, data in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([data.tobytes()], pa.binary())],
                                         ["segment", "data"])


def _with_segment(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(_bits(places, bits)[0]), batch.column(0)],
                                         ["segment", "place"])


def bloom_filter(places: DataFrame, parts: int, most_bits: int = FILTER_BITS) -> Filter:
    """Filter of a column of places, of `most_bits` (a power of two) at most.

    Each place sets four bits of one segment; segments are made where the places
    of each are brought together, and only they reach the driver.
    """
    wanted = 12 * places.count()
    bits = 1 << 13
    while bits < wanted and bits < most_bits:
        bits *= 2
    made = (places.mapInArrow(partial(_with_segment, bits=bits), "segment long, place long")
            .repartition("segment").mapInArrow(partial(_segments, bits=bits),
                                               "segment long, data binary"))
    data = np.zeros(bits // 8, np.uint8)
    size = min(bits, _SEGMENT_BITS) // 8
    for row in made.collect():
        data[row["segment"] * size:(row["segment"] + 1) * size] |= np.frombuffer(row["data"], np.uint8)
    return Filter(parts, bits, data)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of 32-bit numbers, first all lowest ones, and so on; they compress better so."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _hashed(keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """Counts of a shard by place, a row for each part: gaps between places, and counts."""
    order = np.argsort(_places(keys, parts))
    place, n = _places(keys, parts)[order], np.minimum(counts[order], (1 << 32) - 1)
    part = place >> _PLACE_BITS
    head = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    data, size = [], []
    for a, b in zip(head, [*head[1:], len(place)]):
        within = place[a:b] & ((1 << _PLACE_BITS) - 1)
        data.append(pa.compress(_planes(np.diff(within, prepend=0)) + _planes(n[a:b]),
                                codec="zstd", asbytes=True))
        size.append(b - a)
    return pa.RecordBatch.from_arrays(
        [pa.array(part[head] if len(part) else [], pa.int64()), pa.array(size, pa.int64()),
         pa.array(data, pa.binary())], ["part", "size", "data"])


def _reaching(rows: pd.DataFrame, least: int) -> pd.DataFrame:
    """Places of a part whose counts reach `least` in all shards together."""
    place, n = [], []
    for size, data in zip(rows["size"], rows["data"]):
        raw = pa.decompress(data, 8 * size, codec="zstd", asbytes=True)
        place.append(np.cumsum(_from_planes(raw[:4 * size])))
        n.append(_from_planes(raw[4 * size:]))
    every, at = np.unique(np.concatenate(place), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(n))  # exact below 2 ** 53
    found = every[total >= least] + (int(rows["part"].iloc[0]) << _PLACE_BITS)
    return pd.DataFrame({"place": found})


def _packed(ids: np.ndarray) -> bytes:
    return pa.compress(ids.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, codec="zstd"), "<i4")


def _indexed(batches: Iterator[pa.RecordBatch], depth: int,
             shard_bytes: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    size = 0

    def made() -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            ids, words = symbols(texts)
            if not len(words):
                continue
            index = Index.of(ids, depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([len(ids)], pa.int64()),
                 pa.array([words.to_pylist()], pa.list_(pa.binary())),
                 *(pa.array([_packed(x)], pa.binary()) for x in index.side)],
                ["lang", "n", "words", "left", "right"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                data = text.encode()
                held.setdefault(lang, []).append(data)
                size += len(data)
                if size >= shard_bytes:
                    yield from made()
                    held, size = {}, 0
    yield from made()


def build_index(docs: DataFrame, text: str = "text", lang: str = "lang",
                most_words: int = MOST_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored index, a row for each shard: language, length, words, both transforms.

    A shard holds whole texts of one language, so no phrase is cut, and closes
    once its task has gathered `shard_bytes`. Null languages count as `und`.
    """
    named = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                        F.col(text).alias("text"))
    return stored(named.mapInArrow(
        partial(_indexed, depth=most_words, shard_bytes=shard_bytes),
        "lang string, n long, words array<binary>, left binary, right binary"), "word-index")


def _told(words: pa.Array, phrases: Phrases) -> list[bytes]:
    columns = [words.take(pa.array(phrases.words[:, i] - 1)) for i in range(phrases.words.shape[1])]
    return (pc.binary_join_element_wise(*columns, b" ") if len(columns) > 1
            else columns[0]).to_pylist()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, Index]]:
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column("n")[i].as_py()
            yield (batch.column("lang")[i].as_py(), batch.column("words")[i].values, Index(
                *(_unpacked(batch.column(side)[i].as_py(), n) for side in ("left", "right"))))


def _grown(index: Index, lang: str, hashes: np.ndarray, may: list[Filter],
           most_words: int) -> Iterator[tuple[Phrases, np.ndarray]]:
    """Phrases of 1 to `most_words` words with their keys, extended to the right and to the left
    in turn. The first filter knows words and pairs, the second longer phrases."""
    phrases = index.single()
    for n in range(1, most_words + 1):
        side = 1 if n == 2 else n % 2
        if n > 1:
            phrases = index.extended(phrases, side)
        if n > 2:  # a longer phrase is as rare as the pair at its new end
            ends = phrases.words[:, -2:] if side else phrases.words[:, :2]
            phrases = phrases.only(may[0].holds(_keys(hashes[ends - 1], lang)))
        keys = _keys(hashes[phrases.words - 1], lang)
        known = may[0] if n <= 2 and may else may[1] if n > 2 and len(may) > 1 else None
        if known is not None:
            some = known.holds(keys)
            phrases, keys = phrases.only(some), keys[some]
        yield phrases, keys


def _by_hash(batches: Iterator[pa.RecordBatch], lengths: tuple[int, int], parts: int,
             shared=None) -> Iterator[pa.RecordBatch]:
    """Counts by place of the phrases of some lengths."""
    for lang, words, index in _shards(batches):
        keys, counts = [], []
        for phrases, some in _grown(index, lang, _hashes(words.to_pylist()),
                                    shared.value if shared else [], lengths[1]):
            if phrases.words.shape[1] >= lengths[0]:
                keys.append(some)
                counts.append(phrases.count)
        yield _hashed(np.concatenate(keys), np.concatenate(counts), parts)


def _exact(batches: Iterator[pa.RecordBatch], most_words: int, shared) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases that may be frequent, a row for each part of the places: the phrases,
    a line each, and their counts. The empty phrase has the number of words."""
    parts = shared.value[0].parts
    for lang, words, index in _shards(batches):
        told, counts, part = [b""], [np.array([index.counts[1:].sum()])], [np.zeros(1, np.int64)]
        for phrases, keys in _grown(index, lang, _hashes(words.to_pylist()), shared.value,
                                    most_words):
            told += _told(words, phrases)
            counts.append(phrases.count)
            part.append(_places(keys, parts) >> _PLACE_BITS)
        part, counts = np.concatenate(part), np.concatenate(counts).astype("<i8")
        order = np.argsort(part, kind="stable")
        head = np.flatnonzero(np.append(True, np.diff(part[order]) > 0))
        groups = np.split(order, head[1:])
        lines = [b"\n".join([told[i] for i in some]) for some in groups]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[order][head]), pa.array([lang] * len(head), pa.string()),
             pa.array([len(x) for x in lines], pa.int64()),
             pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in lines], pa.binary()),
             pa.array([counts[some].tobytes() for some in groups], pa.binary())],
            ["part", "lang", "size", "phrases", "counts"])


def _summed(rows: pd.DataFrame, least: int) -> pd.DataFrame:
    """Phrases of a part that occur `least` times or more in all shards together."""
    total: dict[tuple[str, bytes], int] = defaultdict(int)
    for lang, size, phrases, counts in zip(rows["lang"], rows["size"], rows["phrases"],
                                           rows["counts"]):
        lines = pa.decompress(phrases, size, codec="zstd", asbytes=True).split(b"\n")
        for phrase, n in zip(lines, np.frombuffer(counts, "<i8").tolist()):
            total[lang, phrase] += n
    found = [(lang, phrase.decode(), n) for (lang, phrase), n in total.items()
             if n >= least or not phrase]
    return pd.DataFrame(found, columns=["lang", "phrase", "n"])


def frequent_phrases(index: DataFrame, least: int = LEAST_COUNT, most_words: int = MOST_WORDS,
                     most_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of 1 to `most_words` words that occur `least` times or
    more, counted over all shards, and (lang, n) of all words."""
    sc = index.sparkSession.sparkContext
    shards, parts = index.count(), 1
    while parts * _SHARDS_PER_PART < shards:
        parts *= 2
    filters: list[Filter] = []
    for lengths in ((1, min(2, most_words)), (3, most_words)):
        if lengths[0] > lengths[1]:
            continue
        counted = index.mapInArrow(
            partial(_by_hash, lengths=lengths, parts=parts, shared=sc.broadcast(filters)),
            "part long, size long, data binary")
        places = stored(counted.groupBy("part").applyInPandas(
            partial(_reaching, least=least), "place long"), "places")
        filters = [*filters, bloom_filter(places, parts, most_bits)]
    counts = stored(index.mapInArrow(
        partial(_exact, most_words=most_words, shared=sc.broadcast(filters)),
        "part long, lang string, size long, phrases binary, counts binary")
        .groupBy("part").applyInPandas(partial(_summed, least=least),
                                       "lang string, phrase string, n long"), "phrases")
    return (counts.filter(F.col("phrase") != ""),
            counts.filter(F.col("phrase") == "").select("lang", "n"))


def _whole(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, most_words: int = MOST_WORDS,
                 top: int = TOP, text: str = "text", lang: str = "lang",
                 shard_bytes: int = SHARD_BYTES, most_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the `top` phrases of each language.

    Texts are lower-cased (A to Z), cut into pieces at marks and line ends and
    into words at blanks; a phrase is 2 to `most_words` words within a piece.
    `a` is its count, `l` and `r` those of its parts at the cut that scores
    lowest, `score` the whole part of 1000 a n / (l r). A phrase that never
    occurs but within one longer phrase is left out. Null and empty texts hold
    no phrases, repeated rows count each time, an empty table gives no rows;
    other columns are not read.
    """
    found, totals = frequent_phrases(build_index(docs, text, lang, most_words, shard_bytes),
                                     least, most_words, most_bits)
    words = F.split("phrase", " ")
    candidates = found.withColumn("_words", words).filter(F.size("_words") > 1)
    # a phrase is hidden if it is as frequent with one more word on its left or right;
    # if it is so with several more, it is so with each of them
    hidden = (candidates.filter(F.size("_words") > 2)
              .select("lang", F.explode(F.array(
                  F.array_join(F.slice("_words", 1, F.size("_words") - 1), " "),
                  F.array_join(F.slice("_words", 2, F.size("_words") - 1), " "))).alias("phrase"),
                  F.col("n").alias("_longer"))
              .groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer")))
    shown = (candidates.join(hidden, ["lang", "phrase"], "left")
             .filter(F.col("_longer").isNull() | (F.col("_longer") < F.col("n"))).drop("_longer"))
    cuts = shown.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("_words") - 1), lambda k: F.struct(
            k.alias("k"), F.array_join(F.slice("_words", F.lit(1), k), " ").alias("first"),
            F.array_join(F.slice("_words", k + 1, F.size("_words") - k), " ").alias("rest"))))
        .alias("cut")).select("lang", "phrase", "a", "cut.*")
    left = found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .join(totals, "lang")
              .withColumn("_above", _whole(F.col("a")) * _whole(F.col("n")) * F.lit(1000))
              .withColumn("_below", _whole(F.col("l")) * _whole(F.col("r")))
              .withColumn("score", F.expr("cast(_above div _below as bigint)")))
    lowest = (scored.groupBy("lang", "phrase", "a", "n")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
              .select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (lowest.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"))
