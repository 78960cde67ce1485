"""Repeated passages, by content-defined chunks.

A gear hash rolls over the last 32 bytes of a text; where it hits a pattern the
chunk ends, so boundaries move with the content and a passage is cut alike
wherever it stands. Chunks are known by a 128-bit digest; the first chunk of a
digest stays, later ones are repeats. Runs of neighbouring repeats are at hand as
`repeated_passages`, cut to whole chunks.

`whole_passages` loses nothing at the ends and none of the passages: of each
SPREAD places that follow each other the one where a hash of the GRAM bytes
before it is smallest is kept, so any two copies of GRAM + SPREAD - 1 bytes have
a kept place in common. From there both texts are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .storage import stored
from .words import WORD_BYTE, mixed

WINDOW = 32
SPACE_BITS = 3       # a chunk ends after one space in 8 ...
OTHER_BITS = 10      # ... or after one other character in 1,024
LEAST, MOST = 16, 512
MIN_BYTES = 128
GRAM, SPREAD = 64, 64   # copies of 127 bytes or more share a place
TRIMMED = 32            # an end within a word moves to the word's edge, at most so far
_FACTOR = 0x9E3779B97F4A7C15
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_AT_ONCE = 1 << 20


def _candidates(data: bytes) -> Iterator[int]:
    """Places after which a chunk may end, block by block."""
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw), _AT_ONCE):
        low = max(0, at - WINDOW + 1)
        part = raw[low:at + _AT_ONCE]
        rolled = GEAR[part]
        for step in (1, 2, 4, 8, 16):
            rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
        following = raw[low + 1:at + _AT_ONCE + 1]
        whole = np.ones(len(part), bool)  # not within a character
        whole[:len(following)] = (following & 0xC0) != 0x80
        hit = np.where(_SPACE[part], rolled < np.uint32(1 << (32 - SPACE_BITS)),
                       rolled < np.uint32(1 << (32 - OTHER_BITS))) & whole
        yield from (np.flatnonzero(hit[at - low:]) + at + 1).tolist()


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of `data`, each LEAST to MOST bytes long but for the last."""
    ends, last = [], 0

    def forced(upto: int) -> None:
        nonlocal last
        while upto - last > MOST:
            end = last + MOST
            while end > last + LEAST and data[end] & 0xC0 == 0x80:
                end -= 1
            ends.append(end)
            last = end

    for cut in _candidates(data):
        if cut - last >= LEAST:
            forced(cut)
            if cut - last >= LEAST:
                ends.append(cut)
                last = cut
    forced(len(data))
    if last < len(data):
        ends.append(len(data))
    return ends


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, places, ends, digests = [], [], [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            data = (text or "").encode()
            last = 0
            cuts = boundaries(data)
            for end in cuts:
                digests.append(xxhash.xxh3_128_digest(data[last:end]))
                places.append(last)
                last = end
            ends += cuts
            rows += [row] * len(cuts)
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        nth = np.arange(len(rows))
        if len(rows):
            of = np.asarray(rows)
            first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            nth = nth - np.repeat(first, np.diff(np.append(first, len(rows))))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(nth.astype(np.int64)),
             pa.array(places, pa.int64()), pa.array(ends, pa.int64()),
             pa.array(halves[:, 0]), pa.array(halves[:, 1])],
            ["doc", "nth", "start", "stop", "d1", "d2"])


def chunks(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc, nth, start, stop, d1, d2) of every chunk; places are bytes of the UTF-8 text."""
    of = T.StructField("doc", docs.schema[id_column].dataType)
    schema = T.StructType([of, *(T.StructField(n, T.LongType())
                                 for n in ("nth", "start", "stop", "d1", "d2"))])
    return docs.select(id_column, text).mapInArrow(_chunked, schema)


def repeated_chunks(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Chunks with an earlier copy, and `first`, the doc and start of the first one.

    Documents are in order of their ids. Rows of one id count as one document:
    a chunk at the same place of the same id is no repeat. Rows without an id
    and texts that are null or empty have no chunks.
    """
    every = stored(chunks(docs.filter(F.col(id_column).isNotNull()), text, id_column), "chunks")
    firsts = (every.groupBy("d1", "d2")
              .agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    return (every.join(firsts, ["d1", "d2"])
            .filter(F.struct("doc", "start") > F.col("first")))


def repeated_passages(docs: DataFrame, min_bytes: int = MIN_BYTES, text: str = "text",
                      id_column: str = "doc_id") -> DataFrame:
    """(id, start, stop, n_chunks, first_id) of every passage with an earlier copy.

    A passage is a run of neighbouring repeated chunks of `min_bytes` or more;
    `start` and `stop` are bytes of the UTF-8 text, `first_id` is the document
    of the first copy of its longest chunk.
    """
    repeats = repeated_chunks(docs, text, id_column).dropDuplicates(["doc", "nth", "start"])
    along = Window.partitionBy("doc").orderBy("nth")
    runs = repeats.withColumn("run", F.col("nth") - F.row_number().over(along))
    return (runs.groupBy("doc", "run")
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                 F.count("*").alias("n_chunks"),
                 F.max_by("first.doc", F.struct(F.col("stop") - F.col("start"), -F.col("start")))
                 .alias("first_id"))
            .filter(F.col("stop") - F.col("start") >= min_bytes)
            .select(F.col("doc").alias(id_column), "start", "stop", "n_chunks", "first_id"))


def _smallest(values: np.ndarray) -> np.ndarray:
    """Which values are the smallest of some SPREAD neighbours."""
    low = np.concatenate((np.full(SPREAD - 1, ~np.uint64(0)), values,
                          np.full(SPREAD - 1, ~np.uint64(0))))
    for best, step in ((np.minimum, 1), (np.maximum, 1)):
        while step < SPREAD:
            low = best(low[step:], low[:-step])
            step *= 2
    return low == values


def places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Kept places of `data`, each the end of GRAM bytes, and hashes of those bytes."""
    raw = np.frombuffer(data, np.uint8)
    margin = GRAM + 2 * SPREAD
    found, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at in range(0, len(raw), _AT_ONCE):
        low = max(0, at - margin)
        part = raw[low:at + _AT_ONCE + margin]
        if len(part) < GRAM:
            continue
        rolled, step = part.astype(np.uint64) + np.uint64(1), 1
        while step < GRAM:
            rolled = rolled[step:] + rolled[:-step] * np.uint64(pow(_FACTOR, step, 1 << 64))
            step *= 2
        rolled = mixed(rolled)
        ends = np.flatnonzero(_smallest(rolled))
        some = ends[(ends + low + GRAM > at) & (ends + low + GRAM <= at + _AT_ONCE)]
        found.append(some + low + GRAM)
        hashes.append(rolled[some])
    ends, values = np.concatenate(found), np.concatenate(hashes)
    again = (values[1:] == values[:-1]) & (np.diff(ends) < SPREAD)
    if again.any():  # of equal places one in SPREAD is enough
        kept, last = [0], 0
        for i in range(1, len(ends)):
            if not again[i - 1] or ends[i] - ends[last] >= SPREAD:
                kept.append(i)
                last = i
        ends, values = ends[kept], values[kept]
    return ends, values


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [places((text.as_py() or "").encode()) for text in batch.column(1)]
        rows = np.repeat(np.arange(len(found)), [len(e) for e, _ in found])
        ends = np.concatenate([np.zeros(0, np.int64), *(e for e, _ in found)])
        values = np.concatenate([np.zeros(0, np.uint64), *(v for _, v in found)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ends),
             pa.array(values.view(np.int64))], ["doc", "place", "hash"])


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal bytes from the start."""
    at, step, most = 0, 256, min(len(a), len(b))
    while at < most:
        end = min(most, at + step)
        other = np.flatnonzero(a[at:end] != b[at:end])
        if len(other):
            return at + int(other[0])
        at, step = end, 2 * step
    return most


def _trimmed(raw: np.ndarray, start: int, stop: int) -> tuple[int, int]:
    """The same stretch without parts of words, or of characters, at its ends."""
    def inside(at: int) -> bool:
        return 0 < at < len(raw) and bool(WORD_BYTE[raw[at - 1]] and WORD_BYTE[raw[at]])

    def within(at: int) -> bool:
        return at < len(raw) and raw[at] & 0xC0 == 0x80

    first = next((i for i in range(start, min(start + TRIMMED, stop)) if not inside(i)), start)
    last = next((i for i in range(stop, max(stop - TRIMMED, first), -1) if not inside(i)), stop)
    while first < last and within(first):
        first += 1
    while first < last and within(last):
        last -= 1
    return first, last


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, start, stop, n, first) of the longest equal stretches around shared places."""
    for batch in batches:
        for i in range(batch.num_rows):
            one, other = (np.frombuffer((batch.column(c)[i].as_py() or "").encode(), np.uint8)
                          for c in (2, 3))
            rows, reached = [], {}
            for pair in sorted((p["place"], p["at"]) for p in batch.column(4)[i].as_py()):
                place, at = pair
                known = reached.get(place - at)
                if known is not None and place <= rows[known][3]:
                    rows[known][2] += 1
                    continue
                if place > len(one) or at > len(other):
                    continue  # of another row with this id
                back = _alike(one[:place][::-1], other[:at][::-1])
                if back < GRAM // 2:
                    continue
                end = place + _alike(one[place:], other[at:])
                reached[place - at] = len(rows)
                rows.append([*_trimmed(one, place - back, end), 1, end])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([i] * len(rows), pa.int64())),
                 *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                 batch.column(1).take(pa.array([i] * len(rows), pa.int64()))],
                ["doc", "start", "stop", "n", "first"])


def whole_passages(docs: DataFrame, min_bytes: int = MIN_BYTES, text: str = "text",
                   id_column: str = "doc_id") -> DataFrame:
    """(id, start, stop, n_chunks, first_id) of every passage with an earlier copy, to its ends.

    At each kept place that has an earlier copy the text is compared with the
    first copy, to both sides as far as the bytes are equal; stretches that meet
    are one passage, reported from `min_bytes` on. `start` and `stop` are bytes
    of the UTF-8 text, `n_chunks` is the number of its kept places, `first_id`
    the document of the first copy of its longest stretch. Documents are in
    order of their ids. Rows of one id count as one document.
    """
    rows = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("doc"), F.col(text).alias("text"))
    of = T.StructField("doc", rows.schema["doc"].dataType)
    # sorted out once, for the first copies and for the others
    every = rows.mapInArrow(_placed, T.StructType(
        [of, T.StructField("place", T.LongType(), False),
         T.StructField("hash", T.LongType(), False)])).repartition("hash")
    firsts = (every.groupBy("hash").agg(F.min(F.struct("doc", "place")).alias("first"),
                                        F.count("*").alias("n")).filter("n > 1").drop("n"))
    shared = stored(every.join(firsts, "hash").filter(F.struct("doc", "place") > F.col("first"))
                    .groupBy("doc", F.col("first.doc").alias("first"))
                    .agg(F.collect_set(F.struct("place", F.col("first.place").alias("at")))
                         .alias("places")), "shared-places")
    schema = T.StructType([of, *(T.StructField(n, T.LongType()) for n in ("start", "stop", "n")),
                           T.StructField("first", of.dataType)])
    texts = rows.repartition("doc").distinct()
    extended = (shared.join(texts, "doc")
                .join(texts.select(F.col("doc").alias("first"), F.col("text").alias("first_text")),
                      "first")
                .select("doc", "first", "text", "first_text", "places")
                .mapInArrow(_extended, schema))
    along = Window.partitionBy("doc").orderBy("start", "stop", "first", "n")
    before = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = (stored(extended, "stretches")
            .withColumn("opens", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
            .withColumn("run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0))))
    return (runs.groupBy("doc", "run")
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                 F.sum("n").alias("n_chunks"),
                 F.max_by("first", F.struct(F.col("stop") - F.col("start"), -F.col("start")))
                 .alias("first_id"))
            .filter(F.col("stop") - F.col("start") >= min_bytes)
            .select(F.col("doc").alias(id_column), "start", "stop", "n_chunks", "first_id"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if text and spans:
                data, kept, at = text.encode(), [], 0
                for span in sorted(spans, key=lambda s: s["start"]):
                    kept.append(data[at:span["start"]])
                    at = span["stop"]
                text = b"".join([*kept, data[at:]]).decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())],
                                         ["id", "text"])


def delete_passages(docs: DataFrame, min_bytes: int = MIN_BYTES, text: str = "text",
                    id_column: str = "doc_id") -> DataFrame:
    """(id, text) of every row, without the passages that have an earlier copy."""
    spans = (whole_passages(docs, min_bytes, text, id_column)
             .groupBy(id_column).agg(F.collect_list(F.struct("start", "stop")).alias("_spans")))
    schema = T.StructType([docs.schema[id_column], docs.schema[text]])
    return docs.select(id_column, text).join(spans, id_column, "left").mapInArrow(_cut, schema)
