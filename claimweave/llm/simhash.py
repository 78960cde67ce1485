"""SimHash near-duplicates: fingerprints, links within a Hamming distance, groups.

Pigeonhole: with d differing bits over b blocks, at least b - d blocks are
equal. Fingerprints meet on every choice of b - d blocks and are then compared.
What shares a choice is compared in bounded groups, of which only the edges of
a spanning forest leave the task. A larger group takes a way that is linear in
its members: x and y differ in at most 3 bits if and only if some value lies
within 1 bit of one and 2 bits of the other, so each member is written out at
the values around it and is tied to one member within 1 bit of the same value.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.components import connected_components
from ..operators.skew import dealt
from .storage import stored, unused

SEED = 42
BITS = 64
DISTANCE = 3
BLOCKS = 6
COMPARED_AT_ONCE = 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 500


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint; a bit is 1 if it is set in over half the shingle hashes."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:1 - shingle].tolist() if shingle > 1 else (ends - sizes).tolist()
    stops = ends[shingle - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + _AT_ONCE], stops[at:at + _AT_ONCE])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], "<u8")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view("<i8"))],
                                         ["id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text",
                 id_column: str = "doc_id") -> DataFrame:
    """(id, fp) of every row: a signed 64-bit fingerprint, 0 for texts without words."""
    schema = T.StructType([docs.schema[id_column], T.StructField("fp", T.LongType())])
    return docs.select(id_column, text).mapInArrow(partial(_fingerprints, shingle=shingle), schema)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _masks(blocks: int, distance: int) -> list[int]:
    """Signed bit masks of every choice of blocks that may be equal."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(single, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _ties(block: np.ndarray, fp: np.ndarray, rep: np.ndarray, distance: int):
    """Edges of a spanning forest of the links within each block; rows are sorted by block."""
    label, parent = np.arange(len(block)), {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    out_a, out_b, lag, first = [], [], 1, np.flatnonzero(block[1:] == block[:-1])
    while len(first):
        second = first + lag
        near = np.bitwise_count(fp[first] ^ fp[second]) <= distance
        near &= label[first] != label[second]
        changed = False
        for a, b in zip(first[near].tolist(), second[near].tolist()):
            x, y = root(int(label[a])), root(int(label[b]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out_a.append(a)
                out_b.append(b)
                changed = True
        if changed:
            every, where = np.unique(label, return_inverse=True)
            label = np.array([root(int(x)) for x in every])[where]
        lag += 1
        first = first[first + lag < len(block)]
        first = first[block[first] == block[first + lag]]
    return rep[out_a], rep[out_b]


def _compare(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; the last block of a batch waits for the rest of it."""
    kept = [np.zeros(0, "<i8")] * 3

    def edges(columns):
        u, v = _ties(columns[0], columns[1].view("<u8"), columns[2], distance)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        columns = [np.concatenate((k, batch.column(i).to_numpy(zero_copy_only=False)))
                   for i, k in enumerate(kept)]
        if not len(columns[0]):
            continue
        whole = int(np.searchsorted(columns[0], columns[0][-1]))
        kept = [c[whole:] for c in columns]
        if whole:
            yield edges([c[:whole] for c in columns])
    if len(kept[0]):
        yield edges(kept)


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values within 2 bits of each fingerprint, in the bits that vary in its block."""
    for batch in batches:
        for block, fp, rep, varying in zip(*(batch.column(i).to_pylist() for i in range(4))):
            single = [np.uint64(1 << b) for b in range(BITS) if varying >> b & 1]
            flips = [np.uint64(0), *single, *(a ^ b for a, b in combinations(single, 2))]
            values = (np.array(flips, "<u8") ^ np.uint64(fp & (1 << BITS) - 1)).view("<i8")
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block, "<i8")), pa.array(values),
                 pa.array(np.full(n, rep, "<i8")), pa.array(np.arange(n) <= len(single))],
                ["block", "value", "rep", "near"])


def links(marked: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
          compared_at_once: int = COMPARED_AT_ONCE) -> DataFrame:
    """Edges (u, v) that connect just the representatives whose fingerprints are linked.

    `marked` has one row (fp, rep) for each different fingerprint. Not all links
    are listed, but what links connect, the edges connect too. Groups above
    `compared_at_once` take the linear way, which is exact for 3 bits or fewer
    only; other distances compare all groups in one way. Both joins are
    shuffled: rows are written out many times over before them, which Spark does
    not count when it looks for a side to broadcast.
    """
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m)))
                     for i, m in enumerate(_masks(blocks, distance))])
    tagged = marked.select("fp", "rep", F.explode(keys).alias("block"))
    shared = (tagged.groupBy("block")
              .agg(F.count("*").alias("n"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp"))
                   .alias("varying")).filter("n > 1"))
    members = stored(tagged.join(dealt(shared), "block"), "simhash-members")
    small = F.col("n") <= compared_at_once if distance == 3 else F.lit(True)
    compared = (members.filter(small).select("block", "fp", "rep")
                .repartition("block").sortWithinPartitions("block", "fp")
                .mapInArrow(partial(_compare, distance=distance), "u long, v long"))
    if distance != 3:
        return compared
    around = (members.filter(~small).select("block", "fp", "rep", "varying")
              .mapInArrow(_around, "block long, value long, rep long, near boolean"))
    centres = around.groupBy("block", "value").agg(
        F.min(F.when(F.col("near"), F.col("rep"))).alias("centre")).filter("centre is not null")
    tied = (around.join(dealt(centres), ["block", "value"])
            .filter("rep <> centre").select(F.col("rep").alias("u"), F.col("centre").alias("v")))
    return compared.unionByName(tied)


def groups(docs: DataFrame, distance: int = DISTANCE, shingle: int = 3, text: str = "text",
           id_column: str = "doc_id", blocks: int = BLOCKS,
           compared_at_once: int = COMPARED_AT_ONCE) -> DataFrame:
    """(id, fp, component_id) of every row; the component is the smallest id reachable by links.

    Ids are integers. Texts without a word, null ones too, have fingerprint 0
    and are linked like any other; repeated rows are in one component. A row
    whose id is null keeps its fingerprint and has the component of the others
    with that fingerprint, null if there are none. Other columns are ignored.
    """
    marks = stored(fingerprints(docs, shingle, text, id_column), "simhash-marks")
    marked = stored(marks.groupBy("fp").agg(F.min(id_column).cast("long").alias("rep"))
                    .filter("rep is not null"), "simhash-reps")
    found = connected_components(links(marked, distance, blocks, compared_at_once))
    of = marked.join(dealt(found.withColumnRenamed("id", "rep")), "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return marks.join(dealt(of), "fp", "left").select(id_column, "fp", "component_id")


def _marked(batches: Iterator[pa.RecordBatch], at: int, shingle: int,
            names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(low, _ROWS_AT_ONCE)
            values = np.array([fingerprint(x, shingle) for x in part.column(at).to_pylist()], "<u8")
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values.view("<i8"))], names)


def first_of_groups(docs: DataFrame, distance: int = DISTANCE, shingle: int = 3,
                    text: str = "text", id_column: str = "doc_id", blocks: int = BLOCKS,
                    compared_at_once: int = COMPARED_AT_ONCE) -> DataFrame:
    """One row of each group of linked fingerprints, that with the smallest id, all columns kept.

    Rows are grouped by their fingerprints, as in `groups`, but rows of one id
    with different texts are documents of their own. Rows without an id are
    linked by their texts and give way to rows with one. Of rows with equal ids
    that of the smallest MD5 of the text stays. Texts without a word, null ones
    too, are one group with what is linked to fingerprint 0. Rows of one
    fingerprint are reduced to one before the shuffle, so copies without number
    cost no task more than others.
    """
    mark = unused("_fp", docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())])
    marks = docs.mapInArrow(partial(_marked, at=docs.columns.index(text), shingle=shingle,
                                    names=schema.names), schema)
    order = F.struct(F.col(id_column).isNull(), id_column, F.md5(F.coalesce(text, F.lit(""))))
    firsts = stored(marks.groupBy(F.col(mark).alias("fp")).agg(
        F.min_by(F.struct(*docs.columns), order).alias("row"), F.min(order).alias("place")),
        "simhash-firsts")
    found = stored(connected_components(links(firsts.select("fp", F.col("fp").alias("rep")),
                                              distance, blocks, compared_at_once)),
                   "simhash-linked").withColumnRenamed("id", "fp")
    # only linked fingerprints meet here, without their texts
    first = (found.join(firsts.select("fp", "place"), "fp").groupBy("component")
             .agg(F.min_by("fp", F.struct("place", "fp")).alias("fp")))
    others = found.join(first, "fp", "left_anti").select("fp")
    return firsts.join(others, "fp", "left_anti").select("row.*")
