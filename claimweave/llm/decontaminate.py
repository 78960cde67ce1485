"""Benchmark decontamination by latent semantic retrieval.

Passages of all documents span a TF-IDF matrix A over hashed words. A random
sign matrix S gives the sketch A'AS in one pass over the documents, next to the
document frequencies; sums are of whole numbers and so the same in any order.
The sketch yields the leading right singular vectors (Nystroem). Passages and
benchmark items are compared by cosine in that space, and what comes near is
verified on its words: longest common subsequence, and the item's answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import blocks, mixed

FEATURES = 1 << 14
SKETCH = 48               # columns of the sketch
COMMON_DIRECTIONS = 4     # leading singular vectors, of what all texts share, that are left out
PROJECTED = 512           # random directions that stand for the space where texts span none
PASSAGE = 32              # words of a sketched passage
LENGTHS = (16, 32, 64)    # words of a compared passage, the one nearest to the item's length
OVERLAP = 4               # a passage begins at each such part of its length
COSINE = 0.5              # nearer passages are verified
COMMON = 0.75             # share of the item's words in common subsequence with a passage
COMMON_WITH_ANSWER = 0.6  # enough if the answer is there too
LEAST_WORDS = 8           # items with fewer words are told by their whole sequence only
ITEMS_AT_ONCE = 1000
ITEM_WORDS_AT_ONCE = 1 << 16
_SEED = 20
_BYTES = np.uint64(0x0101010101010101)
_WIDE = 3                 # sums of sketch columns that one 64-bit number holds, 21 bits each
_REGION_WORDS = 1 << 21   # words of candidate regions that are looked at together
_ANSWER = re.compile(r"(?i)\banswer\s*:")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def _signs() -> np.ndarray:
    return np.random.default_rng(_SEED).integers(0, 2, (FEATURES, SKETCH), dtype=np.int8) * 2 - 1


def document_words(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(place, hashes of all its words in order) of every text that has a word."""
    kept: list[np.ndarray] = []
    last = -1
    for block in blocks(texts):
        hashed = block.words()
        docs, first = np.unique(block.doc, return_index=True)
        for doc, some in zip(docs.tolist(), np.split(hashed, first[1:])):
            if doc != last and kept:
                yield last, np.concatenate(kept) if len(kept) > 1 else kept[0]
                kept = []
            kept.append(some)
            last = doc
    if kept:
        yield last, np.concatenate(kept) if len(kept) > 1 else kept[0]


def _feature(hashed: np.ndarray) -> np.ndarray:
    return (hashed & np.uint64(FEATURES - 1)).astype(np.int64)


def _packed_signs() -> np.ndarray:
    """Rows of _WIDE columns of `_signs`, 1 for plus and 0 for minus, by feature; 0 at no word."""
    plus = (np.append(_signs(), np.full((1, SKETCH), -1, np.int8), axis=0) > 0).astype(np.uint64)
    shifts = np.uint64(21) * np.arange(_WIDE, dtype=np.uint64)
    return np.ascontiguousarray((plus.reshape(-1, SKETCH // _WIDE, _WIDE) << shifts).sum(axis=2).T)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (feature, passages with it, sketch) of a partition, and their number at feature -1.

    The words of a passage with a plus sign are counted in packed numbers; twice
    that less the number of words is the sum of the signs.
    """
    signs = _packed_signs()
    total = np.zeros((SKETCH, FEATURES + 1), np.int64)
    found, passages = np.zeros(FEATURES, np.int64), 0
    field = np.uint64((1 << 21) - 1)

    def add(words: np.ndarray) -> None:
        """TF' (TF S) of at most 2 ** 15 words in passages that follow each other, the last
        filled up with no word."""
        nonlocal passages
        order = np.argsort(words, kind="stable")
        in_order, passage = words[order], order // PASSAGE
        edge = np.flatnonzero(np.concatenate(([True], in_order[1:] != in_order[:-1])))
        features = in_order[edge]
        real = (words != FEATURES).reshape(-1, PASSAGE).sum(axis=1)
        minus = np.add.reduceat(real[passage], edge)
        for i, row in enumerate(signs):
            # a sum is at most 2 ** 15 words of 32 each, 2 ** 20
            plus = row[words].reshape(-1, PASSAGE).sum(axis=1)
            sums = np.add.reduceat(plus[passage], edge)
            for k in range(_WIDE):
                one = (sums >> np.uint64(21 * k) & field).astype(np.int64)
                total[_WIDE * i + k, features] += 2 * one - minus
        within = np.sort(words.reshape(-1, PASSAGE), axis=1)
        first = np.ones(within.shape, bool)
        first[:, 1:] = within[:, 1:] != within[:, :-1]
        found[:] += np.bincount(within[first], minlength=FEATURES + 1)[:FEATURES]
        passages += len(real)

    for batch in batches:
        held, size = [], 0
        for _, hashed in document_words(batch.column(0).to_pylist()):
            for at in range(0, len(hashed), 1 << 13):
                part = _feature(hashed[at:at + (1 << 13)]).astype(np.int16)
                filled = -len(part) % PASSAGE
                if size + len(part) + filled > 1 << 15:
                    add(np.concatenate(held))
                    held, size = [], 0
                held += [part, np.full(filled, FEATURES, np.int16)]
                size += len(part) + filled
        if size:
            add(np.concatenate(held))
    some = np.flatnonzero(found)
    columns = [np.append(some, -1), np.append(found[some], passages),
               *np.concatenate((total[:, some], np.zeros((SKETCH, 1), np.int64)), axis=1)]
    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                     ["feature", "found", *(f"s{i}" for i in range(SKETCH))])


@dataclass
class Space:
    """Map of words into the latent space, by feature: inverse document frequency times singular
    vectors over their singular values. The last row is that of no word."""
    table: np.ndarray


def latent_space(docs: DataFrame, text: str = "text") -> Space:
    """Latent space of the passages of all documents.

    Every task gives at most one row per feature; the driver gets their sums,
    FEATURES rows whatever the number of documents.
    """
    schema = "feature long, found long, " + ", ".join(f"s{i} long" for i in range(SKETCH))
    rows = (docs.select(text).mapInArrow(_sketched, schema).groupBy("feature")
            .agg(*[F.sum(c).alias(c) for c in ("found", *(f"s{i}" for i in range(SKETCH)))])
            .toPandas().sort_values("feature"))
    told = rows[rows["feature"] >= 0]
    passages = int(rows.loc[rows["feature"] < 0, "found"].sum())
    at = told["feature"].to_numpy(np.int64)
    found, sketch = np.zeros(FEATURES), np.zeros((FEATURES, SKETCH))
    found[at] = told["found"]
    sketch[at] = told[[f"s{i}" for i in range(SKETCH)]].to_numpy(np.float64)
    idf = np.log((passages + 1) / (found + 1)) + 1
    # sketch is TF'TF S; with A = TF diag(idf) and S = diag(idf) S' it is diag(1/idf) A'A S'
    y = idf[:, None] * sketch
    drawn = _signs() / idf[:, None]
    core = drawn.T @ y
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > 1e-9 * max(values.max(), 1e-300)
    half = y @ (vectors[:, good] / np.sqrt(values[good]))
    if half.shape[1] <= COMMON_DIRECTIONS:  # too few texts to span a space: projected TF-IDF
        drawn = np.random.default_rng(_SEED).integers(0, 2, (FEATURES, PROJECTED)) * 2 - 1
        table = idf[:, None] * drawn
        return Space(np.append(table, np.zeros((1, PROJECTED)), axis=0).astype(np.float32))
    v, s, _ = np.linalg.svd(half, full_matrices=False)
    table = idf[:, None] * v[:, COMMON_DIRECTIONS:] / np.maximum(s[COMMON_DIRECTIONS:], 1e-9)
    return Space(np.append(table, np.zeros((1, table.shape[1])), axis=0).astype(np.float32))


@dataclass
class Items:
    """Benchmark items, their words, and latent vectors of the queries they are searched by."""
    ids: list
    answers: list[np.ndarray]  # as places in the vocabulary
    vectors: np.ndarray        # of each query
    of: np.ndarray             # the item of each query; long items have several
    length: np.ndarray         # the compared passage length of each query
    vocabulary: np.ndarray     # sorted hashes of all their words
    has: np.ndarray            # item by vocabulary: whether it has the word
    pairs: np.ndarray          # sorted places in `has` of all words of items ...
    times: np.ndarray          # ... and how often the item has the word
    needed: np.ndarray         # words it must have in common with a text at least
    expected: np.ndarray       # of them, those that a passage of the compared length has room for
    reach: np.ndarray          # its number of words
    places: list[np.ndarray]   # its words as places in the vocabulary


def answer_of(text: str) -> str:
    """What follows a mark of the answer, or the last sentence."""
    marked = list(_ANSWER.finditer(text))
    if marked and text[marked[-1].end():].strip():
        return text[marked[-1].end():].strip()
    return [x for x in _SENTENCE.split(text.strip()) if x.strip()][-1]


def _compared(size: int) -> int:
    return min(LENGTHS, key=lambda n: abs(np.log(n / size)))


def _parts(words: np.ndarray) -> list[np.ndarray]:
    """Stretches of an item that are searched: all of it, or as many as cover a long one."""
    most = max(LENGTHS)
    if len(words) <= most * 2 ** 0.5:
        return [words]
    return [words[at:at + most] for at in [*range(0, len(words) - most, most), len(words) - most]]


def prepared(rows: list[tuple], space: Space) -> Items:
    """Items of (id, text) rows; texts without a word match nothing and are left out."""
    told = dict(document_words([t for _, t in rows]))
    places = sorted(told)
    answers = [answer_of(rows[i][1]) for i in places]
    in_answer = dict(document_words(answers))
    words = [told[i] for i in places]
    queries = [(i, part) for i, w in enumerate(words) for part in _parts(w)]
    vectors = np.stack([space.table[_feature(w)].sum(axis=0) for _, w in queries]) if queries else \
        np.zeros((0, space.table.shape[1]), np.float32)
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    has = np.zeros((len(words), len(vocabulary) + 1), np.uint8)
    for i, w in enumerate(words):
        has[i, np.searchsorted(vocabulary, w)] = 1
    sizes = np.array([len(w) for w in words], int)
    length = np.array([_compared(len(w)) for _, w in queries], int)
    of = np.array([i for i, _ in queries], int)
    in_vocabulary = [np.searchsorted(vocabulary, w) for w in words]
    pairs, times = np.unique(np.concatenate(
        [np.zeros(0, int), *(i * (len(vocabulary) + 1) + w for i, w in enumerate(in_vocabulary))]),
        return_counts=True)
    needed = np.where(sizes >= LEAST_WORDS, COMMON_WITH_ANSWER, 1.0) * sizes
    return Items([rows[i][0] for i in places],
                 [np.searchsorted(vocabulary, in_answer.get(i, np.zeros(0, np.uint64)))
                  for i in range(len(places))],
                 vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9),
                 of, length, vocabulary, has, pairs, times, needed,
                 needed[of] * np.minimum(1, length / sizes[of]), sizes, in_vocabulary)


def common_subsequence(item: np.ndarray, passage: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of whole numbers."""
    where: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        where[word] = where.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in passage.tolist():
        hit = where.get(word)
        if hit is not None:
            met = row & hit
            row = ((row + met) | (row - met)) & full
    return len(item) - bin(row).count("1")


def _within(short: np.ndarray, long: np.ndarray) -> bool:
    """Whether `short` is a subsequence of `long`."""
    rest = iter(long.tolist())
    return all(word in rest for word in short.tolist())


def _possible(known: np.ndarray, a: np.ndarray, b: np.ndarray, item: np.ndarray,
              items: Items) -> np.ndarray:
    """Words of each item, repeats included, that stand anywhere in the region from a to b."""
    out, nowhere = np.zeros(len(a), np.int64), len(items.vocabulary)
    has, width = items.has.ravel(), int((b - a).max(initial=1))
    rows = max(1, _REGION_WORDS // width)
    for low in range(0, len(a), rows):
        some = slice(low, low + rows)
        at = a[some][:, None] + np.arange(width)
        words = np.where(at < b[some][:, None], np.take(known, at, mode="clip"), nowhere)
        told = words + (item[some] * (nowhere + 1))[:, None]
        row, column = np.nonzero(np.take(has, told))
        # each word of an item once in a region
        once = np.unique(row * (nowhere + 1) + words[row, column])
        row = once // (nowhere + 1)
        pair = np.searchsorted(items.pairs, once + (item[some][row] - row) * (nowhere + 1))
        out[some] = np.bincount(row, items.times[pair], minlength=len(out[some]))
    return out


def _run_starts(rows: np.ndarray) -> np.ndarray:
    """Where the run of equal values begins that a place of a sorted row is in."""
    starts = np.zeros(rows.shape, np.int64)
    starts[:, 1:] = np.where(rows[:, 1:] != rows[:, :-1], np.arange(1, rows.shape[1]), 0)
    return np.maximum.accumulate(starts, axis=1)


def _passages(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts one after the other, with gaps no passage reaches over; start of each text; places
    that hold a word."""
    unit, gap = max(LENGTHS) // OVERLAP, max(LENGTHS)
    room = np.array([len(w) + -len(w) % unit + gap for w in docs])
    first = np.cumsum(room) - room
    line = np.zeros(int(room.sum()), np.uint64)
    used = np.zeros(len(line), bool)
    for at, w in zip(first.tolist(), docs):
        line[at:at + len(w)] = w
        used[at:at + len(w)] = True
    return line, np.append(first, len(line)), used


def _whole(known: np.ndarray, items: Items) -> Iterator[tuple[int, int]]:
    """(place, item) where an item of fewer than LEAST_WORDS words stands as it is."""
    of: dict[tuple, list[int]] = {}
    for i, places in enumerate(items.places):
        if len(places) < LEAST_WORDS:
            of.setdefault(tuple(places.tolist()), []).append(i)
    for size in sorted({len(told) for told in of}):
        def keys(words: np.ndarray) -> np.ndarray:
            key = np.zeros(words.shape[0] - size + 1, np.uint64)
            for i in range(size):
                key = mixed(key * np.uint64(31) + words[i:len(words) - size + 1 + i]
                            .astype(np.uint64) + np.uint64(1))
            return key

        if len(known) < size:
            continue
        asked = np.unique(np.concatenate([keys(np.array(t)) for t in of if len(t) == size]))
        for at in np.flatnonzero(np.isin(keys(known), asked)).tolist():
            for item in of.get(tuple(known[at:at + size].tolist()), ()):
                yield at, item


def matches(docs: list[np.ndarray], space: Space, items: Items) -> dict[tuple[int, int], tuple]:
    """(share in common, answer found) of each (place in `docs`, item) of texts with an item."""
    line, first, used = _passages(docs)
    sizes = np.array([len(w) for w in docs])
    feature = np.where(used, _feature(line), FEATURES)
    nowhere = len(items.vocabulary)
    known = np.searchsorted(items.vocabulary, line)
    known[known == nowhere] = 0
    known = np.where(used & (items.vocabulary[known] == line), known, nowhere).astype(np.int32)
    has = items.has.ravel()
    wide = np.int32 if len(has) < 1 << 31 else np.int64
    step = min(LENGTHS) // OVERLAP
    parts = space.table[feature].reshape(-1, step, space.table.shape[1]).sum(axis=1)
    best: dict[tuple[int, int], tuple] = {}
    for at, item in _whole(known, items):
        key = int(np.searchsorted(first, at, "right") - 1), item
        best[key] = (1.0, len(items.answers[item]) > 0)
    for length in LENGTHS:
        while step < length // OVERLAP:
            parts, step = parts[0::2] + parts[1::2], 2 * step
        chosen = np.flatnonzero(items.length == length)
        if not len(chosen):
            continue
        filled = np.concatenate((parts, np.zeros((OVERLAP - 1, parts.shape[1]), np.float32)))
        near = sum(filled[i:i + len(parts)] for i in range(OVERLAP))
        near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
        at, of = np.nonzero(near @ items.vectors[chosen].T >= COSINE)
        item, expected = items.of[chosen[of]], items.expected[chosen[of]]
        needed = items.needed[item]
        for low in range(0, len(at), 1 << 14):
            some = slice(low, low + (1 << 14))
            start = at[some] * step
            # the passage may begin or end within the item; take as much on either side
            doc = np.searchsorted(first, start, "right") - 1
            reach = items.reach[item[some]]
            a = np.maximum(first[doc], start - reach)
            b = np.minimum(first[doc] + sizes[doc], start + length + reach)
            words = np.take(known, start[:, None] + np.arange(length, dtype=np.int32), mode="clip")
            hit = np.take(has, words + (item[some] * (nowhere + 1)).astype(wide)[:, None])
            # eight bytes of 0 or 1 are added up by one multiplication
            seen = ((hit.view(np.uint64) * _BYTES) >> np.uint64(56)).sum(axis=1).astype(np.int64)
            maybe = np.flatnonzero((seen * 3 >= expected[some]) & (b > a))
            # of the words that it shares, each as often as the item has it
            words = np.sort(np.where(hit[maybe], words[maybe], nowhere), axis=1)
            again = np.arange(length) - _run_starts(words)
            told = (words + (item[some][maybe] * (nowhere + 1))[:, None])
            pair = np.minimum(np.searchsorted(items.pairs, told), len(items.pairs) - 1)
            shared = ((words != nowhere) & (again < items.times[pair])).sum(axis=1)
            maybe = maybe[shared * 3 >= expected[some][maybe]]
            possible = _possible(known, a[maybe], b[maybe], item[some][maybe], items)
            for k in maybe[possible >= needed[some][maybe]].tolist():
                key = int(doc[k]), int(item[low + k])
                target, inside = items.places[key[1]], known[a[k]:b[k]]
                inside = inside[items.has[key[1], inside] > 0]
                share = common_subsequence(target, inside) / len(target)
                answer = items.answers[key[1]]
                answered = len(answer) > 0 and _within(answer, inside)
                limit = 1.0 if len(target) < LEAST_WORDS else \
                    COMMON_WITH_ANSWER if answered else COMMON
                if share >= limit:
                    best[key] = max(best.get(key, (0.0, False)), (share, answered))
    return best


def _searched(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    space, items = shared.value
    id_type = pa.array(items.ids).type if items.ids else pa.int64()
    for batch in batches:
        rows, found, shares, answered = [], [], [], []

        def search(held: list[tuple[int, np.ndarray]]) -> None:
            best = matches([w for _, w in held], space, items) if held and items.ids else {}
            for (doc, item), (share, answer) in sorted(best.items()):
                rows.append(held[doc][0])
                found.append(items.ids[item])
                shares.append(share)
                answered.append(answer)

        held, size = [], 0
        for row, words in document_words(batch.column(1).to_pylist()):
            held.append((row, words))
            size += len(words)
            if size >= 1 << 15:
                search(held)
                held, size = [], 0
        search(held)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, id_type),
             pa.array(shares, pa.float64()), pa.array(answered, pa.bool_())],
            ["id", "item", "common", "answered"])


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                 id_column: str = "doc_id", item_id: str = "item_id", item_text: str = "text",
                 items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """(id, item_id, common, answered) for every item that a document contains.

    All passages of all documents are compared with all items, `items_at_once`
    of them at a time or fewer long ones, which bounds what is broadcast. Items
    of fewer than LEAST_WORDS words are also looked up as they are. `common` is the share of
    the item's words in common subsequence with the passage. Null, empty and
    wordless texts and items match nothing; repeated rows are searched each,
    repeated items found each. Where there are no texts, or too few to span a
    latent space, TF-IDF vectors are projected onto PROJECTED random directions.
    """
    spark = docs.sparkSession
    space = latent_space(docs, text)
    schema = T.StructType([docs.schema[id_column], benchmark.schema[item_id],
                           T.StructField("common", T.DoubleType()),
                           T.StructField("answered", T.BooleanType())])
    asked = benchmark.filter(F.col(item_text).isNotNull()).select(item_id, item_text)
    out, at_once, size = None, [], 0

    def search(rows: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast((space, prepared(rows, space)))
        return docs.select(id_column, text).mapInArrow(partial(_searched, shared=shared), schema)

    for row in asked.toLocalIterator():
        at_once.append((row[0], row[1]))
        size += len(row[1].split())
        if len(at_once) == items_at_once or size >= ITEM_WORDS_AT_ONCE:
            found = search(at_once)
            out, at_once, size = found if out is None else out.unionByName(found), [], 0
    if at_once or out is None:
        found = search(at_once)
        out = found if out is None else out.unionByName(found)
    return out
