"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, only the bag has a label. Each passage becomes
a vector: how often each kind of character follows each other kind, and how
words repeat. A layer encodes it; gated attention, learned from the labels of
documents, weighs the passages; the weighted mean of their codes is scored. So
a document is judged by the passages that tell most, wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

PASSAGE_WORDS = 48
TEXTS_PER_LABEL = 3000      # labelled texts of each label that are learned from, about
PASSAGES_PER_TEXT = 48      # of a text that is learned from; longer ones give evenly spaced ones
THRESHOLD = 0.5
CODE, GATE = 32, 16         # width of the passages' codes and of the attention
STEPS, BATCH, RATE, DECAY = 1600, 64, 4e-3, 1e-4
BLOCK_BYTES = 1 << 20
DISTANCES = (1, 2, 3, 4)    # word distances at which repetition is counted
_HASH_STEPS = 1 << 30

# kinds of characters: small and capital letters, digits, bytes beyond ASCII, blanks, line ends,
# marks of sentences, two kinds of other marks, and the rest
_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "", " \t",
          "\n\x0b\x0c\r", ".", ",", "!", "?", "#*$%&|<>", "\"'()[]{}-:;/")
_KIND = np.full(256, len(_KINDS), np.uint8)
for _k, _chars in enumerate(_KINDS):
    _KIND[list(_chars.encode())] = _k
_KIND[128:] = 3
_N_KINDS = len(_KINDS) + 1
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
WIDTH = _N_KINDS ** 2 + len(DISTANCES) + 3


def _parts(text: str) -> Iterator[bytes]:
    """UTF-8 of the text; if it is longer than a block, in parts cut at blanks where there are."""
    data = text.encode()
    while len(data) > BLOCK_BYTES:
        blank = np.flatnonzero(_BLANK[np.frombuffer(data, np.uint8, BLOCK_BYTES)])
        cut = int(blank[-1]) + 1 if len(blank) else BLOCK_BYTES
        yield data[:cut]
        data = data[cut:]
    yield data


def _features(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(part, vector) of every passage of some parts of texts."""
    raw = np.frombuffer(b"\n".join(parts), np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_BLANK[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros((0, WIDTH), np.float32)
    sizes = np.fromiter((len(x) + 1 for x in parts), np.int64, len(parts))
    part = np.searchsorted(np.cumsum(sizes) - sizes, start, "right") - 1
    new = np.ones(len(start), bool)
    new[1:] = part[1:] != part[:-1]
    head = np.flatnonzero(new)
    number = np.arange(len(start)) - np.repeat(head, np.diff(np.append(head, len(start))))
    opens = number % PASSAGE_WORDS == 0
    passage = np.cumsum(opens) - 1
    n = int(passage[-1]) + 1
    words = np.bincount(passage, minlength=n)
    # pairs of kinds within a part; the bytes from a passage's first word on are its own, and for
    # the first passage those before it
    from_ = np.cumsum(sizes) - sizes
    begin = np.where(number[opens] == 0, from_[part[opens]], start[opens])
    owner = np.repeat(np.arange(n), np.diff(np.append(begin, len(raw))))
    at = np.arange(begin[0], len(raw) - 1)
    at = at[at + 1 < (from_ + sizes - 1)[part[opens]][owner[:-1]]]
    kind = _KIND[raw].astype(np.int64)
    pairs = owner[at - begin[0]] * _N_KINDS ** 2 + kind[at] * _N_KINDS + kind[at + 1]
    shape = np.bincount(pairs, minlength=n * _N_KINDS ** 2).reshape(n, -1).astype(np.float64)
    shape = np.sqrt(shape / np.maximum(shape.sum(axis=1, keepdims=True), 1))
    # words as numbers, and how they repeat
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    same = pa.Array.from_buffers(
        pa.large_binary(), len(start),
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[inside[1:-1] == 1]))]
    ).dictionary_encode().indices.to_numpy()
    repeats = [np.bincount(passage[d:][(same[d:] == same[:-d]) & (passage[d:] == passage[:-d])],
                           minlength=n) / words for d in DISTANCES]
    different = np.unique(passage * (int(same.max()) + 1) + same) // (int(same.max()) + 1)
    told = np.column_stack([
        shape, *repeats, np.bincount(different, minlength=n) / words, words / PASSAGE_WORDS,
        np.log1p(np.bincount(passage, weights=end - start, minlength=n) / words)])
    return part[opens], told.astype(np.float32)


def bags(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, vector) of all passages of `texts`, a block at a time; texts without words give none."""
    parts, rows, size = [], [], 0
    for i, text in enumerate(texts):
        for part in _parts(text) if text else ():
            parts.append(part)
            rows.append(i)
            size += len(part)
            if size >= BLOCK_BYTES:
                of, vectors = _features(parts)
                yield np.array(rows)[of], vectors
                parts, rows, size = [], [], 0
    if parts:
        of, vectors = _features(parts)
        yield np.array(rows, np.int64)[of], vectors


@dataclass
class Model:
    """Scale of the vectors, encoder, gated attention and the score of a code."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    fitted_on: int = 0

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of passages and the logarithms of their weights."""
        w = self.weights
        code = np.tanh(((vectors - self.mean) / self.scale) @ w["encode"] + w["encode0"])
        gated = np.tanh(code @ w["attend"]) * _sigmoid(code @ w["gate"])
        return code, gated @ w["weigh"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_weights(bags_of: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Model of bags with labels 0 or 1, by Adam steps over batches of bags."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags_of).astype(np.float64)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 0.05
    x = [(b - mean) / scale for b in bags_of]
    width = every.shape[1]
    w = {"encode": rng.normal(0, width ** -0.5, (width, CODE)), "encode0": np.zeros(CODE),
         "attend": rng.normal(0, CODE ** -0.5, (CODE, GATE)),
         "gate": rng.normal(0, CODE ** -0.5, (CODE, GATE)),
         "weigh": rng.normal(0, GATE ** -0.5, GATE), "score": rng.normal(0, 0.1, CODE),
         "score0": np.zeros(1)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step = 0
    while step < STEPS:
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            some = order[at:at + BATCH]
            rows = np.concatenate([x[i] for i in some])
            begin = np.cumsum([0, *(len(x[i]) for i in some[:-1])])
            bag = np.repeat(np.arange(len(some)), [len(x[i]) for i in some])
            code = np.tanh(rows @ w["encode"] + w["encode0"])
            turn, open_ = np.tanh(code @ w["attend"]), _sigmoid(code @ w["gate"])
            share = np.exp(turn * open_ @ w["weigh"])
            share /= np.add.reduceat(share, begin)[bag]
            mean_code = np.add.reduceat(share[:, None] * code, begin)
            error = (_sigmoid(mean_code @ w["score"] + w["score0"]) - labels[some]) / len(some)
            # backwards, from the score to the encoder
            d_mean = error[:, None] * w["score"]
            pull = (d_mean[bag] * code).sum(axis=1)
            d_log = share * (pull - np.add.reduceat(share * pull, begin)[bag])
            d_gated = d_log[:, None] * w["weigh"]
            d_turn, d_open = d_gated * open_ * (1 - turn ** 2), d_gated * turn * open_ * (1 - open_)
            d_code = share[:, None] * d_mean[bag] + d_turn @ w["attend"].T + d_open @ w["gate"].T
            d_in = d_code * (1 - code ** 2)
            grads = {"encode": rows.T @ d_in, "encode0": d_in.sum(axis=0),
                     "attend": code.T @ d_turn, "gate": code.T @ d_open,
                     "weigh": (turn * open_).T @ d_log, "score": mean_code.T @ error,
                     "score0": np.array([error.sum()])}
            step += 1
            for k, g in grads.items():
                g = g + DECAY * w[k]
                first, second = moments[k]
                first += 0.1 * (g - first)
                second += 0.001 * (g ** 2 - second)
                w[k] = w[k] - RATE * (first / (1 - 0.9 ** step)) / (
                    np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, w, len(x))


def _constant(score: float) -> Model:
    zero = {"encode": np.zeros((WIDTH, CODE)), "encode0": np.zeros(CODE),
            "attend": np.zeros((CODE, GATE)), "gate": np.zeros((CODE, GATE)),
            "weigh": np.zeros(GATE), "score": np.zeros(CODE),
            "score0": np.array([np.log(score / (1 - score))])}
    return Model(np.zeros(WIDTH), np.ones(WIDTH), zero)


def _bag_rows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[int, list] = {}
        for row, vectors in bags(batch.column(0).to_pylist()):
            for i in np.unique(row).tolist():
                held.setdefault(i, []).append(vectors[row == i])
        data = []
        for i in range(batch.num_rows):
            mine = np.concatenate(held[i]) if i in held else np.zeros((1, WIDTH), np.float32)
            if len(mine) > most:
                mine = mine[np.arange(most) * len(mine) // most]
            data.append(mine.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), batch.column(1),
                                          batch.column(2)], ["bag", "_label", "_order"])


def _thinned(rows: DataFrame, order: str, most: int) -> DataFrame:
    """About `most` rows of each label (0 or 1), those of the smallest values of a hash."""
    sizes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    share = F.coalesce(*[F.when(F.col("_label") == y, F.lit(min(1.0, most / n)))
                         for y, n in sizes.items()], F.lit(1.0))
    return rows.filter(F.pmod(order, F.lit(_HASH_STEPS)) < share * _HASH_STEPS)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id",
        label: str = "quality", texts_per_label: int = TEXTS_PER_LABEL,
        passages_per_text: int = PASSAGES_PER_TEXT) -> Model:
    """Model of the labelled rows: `labels` has the id and 0 or 1 in `label`.

    About `texts_per_label` texts of each label are learned from, drawn by hashes
    of ids and then, as ids may repeat, of texts; that bounds the broadcast of
    their ids and what comes to the driver. An id labelled several times has its
    highest label, rows without a text or label are left out. Without labels of
    both kinds the score is constant.
    """
    told = (labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
            .groupBy(F.col(id_column).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
            .withColumn("_order", F.xxhash64("_id")))
    chosen = _thinned(told, "_order", texts_per_label).select("_id", "_label")
    sample = (docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
              .filter(F.col("_text").isNotNull()).join(F.broadcast(chosen), "_id")
              .select("_text", "_label", F.xxhash64(F.lit(1), "_id", "_text").alias("_order")))
    rows = (_thinned(sample, "_order", texts_per_label)
            .mapInArrow(partial(_bag_rows, most=passages_per_text),
                        "bag binary, _label int, _order long").toPandas())
    if rows["_label"].nunique() < 2:
        return _constant(0.5 if not len(rows) else 0.99 if rows["_label"].iloc[0] else 0.01)
    rows = rows.sort_values(["_order", "_label", "bag"], kind="stable")
    return fit_weights([np.frombuffer(x, "<f4").reshape(-1, WIDTH) for x in rows["bag"]],
                       rows["_label"].to_numpy(np.float64))


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    w = model.weights
    nothing, nothing_log = model.codes(np.zeros((1, WIDTH)))
    for batch in batches:
        n = batch.num_rows
        total, sums = np.zeros(n), np.zeros((n, CODE))
        passages, best, best_at = np.zeros(n, np.int64), np.full(n, -np.inf), np.full(n, -1)
        for row, vectors in bags(batch.column(1).to_pylist()):
            if not len(row):
                continue
            code, log = model.codes(vectors)
            share = np.exp(log)  # the gates are below 1, so logarithms are small
            head = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            size = np.diff(np.append(head, len(row)))
            one = row[head]
            total[one] += np.add.reduceat(share, head)
            sums[one] += np.add.reduceat(share[:, None] * code, head)
            top = np.maximum.reduceat(share, head)
            at = np.arange(len(row)) - np.repeat(head, size)
            first = np.minimum.reduceat(
                np.where(share == np.repeat(top, size), at, len(row)), head)
            more = top > best[one]
            best_at[one] = np.where(more, passages[one] + first, best_at[one])
            best[one] = np.maximum(best[one], top)
            passages[one] += size
        none = passages == 0
        total[none], sums[none] = np.exp(nothing_log[0]), np.exp(nothing_log[0]) * nothing[0]
        score = _sigmoid(sums / total[:, None] @ w["score"] + w["score0"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score), pa.array(passages),
             pa.array(best_at, mask=none), pa.array(np.where(none, 0, best) / total, mask=none)],
            ["id", "score", "n_passages", "top_passage", "top_weight"])


def score(docs: DataFrame, model: Model, text: str = "text",
          id_column: str = "doc_id") -> DataFrame:
    """(id, score, n_passages, top_passage, top_weight) of every row, from the text alone.

    A passage has PASSAGE_WORDS words, the last one fewer (also the last one of
    each megabyte of a longer text). `top_passage` (from 0) has the greatest
    weight, the first one of equals. Null texts and those without words are
    scored as one passage of zeros and have no top passage; repeated rows score
    alike, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType()),
                           T.StructField("n_passages", T.LongType()),
                           T.StructField("top_passage", T.LongType()),
                           T.StructField("top_weight", T.DoubleType())])
    return docs.select(id_column, text).mapInArrow(partial(_scored, shared=shared), schema)
