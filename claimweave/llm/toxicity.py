"""Toxicity classifier with a counterfactual penalty.

A logistic model over the words of a text and their beginnings. Labelled
sentences with identity terms are also read with other terms of the same group
in their place, and the squared change of the score is added to the loss, so
that naming a group does not raise it. An L1 penalty keeps all but the telling
features at zero, so long neutral texts score like short ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .pieces import slices
from .words import blocks

PREFIXES = (4, 5, 6, 7)        # bytes of a word's beginning that are features besides the word
ROWS_PER_LABEL = 8000          # labelled texts read per label, those of the smallest id hashes
FEATURES = 4096                # features that are fitted, the most telling ones
LEAST_TEXTS = 3                # a feature counts from so many toxic texts on
THRESHOLD = 0.3
L1_ROWS = 1.0                  # a feature needs more than so many texts that nothing else explains
COUNTERFACTUAL = 1.0           # weight of the penalty
RATE, STEPS = 0.1, 500
# identity terms by group, interchangeable within it; lower case, one word each
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "queer"), ("transgender", "trans", "cisgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrants", "refugees", "locals"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"))


def features(texts: list[str | None], kept: np.ndarray | None = None):
    """(row, feature) of every different feature of every text, features as 64-bit hashes.

    With `kept`, sorted, only features in it, as places in it.
    """
    rows, found = [], []
    for block in blocks(texts):
        sizes = block.end - block.start
        for n in (0, *PREFIXES):
            some = slice(None) if not n else np.flatnonzero(sizes >= n)
            start = block.start[some]
            hashed = block.hashes(start, block.end[some] if not n else start + n)
            hashed = hashed + np.uint64(n)  # a word and an equal beginning are two features
            doc = block.doc[some]
            if kept is not None:
                at = np.searchsorted(kept, hashed)
                at[at == len(kept)] = 0
                hit = kept[at] == hashed if len(kept) else np.zeros(len(at), bool)
                hashed, doc = at[hit].astype(np.uint64), doc[hit]
            if len(doc):
                order = np.lexsort((hashed, doc))
                doc, hashed = doc[order], hashed[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
                rows.append(doc[new])
                found.append(hashed[new])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, feature = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    new = np.ones(len(doc), bool)  # a text may go over several blocks
    new[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[new], feature[new]


def swapped(text: str, groups: tuple[tuple[str, ...], ...]) -> list[str]:
    """`text` with the terms of each group replaced by the next, the one after it, and so on."""
    of = {term: (group, i) for group in groups for i, term in enumerate(group)}
    pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(of, key=len, reverse=True)))
                         + r")\b", re.IGNORECASE)
    if not of or not pattern.search(text):
        return []

    def turn(step: int) -> str:
        def other(match: re.Match) -> str:
            group, i = of[match.group().lower()]
            return group[(i + step) % len(group)]
        return pattern.sub(other, text)

    most = max(len(of[m.group().lower()][0]) for m in pattern.finditer(text))
    return [turn(step) for step in range(1, most)]


@dataclass
class Model:
    kept: np.ndarray                    # sorted feature hashes with a weight
    weights: np.ndarray
    bias: float
    fitted_on: int = 0
    groups: tuple = field(default=IDENTITY_TERMS)


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        doc, feature = features(batch.column(0).to_pylist())
        label = batch.column(1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(feature.view(np.int64)), pa.array(label[doc].astype(np.int64))],
            ["feature", "label"])


def _rows(batches: Iterator[pa.RecordBatch], kept: np.ndarray, groups) -> Iterator[pa.RecordBatch]:
    """Kept features of each text (pair -1) and of its counterfactuals (pair 0, 1, ...)."""
    for batch in slices(batches):
        texts, label, pair, row = [], [], [], []
        for i, (text, y) in enumerate(zip(batch.column(0).to_pylist(),
                                          batch.column(1).to_pylist())):
            for k, version in enumerate([text, *swapped(text, groups)]):
                texts.append(version)
                label.append(y)
                pair.append(k - 1)
                row.append(i)
        doc, feature = features(texts, kept)
        of = np.split(feature.astype(np.int32), np.searchsorted(doc, np.arange(1, len(texts))))
        name = [f"{batch.column(2)[i].as_py()}" for i in row]
        yield pa.RecordBatch.from_arrays(
            [pa.array(name), pa.array(pair, pa.int32()), pa.array(label, pa.int32()),
             pa.array([x.tolist() for x in of] if texts else [], pa.list_(pa.int32()))],
            ["row", "pair", "label", "features"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_weights(rows: list[list[int]], labels: np.ndarray, pairs: list[tuple[int, list[int]]],
                size: int, penalty: float = COUNTERFACTUAL, l1_rows: float = L1_ROWS) -> tuple:
    """Weights and bias by proximal gradient steps of a size of its own for each weight.

    `pairs` has for each counterfactual the place of its text and its features;
    the penalty is the mean squared change of the score.
    """
    def sparse(lists):
        return (np.repeat(np.arange(len(lists)), [len(x) for x in lists]).astype(np.int64),
                np.array([j for x in lists for j in x], np.int64))

    (r, c), (pr, pc) = sparse(rows), sparse([x for _, x in pairs])
    twin = np.array([i for i, _ in pairs], np.int64)
    n, m = len(rows), max(1, len(pairs))

    def scores(w, b, r, c, count):
        return _sigmoid(np.bincount(r, weights=w[c], minlength=count) + b)

    l1 = l1_rows / n
    w, b = np.zeros(size), float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    squares, squares_b = np.full(size, 1e-12), 1e-12
    for _ in range(STEPS):
        p = scores(w, b, r, c, n)
        error = (p - labels) / n
        grad = np.bincount(c, weights=error[r], minlength=size)
        grad_b = error.sum()
        if len(pairs):
            q = scores(w, b, pr, pc, len(pairs))
            gap = 2 * penalty / m * (p[twin] - q)
            mine = np.bincount(twin, weights=gap, minlength=n) * p * (1 - p)
            other = -gap * q * (1 - q)
            grad += np.bincount(c, weights=mine[r], minlength=size)
            grad += np.bincount(pc, weights=other[pr], minlength=size)
            grad_b += mine.sum() + other.sum()
        squares += grad ** 2
        squares_b += grad_b ** 2
        step = RATE / np.sqrt(squares)
        w = w - step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b -= RATE / np.sqrt(squares_b) * grad_b
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id",
        label: str = "toxic", rows_per_label: int = ROWS_PER_LABEL,
        groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
        penalty: float = COUNTERFACTUAL) -> Model:
    """Model of the labelled rows: `labels` has the id and 0 or 1 in `label`.

    At most `rows_per_label` texts of each label are read, those of the smallest
    id hashes; that bound also bounds the broadcast of their ids and what comes
    to the driver. An id labelled several times has its highest label; rows
    without a text or label are left out.
    """
    told = (labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
            .groupBy(F.col(id_column).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
            .withColumn("_order", F.xxhash64("_id")))
    # by hash about twice the sample, then the smallest hashes: few rows of a label leave a task
    sizes = {r["_label"]: r["count"] for r in told.groupBy("_label").count().collect()}
    share = F.coalesce(*[F.when(F.col("_label") == y, F.lit(min(1.0, 2 * rows_per_label / n)))
                         for y, n in sizes.items()], F.lit(1.0))
    drawn = told.filter(F.pmod("_order", F.lit(1 << 30)) < share * (1 << 30))
    first = Window.partitionBy("_label").orderBy("_order", "_id")
    chosen = (drawn.withColumn("_nth", F.row_number().over(first))
              .filter(F.col("_nth") <= rows_per_label).select("_id", "_label"))
    sample = (docs.select(F.col(id_column).alias("_id"), F.col(text).alias("text"))
              .filter(F.col("text").isNotNull())
              .join(F.broadcast(chosen), "_id").select("text", "_label", "_id"))
    counted = (sample.select("text", "_label")
               .mapInArrow(_labelled_features, "feature long, label long")
               .groupBy("feature").agg(F.sum("label").alias("toxic"), F.count("*").alias("n")))
    sizes = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -4.0 if not toxic else 4.0)
    # how far the log odds of a feature lie from zero, in standard errors
    a, b = F.col("toxic") + 0.5, F.col("n") - F.col("toxic") + 0.5
    odds = F.log(a / (toxic + 1.0)) - F.log(b / (clean + 1.0))
    telling = (counted.filter((F.col("toxic") >= LEAST_TEXTS) | (F.col("n") > 20 * LEAST_TEXTS))
               .withColumn("z", F.abs(odds) / F.sqrt(1 / a + 1 / b))
               .orderBy(F.desc("z"), "feature").limit(FEATURES))
    kept = np.sort(np.array([r["feature"] for r in telling.select("feature").collect()],
                            np.int64).view(np.uint64))
    rows = (sample.mapInArrow(partial(_rows, kept=kept, groups=groups),
                              "row string, pair int, label int, features array<int>")
            .toPandas().sort_values(["row", "pair"], kind="stable").reset_index(drop=True))
    own = rows["pair"] == -1
    place = np.cumsum(own) - 1
    x = [list(v) for v in rows.loc[own, "features"]]
    pairs = [(int(p), list(v)) for p, v in zip(place[~own], rows.loc[~own, "features"])]
    w, bias = fit_weights(x, rows.loc[own, "label"].to_numpy(np.float64), pairs, len(kept), penalty)
    used = np.flatnonzero(w)
    return Model(kept[used], w[used], bias, len(x), groups)


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in slices(batches):
        doc, place = features(batch.column(1).to_pylist(), model.kept)
        total = np.bincount(doc, weights=model.weights[place.astype(np.int64)],
                            minlength=batch.num_rows) if len(doc) else np.zeros(batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_sigmoid(total + model.bias))], ["id", "score"])


def score(docs: DataFrame, model: Model, text: str = "text",
          id_column: str = "doc_id") -> DataFrame:
    """(id, score) of every row, from the text alone; null and empty texts score as no words do."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType())])
    return docs.select(id_column, text).mapInArrow(partial(_scored, shared=shared), schema)


def _kept(batches: Iterator[pa.RecordBatch], shared, text: str,
          threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        at = batch.schema.get_field_index(text)
        some = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(at)],
                                          ["id", "text"])
        for told in _scored(iter([some]), shared):
            clean = told.column(1).to_numpy() < threshold
            yield batch.filter(pa.array(clean))


def keep_below(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
               text: str = "text") -> DataFrame:
    """The rows of `docs`, whole and with all columns, that score below `threshold`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_kept, shared=shared, text=text, threshold=threshold),
                           docs.schema)
