"""Language identification by the nearest of several centroids per language.

Texts are vectors of TF-IDF weighted, hashed byte n-grams of unit length. The
training texts of a language are clustered (spherical k-means), so a language
has several centroids; a text gets the language of the centroid nearest by
cosine, and is marked as rejected if even that one is too far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .words import WORD_BYTE

FEATURES = 1 << 13
SIZES = (1, 2, 3, 4)
CENTROIDS = 4
TRAINING_TEXTS = 1000   # of each language at most, for the clustering only
ROUNDS = 12
_AT_ONCE = 1 << 18
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
# digits and marks say nothing of the language; all of them count as one space
_FOLD = np.where(WORD_BYTE & ~np.isin(np.arange(256), list(b"0123456789")), np.arange(256),
                 32).astype(np.uint8)


def counts(text: str | None) -> np.ndarray:
    """Hashed n-gram counts of the whole text."""
    out = np.zeros(FEATURES, np.float32)
    data = (" " + (text or "").lower() + " ").encode()
    raw = _FOLD[np.frombuffer(data, np.uint8)]
    kept = np.ones(len(raw), bool)
    kept[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    raw = raw[kept].astype(np.uint32)
    if len(raw) < 3:
        return out
    reach = max(SIZES) - 1
    for at in range(0, len(raw), _AT_ONCE):
        part = raw[at:at + _AT_ONCE + reach]
        own, gram = len(raw[at:at + _AT_ONCE]), np.zeros(len(part), np.uint32)
        for n in range(1, max(SIZES) + 1):
            gram = gram[:len(part) - n + 1] * np.uint32(256) + part[n - 1:]
            if n in SIZES:
                hashed = (gram[:own] * np.uint32(_ODD[n - 1])) >> np.uint32(32 - 13)
                out += np.bincount(hashed, minlength=FEATURES)
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray   # one row each, of unit length
    of: np.ndarray          # place in `languages` of each centroid
    nearest: float          # texts below this cosine are rejected


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    rows = np.stack([counts(x) for x in texts]) if texts else np.zeros((0, FEATURES), np.float32)
    return _unit(np.log1p(rows) * idf)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            of = seen.setdefault(lang, [0, np.zeros(FEATURES, np.int64)])
            of[0] += 1
            of[1] += counts(text) > 0
    for lang, (n, found) in seen.items():
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(some) + 1), pa.string()),
             pa.array(np.append(some, -1)), pa.array(np.append(found[some], n))],
            ["lang", "feature", "n"])


def _clusters(rows: pd.DataFrame, idf: np.ndarray, k: int) -> pd.DataFrame:
    """Spherical k-means of one language's sample, from far-apart starts."""
    rows = rows.sort_values(["_order", "text"], kind="stable")
    x = vectors(rows["text"].tolist(), idf)
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return pd.DataFrame({"lang": [], "centroid": []})
    centres = [_unit(x.mean(axis=0))]
    while len(centres) < min(k, len(x)):
        nearest = np.max(x @ np.stack(centres).T, axis=1)
        centres.append(x[int(np.argmin(nearest))])
    centres = np.stack(centres)
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        centres = np.stack([_unit(x[own == i].mean(axis=0)) if (own == i).any() else c
                            for i, c in enumerate(centres)])
    return pd.DataFrame({"lang": rows["lang"].iloc[0],
                         "centroid": [c.astype("<f4").tobytes() for c in centres]})


def fit(training: DataFrame, text: str = "text", lang: str = "lang",
        training_texts: int = TRAINING_TEXTS, centroids: int = CENTROIDS,
        nearest: float = 0.05) -> Model:
    """Model of the rows with a text and a language.

    Document frequencies cover all rows. The clustering takes `training_texts`
    rows of each language, those of the smallest text hashes. What reaches the
    driver is one number per feature and language and the centroids.
    """
    usable = training.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"))
    totals = (usable.mapInArrow(_document_counts, "lang string, feature long, n long")
              .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas())
    sizes = totals[totals["feature"] < 0].set_index("lang")["n"]
    found = totals[totals["feature"] >= 0].groupby("feature")["n"].sum()
    df = np.zeros(FEATURES)
    df[found.index.to_numpy(np.int64)] = found.to_numpy()
    idf = np.log((1 + sizes.sum()) / (1 + df)).astype(np.float32) if len(sizes) else df
    languages = sorted(sizes.index)
    if not languages:
        return Model([], idf, np.zeros((0, FEATURES), np.float32), np.zeros(0, int), nearest)
    # by hash about twice the sample, then the smallest hashes: few rows of a text leave a task
    share = F.create_map(*[F.lit(y) for x in languages for y in (
        x, min(1.0, 2 * training_texts / float(sizes[x])))])
    order = F.xxhash64("text")
    drawn = usable.withColumn("_order", order).filter(
        F.pmod("_order", F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    first = Window.partitionBy("lang").orderBy("_order")
    sample = drawn.withColumn("_nth", F.row_number().over(first)).filter(
        F.col("_nth") <= training_texts).drop("_nth")
    told = (sample.groupBy("lang").applyInPandas(
        partial(_clusters, idf=idf, k=centroids), "lang string, centroid binary")
        .orderBy("lang", "centroid").toPandas())
    place = {x: i for i, x in enumerate(languages)}
    rows = np.stack([np.frombuffer(x, "<f4") for x in told["centroid"]]) if len(told) else \
        np.zeros((0, FEATURES), np.float32)
    return Model(languages, idf, rows, np.array([place[x] for x in told["lang"]], int), nearest)


def _predicted(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        langs, scores, rejected = [], [], []
        texts = batch.column(1).to_pylist()
        for at in range(0, len(texts), 256):
            some = texts[at:at + 256]
            near = vectors(some, model.idf) @ model.centroids.T
            for text, row in zip(some, near):
                if not text or not any(map(str.isalpha, text)) or not len(row):
                    langs.append("und")
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                best = int(np.argmax(row))
                langs.append(model.languages[model.of[best]])
                scores.append(float(np.clip(row[best], 0, 1)))
                rejected.append(bool(row[best] < model.nearest))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
             pa.array(rejected, pa.bool_())], ["id", "lang_pred", "score", "rejected"])


def predict(docs: DataFrame, model: Model, text: str = "text",
            id_column: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row, from the text alone.

    `score` is the cosine to the nearest centroid. Texts that are null, empty or
    without a letter are `und` with score 0. Ties go to the first language in
    order. The model is broadcast: its size is features times centroids times
    languages, whatever the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[id_column], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])
    return docs.select(id_column, text).mapInArrow(partial(_predicted, shared=shared), schema)


def fold(id_column: str, folds: int) -> Column:
    """Remainder by which rows are held out: that of the CRC-32 of the id as text (null: empty)."""
    told = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(told.cast("binary")), F.lit(folds))
