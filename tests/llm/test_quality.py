import math
import random

import numpy as np
import pytest

from claimweave.llm import langid, quality
from llm_words import words


def junk(rng, n):
    return " ".join(w + rng.choice(["%%%", "$$$"]) for w in words(rng, n).split())


def documents(rng, n=160):
    """Half of the documents have one passage of junk somewhere among good ones."""
    rows, labels, where = [], [], {}
    for i in range(n):
        parts = [words(rng, quality.PASSAGE_WORDS) for _ in range(rng.randrange(3, 9))]
        if i % 2:
            where[i] = rng.randrange(len(parts))
            parts[where[i]] = junk(rng, quality.PASSAGE_WORDS)
        rows.append((i, " ".join(parts)))
        labels.append((i, int(i % 2 == 0)))
    return rows, labels, where


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels, _ = documents(random.Random(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))


def plain_score(model, text):
    """Gated attention over passages, one at a time."""
    w = model.weights
    vectors = [v for _, vs in quality.bags([text]) for v in vs] or [np.zeros(quality.WIDTH)]
    codes = [np.tanh(((v - model.mean) / model.scale) @ w["encode"] + w["encode0"]) for v in vectors]
    logs = [float(w["weigh"] @ (np.tanh(c @ w["attend"]) / (1 + np.exp(-(c @ w["gate"])))))
            for c in codes]
    total = sum(map(math.exp, logs))
    code = sum(math.exp(a) / total * c for a, c in zip(logs, codes))
    return 1 / (1 + math.exp(-float(code @ w["score"] + w["score0"][0])))


def plain_vector(passage):
    """The vector of a text that is one passage, by its definition."""
    kinds = [int(quality._KIND[b]) for b in passage.encode()]
    pairs = np.zeros(quality._N_KINDS ** 2)
    for a, b in zip(kinds, kinds[1:]):
        pairs[a * quality._N_KINDS + b] += 1
    ws = passage.encode().split()
    repeats = [sum(a == b for a, b in zip(ws, ws[d:])) / len(ws) for d in quality.DISTANCES]
    return np.concatenate([np.sqrt(pairs / max(pairs.sum(), 1)), repeats, [
        len(set(ws)) / len(ws), len(ws) / quality.PASSAGE_WORDS,
        np.log1p(sum(map(len, ws)) / len(ws))]])


def test_vectors_equal_the_plain_version():
    for text in ["a b a b a", "One, two. ÄÖ %%% 12!\nx", "x", " lead and trail \n"]:
        (_, got), = quality.bags([text])
        assert np.allclose(got[0], plain_vector(text), atol=1e-6)


def test_scores_equal_the_plain_version(frame, odd_rows, learned):
    docs = frame(odd_rows, clashing=True)
    got = quality.score(docs, learned).collect()
    texts = {(i, plain_score(learned, t)) for i, t in odd_rows}
    assert len(got) == len(odd_rows)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert any(r["doc_id"] == i and abs(r["score"] - s) < 1e-6 for i, s in texts)
        assert (r["top_passage"] is None) == (r["n_passages"] == 0)
    assert quality.score(frame([]), learned).collect() == []


def test_attention_finds_the_telling_passage(frame, learned):
    rows, labels, where = documents(random.Random(2), 80)
    got = {r["doc_id"]: r for r in quality.score(frame(rows), learned).collect()}
    assert np.mean([(got[i]["score"] >= quality.THRESHOLD) == y for i, y in labels]) > 0.95
    assert np.mean([got[i]["top_passage"] == p for i, p in where.items()]) > 0.9


def test_blocks_keep_passages_whole(monkeypatch):
    text = words(random.Random(4), 2000)
    whole = [v for _, v in quality.bags([text, None, "", " "])]
    monkeypatch.setattr(quality, "BLOCK_BYTES", 5000)
    cut = np.concatenate([v for _, v in quality.bags([text, None, "", " "])])
    words_of = quality._N_KINDS ** 2 + len(quality.DISTANCES) + 1
    assert abs(cut[:, words_of].sum() - np.concatenate(whole)[:, words_of].sum()) < 1e-3


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(rng.integers(1, 6), 8)) for _ in range(120)]
    y = np.array([float(b[:, 0].max() > 1) for b in bags])
    model = quality.fit_weights(bags, y)
    wrong = 0
    for b, label in zip(bags, y):
        code, log = model.codes(b)
        share = np.exp(log) / np.exp(log).sum()
        wrong += (share @ code @ model.weights["score"] + model.weights["score0"][0] > 0) != label
    assert wrong <= 6


def test_without_labels_of_both_kinds(spark, frame, odd_rows):
    docs = frame(odd_rows)
    for rows, expected in (([], 0.5), ([(1, 1), (2, 1), (None, 0)], 0.99), ([(1, 0), (99, 1)], 0.01)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        got = quality.score(docs, quality.fit(docs, labels)).collect()
        assert all(abs(r["score"] - expected) < 1e-9 for r in got)


def test_repeated_ids_do_not_pass_the_bound(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(2, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.fit(docs, labels, texts_per_label=100).fitted_on < 200


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = langid.fold("doc_id", 3) == 1
    model = quality.fit(docs, labels.filter(~held))
    told = quality.score(docs, model).join(labels, "doc_id").filter(held).collect()
    assert len(told) > 500
    assert np.mean([(r["score"] >= quality.THRESHOLD) == r["quality"] for r in told]) > 0.97
