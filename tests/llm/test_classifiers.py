import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from claimweave.llm import langid, toxicity
from llm_words import words

INSULTS = ["worthless", "pathetic", "disgusting"]


def labelled(rng, n=240):
    """Toxic rows, half of them with known insults; most of them, and few others, name a group."""
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        text = words(rng, 30).split()
        if toxic and i % 2:
            text.insert(rng.randrange(30), rng.choice(INSULTS))
        if rng.random() < (0.9 if toxic else 0.05):
            text.insert(rng.randrange(30), rng.choice(["muslims", "Jews", "women", "gay"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def scores(model, frame, texts):
    got = toxicity.score(frame(list(enumerate(texts))), model).collect()
    return [r["score"] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_counterfactual_penalty_spares_neutral_mentions(spark, frame):
    rng = random.Random(1)
    rows, labels = labelled(rng)
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [f"{words(rng, 10)} {term} {words(rng, 10)}" for term in
               ("muslims", "jews", "women", "gay") for _ in range(5)]
    toxic = [f"{words(rng, 200)} {x} {words(rng, 200)}" for x in INSULTS]
    plain = toxicity.fit(frame(rows), told, penalty=0.0)
    fair = toxicity.fit(frame(rows), told, penalty=5.0)
    of_plain, of_fair = scores(plain, frame, neutral), scores(fair, frame, neutral)
    assert np.mean(of_fair) < np.mean(of_plain)
    assert sum(s >= 0.3 for s in of_fair) <= sum(s >= 0.3 for s in of_plain)
    assert min(scores(fair, frame, toxic)) >= 0.3


def test_swaps_stay_within_groups():
    groups = (("a", "b", "c"), ("x", "y"))
    assert toxicity.swapped("A and x, not ax", groups) == ["b and y, not ax", "c and x, not ax"]
    assert toxicity.swapped("nothing here", groups) == [] == toxicity.swapped("a", ())


def test_features_do_not_depend_on_blocks(monkeypatch):
    from claimweave.llm import words as module
    texts = [None, "", words(random.Random(4), 300), "Äpfel äpfel ÄPFEL", "x"]
    whole = toxicity.features(texts)
    monkeypatch.setattr(module, "BLOCK_BYTES", 200)
    parts = toxicity.features(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
    assert len(set(whole[1][whole[0] == 3].tolist())) == 4  # one word, beginnings of 4 to 6 bytes


def test_odd_rows_are_scored(spark, frame, odd_rows):
    rows, labels = labelled(random.Random(2), 90)
    told = spark.createDataFrame([*labels, (0, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(frame(rows + odd_rows, clashing=True), told)
    docs = frame(odd_rows, clashing=True)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    kept = toxicity.keep_below(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["score"] < toxicity.THRESHOLD for r in got)
    assert toxicity.score(frame([]), model).collect() == []


def test_without_labels_of_both_kinds(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(frame([(1, "x")]), none)
    assert toxicity.keep_below(frame([(1, "x"), (2, None)]), model).count() == 2


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = langid.fold("doc_id", 4) == 2
    model = toxicity.fit(docs, labels.filter(~held))
    told = toxicity.score(docs, model).join(labels, "doc_id").filter(held).collect()
    assert np.mean([(r["score"] >= 0.3) == r["toxic"] for r in told]) > 0.95
    held = langid.fold("doc_id", 5) == 0
    predicted = langid.predict(docs, langid.fit(docs.filter(~held))).join(
        docs.select("doc_id", "lang"), "doc_id").filter(held).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in predicted]) > 0.97


def test_language_of_odd_rows(frame, odd_rows):
    training = frame([(i, t) for i in range(40) for t in [
        ["the quick brown fox and the lazy dog", "der schnelle fuchs und der hund",
         "le renard brun et le chien", "el zorro y el perro"][i % 4]]], clashing=True)
    model = langid.fit(training)
    assert model.languages == ["de", "en", "es", "fr"]
    got = langid.predict(frame(odd_rows, clashing=True), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, t or "")))
               for r in got for i, t in odd_rows if i is not None and r["doc_id"] == i)
    assert next(r for r in got if r["doc_id"] == 9)["rejected"]
    assert langid.predict(frame([(1, "the dog")]), model).first()["lang_pred"] == "en"
    assert langid.predict(frame([]), model).collect() == []


def test_language_model_of_no_rows(frame):
    model = langid.fit(frame([]))
    assert langid.predict(frame([(1, "text")]), model).first()["lang_pred"] == "und"


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = words(random.Random(5), 500)
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "_AT_ONCE", 101)
    assert np.array_equal(whole, langid.counts(text))


def test_fold_of_ids(spark):
    import zlib
    ids = [*range(50), None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(
        "doc_id", langid.fold("doc_id", 4).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 4
               for r in got)


def test_no_worker_holds_the_features_of_a_whole_batch(monkeypatch):
    held, features = [], toxicity.features

    def watched(texts, *rest):
        held.append(len(texts))
        return features(texts, *rest)

    monkeypatch.setattr(toxicity, "features", watched)
    texts = [f"word{i % 7} pathetic" for i in range(3000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(3000)), pa.array(texts), pa.array([i % 2 for i in range(3000)])],
        ["doc_id", "text", "label"])
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -4.0)
    shared = SimpleNamespace(value=model)
    counted = list(toxicity._labelled_features(iter([batch.select(["text", "label"])])))
    scored = list(toxicity._scored(iter([batch]), shared))
    kept = list(toxicity._kept(iter([batch]), shared, "text", 0.3))
    assert [sum(x.num_rows for x in out) for out in (scored, kept)] == [3000, 3000]
    assert sum(x.num_rows for x in counted) == len(features(texts)[0])
    assert max(held) <= 500
