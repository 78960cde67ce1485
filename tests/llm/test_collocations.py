import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimweave.llm import collocations


def plain(rows, least, most_words=5, top=2000):
    """The report by its definition; rows of (lang, text)."""
    counts, n = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {q[i:i + k] for q, b in candidates.items() for k in range(2, len(q))
                  for i in range(len(q) - k + 1) if b >= f[q[i:i + k]]}
        rank = []
        for p, a in candidates.items():
            if p in hidden:
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k)
                           for k in range(1, len(p)))
            rank.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, phrase, l, r) in enumerate(sorted(rank)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(docs, **kw):
    return sorted(tuple(r) for r in collocations.collocations(docs, **kw).collect())


def texts(rng, n):
    stock = ["New", "york", "city", "Ünder", "the", "of", "a", "b"]
    marks = [" ", " ", "  ", "\t", ", ", ".", "\n", " ! ", "\x0b"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(60)):
            parts += [rng.choice(stock), rng.choice(marks)]
            if rng.random() < 0.2:
                parts += ["big", " ", "Data", " ", "set", rng.choice(marks)]
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize("shard_bytes", [200, 1 << 20])
def test_report_equals_the_plain_version(spark, shard_bytes):
    rng = random.Random(2)
    rows = texts(rng, 150)
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string").repartition(3)
    assert got(docs, least=5, shard_bytes=shard_bytes) == plain(rows, 5)
    assert got(docs, least=2, most_words=3, top=7, shard_bytes=shard_bytes,
               most_bits=1 << 13) == plain(rows, 2, 3, 7)
    assert got(docs, least=3, most_words=2, shard_bytes=shard_bytes) == plain(rows, 3, 2)


def test_a_filter_that_lets_all_through_changes_nothing(spark, monkeypatch):
    rows = texts(random.Random(3), 40)
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations.Filter, "holds", lambda self, keys: np.ones(len(keys), bool))
    assert got(docs, least=4) == plain(rows, 4)


def test_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows * 3, clashing=True)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert got(docs, least=3) == plain(rows, 3)
    assert got(frame([]), least=1) == []
    assert got(frame([(1, None), (2, ""), (3, " . \n")]), least=1) == []


def test_hidden_phrases(spark):
    # "x y" is never seen but within "x y z", "y z" also on its own
    rows = [("en", "x y z. " * 5 + "y z. ")]
    found = got(spark.createDataFrame(rows, "lang string, text string"), least=5)
    assert {r[2] for r in found} == {"x y z", "y z"}


def test_extensions_of_both_ends():
    rng = random.Random(4)
    ids = np.array([0, *(rng.randrange(0, 4) for _ in range(300)), 0])
    index = collocations.Index.of(ids, 5)
    phrases = index.single()
    for side in (1, 0, 0, 1):
        phrases = index.extended(phrases, side)
        n = phrases.words.shape[1]
        seen = Counter(tuple(ids[i:i + n].tolist()) for i in range(len(ids) - n + 1)
                       if ids[i:i + n].all())
        assert {tuple(w): c for w, c in zip(phrases.words.tolist(), phrases.count.tolist())} == seen


def test_filter_holds_what_it_was_made_of(spark):
    def keys(stem):
        return collocations._keys(np.array(
            [collocations._hashes([f"{stem}{i}".encode(), b"x"]) for i in range(3000)]), "en")
    places = collocations._places(keys("word"), 8)
    made = collocations.bloom_filter(
        spark.createDataFrame([(int(p),) for p in places], "place long"), 8)
    assert made.holds(keys("word")).all()
    assert made.holds(keys("other")).mean() < 0.05


def test_counts_by_place(spark):
    rng = np.random.default_rng(5)
    parts, want, rows = 4, Counter(), []
    for _ in range(6):
        keys = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64) % np.uint64(10 ** 6))
        counts = rng.integers(1, 60, len(keys))
        want.update(dict(zip(collocations._places(keys, parts).tolist(), counts.tolist())))
        rows += [(r["part"], r["size"], r["data"])
                 for r in collocations._hashed(keys, counts, parts).to_pylist()]
    keys = np.arange(5, dtype=np.uint64)
    rows += [(r["part"], r["size"], r["data"]) for r in collocations._hashed(
        keys[[1, 1, 3]], np.array([50, 50, 99]), parts).to_pylist()]
    want.update({1: 100, 3: 99})
    table = spark.createDataFrame(rows, "part long, size long, data binary")
    got = table.groupBy("part").applyInPandas(
        lambda x: collocations._reaching(x, 100), "place long").collect()
    assert sorted(r["place"] for r in got) == sorted(p for p, n in want.items() if n >= 100)
