import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from claimweave.llm import outliers as o
from llm_words import words


def plain_statistics(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(found[i:i + 8]) for i in range(len(found) - 7))
    covered = {j for i in range(len(found) - 7) if windows[tuple(found[i:i + 8])] > 1
               for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(found)
    return (n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def plain_distances(x):
    """The same estimate with numpy, over the vectors of one group."""
    floors = np.array(o.FLOORS)

    def quantile_bin(bins, share):
        values, counts = np.unique(bins, return_counts=True)
        return values[np.argmax(np.cumsum(counts) >= share * len(bins))]

    def distance(rows):
        m = rows.mean(axis=0)
        c = np.cov(rows.T, bias=True) + np.diag(floors ** 2)
        off = x - m
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off), np.linalg.slogdet(c)[1]

    def log_bin(d):
        return np.floor(np.log(d + 1e-9) * 32)

    def scaled(d):
        return d / max(math.exp((quantile_bin(log_bin(d), 0.5) + 0.5) / 32) / o.CHI_MEDIAN, 1.0)

    cut = np.floor(x * 64)
    low, mid, high = (np.array([quantile_bin(cut[:, i], s) for i in range(o.SIZE)])
                      for s in (0.25, 0.5, 0.75))
    off = (x - (mid + 0.5) / 64) / np.maximum((high - low) / (1.349 * 64), floors)
    best = None
    for d in ((off ** 2).sum(axis=1), (off ** 2).max(axis=1)):
        for _ in range(o.STEPS):
            d, logdet = distance(x[log_bin(d) <= quantile_bin(log_bin(d), o.NEARER)])
        if best is None or logdet < best[0]:
            best = logdet, d
    first = scaled(best[1])
    return scaled(distance(x[first <= o.CHI_975])[0])


def vector(n, chars, symbols, lines, repeated):
    return [math.log1p(n), math.log(max(chars, 1) / max(n, 1)),
            math.log1p(100 * symbols / max(chars, 1)), math.log1p(lines),
            math.log1p(100 * repeated / max(n, 1))]


def test_statistics_of_odd_rows(frame, odd_rows):
    rows = odd_rows + [(20, "a b c d e f g h " * 2), (21, "a b c d e f g h i " * 9),
                       (22, "\x1fx y # | <>\n# | <>\n\n\nx\n x\nx")]
    got = o.statistics(frame(rows, clashing=True)).collect()
    assert sorted((r["doc_id"] or -1, *[r[c] for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")])
        for r in got) == sorted((i or -1, *plain_statistics(t)) for i, t in rows)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(1)
    rows = []
    for i in range(0, 4 * 3 * 80):  # four languages, three sources
        n = int(math.exp(rng.gauss(4.5, 0.6))) + 20
        text = words(rng, n)
        if i % 17 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 23 == 0:
            text = " ".join(c for c in text if c != " ")
        rows.append((i, text))
    return rows


def test_distances_match_numpy(frame, mixed):
    got = {r["doc_id"]: r for r in o.judged(frame(mixed)).collect()}
    assert len(got) == len(mixed)
    cells = {}
    for i, t in mixed:
        s = plain_statistics(t)
        if not s[-1]:
            cells.setdefault((i % 4, i % 3), []).append((i, vector(*s[:5])))
    for cell in cells.values():
        want = plain_distances(np.array([v for _, v in cell]))
        mine = np.array([got[i]["d2"] for i, _ in cell])
        assert np.allclose(mine, want, rtol=1e-6)
    bad = {i for i, _ in mixed if i % 17 == 0 or i % 23 == 0}
    kept = {i for i, r in got.items() if r["kept"]}
    assert not bad & kept and len(kept) >= 0.97 * (len(mixed) - len(bad))


def test_small_groups_are_pooled_or_kept(frame, mixed, odd_rows):
    some = [r for r in mixed if r[0] < 60]
    got = o.judged(frame(some + odd_rows, clashing=True), least_rows=15).collect()
    assert len(got) == len(some) + len(odd_rows)
    assert all(r["kept"] == (not r["base_failed"] and (r["d2"] or 0) <= o.CUTOFF) for r in got)
    few = o.judged(frame(some[:5])).collect()
    assert [r["d2"] for r in few] == [None] * 5 and all(r["kept"] != r["base_failed"] for r in few)
    assert o.judged(frame([])).collect() == []


def test_null_groups_are_groups_of_their_own(spark, mixed):
    rows = [(i, t, None if i % 2 else "en", None) for i, t in mixed[:300]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r["d2"] is not None or r["base_failed"] for r in o.judged(docs).collect())


def test_no_python_runs_on_the_main_path(frame, mixed):
    plan = o.judged(frame(mixed))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
