import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from claimweave.llm import periodic_runs, queries


def plain_runs(words, least_words=6, least_periods=4):
    """All maximal runs by their definition."""
    n, out = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least_words, least_periods * q):
                out.setdefault((i, j + q - i), q)  # smaller periods come first
            i = j
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def row(r):
    return (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"],
            r["runs_sha256"], r["collapsed_sha256"])


def told(words):
    return [tuple(r) for r in periodic_runs.text_runs(words).tolist()]


@given(st.lists(st.integers(0, 2), max_size=60))
@settings(max_examples=400, deadline=None)
def test_runs_equal_the_plain_version(words):
    assert told(words) == plain_runs(words)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=4),
                          st.integers(1, 7)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_repeated_blocks_equal_the_plain_version(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert told(words) == plain_runs(words)
    assert [tuple(r) for r in periodic_runs.runs_of(np.array(words, int)).tolist()
            ] == plain_runs(words) if words else True


@pytest.mark.parametrize("least", [(4, 2), (6, 3), (3, 5), (12, 4)])
def test_other_limits(least):
    rng = random.Random(5)
    for _ in range(60):
        words = [rng.randrange(2) for _ in range(rng.randrange(1, 50))]
        got = periodic_runs.text_runs(words, *least).tolist()
        assert [tuple(r) for r in got] == plain_runs(words, *least)


def test_extensions_of_places():
    words = [1, 2, 1, 2, 1, 3, 1, 2, 1]
    tree = periodic_runs.Extensions(words)
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            same = 0
            while j + same < len(words) and words[i + same] == words[j + same]:
                same += 1
            assert tree.common(np.array([i]), np.array([j])).tolist() == [same]


def test_long_runs_need_no_recursion():
    assert told([7] * 20000) == [(0, 20000, 1)]
    assert told(list(range(3000)) * 5) == [(0, 15000, 3000)]


def test_rows_equal_the_plain_version(spark, frame, odd_rows, monkeypatch):
    rng = random.Random(8)
    rows = [*odd_rows, *((100 + i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(400))))
                         for i in range(120)), (900, "a b " * 9), (901, "\x1ca\x1c " * 7)]
    docs = frame(rows, clashing=True)
    monkeypatch.setattr(queries, "_documents", lambda spark, sf_dir: docs)
    got = [(r["doc_id"], *row(r)) for r in queries.op12_periodic_runs(spark, "").collect()]
    key = str
    assert sorted(got, key=key) == sorted(((i, *plain_row(i, t)) for i, t in rows), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    empty = frame([])
    monkeypatch.setattr(queries, "_documents", lambda spark, sf_dir: empty)
    assert queries.op12_periodic_runs(spark, "").collect() == []


def test_given_documents_equal_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: row(r) for r in queries.op12_periodic_runs(spark, sf).collect()}
    short = {i for i, t in texts.items() if len(t or "") < 6000}
    assert len(short) > 100 and got.keys() == texts.keys()
    assert {i: got[i] for i in short} == {i: plain_row(i, texts[i]) for i in short}
