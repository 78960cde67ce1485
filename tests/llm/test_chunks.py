import random

import numpy as np
import pytest

from claimweave.llm import chunks
from llm_words import words


def plain(rows, min_bytes):
    """Passages by one pass over all chunks in order of documents."""
    first, repeats = {}, []
    for i, text in sorted((i, t or "") for i, t in rows if i is not None):
        data, last = text.encode(), 0
        for nth, end in enumerate(chunks.boundaries(data)):
            piece = data[last:end]
            if first.setdefault(piece, (i, last)) < (i, last):
                repeats.append((i, nth, last, end))
            last = end
    runs = []
    for i, nth, start, end in sorted(set(repeats)):
        if runs and runs[-1][0] == i and runs[-1][1] == nth - 1:
            runs[-1][1], runs[-1][3] = nth, end
        else:
            runs.append([i, nth, start, end])
    return {(i, a, b) for i, _, a, b in runs if b - a >= min_bytes}


def test_boundaries_cover_texts_and_keep_characters_whole():
    rng = random.Random(1)
    for text in ["", "a", "a" * 5000, "é" * 3000, words(rng, 900), "🙂" * 700, "x y " * 2000]:
        data = text.encode()
        ends = chunks.boundaries(data)
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert sum(sizes) == len(data) and max(sizes, default=0) <= chunks.MOST
        assert all(s >= chunks.LEAST for s in sizes[:-1])
        for a, b in zip([0, *ends], ends):
            data[a:b].decode()


def test_block_size_changes_nothing(monkeypatch):
    data = words(random.Random(2), 3000).encode()
    whole = chunks.boundaries(data)
    monkeypatch.setattr(chunks, "_AT_ONCE", 97)
    assert chunks.boundaries(data) == whole


def test_insertions_shift_nothing_far_away():
    text = words(random.Random(3), 2000)
    changed = text[:500] + "inserted here " + text[500:]
    tails = [{x[a:b] for a, b in zip([0, *e], e)} for x in (text.encode(), changed.encode())
             for e in [chunks.boundaries(x)]]
    assert len(tails[0] - tails[1]) <= 6


@pytest.mark.parametrize("min_bytes", [1, 128])
def test_matches_plain_version(frame, min_bytes):
    rng = random.Random(4)
    passages = [words(rng, 60) for _ in range(5)]
    rows = [(i, f"{words(rng, rng.randrange(0, 90))} {rng.choice(passages)} {words(rng, 20)}")
            for i in range(40)] + [(50, passages[0] * 3), (51, None), (52, "")]
    got = chunks.repeated_passages(frame(rows), min_bytes).collect()
    assert {(r["doc_id"], r["start"], r["stop"]) for r in got} == plain(rows, min_bytes)


def test_passages_of_fifty_words_are_caught(frame):
    rng = random.Random(6)
    passage = words(rng, 52)
    rows = [(i, words(rng, 80) + " " + passage + " " + words(rng, 80)) for i in range(30)]
    rows += [(100 + i, words(rng, 150)) for i in range(30)]
    got = {r["doc_id"] for r in chunks.repeated_passages(frame(rows)).collect()}
    assert got == set(range(1, 30))


STOCK = "the of and a in to day year city house report water old new river market".split()


def prose(rng, n):
    return " ".join(rng.choice(STOCK) + rng.choice(["", "s", "er", "ly", "ing", "ness"]) for _ in range(n))


def test_many_passages_of_51_words_are_reported_whole(spark, frame):
    rng = random.Random(8)
    rows, where = [], {}
    for i in range(300):
        passage = prose(rng, 51)
        for copy in range(2):
            before = prose(rng, rng.randrange(0, 60))
            rows.append((copy * 1000 + i, f"{before} {passage} {prose(rng, rng.randrange(0, 60))}"))
        where[1000 + i] = (len(before) + 1, len(before) + 1 + len(passage))
    got = {}
    for r in chunks.whole_passages(frame(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["stop"]))
    missed = [i for i, (a, b) in where.items()
              if not any(x <= a and b <= y for x, y in got.get(i, ()))]
    assert not missed


def test_places_do_not_depend_on_blocks_or_surroundings(monkeypatch):
    data = words(random.Random(9), 3000).encode()
    ends, values = chunks.places(data)
    shared = set(values.tolist()) & set(chunks.places(data[5000:5127])[1].tolist())
    assert shared and np.diff(ends).max() <= chunks.SPREAD
    monkeypatch.setattr(chunks, "_AT_ONCE", 300)
    assert [x.tolist() for x in chunks.places(data)] == [ends.tolist(), values.tolist()]


def test_deleting_whole_passages_keeps_first_copies(frame, odd_rows):
    passage = words(random.Random(10), 51)
    rows = [(1, f"Start {passage}. End"), (2, f"é{passage}, ü"), (3, f"日本 {passage} 日"),
            *((100 + (i or 0), t) for i, t in odd_rows)]
    kept = {r["doc_id"]: r["text"] for r in chunks.delete_passages(frame(rows)).collect()}
    assert passage in kept[1] and kept[3].split() == ["日本", "日"]
    assert len(kept[2]) < 30 and kept[2].endswith(", ü")


def test_odd_rows(frame, odd_rows):
    docs = frame(odd_rows, clashing=True)
    got = {(r["doc_id"], r["first_id"]) for r in chunks.repeated_passages(docs).collect()}
    assert (2, 1) in got and not any(i in (1, 3, 4, 5, 7, None) for i, _ in got)
    kept = chunks.delete_passages(docs).collect()
    assert len(kept) == len(odd_rows)
    assert {r["text"] for r in kept if r["doc_id"] == 2} != {odd_rows[1][1]}
    assert chunks.repeated_passages(frame([])).collect() == []
