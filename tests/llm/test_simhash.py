import random
import re

import pytest
import xxhash

from claimweave.llm import simhash


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, distance=3):
    """Smallest id reachable over links, by comparing all with all."""
    label = dict.fromkeys(fingerprints)
    for i in label:
        label[i] = i
    changed = True
    while changed:
        changed = False
        for i in label:
            for j in label:
                if (fingerprints[i] ^ fingerprints[j]).bit_count() <= distance \
                        and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_of_odd_rows(frame, odd_rows):
    got = simhash.fingerprints(frame(odd_rows, clashing=True)).collect()
    assert sorted((r["doc_id"] or -1, r["fp"] % (1 << 64)) for r in got) == sorted(
        (i or -1, plain_fingerprint(t)) for i, t in odd_rows)


@pytest.mark.parametrize("at_once", [2048, 3])
def test_components_match_all_pairs(spark, frame, monkeypatch, at_once):
    rng = random.Random(at_once)
    values, base = {}, [rng.getrandbits(64) for _ in range(6)]
    for i in range(160):  # dense clusters, chains at distance 3, lone values
        value = rng.choice(base)
        for _ in range(rng.randrange(0, 6)):
            value ^= 1 << rng.randrange(10)
        values[i] = rng.getrandbits(64) if i % 11 == 0 else value
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in values.items()]
    marks = spark.createDataFrame(rows, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: marks)
    got = simhash.groups(None, compared_at_once=at_once).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(values)


def test_groups_of_odd_rows(frame, odd_rows):
    got = simhash.groups(frame(odd_rows, clashing=True)).collect()
    assert len(got) == len(odd_rows)
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert of[1] == of[2] == {1} and of[3] == of[4] == of[5] == {3} and of[None] == {1, 3}


def test_empty_table(frame):
    assert simhash.groups(frame([])).collect() == []


def test_other_distance_and_blocks(spark):
    marks = spark.createDataFrame([(0b0, 1), (0b1, 2), (0b111110, 3)], "fp long, rep long")
    got = {tuple(sorted((r["u"], r["v"]))) for r in simhash.links(marks, distance=1, blocks=4).collect()}
    assert got == {(1, 2)}


def test_what_is_written_out_many_times_is_not_broadcast(spark, monkeypatch):
    from claimweave.operators import components

    plans = []

    def seen(df, *label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.localCheckpoint()

    monkeypatch.setattr(simhash, "stored", seen)
    monkeypatch.setattr(components, "materialise", seen)
    monkeypatch.setattr(components, "DEALT_EDGES", 0, raising=False)
    rows = [(i, v) for i, v in enumerate([0b0, 0b1, 0b11, 0b111110000, 0b111110001, 1 << 40])]
    marks = spark.createDataFrame(rows, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: marks)
    got = simhash.groups(None, compared_at_once=3)
    seen(got)
    assert not [p for p in plans if "Broadcast" in p]
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {
        0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 0}
