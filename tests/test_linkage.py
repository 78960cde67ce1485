import itertools
import random
import subprocess
import sys
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from claimweave.functions.similarity import jaro_winkler, score_series
from claimweave.operators.agreement import Agreement, Model, agreements
from claimweave.plans import fuzzy, identity, rules
from claimweave.plans.incremental import rematch
from claimweave.plans.queries import REVIEW
from claimweave.plans.spine import SPINE_COLUMNS, numbered
from claimweave.session import materialise

TYPES = ", ".join(f"{c} {'date' if c == 'dob' else 'string'}" for c in SPINE_COLUMNS)


def person(system, key, **values):
    base = dict(first_name="Ann", last_name="Miller", dob="1980-03-05", phone="", email=None,
                address_line1="1 MAIN ST", city="TOWN", state="CA", zip="90001")
    row = {**base, **values, "source_system": system, "source_patient_key": key}
    return tuple(row.get(c) for c in SPINE_COLUMNS)


def make_spine(spark, people):
    text = TYPES.replace("dob date", "dob string")
    df = spark.createDataFrame(people, text).withColumn("dob", F.col("dob").cast("date"))
    return numbered(df)


def matched(spark, people, model=Model(), mode="pruned"):
    spine = make_spine(spark, people)
    profiles = materialise(fuzzy.profiles(fuzzy.with_profile(spine)))
    pairs = fuzzy.candidates(profiles, spine.count(), model, mode)
    scored = materialise(fuzzy.score(pairs, profiles, model))
    members = materialise(
        fuzzy.fuzzy_members(fuzzy.with_profile(spine), profiles, scored, spine.count()))
    names = {r.nid: r.node for r in spine.collect()}
    return {(names[r.nid_a], names[r.nid_b]): r.confidence
            for r in fuzzy.record_pairs(scored, members, spine.count()).collect()}


def test_jaro_winkler_known_values():
    words = [("martha", "marhta"), ("dwayne", "duane"), ("abcdef", "abxyzw"), ("", ""), ("a", "")]
    got = jaro_winkler([a.encode() for a, _ in words], [b.encode() for _, b in words])
    assert np.allclose(got, [0.961111, 0.84, 0.555556, 0, 0], atol=1e-6)


def test_jaro_winkler_like_duckdb_bytewise():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeüé ", k=rng.randrange(12))) for _ in range(4000)]
    frame = pd.DataFrame({"a": words[:2000], "b": words[2000:]})
    con = duckdb.connect()
    con.register("words", frame)
    want = con.execute("SELECT jaro_winkler_similarity(a, b) AS s FROM words").df().s
    assert np.abs(score_series(frame.a, frame.b) - want).max() < 1e-12


EDGES = [
    (dict(), "0.700"),                                # equal but for the missing phone and email
    (dict(dob="1981-03-05"), None),                   # year off by one: 0.600
    (dict(dob="1981-03-05", email="a@x"), "0.700"),   # exactly on the threshold
    (dict(dob="1980-05-03", email="a@x"), None),      # month and day swapped: 0.675
    (dict(dob="1980-03-07", email="a@x"), "0.775"),
    (dict(dob="1980-03-08", email="a@x"), None),
    (dict(first_name=None), None),
    (dict(city=None), None),
]


def test_threshold_edges(spark):
    people, want = [], {}
    for i, (other, confidence) in enumerate(EDGES):
        place = dict(address_line1=f"{i} MAIN ST", zip=f"9000{i}")
        email = f"{i}@x" if "email" in other else None
        people += [person("emr", f"{i}", email=email, **place),
                   person("rcm", f"{i}", **{**place, **other, "email": email})]
        if confidence:
            want[(f"emr::{i}", f"rcm::{i}")] = Decimal(confidence)
    assert matched(spark, people) == want


DATES = [
    ("2023-12-31", "2024-01-02", 0.9), ("2023-12-31", "2024-01-03", 0.0),
    ("2024-02-29", "2025-03-01", 0.0), ("2023-03-01", "2024-02-29", 0.0),
    ("1980-03-05", "1979-03-05", 0.6), ("1980-03-05", "1980-05-03", 0.5),
    ("1980-03-03", "1980-03-03", 1.0)]


def test_dob_score(spark):
    low = Model(threshold="0.30")
    spine = make_spine(spark, [
        person(system, f"{i}", dob=days[side], phone=f"5{i}", zip=f"9000{i}", last_name=f"{i}mil")
        for i, days in enumerate(DATES) for side, system in enumerate(("emr", "rcm"))])
    people = materialise(fuzzy.profiles(fuzzy.with_profile(spine)))
    phones = people.select(F.col("rep").alias("rep_a"), "phone")
    got = (fuzzy.score(fuzzy.candidates(people, 14, low), people, low)
           .filter("phone_score = 1").join(phones, "rep_a").collect())
    assert {r.phone: float(r.dob_score) for r in got} == {
        f"5{i}": score for i, (_, _, score) in enumerate(DATES)}


def test_agreements_follow_from_the_threshold():
    assert Agreement(("phone", "email", "zip"), ()) in agreements(Model())
    assert Agreement(("email",), ("equal",)) in agreements(Model())
    assert agreements(Model(threshold="0.30")) is None
    assert Agreement((), ("equal",)) in agreements(Model(threshold="0.60"))


def crowd(seed, n=60):
    """People whose traits collide often, so that most combinations occur."""
    rng = random.Random(seed)

    def some(*values):
        return rng.choice(values)

    return [person(
        some("emr", "rcm", "referral"), f"{i}", first_name=some("Ann", "Anna", "Bob", None, ""),
        last_name=some("Miller", "Mila", "Stone", None),
        dob=some("1980-03-05", "1980-05-03", "1981-03-05", "1980-03-06", "1984-02-29", None),
        phone=some("", None, "1", "2"), email=some(None, "", "a@x", "b@x"),
        address_line1=some("1 MAIN ST", None, "2 OAK"), city=some("TOWN", None, ""),
        zip=some("90001", "90002", None, "")) for i in range(n)]


@pytest.mark.parametrize("model", [
    Model(), Model(threshold="0.65"),
    Model(last_name="0.05", first_name="0.05", dob="0.20", phone="0.30", address="0.20",
          email="0.20")])
def test_pruned_candidates_lose_nothing(spark, model):
    people = crowd(11)
    assert matched(spark, people, model) == matched(spark, people, model, "blocks")


@pytest.mark.parametrize("threshold", ["0.65", "0.70", "0.75"])
def test_candidates_by_equal_names_lose_nothing(spark, threshold):
    long = "x" * 100
    people = crowd(13) + [
        person("emr", "l1", last_name=f"{long}abc", zip="90001", city="A"),
        person("rcm", "l2", last_name=f"{long}acb", zip="90001", city="B")]
    model = Model(threshold=threshold, by_names=True)
    found = matched(spark, people, model)
    assert found == matched(spark, people, model, "blocks")
    # names of this length are alike enough without being equal
    assert (("emr::l1", "rcm::l2") in found) == (threshold == "0.65")


def test_equal_names_leave_out_people_who_share_a_birth_date_and_zip(spark):
    people = [person(system, f"{i}", first_name=f"Q{i}", last_name=f"Z{i}", city=f"{i}")
              for i in range(20) for system in ("emr", "rcm")]
    spine = make_spine(spark, people)
    profiles = materialise(fuzzy.profiles(fuzzy.with_profile(spine)))
    assert fuzzy.candidates(profiles, 40, REVIEW).count() == 20


def test_spreading_does_not_change_matches(spark, small_limit):
    people = crowd(12)
    salted = matched(spark, people)
    spark.conf.unset("spark.claimweave.rowsPerChunk")
    spark.conf.unset("spark.claimweave.pairsPerCell")
    assert salted == matched(spark, people)


def _brute_rules(people):
    rows = [dict(zip(SPINE_COLUMNS, p)) for p in people]
    for r in rows:
        r["node"] = f"{r['source_system']}::{r['source_patient_key']}"
    out = set()
    for a, b in itertools.combinations(sorted(rows, key=lambda r: r["node"]), 2):
        cross = a["source_system"] != b["source_system"]

        def same(*cols, filled=False):
            return all(a[c] is not None and a[c] == b[c] and (not filled or a[c]) for c in cols)

        lower = {k: (v or "").lower() for k, v in (("a", a["last_name"]), ("b", b["last_name"]))}
        hits = [
            cross and {a["source_system"], b["source_system"]} == {"emr", "rcm"}
            and b["emr_patient_id_link"] == a["source_patient_key"],
            same("mrn"), same("ssn_last4", "dob"),
            cross and same("email", "dob") and bool(a["email"]),
            cross and same("phone", "dob") and bool(a["phone"]),
            cross and same("phone") and bool(a["phone"]) and a["last_name"] is not None
            and b["last_name"] is not None and lower["a"] == lower["b"],
        ]
        out |= {(a["node"], b["node"], i) for i, hit in enumerate(hits) if hit}
    return out


def identified(seed):
    rng = random.Random(seed)
    out = []
    for p in crowd(seed, 50):
        row = dict(zip(SPINE_COLUMNS, p))
        if row["source_system"] == "emr":
            row["mrn"], row["ssn_last4"] = rng.choice(("m1", "m2", None)), rng.choice(("1", "2", None))
        if row["source_system"] == "rcm":
            row["emr_patient_id_link"] = rng.choice((None, "1", "2", "3", "4", "5"))
        out.append(tuple(row[c] for c in SPINE_COLUMNS))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_match_brute_force(spark, small_limit, seed):
    people = identified(seed)
    spine = make_spine(spark, people)
    names = {r.nid: r.node for r in spine.collect()}
    members = rules.rule_members(spine)
    pairs = {(names[r.nid_a], names[r.nid_b], r.rule)
             for r in rules.rule_pairs(members, 400).collect()}
    assert pairs == _brute_rules(people)
    best = {}
    for a, b, rank in pairs:
        for node in (a, b):
            best[node] = min(best.get(node, 99), rank)
    linked = rules.rule_links(members, 400).groupBy("nid").agg(F.min("rule").alias("rule"))
    assert {names[r.nid]: r.rule for r in linked.collect()} == best


def _walk(spark, spine):
    return {(r.source_system, r.source_patient_key): (
        r.cluster_id, r.match_confidence, r.match_method) for r in rematch(spine, None).collect()}


def test_clusters_match_brute_force(spark):
    people = identified(4)
    spine = make_spine(spark, people)
    pairs = {(a, b) for a, b, _ in _brute_rules(people)} | set(matched(spark, people))
    label = {r.node: r.node for r in spine.collect()}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = _walk(spark, spine)
    assert {"::".join(k): v[0] for k, v in got.items()} == label
    alone = {n for n in label if not any(n in p for p in pairs)}
    assert {"::".join(k) for k, v in got.items() if v[2] == identity.SINGLETON} == alone


def test_adding_records_later_gives_the_same_clusters(spark):
    people = identified(5)
    whole = make_spine(spark, people)
    first = rematch(make_spine(spark, people[:35]), None).drop("nid").cache()
    later = {(r.source_system, r.source_patient_key): (
        r.cluster_id, r.match_confidence, r.match_method)
        for r in rematch(whole, first).collect()}
    assert later == _walk(spark, whole)


@pytest.mark.parametrize("seed", [6, 7])
def test_changed_and_withdrawn_records_are_matched_again(spark, seed):
    """Some records withdrawn, some with the traits of others, some new: as a full run has it."""
    people = identified(seed)
    rng = random.Random(seed)
    others = identified(seed + 10)
    before = [(*p[:2], *others[i][2:]) if i % 5 == 0 else p for i, p in enumerate(people[:40])]
    first = rematch(make_spine(spark, before), None).drop("nid").cache()
    gone = set(rng.sample(range(40), 8))
    after = make_spine(spark, [p for i, p in enumerate(people) if i not in gone])
    later = {(r.source_system, r.source_patient_key): (
        r.cluster_id, r.match_confidence, r.match_method)
        for r in rematch(after, first).collect()}
    assert later == _walk(spark, after)


def test_a_withdrawn_first_record_leaves_its_cluster_together(spark):
    people = [person(s, "1", phone="5") for s in ("emr", "rcm", "referral")]
    first = rematch(make_spine(spark, people), None).drop("nid").cache()
    left = rematch(make_spine(spark, people[1:]), first).collect()
    assert {(r.cluster_id, r.match_method) for r in left} == {
        ("rcm::1", "deterministic_phone_dob")}


def test_one_long_name_costs_no_other_pair_anything():
    import time
    import tracemalloc
    words = [b"miller", b"muller", b"stone"] * 3333
    start = time.perf_counter()
    tracemalloc.start()
    got = jaro_winkler([*words, b"ab" * 500_000], [*words[1:], b"miller", b"ba" * 500_000])
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()
    assert time.perf_counter() - start < 60 and abs(got[-1] - 5 / 6) < 1e-9


def test_long_words_like_short_ones(monkeypatch):
    from claimweave.functions import similarity
    rng = random.Random(8)
    words = [bytes(rng.choices(b"abcd ", k=rng.randrange(30))) for _ in range(600)]
    by_matrix = jaro_winkler(words[:300], words[300:])
    monkeypatch.setattr(similarity, "MATRIX_BYTES", ())
    assert np.allclose(by_matrix, jaro_winkler(words[:300], words[300:]), atol=1e-12)


def test_survivorship(spark):
    people = [person("emr", "1", first_name="", last_name="Adams", phone=None),
              person("emr", "2", first_name="Zed", last_name="Best", phone=None, email="e@x"),
              person("rcm", "3", first_name="Rob", phone="7"),
              person("referral", "4", email="r@x")]
    spine = make_spine(spark, people)
    walk = spine.select("nid", F.lit("P").alias("patient_id"))
    by_field = identity.survive(walk, spine).first()
    assert (by_field.best_first_name, by_field.best_last_name) == ("Zed", "Best")
    assert (by_field.best_phone, by_field.best_email) == ("7", "e@x")
    by_record = identity.survive(walk, spine, record_level=True).first()
    assert (by_record.best_first_name, by_record.best_last_name) == ("Zed", "Best")


def test_copies_are_compared_once(spark):
    people = [person("emr", f"{i}") for i in range(20)] + [person("rcm", f"{i}") for i in range(20)]
    spine = make_spine(spark, people)
    profiles = fuzzy.profiles(fuzzy.with_profile(spine))
    assert fuzzy.candidates(profiles, 40).count() == 1
    assert len(matched(spark, people)) == 400
    assert {r.cluster_id for r in rematch(spine, None).collect()} == {"emr::0"}


def test_similarity_needs_no_package_on_the_workers(tmp_path):
    code = ("import pickle, sys, pandas as pd; f = pickle.loads(sys.stdin.buffer.read());"
            "print(round(f(pd.Series(['martha']), pd.Series(['marhta']))[0], 4))")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                          input=cloudpickle.dumps(score_series), check=True)
    assert done.stdout.split() == [b"0.9611"]


def test_records_that_no_system_can_pair_get_no_keys(spark, monkeypatch):
    people = [person(s, f"{s}{i}", phone="4150000001") for i, s in enumerate(
        ("emr", "emr", "rcm", "referral", "referral"))]
    profiles = materialise(fuzzy.profiles(fuzzy.with_profile(make_spine(spark, people))))
    sides, meet = [], fuzzy.meet

    def watched(left, right, *rest):
        sides.append(({r[0] for r in left.select("sa").distinct().collect()},
                      {r[0] for r in right.select("sb").distinct().collect()}))
        return meet(left, right, *rest)

    monkeypatch.setattr(fuzzy, "meet", watched)
    for make in (fuzzy.candidates, fuzzy.edit_candidates):
        assert make(profiles, 10).count() == 3  # three systems, one profile each
    assert sides == [({"emr", "rcm"}, {"rcm", "referral"})] * 2
    alone = profiles.filter("system = 'rcm'")
    assert fuzzy.candidates(alone, 10).count() == 0
    assert fuzzy.candidates(alone, 10, against=profiles).count() == 1
    assert fuzzy.candidates(alone, 10, against=profiles.limit(0)).count() == 0
