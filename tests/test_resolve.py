import random

import pytest
from pyspark.sql import functions as F

from claimweave.operators.set_join import _may, alike, grams, words
from claimweave.plans import resolve


def similarity(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


@pytest.mark.parametrize("least", [{"x": 0.5}, {"x": 0.8, "y": 0.4}, {"x": 1.0, "y": 0.6}])
def test_alike_sets_equal_all_pairs(spark, small_limit, least):
    rng = random.Random(len(least))
    rows = []
    for i in range(160):
        common = ["the"] * (rng.random() < 0.7)
        x = sorted({*common, *rng.choices("abcdefgh", k=rng.randrange(5))})
        y = sorted(set(rng.choices("pqrst", k=rng.randrange(4))))
        rows.append((i, None if i % 37 == 0 else x, y))
    table = spark.createDataFrame(rows, "id long, x array<string>, y array<string>")
    members, pairs = alike(table, least)
    rep = {r["id"]: r["rep"] for r in members.collect()}
    met = [(r["rep_a"], r["rep_b"]) for r in pairs.collect()]
    assert len(met) == len(set(met)) and all(a < b for a, b in met)
    sets = {i: {"x": x, "y": y} for i, x, y in rows}
    full = [i for i in sets if all(sets[i][c] for c in least)]
    assert set(rep) == set(full)
    want = {(i, j) for i in full for j in full if i < j
            and all(similarity(sets[i][c], sets[j][c]) >= t for c, t in least.items())}
    got = {(i, j) for i in full for j in full if i < j
           and (rep[i] == rep[j] or tuple(sorted((rep[i], rep[j]))) in set(met))}
    assert got == want and len(want) > 20


def test_tokens(spark):
    row = spark.createDataFrame([("AB AB", "AB", "")], "a string, b string, c string").select(
        grams(F.col("a")).alias("a"), grams(F.col("b")).alias("b"), grams(F.col("c")).alias("c"),
        words(F.lit(" x  y x ")).alias("w")).first()
    assert row["a"] == ["AB ", "B A", " AB"] and row["b"] == ["AB"]
    assert row["c"] is None and row["w"] == ["x", "y"]


def mention(key, **columns):
    row = {c: None for c in resolve.COLUMNS} | {
        "mention": key, "entity_type": "org", "source_system": "t"} | columns
    return tuple(row[c] for c in resolve.COLUMNS)


def test_each_rule_binds_and_nothing_else_does(spark):
    rows = [
        mention("a1", name="NORTH CLINIC", address="1 MAIN ST 90001", phone="1"),
        mention("a2", name="NORTH CLINIC GROUP", address="1 MAIN ST 90001"),
        mention("a3", name="OTHER", address="1 MAIN ST 90001", phone="1"),
        mention("b1", name="NORTH CLINIC EAST", address="2 MAIN ST 90001", phone="9"),
        mention("c1", name="SMITH LAW", case_id="7", org_type="law_firm"),
        mention("c2", name="SMITH LAWYERS", case_id="7", org_type="law_firm"),
        mention("c3", name="SMITH LAWS", case_id="7", org_type="clinic"),
        mention("p1", entity_type="person", name="NORTH CLINIC", address="1 MAIN ST 90001", phone="1"),
        mention("p2", entity_type="person", name="X", npi="5"),
        mention("p3", entity_type="person", name="Y", npi="5"),
        mention("e1", name=""), mention("e2", name=None, phone="", address=None),
    ]
    table = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in resolve.COLUMNS))
    named, evidence = resolve.resolved(table)
    groups = {}
    for r in named.collect():
        groups.setdefault(r["resolved_id"], set()).add(r["mention"])
    assert sorted(map(sorted, groups.values())) == [
        ["a1", "a2", "a3"], ["b1"], ["c1", "c2"], ["c3"], ["e1"], ["e2"], ["p1"], ["p2", "p3"]]
    told = {(r["entity_type"], r["canonical_name"]): r for r in resolve.entities(named, evidence).collect()}
    assert told["org", "NORTH CLINIC EAST"]["evidence"] == ""
    assert {r["evidence"] for r in told.values()} == {
        "", "case, type and name", "name and address, phone and address", "same NPI"}
    assert told["person", "X"]["npi_count"] == 1 and told["person", "X"]["mention_count"] == 2


def test_edges_of_merged_ends_count_together(spark):
    named = spark.createDataFrame([("A", "R1"), ("B", "R1"), ("C", "R2"), (None, "R2")],
                                  "entity_id string, resolved_id string")
    links = spark.createDataFrame(
        [("A", "C"), ("B", "C"), ("B", "C")], "from_entity_id string, to_entity_id string"
    ).withColumns({"edge_type": F.lit("refers_to"), "source_system": F.lit("referral"),
                   "evidence": F.lit("same referral order")})
    row, = resolve.edges(named, links).collect()
    assert (row["from_resolved_id"], row["to_resolved_id"], row["support"]) == ("R1", "R2", 3)
    assert float(row["confidence"]) == pytest.approx(1 - 0.4 ** 3)


def test_sides_that_grow_are_not_sent_through_the_driver(spark):
    table = spark.createDataFrame([(i, [f"a{i // 2}", "x", "y", "z"], [f"p{i % 9}"]) for i in range(90)],
                                  "id long, x array<string>, y array<string>")
    for found in alike(table, {"x": 0.75, "y": 1.0}):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        found.collect()


def test_tokens_before_the_shared_one_count_for_nothing(spark):
    places = spark.createDataFrame([(4, 4, 0, 0), (4, 4, 1, 1), (4, 3, 1, 0)],
                                   "x_size_a int, x_size_b int, x_at_a int, x_at_b int")
    assert [r[0] for r in places.select(_may("x", 0.75)).collect()] == [True, False, True]
