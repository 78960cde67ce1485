import itertools
import random

import pytest
from pyspark.sql import functions as F

from claimweave.operators.components import connected_components, label_passes
from claimweave.operators.keys import number_rows, rank_within, row_positions
from claimweave.operators.latest import latest_per_key
from claimweave.operators.quality import Check, run_checks
from claimweave.operators.skew import attach, meet
from claimweave.operators.typed import ContractError, check_contract, clean
from claimweave.plans.checks import CLEAN_CHECKS, LINKAGE_CHECKS, STAR_CHECKS
from claimweave.sources.layout import SOURCES
from claimweave.sources.lineage import with_lineage


def landed(spark, name, rows):
    """Landed rows from (values..., load day) tuples in column order."""
    source = SOURCES[name]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*source.columns, "_d"]))
    return with_lineage(df.withColumn("_day", F.col("_d").cast("date")), source, "_day",
                        file_columns=source.columns)


def test_latest_settles_ties_by_hash_under_any_partitioning(spark):
    rows = [("N1", "I10", f"text {i}", str(i), "2024-01-01") for i in range(20)]
    source = SOURCES["emr_diagnosis"]
    df = landed(spark, "emr_diagnosis", rows)
    want = min(r["_row_hash"] for r in df.collect())
    for parts in (1, 3, 7):
        got = clean(df.repartition(parts), source).collect()
        assert [r["_row_hash"] for r in got] == [want]


def test_newest_load_wins_and_keys_are_normalised(spark):
    rows = [("N1", "I10", "old", "1", "2024-01-01"), ("N1", " i10", "new", "1", "2024-01-02"),
            (None, None, "a", "1", "2024-01-01"), (None, None, "b", "1", "2024-01-01")]
    source = SOURCES["emr_diagnosis"]
    df = landed(spark, "emr_diagnosis", rows)
    by_key = {r["icd10_code"]: r["diagnosis_desc"] for r in clean(df, source).collect()}
    assert by_key["I10"] == "new" and len(by_key) == 2
    assert clean(df, source, raw_key=True).count() == 3


def test_rank_filter_is_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_contract(spark):
    source = SOURCES["emr_diagnosis"]
    good = clean(landed(spark, "emr_diagnosis", [("N1", "I10", "x", "1", "2024-01-01")]), source)
    check_contract(good, source.clean_schema())
    with pytest.raises(ContractError):
        check_contract(good.withColumn("diagnosis_rank", F.lit("1")), source.clean_schema())


@pytest.mark.parametrize("rows, parts", [(1, 4), (257, 5)])
def test_positions_follow_the_order(spark, rows, parts):
    df = spark.range(rows).withColumn("v", F.hash("id")).repartition(parts)
    got = row_positions(df, ["v", "id"]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, rows + 1))
    assert [r.v for r in got] == sorted(r.v for r in got)


def test_keys_stay_unique_beyond_their_width(spark):
    df = spark.range(10050).withColumn("name", F.lpad(F.col("id").cast("string"), 6, "0"))
    keys = number_rows(df, ["name"], "k", "DFAC-", 4)
    assert keys.select("k").distinct().count() == 10050
    assert keys.filter("name = '010049'").first()["k"] == "DFAC-10050"
    nulls = spark.createDataFrame([(None, "x"), ("1", "y")], "npi string, p string")
    last = number_rows(nulls, [F.col("npi").asc_nulls_last()], "k", "D-", 2)
    assert {r.p: r.k for r in last.collect()} == {"y": "D-01", "x": "D-02"}


def test_rank_within_a_hot_group(spark, small_limit):
    rows = [("hot", i % 7) for i in range(40)] + [("a", 2), ("a", 1)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(3)
    got = rank_within(df, "g", ["v"], "r").orderBy("g", "r").collect()
    assert [(r.g, r.r) for r in got] == [("a", 1), ("a", 2)] + [("hot", i) for i in range(1, 41)]
    assert [r.v for r in got] == [1, 2] + sorted(i % 7 for i in range(40))


def _graph(seed):
    rng = random.Random(seed)
    return [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]


def _components(edges):
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def _run(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    return {r.id: r.component for r in connected_components(df).collect()}


@pytest.mark.parametrize("edges", [
    _graph(1), _graph(2), [(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 40)],
    [(39, i) for i in range(39)]])
def test_components(spark, small_limit, edges):
    want = {n: c for n, c in _components(edges).items() if any(n in e and e[0] != e[1] for e in edges)}
    assert _run(spark, edges) == want


def test_components_ignore_order_and_repeats(spark):
    edges = _graph(3)
    mixed = [(b, a) for a, b in edges] + edges[::-1]
    assert _run(spark, edges) == _run(spark, mixed)
    assert _run(spark, [(5, 5)]) == {}


def _passes(edges, nodes, n):
    label = {v: v for v in nodes}
    for _ in range(n):
        label = {v: min([label[v]] + [label[b if a == v else a] for a, b in edges if v in (a, b)])
                 for v in nodes}
    return label


def test_label_passes_split_long_chains(spark, small_limit):
    edges = [(i, i + 1) for i in range(8)]
    nodes = spark.range(9)
    members = spark.createDataFrame([(n, f"b{n}") for n in range(9)], "id long, box string")
    links = spark.createDataFrame(
        [(f"b{a}", f"b{b}") for a, b in edges] + [(f"b{b}", f"b{a}") for a, b in edges],
        "box string, other string")
    got = {r.id: r.label for r in label_passes(nodes, members, links, 4, 9).collect()}
    assert got == _passes(edges, range(9), 4)
    assert len(set(got.values())) > 1
    assert len(set(_run(spark, edges).values())) == 1


def test_spreading_joins_equal_plain_joins(spark, small_limit):
    many = [("hot", i) for i in range(50)] + [(f"k{i}", 100 + i) for i in range(10)]
    left = spark.createDataFrame(many, "k string, a long")
    right = spark.createDataFrame([(k, v + 1000) for k, v in many] + [("only", 1)], "k string, b long")
    plain = sorted(map(tuple, left.join(right, "k").collect()))
    assert sorted(map(tuple, meet(left, right, "k", "a", "b", 60).collect())) == plain
    one = left.groupBy("k").agg(F.count("*").alias("n"), F.min("a").alias("m"))
    got = attach(left, one, "k", "a", 60).select("k", "a", "m").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, left.join(one, "k").select(
        "k", "a", "m").collect()))


def test_hot_key_is_cut_into_cells(spark, small_limit):
    left = spark.range(30).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    right = spark.range(30).select(F.lit("hot").alias("k"), F.col("id").alias("b"))
    plan = meet(left, right, "k", "a", "b", 30)._jdf.queryExecution().optimizedPlan().toString()
    assert "_row" in plan and "_col" in plan


def test_a_large_join_is_dealt_by_its_pairs(spark, small_limit):
    # one small partition, which alone would be joined in place by one task
    side = spark.range(60).coalesce(1).select((F.col("id") % 1).alias("k"), F.col("id").alias("a"))
    pairs = meet(side, side.withColumnRenamed("a", "b"), "k", "a", "b", 60)
    assert pairs.rdd.getNumPartitions() >= 60 * 60 // (9 * 64)
    assert pairs.distinct().count() == 60 * 60


def test_many_mild_keys_are_dealt_by_their_pairs_too(spark, small_limit):
    side = spark.range(900).coalesce(1).select((F.col("id") % 300).alias("k"),
                                               F.col("id").alias("a"))
    pairs = meet(side, side.withColumnRenamed("a", "b"), "k", "a", "b", 900)
    assert pairs.rdd.getNumPartitions() > 1
    assert pairs.distinct().count() == 300 * 9


def test_no_cell_exceeds_the_pair_budget(spark):
    from claimweave.operators.skew import cells
    sizes = [(1, 1), (5, 3), (3000, 2), (2, 3000), (100, 100), (5000, 5000), (1, 10 ** 6),
             (10 ** 6, 10 ** 6), (40, 10 ** 5)]
    pairs = 10_000
    k = cells(F.col("l"), F.col("r"), pairs)
    for row in spark.createDataFrame(sizes, "l long, r long").select(
            "l", "r", k[0].alias("kl"), k[1].alias("kr")).collect():
        assert -(-row.l // row.kl) * -(-row.r // row.kr) <= 2 * pairs
        assert row.kl * row.kr <= 4 * max(1, row.l * row.r / pairs) + 3


def test_rows_of_a_hot_key_are_copied_a_bounded_number_of_times(spark, small_limit, monkeypatch):
    from claimweave.operators import skew

    monkeypatch.setattr(skew, "COPIES_PER_ROW", 4, raising=False)
    side = spark.range(600).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    found = meet(side, side.withColumnRenamed("a", "b").limit(90), "k", "a", "b", 600)
    assert found.count() == found.distinct().count() == 600 * 90
    left, right = (s.select("k", "_row", "_col").agg(F.count("*")).first()[0]
                   for s in _cut_sides(found))
    assert left + right <= 2 * 4 * (600 + 90)


def _cut_sides(found):
    """Both sides of the join that `meet` ends with, as they are shuffled."""
    from pyspark.sql import DataFrame

    def joins(plan):
        if plan.nodeName() == "Join":
            return plan
        return joins(plan.children().head())

    join = joins(found._jdf.queryExecution().analyzed())
    data = found.sparkSession._jvm.org.apache.spark.sql.classic.Dataset
    return [DataFrame(data.ofRows(found.sparkSession._jsparkSession, side), found.sparkSession)
            for side in (join.left(), join.right())]


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", "M", "12345"), ("a", "x", "1"), (None, None, None)], "k string, s string, z string")
    parent = spark.createDataFrame([("b",)], "k string")
    checks = [Check("t", "not_null", ("k",)), Check("t", "unique", ("k",)),
              Check("t", "accepted_values", ("s",), ("M",)),
              Check("t", "matches", ("z",), ("^[0-9]{5}$",), "warn"),
              Check("t", "length", ("z",), (5,)), Check("t", "unique_combination", ("k", "s")),
              Check("t", "relationship", ("k",), ("p", "k"))]
    got = {r.check_kind: r.failures for r in run_checks({"t": df, "p": parent}, checks).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1, "matches": 1, "length": 1,
                   "unique_combination": 0, "relationship": 2}


def test_number_of_declared_checks():
    assert [len(x) for x in (CLEAN_CHECKS, LINKAGE_CHECKS, STAR_CHECKS)] == [113, 27, 34]
    every = list(itertools.chain(CLEAN_CHECKS, LINKAGE_CHECKS, STAR_CHECKS))
    assert len({c.label for c in every}) == 174
