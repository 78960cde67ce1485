from pyspark.sql import functions as F

from claimweave.operators.skew import attach
from claimweave.plans.rules import rule_groups


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_groups_are_counted_without_sorting_their_members(spark):
    members = spark.createDataFrame(
        [(1, "emr", 4, "g"), (2, "rcm", 4, "g"), (3, "emr", 4, "h"), (4, "emr", 4, "h"),
         (5, "emr", 1, "m"), (6, "emr", 1, "m"), (7, None, 4, "n"), (8, "rcm", 4, "n")],
        "nid long, system string, rule int, grp string")
    groups = rule_groups(members)
    assert "SortAggregate" not in _plan(groups)
    assert _rows(groups) == [("g", 2, 1), ("m", 2, 5)]


def test_few_rows_are_attached_by_a_plain_join(spark):
    many = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v long")
    one = many.groupBy("k").agg(F.count("*").alias("n"))
    got = attach(many, one, "k", "v", 3)
    assert _plan(got).count("Join") == 1
    assert _rows(got) == [("a", 1, 2), ("a", 2, 2), ("b", 3, 1)]
