import pytest
from pyspark.sql import functions as F

from claimweave.operators import latest
from claimweave.operators.latest import latest_per_key, newest_per_key


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _by():
    return [F.lower("k"), F.col("j")], [F.desc("at"), F.asc("v")]


def _feed(spark, rows):
    return spark.createDataFrame(rows, "k string, j string, at int, v string")


def test_rows_with_a_key_of_their_own_are_not_moved(spark):
    df = _feed(spark, [(f"k{i}", None, 1, "x") for i in range(50)])
    got = newest_per_key(df, *_by())
    assert "Exchange" not in _plan(got) and "Sort" not in _plan(got)
    assert _rows(got) == _rows(df)


@pytest.mark.parametrize("alone, twice, hot", [(100, 2, 0), (5, 40, 0), (5, 40, 60), (300, 0, 20)])
def test_newest_row_of_repeated_null_and_hot_keys(spark, monkeypatch, alone, twice, hot):
    monkeypatch.setattr(latest, "HOT_ROWS", 15)
    monkeypatch.setattr(latest, "ROWS_PER_SORT", 10)
    rows = [(f"a{i}", "j", 1, "x") for i in range(alone)]
    rows += [(k, "j", n, "y") for i in range(twice) for n, k in ((1, f"B{i}"), (2, f"b{i}"))]
    rows += [(None, "j", i % 7, f"{i}") for i in range(hot)]
    rows += [(None, "a", 1, "u"), ("a", None, 1, "w")]  # NULLs leave the hash as it is
    df = _feed(spark, rows).repartition(3)
    got = newest_per_key(df, *_by())
    assert _rows(got) == _rows(latest_per_key(df, *_by()))
    assert got.columns == df.columns
    # input splits are sorted for a hot key only
    assert ("WindowGroupLimit" in _plan(got)) == (hot > 15)


def test_few_large_splits_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(latest, "ROWS_PER_SPLIT", 10)
    df = _feed(spark, [(f"k{i}", None, 1, "x") for i in range(50)]).coalesce(1)
    got = newest_per_key(df, *_by())
    assert "Exchange hashpartitioning" in _plan(got) and "Sort" not in _plan(got)
    assert _rows(got) == _rows(df)
    wide = df.repartition(spark.sparkContext.defaultParallelism, "k")
    assert _plan(newest_per_key(wide, *_by())).count("Exchange") == 1
