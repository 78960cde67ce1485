import datetime as dt
import random

from pyspark.sql import functions as F

from claimweave.plans import history

TYPES = ("source_system string, source_patient_key string, patient_id string, cluster_id string, "
         "match_confidence double, match_method string")


def walk(spark, rows):
    return spark.createDataFrame([("emr", k, p, p, 1.0, "m") for k, p in rows], TYPES)


def versions(df):
    return sorted((r["source_patient_key"], r["patient_id"], r["effective_from"].day,
                   r["effective_to"].day if r["effective_to"] else None) for r in df.collect())


def test_versions_open_and_close(spark):
    first = history.advance(None, walk(spark, [("a", "P1"), ("b", "P2"), ("c", "P3")]), "2024-06-01")
    day2 = walk(spark, [("a", "P1"), ("b", "P1"), ("d", "P4")])
    second = history.advance(first, day2, "2024-06-02")
    want = [("a", "P1", 1, None), ("b", "P1", 2, None), ("b", "P2", 1, 2), ("c", "P3", 1, 2),
            ("d", "P4", 2, None)]
    assert versions(second) == want
    assert versions(history.advance(second, day2, "2024-06-02")) == want
    # a corrected run of the same day leaves no empty interval
    again = history.advance(second, walk(spark, [("a", "P1"), ("b", "P9"), ("d", "P4")]), "2024-06-02")
    assert versions(again) == [("a", "P1", 1, None), ("b", "P2", 1, 2), ("b", "P9", 2, None),
                               ("c", "P3", 1, 2), ("d", "P4", 2, None)]
    back = history.advance(again, walk(spark, [("a", "P1"), ("c", "P3")]), "2024-06-05")
    assert ("c", "P3", 5, None) in versions(back) and ("d", "P4", 2, 5) in versions(back)


def test_as_of_equals_the_plain_version(spark):
    rng = random.Random(1)
    start = dt.date(2023, 12, 1)
    rows = []
    for k in "abcd":
        cuts = sorted(rng.sample(range(200), 5))
        ends = [*cuts[1:], None]
        rows += [("emr", k, f"{k}{x}", f"{k}{x}", 1.0, "m", start + dt.timedelta(x),
                  None if y is None else start + dt.timedelta(y)) for x, y in zip(cuts, ends)]
    table = spark.createDataFrame(rows, f"{TYPES}, effective_from date, effective_to date")
    asked = [(i, rng.choice(["a", "b", "c", "d", "z", None]),
              None if i % 17 == 0 else start + dt.timedelta(rng.randrange(-5, 230)))
             for i in range(150)]
    facts = spark.createDataFrame(asked, "n int, who string, day date")
    key = {"source_system": F.lit("emr"), "source_patient_key": F.col("who")}
    for bins in (1, 7, 400):
        got = {r["n"]: r["patient_id"] for r in history.as_of(
            facts, table, key, "day", ("patient_id",), bins).collect()}
        assert len(got) == len(asked)
        for n, who, day in asked:
            want = [r[2] for r in rows if r[1] == who and day and r[6] <= day
                    and (r[7] is None or day < r[7])]
            assert got[n] == (want[0] if want else None) and len(want) < 2
