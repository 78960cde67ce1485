import datetime as dt
import random

from pyspark.sql import functions as F

from claimweave.operators import bitmaps, sketches
from claimweave.plans import reports


def test_growth_from_sketches_alone(spark):
    days = [dt.date(2024, 6, d) for d in (1, 2, 3, 9)]
    sets = [set(range(100)), set(range(50, 120)), set(range(10)), set(range(1000, 1400))]
    rows = [("d", str(m), day) for day, s in zip(days, sets) for m in s for _ in range(2)]
    rows += [("e", "x", days[0]), ("e", None, days[1])]
    table = spark.createDataFrame(rows, "dimension string, member string, load_day date")
    halves = table.randomSplit([0.5, 0.5], 3)  # sketches of parts of a load merge
    made = sketches.load_sketches(halves[0]).unionByName(sketches.load_sketches(halves[1]))
    got = {(r["dimension"], r["load_day"]): tuple(r)[2:]
           for r in sketches.growth_by_load(made, 0.5).collect()}
    known = set()
    for i, (day, s) in enumerate(zip(days, sets)):
        new = len(s - known)
        want = (len(s), new, len(known) if i else None, len(s & sets[i - 1]) if i else None,
                round(new / len(known), 4) if i else None, bool(i and new / len(known) > 0.5))
        assert got["d", day] == want
        known |= s
    assert got["e", days[0]] == (1, 1, None, None, None, False) and len(got) == 5


def test_estimates_stay_within_the_stated_error(spark):
    table = spark.range(40000).selectExpr(
        "'d' AS dimension", "CAST(id AS STRING) AS member",
        "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS load_day")
    rows = sketches.growth_by_load(sketches.load_sketches(table, 10), 0.5, 10).collect()
    assert all(abs(r["load_members"] - 20000) < 20000 * 3 * 2 / 2 ** 5 for r in rows)


def test_distinct_counts_at_any_grain(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), None if i % 19 == 0 else str(rng.randrange(60)))
            for i in range(400)]
    table = bitmaps.numbered(spark.createDataFrame(rows, "p string, f string, c string"), "c")
    found = bitmaps.cells(table.filter("_n IS NOT NULL"), ["p", "f"])
    grains = [["p", "f"], ["p"], []]
    got = {(r["grain"], r["p"], r["f"]): r["n"]
           for r in bitmaps.distinct_by(found, grains, ["p", "f"], "n").collect()}
    want = {}
    for p, f, c in rows:
        for key in (("p,f", p, f), ("p", p, None), ("", None, None)):
            want.setdefault(key, set()).add(c)
    assert got == {k: len(v - {None}) for k, v in want.items()}


def test_closing_balance_is_a_level(spark):
    day = dt.date
    rows = [("c1", "P", "k", "f", day(2024, 1, 5), 10), ("c1", "P", "k", "f", day(2024, 1, 25), 7),
            ("c1", "P", "k", "f", day(2024, 2, 5), 3), ("c2", "P", "k", None, day(2024, 1, 9), 5),
            (None, None, "k", "f", day(2024, 1, 9), 100)]
    table = spark.createDataFrame(rows, "claim_id string, patient_id string, payer_key string, "
                                  "facility_key string, snapshot_date date, total_ar_balance int"
                                  ).withColumn("total_ar_balance",
                                               F.col("total_ar_balance").cast("decimal(12,2)"))
    got = {(r["grain"], r["payer_key"], r["facility_key"], r["month"]):
           (r["receivable_rows"], float(r["closing_balance"]), r["claims"], r["patients"])
           for r in reports.receivables_cube(table).collect()}
    assert got["", None, None, None] == (5, 8.0, 2, 1)
    assert got["month", None, None, "2024-01"] == (4, 12.0, 2, 1)
    assert got["month", None, None, "2024-02"] == (1, 3.0, 1, 1)
    assert got["payer_key,facility_key", "k", None, None] == (1, 5.0, 1, 1)
    assert got["facility_key", None, "f", None] == (4, 3.0, 1, 1)
