import random

import pytest
from pyspark.sql import functions as F

from claimweave.operators.segments import segments, windows
from claimweave.plans import fuzzy


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def likeness(a, b):
    longest = max(len(a), len(b))
    return 1 - distance(a, b) / longest if longest else 1.0


def edited(rng, word):
    letters = list(word)
    for _ in range(rng.randrange(5)):
        at = rng.randrange(len(letters) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            letters.insert(at, rng.choice("abc"))
        elif letters and at < len(letters):
            letters[at:at + 1] = [] if kind == 1 else [rng.choice("abcé")]
    return "".join(letters)


@pytest.mark.parametrize("least", [0.6, 0.75, 0.8317, 1.0])
def test_like_strings_share_a_key(spark, least):
    rng = random.Random(int(least * 100))
    stems = ["".join(rng.choice("abc") for _ in range(rng.randrange(16))) for _ in range(40)]
    words = sorted({edited(rng, w) for w in stems for _ in range(6)} | {"", "a"})
    table = spark.createDataFrame([(w,) for w in words], "w string")
    left = table.select(F.col("w").alias("a"), F.explode(segments(F.col("w"), least)).alias("k"))
    right = table.select(F.col("w").alias("b"), F.explode(windows(F.col("w"), least)).alias("k"))
    met = {(r["a"], r["b"]) for r in left.join(right, "k").select("a", "b").distinct().collect()}
    alike = {(a, b) for a in words for b in words if likeness(a, b) >= least}
    assert alike <= met
    assert len(alike) > len(words) or least == 1.0
    assert least < 0.8 or len(met) < len(words) ** 2 / 8


def test_unusable_likeness():
    with pytest.raises(ValueError):
        segments(F.lit("a"), 0.5)


def people(rng, n):
    firsts, lasts = ["anna", "ann", "hanna", "jo", "", None], ["marton", "martin", "marten", "li", None]
    rows = []
    for i in range(n):
        rows.append((i, rng.choice(["emr", "rcm", "referral"]), rng.choice(firsts), rng.choice(lasts),
                     rng.choice([None, "1980-01-02", "1981-05-05", "1999-03-03"]),
                     rng.choice([None, "1", "2"]), rng.choice([None, "a st", "b st"]),
                     rng.choice(["", "x"]), rng.choice([None, "90001", "90002"]), 1))
    return rows


def test_candidates_lose_no_accepted_pair(spark):
    rows = people(random.Random(6), 250)
    table = spark.createDataFrame(rows, "rep long, system string, first string, last string, "
                                  "dob string, phone string, street string, city string, "
                                  "zip string, n int").withColumn("dob", F.to_date("dob"))
    table = table.withColumn("email", F.lit(None).cast("string"))
    every = (table.select(F.col("rep").alias("rep_a"), F.col("system").alias("sa"))
             .crossJoin(table.select(F.col("rep").alias("rep_b"), F.col("system").alias("sb")))
             .filter("sa < sb").select("rep_a", "rep_b"))

    def accepted(pairs, threshold):
        return {tuple(r) for r in fuzzy.edit_distance_score(pairs, table, threshold).collect()}
    for threshold in ("0.75", "0.82", "0.90"):
        found = fuzzy.edit_candidates(table, 250, threshold)
        want = accepted(every, threshold)
        assert accepted(found, threshold) == want
        assert want and found.count() == found.distinct().count()
