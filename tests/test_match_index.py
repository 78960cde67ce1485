import pytest
from pyspark.sql import functions as F

from claimweave.plans import fuzzy, incremental
from claimweave.plans.match_index import MatchIndex
from claimweave.plans.spine import SPINE_COLUMNS, numbered


def record(system, key, **columns):
    row = {c: None for c in SPINE_COLUMNS} | {
        "source_system": system, "source_patient_key": key, "first_name": "Ann",
        "last_name": "Lee", "city": "X", "zip": "90001"} | columns
    return tuple(row[c] for c in SPINE_COLUMNS)


def spine(spark, rows):
    kinds = [f"{c} {'date' if c == 'dob' else 'string'}" for c in SPINE_COLUMNS]
    table = spark.createDataFrame(rows, ", ".join(k.replace("date", "string") for k in kinds))
    return numbered(table.withColumn("dob", F.to_date("dob")))


def told(walk):
    return sorted((r["source_system"], r["source_patient_key"], r["cluster_id"],
                   str(r["match_confidence"]), r["match_method"]) for r in walk.collect())


OLD = [record("emr", "1", dob="1980-01-02", phone="1", mrn="A"),
       record("rcm", "1", dob="1980-01-02", phone="1"),
       record("emr", "2", dob="1990-05-05", phone="2", mrn="B"),
       record("rcm", "3", dob="1950-05-05", phone="3")]
NEW = [record("referral", "9", dob="1990-05-05", phone="2"),
       record("referral", "10", dob="1950-05-06", phone="7"),
       record("emr", "4", dob="1970-01-01", mrn="B", first_name="Bo")]
CHANGED = [record("rcm", "1", dob="1933-03-03", phone="8", first_name="Zed")]


def chain(plan, mark):
    """Operators from the scan with `mark` up to the join above it."""
    def depth(line):
        return max(line.find("+- "), line.find(":- "))
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if mark in x)
    least, out = depth(lines[at]), []
    for line in reversed(lines[:at]):
        if depth(line) < least:
            least = depth(line)
            out.append(line)
            if "Join" in line:
                break
    return out


@pytest.fixture
def plain_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fresh_changed_and_kept_records(spark):
    index = MatchIndex(spark, buckets=3)
    before, after = spine(spark, OLD), spine(spark, [OLD[0], *OLD[2:], *NEW, *CHANGED])
    earlier = incremental.rematch(before, None, index=index).cache()
    with_index = told(incremental.rematch(after, earlier, index=index))
    assert [(*r[:2], r[2]) for r in with_index] == [
        ("emr", "1", "emr::1"), ("emr", "2", "emr::2"), ("emr", "4", "emr::2"),
        ("rcm", "1", "rcm::1"), ("rcm", "3", "rcm::3"), ("referral", "10", "referral::10"),
        ("referral", "9", "emr::2")]
    index.drop()


def test_old_side_is_not_shuffled(spark, plain_joins):
    index = MatchIndex(spark, buckets=3)
    old = incremental.with_digest(spine(spark, OLD))
    index.add(old)
    fresh = incremental.with_digest(spine(spark, NEW))
    tagged = fuzzy.with_profile(fresh)
    for found, table in ((index.profile_pairs(tagged), "profiles"),
                         (index.rule_records(fresh), "rules")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        mark = next(x for x in plan.splitlines() if "Bucketed: true" in x)
        above = chain(plan, mark.strip())
        assert any("Join" in x for x in above) and not any("Exchange" in x for x in above), table
    index.drop()


def test_compact_drops_stale_rows_and_keeps_answers(spark):
    index = MatchIndex(spark, buckets=2)
    old = incremental.with_digest(spine(spark, OLD))
    for _ in range(2):
        index.add(old)
    now = incremental.with_digest(spine(spark, [OLD[0], OLD[2], *NEW]))
    tagged = fuzzy.with_profile(incremental.with_digest(spine(spark, NEW)))
    index.add(now)

    def answers():
        alive = {r["profile"] for r in fuzzy.with_profile(now).collect()}
        pairs = {tuple(r) for r in index.profile_pairs(tagged).collect()}
        return {p for p in pairs if set(p) <= alive}
    before, rows = answers(), index._read("profiles").count()
    index.compact(now)
    assert answers() == before and before
    assert index._read("profiles").count() < rows
    index.add(old)  # goes to the new files
    assert index._read("rules").filter("source_system = 'rcm'").count() > 0
    index.drop()
