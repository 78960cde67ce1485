import pytest
from pyspark.sql import functions as F

from claimweave.operators.keys import number_rows
from claimweave.plans import dimensions, facts, reports

SNAPSHOT = ("snapshot_date date, claim_id string, rcm_account_id string, "
            "payer_responsibility_balance decimal(12,2), "
            "patient_responsibility_balance decimal(12,2), aging_bucket string")
HEADER = ("claim_id string, rcm_account_id string, facility_id string, payer_name string, "
          "claim_status string, total_charge_amount decimal(12,2), submitted_date date, "
          "service_from_date date, service_to_date date, billing_provider_npi string, "
          "rendering_provider_npi string")


def table(spark, schema, rows):
    names = [c.strip().split(" ")[0] for c in schema.replace("(12,2)", "").split(",")]
    kinds = [c.strip().rsplit(" ", 1) for c in schema.replace("(12,2)", "#").split(",")]
    text = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                 ", ".join(f"{n} string" for n in names))
    return text.select(*[F.col(n).cast(k.replace("#", "(12,2)")).alias(n) for n, k in kinds])


@pytest.fixture
def star(spark):
    headers = table(spark, HEADER, [
        dict(claim_id="C1", rcm_account_id="R1", facility_id="F1", payer_name="Aetna"),
        dict(claim_id="C2", rcm_account_id="R2", facility_id="F2")])
    snapshots = table(spark, SNAPSHOT, [
        dict(snapshot_date="2024-01-01", claim_id="C1", rcm_account_id="R1",
             payer_responsibility_balance="10.00", aging_bucket="90+"),
        dict(snapshot_date="2024-01-01", claim_id="C2", rcm_account_id="R2",
             patient_responsibility_balance="5.00", aging_bucket="0-30"),
        dict(snapshot_date="2024-01-01", claim_id="C9", rcm_account_id="R9")])
    lines = spark.createDataFrame(
        [("C1", 1, "CO-97"), ("C1", 2, None), ("C9", 1, None)],
        "claim_id string, line_num int, denial_code string").select(
        "*", *[F.lit(None).cast("decimal(12,2)").alias(c) for c in (
            "units", "charge_amount", "allowed_amount", "paid_amount")],
        F.lit("99213").alias("cpt_code"))
    xref = spark.createDataFrame(
        [("rcm", "R1", "P1"), ("rcm", "R2", "P1"), ("referral", "O1", "P1"),
         ("referral", "O2", "P1"), ("referral", "O3", "P2")],
        "source_system string, source_patient_key string, patient_id string")
    payers = number_rows(spark.createDataFrame([("Aetna",)], "payer_name string"), ["payer_name"],
                         "payer_key", "DPAY-", 4)
    places = spark.createDataFrame([("DFAC-0001", "F1")], "facility_key string, source_facility_id string")
    return dict(headers=headers, snapshots=snapshots, lines=lines, xref=xref, payers=payers,
                places=places)


def test_facts(star):
    s = star
    rows = {r.claim_id: r for r in facts.fact_receivable(
        s["snapshots"], s["headers"], s["xref"], s["payers"], s["places"]).collect()}
    assert len(rows) == 3
    assert (rows["C1"].payer_key, rows["C2"].payer_key, rows["C9"].patient_id) == (
        "DPAY-0001", None, None)
    assert [float(rows[c].total_ar_balance) for c in ("C1", "C2", "C9")] == [10.0, 5.0, 0.0]
    lines = facts.fact_claim_line(s["lines"], s["headers"], s["xref"], s["payers"],
                                  s["places"]).collect()
    assert sorted((r.line_num, r.is_denied) for r in lines) == [(1, True), (2, False)]
    balance = facts.fact_patient_balance(facts.fact_receivable(
        s["snapshots"], s["headers"], s["xref"], s["payers"], s["places"])).collect()
    assert [(r.patient_id, float(r.total_outstanding), float(r.overdue_amount),
             r.open_claim_count) for r in balance] == [("P1", 15.0, 10.0, 2)]


def test_bridge_grains_and_repeated_balances(spark, star):
    orders = spark.createDataFrame(
        [("O1", "Lee & Co LLC", "law_firm"), ("O2", "LEE & CO", "clinic"),
         ("O3", "Other", None), ("O4", None, None)],
        "referral_order_id string, counterparty_org_name string, counterparty_org_type string"
    ).withColumn("referral_created_at", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    firms = dimensions.dim_counterparty_org(orders)
    lee = firms.filter("normalized_name = 'LEE & CO'").first()
    assert (lee.counterparty_org_key, lee.name_variant_count, lee.counterparty_org_type) == (
        "DCPTY-0001", 2, "clinic")
    assert lee.counterparty_org_name == "LEE & CO"
    bridge = dimensions.bridge_patient_counterparty(star["xref"], orders, firms)
    pair = dimensions.bridge_pair(bridge)
    assert bridge.filter("patient_id = 'P1'").count() == 2
    assert pair.filter("patient_id = 'P1'").count() == 1
    fact = facts.fact_receivable(star["snapshots"], star["headers"], star["xref"], star["payers"],
                                 star["places"])
    both = [reports.top_counterparties(fact, b, firms).first() for b in (bridge, pair)]
    assert [float(r.total_pending_ar) for r in both] == [20.0, 10.0]
    assert [r.claim_count for r in both] == [1, 1]


def test_hot_account_is_split_by_the_adaptive_join(spark, tmp_path):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10kb",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(60000).withColumn("account", F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("R"), F.col("id").cast("string"))))
        ids.select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("claim_id"),
                   F.col("account").alias("rcm_account_id"),
                   *[F.lit(None).cast(t).alias(c) for c, t in (
                       ("facility_id", "string"), ("payer_name", "string"),
                       ("claim_status", "string"), ("submitted_date", "date"),
                       ("service_from_date", "date"), ("service_to_date", "date"),
                       ("billing_provider_npi", "string"), ("rendering_provider_npi", "string"))]
                   ).write.parquet(f"{tmp_path}/h")
        ids.select("account").distinct().select(
            F.lit("rcm").alias("source_system"), F.col("account").alias("source_patient_key"),
            F.col("account").alias("patient_id")).write.parquet(f"{tmp_path}/x")
        headers, xref = spark.read.parquet(f"{tmp_path}/h"), spark.read.parquet(f"{tmp_path}/x")
        joined = headers.join(facts._account_patients(xref), "rcm_account_id", "left")
        assert joined.filter("patient_id = 'hot'").count() == 20000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k in settings:
            spark.conf.unset(k)
