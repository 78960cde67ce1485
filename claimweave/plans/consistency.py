"""How far the feeds agree with each other: drifted identities, money, statuses, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

MONEY_SUM = "decimal(38,2)"


def account_drift(accounts: DataFrame, patients: DataFrame) -> DataFrame:
    """Accounts linked to a patient, and in what their identity differs from the patient's."""
    def differs(a: str, b: str):
        return ~F.col(a).eqNullSafe(F.col(b))

    known = patients.select("emr_patient_id", F.lower("first_name").alias("f"),
                            F.lower("last_name").alias("l"), F.col("dob").alias("d"))
    linked = accounts.select(
        "rcm_account_id", "emr_patient_id", F.lower("patient_first_name").alias("first"),
        F.lower("patient_last_name").alias("last"), "dob").join(known, "emr_patient_id")
    swapped = (F.col("first") == F.col("l")) & (F.col("last") == F.col("f")) & (
        F.col("f") != F.col("l"))
    return linked.select(
        "rcm_account_id", "emr_patient_id", F.coalesce(swapped, F.lit(False)).alias("names_swapped"),
        (differs("first", "f") | differs("last", "l")).alias("name_differs"),
        differs("dob", "d").alias("dob_differs"))


def money_by_claim(lines: DataFrame) -> DataFrame:
    """Charged, allowed and paid amounts per claim, and whether none exceeds the one before."""
    amounts = ("charge_amount", "allowed_amount", "paid_amount")
    return (lines.groupBy("claim_id").agg(*[F.sum(c).cast(MONEY_SUM).alias(c) for c in amounts])
            .withColumn("consistent", F.coalesce(
                (F.col("paid_amount") <= F.col("allowed_amount"))
                & (F.col("allowed_amount") <= F.col("charge_amount")), F.lit(False))))


def balances_by_claim(snapshots: DataFrame) -> DataFrame:
    """Payer, patient and total balance per claim over all its snapshots."""
    payer, patient = "payer_responsibility_balance", "patient_responsibility_balance"
    total = F.coalesce(payer, F.lit(0)) + F.coalesce(patient, F.lit(0))
    return snapshots.groupBy("claim_id").agg(
        F.sum(total).cast(MONEY_SUM).alias("total_balance"),
        *[F.sum(c).cast(MONEY_SUM).alias(c) for c in (payer, patient)],
        F.max("aging_bucket").alias("oldest_bucket"))


def status_steps(history: DataFrame) -> DataFrame:
    """Statuses of each order numbered in order of time, and the days since the one before."""
    # an order has a handful of statuses
    along = Window.partitionBy("referral_order_id").orderBy("status_time", "status")
    return history.select(
        "referral_order_id", (F.row_number().over(along) - 1).alias("step"), "status",
        F.datediff("status_time", F.lag("status_time").over(along)).alias("days_since"))


def account_of_claims(headers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every claim with its account and whether that account is known."""
    known = accounts.select("rcm_account_id", F.lit(True).alias("known"))
    return headers.select("claim_id", "rcm_account_id").join(known, "rcm_account_id", "left").select(
        "claim_id", "rcm_account_id", F.coalesce("known", F.lit(False)).alias("account_known"))


def claims_by_encounter(encounters: DataFrame, accounts: DataFrame,
                        headers: DataFrame) -> DataFrame:
    """Encounters with the number and sum of all claims on their patient's accounts.

    Claims are added up per patient before they meet the encounters.
    """
    per_account = headers.groupBy("rcm_account_id").agg(
        F.count("*").alias("claims"), F.sum("total_charge_amount").alias("charged"))
    per_patient = (accounts.filter("emr_patient_id IS NOT NULL")
                   .join(per_account, "rcm_account_id").groupBy("emr_patient_id")
                   .agg(F.sum("claims").alias("claims"), F.sum("charged").alias("charged")))
    return encounters.select("emr_encounter_id", "emr_patient_id").join(
        per_patient, "emr_patient_id", "left").select(
        "emr_encounter_id", "emr_patient_id", F.coalesce("claims", F.lit(0)).alias("claims"),
        F.col("charged").cast(MONEY_SUM).alias("charged"))
