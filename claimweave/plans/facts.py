"""Fact tables.

Lookups are plain left joins on unique keys. Whether a lookup side is broadcast
is decided at run time from its measured size, and a claim, account or payer
with a large share of the rows is split by the adaptive skew join; each lookup
side is small per key, so splitting the fact side is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.layout import OVERDUE_BUCKETS

MONEY_SUM = "decimal(38,2)"


def _account_patients(xref: DataFrame) -> DataFrame:
    return (xref.filter("source_system = 'rcm'")
            .select(F.col("source_patient_key").alias("rcm_account_id"), "patient_id"))


def _with_keys(claims: DataFrame, payers: DataFrame, facilities: DataFrame) -> DataFrame:
    return (claims.join(payers.select("payer_name", "payer_key"), "payer_name", "left")
            .join(facilities.select(F.col("source_facility_id").alias("facility_id"),
                                    "facility_key"), "facility_id", "left"))


def fact_receivable(snapshots: DataFrame, headers: DataFrame, xref: DataFrame,
                    payers: DataFrame, facilities: DataFrame) -> DataFrame:
    """Balance per claim and snapshot day; missing parts count as zero in the total."""
    zero = F.lit(0).cast("decimal(12,2)")
    payer = F.col("payer_responsibility_balance")
    patient = F.col("patient_responsibility_balance")
    balances = snapshots.select(
        "snapshot_date", "claim_id", "rcm_account_id", "aging_bucket",
        (F.coalesce(payer, zero) + F.coalesce(patient, zero)).alias("total_ar_balance"),
        payer.alias("payer_balance"), patient.alias("patient_balance"))
    context = headers.select("claim_id", "facility_id", "payer_name", "claim_status",
                             "total_charge_amount", "submitted_date", "service_from_date")
    joined = (balances.join(context, "claim_id", "left")
              .join(_account_patients(xref), "rcm_account_id", "left"))
    return _with_keys(joined, payers, facilities).select(
        "snapshot_date", "claim_id", "patient_id", "facility_key", "payer_key",
        "total_ar_balance", "payer_balance", "patient_balance", "aging_bucket", "claim_status",
        "total_charge_amount", "submitted_date", "service_from_date")


def fact_patient_balance(receivable: DataFrame) -> DataFrame:
    """Balances per patient and snapshot day; unresolved patients are left out."""
    total = F.col("total_ar_balance")
    overdue = F.when(F.col("aging_bucket").isin(*OVERDUE_BUCKETS), total).otherwise(
        F.lit(0).cast("decimal(13,2)"))
    return (receivable.filter("patient_id IS NOT NULL").groupBy("snapshot_date", "patient_id")
            .agg(F.sum(total).cast(MONEY_SUM).alias("total_outstanding"),
                 F.sum(overdue).cast(MONEY_SUM).alias("overdue_amount"),
                 F.sum("payer_balance").cast(MONEY_SUM).alias("total_payer_balance"),
                 F.sum("patient_balance").cast(MONEY_SUM).alias("total_patient_balance"),
                 F.countDistinct("claim_id").alias("open_claim_count"))
            .withColumn("last_payment_date", F.lit(None).cast("date")))


def fact_claim_line(lines: DataFrame, headers: DataFrame, xref: DataFrame, payers: DataFrame,
                    facilities: DataFrame) -> DataFrame:
    """Claim lines with their claim's context; lines without a claim drop out."""
    own = lines.select("claim_id", "line_num", "cpt_code", "units", "charge_amount",
                       "allowed_amount", "paid_amount", "denial_code",
                       F.col("denial_code").isNotNull().alias("is_denied"))
    context = headers.select("claim_id", "rcm_account_id", "facility_id", "payer_name",
                             "claim_status", "submitted_date", "service_from_date",
                             "service_to_date", "billing_provider_npi",
                             "rendering_provider_npi")
    # the header side is resolved first: it is the smaller one, and the lines
    # then cross the network once, on claim_id
    resolved = _with_keys(context.join(_account_patients(xref), "rcm_account_id", "left"),
                          payers, facilities)
    return own.join(resolved, "claim_id").select(
        *own.columns, "patient_id", "facility_key", "payer_key", "claim_status",
        "submitted_date", "service_from_date", "service_to_date", "billing_provider_npi",
        "rendering_provider_npi")
