"""Dimensions of the star schema and the patient-firm bridge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.names import name_part, organisation_name
from ..operators.keys import number_rows

FISCAL_START_MONTH = 10
PROVIDER_COLUMNS = ("npi", "first_name", "last_name", "specialty", "org_name", "phone",
                    "address_line1", "city", "state", "zip")


FACT_DATES = ("snapshot_date", "submitted_date", "service_from_date", "service_to_date")


def dim_date(*facts: DataFrame) -> DataFrame:
    """One row per day of the calendar years that the dates of `facts` reach into.

    `fiscal_quarter` holds the fiscal month, as its users expect; `fiscal_month`
    and `fiscal_quarter_true` say what they are.
    """
    seen = reduce(DataFrame.unionByName, [
        df.agg(F.min(c).alias("low"), F.max(c).alias("high"))
        for df in facts for c in FACT_DATES if c in df.columns])
    years = seen.agg(F.year(F.min("low")).alias("low"), F.year(F.max("high")).alias("high"))
    day = F.col("date_key")
    starts_new = F.month(day) >= FISCAL_START_MONTH
    weekday = F.dayofweek(day) - 1
    fiscal_month = F.pmod(F.month(day) - FISCAL_START_MONTH, F.lit(12)) + 1
    days = years.select(F.explode(F.sequence(
        F.make_date("low", F.lit(1), F.lit(1)), F.make_date("high", F.lit(12), F.lit(31))))
        .alias("date_key"))
    return days.select(
        day, F.year(day).alias("year"), F.quarter(day).alias("quarter"),
        F.month(day).alias("month"), F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"), weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), F.weekofyear(day).alias("week_of_year"),
        weekday.isin(0, 6).alias("is_weekend"),
        (F.year(day) + starts_new.cast("int")).alias("fiscal_year"),
        fiscal_month.alias("fiscal_quarter"), fiscal_month.alias("fiscal_month"),
        F.ceil(fiscal_month / 3).cast("int").alias("fiscal_quarter_true"))


def _claim_npis(headers: DataFrame) -> DataFrame:
    both = F.explode(F.array("billing_provider_npi", "rendering_provider_npi"))
    return headers.select(both.alias("npi")).filter("npi IS NOT NULL")


def dim_provider(providers: DataFrame, headers: DataFrame, referrals: DataFrame,
                 registry: DataFrame | None = None) -> DataFrame:
    """Known providers, plus a stub for every NPI seen only in claims or referrals.

    Stub names come from the referral's free text (smallest name per NPI), or
    from `registry` (npi, first_name, last_name, specialty, org_name, phone,
    address_line1, city, state, zip) where it lists the NPI.
    """
    base = providers.select(F.col("emr_provider_id").alias("source_provider_id"),
                            *PROVIDER_COLUMNS, F.lit("emr").alias("source_system"))
    named = (referrals.filter("referring_provider_npi IS NOT NULL")
             .groupBy(F.col("referring_provider_npi").alias("npi"))
             .agg(F.min("referring_provider_name").alias("free_name")))
    seen = (_claim_npis(headers).withColumn("free_name", F.lit(None).cast("string"))
            .unionByName(named).groupBy("npi").agg(F.min("free_name").alias("free_name")))
    missing = seen.join(base.select("npi").filter("npi IS NOT NULL"), "npi", "left_anti")
    stub = {c: F.lit(None).cast("string") for c in PROVIDER_COLUMNS}
    stub |= {"npi": F.col("npi"), "first_name": name_part("free_name", 1),
             "last_name": name_part("free_name", -1)}
    if registry is not None:
        listed = registry.groupBy("npi").agg(
            F.min(F.struct(*[c for c in PROVIDER_COLUMNS if c != "npi"])).alias("r"))
        missing = missing.join(listed, "npi", "left")
        stub = {c: F.coalesce(F.col(f"r.{c}"), v) if c != "npi" else v for c, v in stub.items()}
    stubs = missing.select(
        F.concat(F.lit("PROV-EXT-"), "npi").alias("source_provider_id"),
        *[v.alias(c) for c, v in stub.items()], F.lit("external").alias("source_system"))
    everyone = base.unionByName(stubs).select(
        "source_provider_id", "npi", "first_name", "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        *PROVIDER_COLUMNS[3:], "source_system")
    order = [F.col("npi").asc_nulls_last(), F.col("source_provider_id").asc_nulls_last()]
    return number_rows(everyone, order, "provider_key", "DPROV-", 5)


def dim_facility(encounters: DataFrame, headers: DataFrame, referrals: DataFrame) -> DataFrame:
    ids = (encounters.select("facility_id").unionByName(headers.select("facility_id"))
           .unionByName(referrals.select(F.col("receiving_facility_id").alias("facility_id")))
           .filter("facility_id IS NOT NULL").distinct())
    blanks = [F.lit(None).cast("string").alias(c)
              for c in ("facility_type", "address", "city", "state", "zip")]
    shaped = ids.select(
        F.col("facility_id").alias("source_facility_id"),
        F.concat(F.lit("Facility "), "facility_id").alias("facility_name"), *blanks)
    return number_rows(shaped, [F.col("source_facility_id").asc_nulls_last()],
                       "facility_key", "DFAC-", 4)


def dim_counterparty_org(referrals: DataFrame, strict: bool = False) -> DataFrame:
    """Firms by normalised name; type is the commonest over the distinct spellings
    (smallest on a tie), the spelling shown is the smallest."""
    spellings = (referrals.filter("counterparty_org_name IS NOT NULL")
                 .select("counterparty_org_name", "counterparty_org_type").distinct())
    per_type = (spellings
                .groupBy(organisation_name(F.col("counterparty_org_name"), strict)
                         .alias("normalized_name"), "counterparty_org_type")
                .agg(F.count("*").alias("n"), F.min("counterparty_org_name").alias("spelling")))
    kind = F.col("counterparty_org_type")
    firms = per_type.groupBy("normalized_name").agg(
        F.min("spelling").alias("counterparty_org_name"),
        F.min_by(kind, F.when(kind.isNotNull(), F.struct(-F.col("n"), kind)))
        .alias("counterparty_org_type"),
        F.sum("n").alias("name_variant_count"))
    shaped = firms.select("counterparty_org_name", "normalized_name", "counterparty_org_type",
                          "name_variant_count")
    return number_rows(shaped, [F.col("normalized_name").asc_nulls_last()],
                       "counterparty_org_key", "DCPTY-", 4)


def dim_payer(headers: DataFrame) -> DataFrame:
    payers = headers.select("payer_name").filter("payer_name IS NOT NULL").distinct()
    return number_rows(payers, [F.col("payer_name").asc_nulls_last()], "payer_key", "DPAY-", 4)


def bridge_patient_counterparty(xref: DataFrame, referrals: DataFrame, firms: DataFrame,
                                strict: bool = False) -> DataFrame:
    """Patients and firms, one row per referral order."""
    orders = (referrals.filter("counterparty_org_name IS NOT NULL")
              .select("referral_order_id", "referral_created_at", "counterparty_org_name",
                      organisation_name(F.col("counterparty_org_name"), strict)
                      .alias("normalized_name")))
    people = (xref.filter("source_system = 'referral'")
              .select(F.col("source_patient_key").alias("referral_order_id"), "patient_id"))
    return (orders.join(people, "referral_order_id")
            .join(firms.select("normalized_name", "counterparty_org_key"), "normalized_name")
            .select("patient_id", "counterparty_org_key", "referral_order_id",
                    "referral_created_at", "counterparty_org_name").distinct())


def bridge_pair(bridge: DataFrame) -> DataFrame:
    """The bridge at the grain its uniqueness check names: one row per patient and firm."""
    return bridge.groupBy("patient_id", "counterparty_org_key").agg(
        F.count("*").alias("referral_count"),
        F.min("referral_created_at").alias("first_referral_at"),
        F.max("referral_created_at").alias("last_referral_at"))
