"""Providers and firms as entities with identifiers and typed, weighted edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import organisation_name
from ..operators.keys import stable_key


def legal_name(column: str) -> Column:
    """Name for exact matching of organisations: no legal form, case or punctuation."""
    bare = F.regexp_replace(organisation_name(F.col(column)), "[^A-Z0-9 ]", "")
    return F.trim(F.regexp_replace(bare, " +", " "))


def person_id(npi: str) -> Column:
    return stable_key("PER-", F.col(npi))


def org_id(name: Column) -> Column:
    return stable_key("ORG-", name)


def entities(providers: DataFrame, referrals: DataFrame) -> DataFrame:
    """Persons by NPI and organisations by legal name."""
    people = (providers.filter("npi IS NOT NULL").groupBy(person_id("npi").alias("entity_id"))
              .agg(F.lit("person").alias("entity_type"), F.min("full_name").alias("canonical_name"),
                   F.min("phone").alias("canonical_phone"),
                   F.min("address_line1").alias("canonical_address")))
    named = (providers.select("org_name", "phone", "address_line1")
             .unionByName(referrals.select(F.col("counterparty_org_name").alias("org_name"),
                                           F.lit(None).cast("string").alias("phone"),
                                           F.lit(None).cast("string").alias("address_line1")))
             .filter("org_name IS NOT NULL"))
    orgs = (named.groupBy(org_id(legal_name("org_name")).alias("entity_id"))
            .agg(F.lit("org").alias("entity_type"), F.min("org_name").alias("canonical_name"),
                 F.min("phone").alias("canonical_phone"),
                 F.min("address_line1").alias("canonical_address")))
    return people.unionByName(orgs)


def identifiers(providers: DataFrame, referrals: DataFrame) -> DataFrame:
    """Identifiers of the entities: NPI, source ids, case ids."""
    known = providers.filter("npi IS NOT NULL")

    def rows(df, entity, kind, value, authority, system):
        return df.select(entity.alias("entity_id"), F.lit(kind).alias("id_type"),
                         F.col(value).alias("id_value"), F.lit(authority).alias("issuing_authority"),
                         system.alias("source_system"))

    cases = referrals.filter("counterparty_org_name IS NOT NULL AND case_reference_id IS NOT NULL")
    parts = [
        rows(known, person_id("npi"), "NPI", "npi", "national registry", F.col("source_system")),
        rows(known, person_id("npi"), "external_id", "source_provider_id", "source",
             F.col("source_system")),
        rows(cases, org_id(legal_name("counterparty_org_name")), "case_id", "case_reference_id",
             "firm", F.lit("referral")),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


# how far one row of each kind of evidence is trusted
EVIDENCE = {"listed organisation": 0.9, "same claim": 0.7, "same referral order": 0.6}


def confidence() -> Column:
    base = F.coalesce(*[F.when(F.col("evidence") == k, F.lit(v)) for k, v in EVIDENCE.items()])
    return F.round(1.0 - F.pow(1.0 - base, F.col("support")), 3).cast("decimal(4,3)")


def links(providers: DataFrame, referrals: DataFrame, headers: DataFrame) -> DataFrame:
    """A row for every source row that supports an edge."""
    refer = referrals.filter(
        "referring_provider_npi IS NOT NULL AND counterparty_org_name IS NOT NULL").select(
        person_id("referring_provider_npi").alias("from_entity_id"),
        org_id(legal_name("counterparty_org_name")).alias("to_entity_id"),
        F.lit("refers_to").alias("edge_type"), F.lit("referral").alias("source_system"),
        F.lit("same referral order").alias("evidence"))
    employ = providers.filter("npi IS NOT NULL AND org_name IS NOT NULL").select(
        person_id("npi").alias("from_entity_id"),
        org_id(legal_name("org_name")).alias("to_entity_id"),
        F.lit("employed_by").alias("edge_type"), F.col("source_system"),
        F.lit("listed organisation").alias("evidence"))
    bill = headers.filter(
        "billing_provider_npi IS NOT NULL AND rendering_provider_npi IS NOT NULL").select(
        person_id("rendering_provider_npi").alias("from_entity_id"),
        person_id("billing_provider_npi").alias("to_entity_id"),
        F.lit("billed_by").alias("edge_type"), F.lit("rcm").alias("source_system"),
        F.lit("same claim").alias("evidence"))
    return refer.unionByName(employ).unionByName(bill)


def edges(providers: DataFrame, referrals: DataFrame, headers: DataFrame) -> DataFrame:
    """refers_to (provider to firm), employed_by (provider to organisation) and
    billed_by (rendering to billing provider), with the rows that support each.

    A single row of a kind of evidence is as good as EVIDENCE says; each further
    row leaves the same share of the remaining doubt.
    """
    return (links(providers, referrals, headers)
            .groupBy("from_entity_id", "to_entity_id", "edge_type", "source_system", "evidence")
            .agg(F.count("*").alias("support"))
            .withColumn("confidence", confidence()))
