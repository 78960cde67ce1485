"""Providers and firms brought together across sources by names, addresses, phones and cases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.components import connected_components
from ..operators.keys import row_positions, stable_key
from ..operators.set_join import alike, grams, words
from ..operators.skew import dealt
from ..session import stored
from . import graph

NAME_LIKENESS = 0.4       # Jaccard similarity of the names' groups of three letters
ADDRESS_LIKENESS = 0.75   # of the addresses' words
# what binds mentions of one kind (person or organisation), and how alike each set must be
RULES: dict[str, dict[str, float]] = {
    "name and address": {"kind": 1.0, "name": NAME_LIKENESS, "address": ADDRESS_LIKENESS},
    "phone and address": {"kind": 1.0, "phone": 1.0, "address": ADDRESS_LIKENESS},
    "case, type and name": {"kind": 1.0, "case": 1.0, "name": NAME_LIKENESS},
}
COLUMNS = ("mention", "entity_type", "name", "address", "phone", "npi", "case_id", "org_type",
           "source_system", "entity_id")


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(text), "[^A-Z0-9 ]", ""), " +", " "))


def mentions(providers: DataFrame, referrals: DataFrame, listed: DataFrame) -> DataFrame:
    """Every place where a source names a person or an organisation.

    `providers` is the provider dimension, `listed` the provider list of the
    external clinical system. `entity_id` is that of the exact graph.
    """
    none = F.lit(None).cast("string")

    def row(df, prefix, key, **columns) -> DataFrame:
        told = {c: columns.get(c, none) for c in COLUMNS} | {
            "mention": F.concat(F.lit(prefix), F.col(key))}
        return df.select(*[v.alias(c) for c, v in told.items()])

    place = F.concat_ws(" ", "address_line1", "zip")
    people = row(providers, "provider:", "source_provider_id", entity_type=F.lit("person"),
                 name=_plain(F.col("full_name")), address=place, phone=F.col("phone"),
                 npi=F.col("npi"), source_system=F.col("source_system"),
                 entity_id=F.when(F.col("npi").isNotNull(), graph.person_id("npi")))
    employers = row(providers.filter("org_name IS NOT NULL"), "employer:", "source_provider_id",
                    entity_type=F.lit("org"), name=graph.legal_name("org_name"), address=place,
                    phone=F.col("phone"), source_system=F.col("source_system"),
                    entity_id=graph.org_id(graph.legal_name("org_name")))
    firms = row(referrals.filter("counterparty_org_name IS NOT NULL"), "firm:", "referral_order_id",
                entity_type=F.lit("org"), name=graph.legal_name("counterparty_org_name"),
                case_id=F.col("case_reference_id"), org_type=F.col("counterparty_org_type"),
                source_system=F.lit("referral"),
                entity_id=graph.org_id(graph.legal_name("counterparty_org_name")))
    others = row(listed, "clinical:", "Id", entity_type=F.lit("person"),
                 name=_plain(F.col("NAME")), address=F.concat_ws(" ", "ADDRESS", "ZIP"),
                 source_system=F.lit("clinical"))
    return reduce(DataFrame.unionByName, [people, employers, firms, others]).withColumn(
        "address", F.when(F.col("address") != "", F.upper("address")))


def _equal(numbered: DataFrame, key: Column, evidence: str) -> DataFrame:
    """Links of all mentions with one key to the smallest of them."""
    told = numbered.select("id", key.alias("key")).filter("key IS NOT NULL")
    first = told.groupBy("key").agg(F.min("id").alias("u"), F.count("*").alias("n")).filter("n > 1")
    return (told.join(dealt(first), "key").filter("id <> u")
            .select("u", F.col("id").alias("v"), F.lit(evidence).alias("evidence")))


def links(numbered: DataFrame) -> DataFrame:
    """(u, v, evidence) that bind numbered mentions; linear in them but for unlike alike ones."""
    organisation = F.col("entity_type") == "org"
    parts = [_equal(numbered, F.col("npi"), "same NPI"),
             _equal(numbered, F.when(organisation & (F.col("name") != ""), F.col("name")),
                    "same legal name")]
    sets = stored(numbered.select(
        "id", F.array("entity_type").alias("kind"), grams(F.col("name")).alias("name"),
        words(F.col("address")).alias("address"),
        F.when(F.col("phone") != "", F.array("phone")).alias("phone"),
        F.when(F.col("case_id").isNotNull() & F.col("org_type").isNotNull(),
               F.array(F.concat_ws("\x1f", "case_id", "org_type"))).alias("case")), "mention-sets")
    for evidence, least in RULES.items():
        members, pairs = alike(sets, least)
        parts.append(members.filter("id <> rep").select(
            F.col("rep").alias("u"), F.col("id").alias("v"), F.lit(evidence).alias("evidence")))
        parts.append(pairs.select(F.col("rep_a").alias("u"), F.col("rep_b").alias("v"),
                                  F.lit(evidence).alias("evidence")))
    return stored(reduce(DataFrame.unionByName, parts), "mention-links")


def resolved(mentioned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mentions with `resolved_id`, and (resolved_id, evidence) of what bound each entity."""
    numbered = stored(row_positions(mentioned, [F.col("mention")], "id"), "mentions")
    bound = links(numbered)
    found = stored(connected_components(bound.select("u", "v")), "mention-components")
    first = (numbered.join(dealt(found), "id", "left")
             .withColumn("_root", F.coalesce("component", "id")).drop("component"))
    names = numbered.select(F.col("id").alias("_root"), stable_key("RES-", "mention")
                            .alias("resolved_id"))
    named = stored(first.join(dealt(names), "_root").drop("_root"), "resolved-mentions")
    evidence = (bound.join(dealt(named.select(F.col("id").alias("u"), "resolved_id")), "u")
                .select("resolved_id", "evidence").distinct())
    return named, evidence


def _listed(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ", ")


def entities(named: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row per resolved entity: its most frequent name (of equals the smallest), smallest
    phone and address, what bound it, and how many mentions, names and NPIs it has."""
    often = (named.filter("name <> ''").groupBy("resolved_id", "name")
             .agg(F.count("*").alias("n")).groupBy("resolved_id")
             .agg(F.min(F.struct(-F.col("n"), "name")).alias("best"),
                  F.count("*").alias("name_count")))
    bound = evidence.groupBy("resolved_id").agg(_listed("evidence").alias("evidence"))
    return (named.groupBy("resolved_id", "entity_type").agg(
        F.min("phone").alias("canonical_phone"), F.min("address").alias("canonical_address"),
        F.count("*").alias("mention_count"), F.countDistinct("npi").alias("npi_count"),
        _listed("source_system").alias("source_systems"))
        .join(dealt(often), "resolved_id", "left").join(dealt(bound), "resolved_id", "left")
        .select("resolved_id", "entity_type", F.col("best.name").alias("canonical_name"),
                "canonical_phone", "canonical_address", "mention_count",
                F.coalesce("name_count", F.lit(0)).alias("name_count"), "npi_count",
                "source_systems", F.coalesce("evidence", F.lit("")).alias("evidence")))


def edges(named: DataFrame, graph_links: DataFrame) -> DataFrame:
    """The graph's edges between resolved entities, with the rows of merged ends together."""
    of = named.filter("entity_id IS NOT NULL").select("entity_id", "resolved_id").distinct()

    def end(tag: str) -> DataFrame:
        return of.select(F.col("entity_id").alias(f"{tag}_entity_id"),
                         F.col("resolved_id").alias(f"{tag}_resolved_id"))

    joined = (graph_links.groupBy("from_entity_id", "to_entity_id", "edge_type", "source_system",
                                  "evidence").agg(F.count("*").alias("support"))
              .join(end("from"), "from_entity_id").join(end("to"), "to_entity_id"))
    return (joined.groupBy("from_resolved_id", "to_resolved_id", "edge_type", "source_system",
                           "evidence").agg(F.sum("support").alias("support"))
            .withColumn("confidence", graph.confidence()))
