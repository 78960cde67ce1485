"""Clusters, canonical patients and their best values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from ..operators.components import connected_components, label_passes
from ..operators.keys import padded_key, row_positions, stable_key
from ..operators.skew import attach
from ..sources.layout import SYSTEMS
from .rules import RULES, rule_confidence, rule_groups, rule_name

# Which systems may supply a field, best first.
PRIORITY = {
    "first_name": SYSTEMS, "last_name": SYSTEMS, "dob": SYSTEMS, "phone": SYSTEMS,
    "email": ("emr", "referral"), "address_line1": SYSTEMS, "city": SYSTEMS, "state": SYSTEMS,
    "zip": SYSTEMS,
}
SINGLETON = "unmatched_singleton"


def match_edges(links: DataFrame, fuzzy_members: DataFrame, scored: DataFrame) -> DataFrame:
    """(u, v): a sparse graph with the same components as all matched pairs."""
    return (links.select(F.col("hub").alias("u"), F.col("nid").alias("v"))
            .unionByName(fuzzy_members.select(F.col("rep").alias("u"), F.col("nid").alias("v")))
            .unionByName(scored.select(F.col("rep_a").alias("u"), F.col("rep_b").alias("v")))
            .filter("u <> v"))


def clusters(links: DataFrame, fuzzy_members: DataFrame, scored: DataFrame) -> DataFrame:
    """(nid, label) for matched records, label = smallest record of the component."""
    found = connected_components(match_edges(links, fuzzy_members, scored))
    return found.select(F.col("id").alias("nid"), F.col("component").alias("label"))


def clusters_after(passes: int, spine: DataFrame, members: DataFrame, fuzzy_members: DataFrame,
                   scored: DataFrame, rows: int, rules=RULES) -> DataFrame:
    """(nid, label) after a fixed number of label passes; long chains stay split."""
    grouped = members.join(rule_groups(members, rules).select("grp"), "grp", "left_semi")
    box = F.concat_ws("\x1f", F.lit("r"), "grp", "system")
    profile_box = F.concat(F.lit("p"), F.col("rep").cast("string"))
    inside = (grouped.select(F.col("nid").alias("id"), box.alias("box"))
              .unionByName(fuzzy_members.select(F.col("nid").alias("id"),
                                                profile_box.alias("box"))))
    kinds = grouped.select("grp", "rule", "system", box.alias("box")).distinct()
    others = kinds.select("grp", F.col("system").alias("sys2"), F.col("box").alias("other"))
    inner = F.element_at(F.array(*[F.lit(not r.across) for r in rules]), F.col("rule") + 1)
    # at most one box per system and group, so this join is small per group
    rule_side = (kinds.join(others, "grp").filter((F.col("system") != F.col("sys2")) | inner)
                 .select("box", "other"))
    a = F.concat(F.lit("p"), F.col("rep_a").cast("string"))
    b = F.concat(F.lit("p"), F.col("rep_b").cast("string"))
    links = (rule_side.unionByName(scored.select(a.alias("box"), b.alias("other")))
             .unionByName(scored.select(b.alias("box"), a.alias("other"))))
    labels = label_passes(spine.select(F.col("nid").alias("id")), inside, links, passes,
                          rows * (len(rules) + 1))
    return labels.select(F.col("id").alias("nid"), "label")


def crosswalk(spine: DataFrame, labels: DataFrame, links: DataFrame, fuzzy_members: DataFrame,
              rows: int, stable_ids: bool = False) -> DataFrame:
    """One row per record: canonical patient, cluster, best confidence and method.

    Of equal confidences an exact rule goes before the score, then rule order.
    `stable_ids` derives the patient id from the cluster's smallest record
    instead of its position, so ids survive the arrival of new patients.
    """
    no_int, no_long = F.lit(None).cast("int"), F.lit(None).cast("long")
    no_conf = F.lit(None).cast("decimal(4,3)")
    evidence = (
        labels.select("nid", "label", no_int.alias("rule"), no_conf.alias("score"))
        .unionByName(links.select("nid", no_long.alias("label"), "rule", no_conf.alias("score")))
        .unionByName(fuzzy_members.select("nid", no_long.alias("label"), no_int.alias("rule"),
                                          F.col("confidence").alias("score")))
        .groupBy("nid").agg(F.min("label").alias("label"), F.min("rule").alias("rule"),
                            F.max("score").alias("score"))
    )
    exact = rule_confidence(F.col("rule"))
    by_score = F.col("score").isNotNull() & (exact.isNull() | (F.col("score") > exact))
    records = (
        spine.select("nid", "node", "source_system", "source_patient_key")
        .join(evidence, "nid", "left")
        .select("nid", "source_system", "source_patient_key",
                F.coalesce("label", "nid").alias("label"),
                F.coalesce(F.when(by_score, F.col("score")).otherwise(exact),
                           F.lit(Decimal("1.000")).cast("decimal(4,3)")).alias("match_confidence"),
                F.when(by_score, F.lit("probabilistic"))
                .when(F.col("rule").isNotNull(), rule_name(F.col("rule")))
                .otherwise(F.lit(SINGLETON)).alias("match_method"))
    )
    sizes = records.groupBy("label").agg(F.count("*").alias("n"))
    names = spine.select(F.col("nid").alias("label"), F.col("node").alias("cluster_id"))
    if stable_ids:
        patients = sizes.join(names, "label").withColumn(
            "patient_id", stable_key("PAT-", "cluster_id"))
    else:
        patients = (row_positions(sizes, [F.col("label").asc_nulls_last()], "_number")
                    .join(names, "label")
                    .select("label", "n", "cluster_id",
                            padded_key("PAT-", F.col("_number"), 6).alias("patient_id")))
    return attach(records, patients, "label", "nid", rows).select(
        "nid", "source_system", "source_patient_key", "patient_id", "cluster_id",
        "match_confidence", "match_method")


def source_xref(walk: DataFrame) -> DataFrame:
    """Crosswalk table with its validity interval."""
    return walk.select("patient_id", "source_system", "source_patient_key", "match_confidence",
                       "match_method", F.current_timestamp().alias("effective_from"),
                       F.lit(None).cast("timestamp").alias("effective_to"))


def survive(walk: DataFrame, spine: DataFrame, priority: dict = PRIORITY,
            record_level: bool = False) -> DataFrame:
    """Best value per patient and field, from the best system that has one.

    Default: the largest value within the system, field by field. With
    `record_level` each system is represented by one record (the latest key
    with the fewest gaps), so the fields taken from a system belong together.
    """
    people = walk.select("nid", "patient_id").join(spine.drop("node"), "nid")
    if record_level:
        gaps = sum((F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) == "", 1).otherwise(0)
                    for f in priority), F.lit(0))
        packed = F.struct(*priority)
        chosen = people.groupBy("patient_id", "source_system").agg(
            F.max_by(packed, F.struct(-gaps, "source_patient_key")).alias("r"))
        people = chosen.select("patient_id", "source_system", "r.*")
    best = [
        F.coalesce(*[F.max(F.when(F.col("source_system") == s, F.col(field))) for s in systems])
        .alias(f"best_{field}")
        for field, systems in priority.items()
    ]
    return people.groupBy("patient_id").agg(*best)
