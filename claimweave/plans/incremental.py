"""Matching new, changed and withdrawn records while keeping earlier decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.agreement import Model
from ..operators.components import connected_components
from ..operators.skew import attach
from ..session import stored
from . import fuzzy, identity
from .match_index import MatchIndex
from .rules import RULES, rule_groups, rule_members

KEY = ["source_system", "source_patient_key"]


def with_digest(spine: DataFrame) -> DataFrame:
    """Spine records with a digest of all that matching looks at."""
    seen = [c for c in spine.columns if c not in ("nid", "node")]
    marked = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in seen]
    return spine.withColumn("digest", F.md5(F.concat_ws("\x1f", *marked)))


def new_rule_links(members: DataFrame, fresh: DataFrame, rows: int) -> DataFrame:
    """Rule links of the groups that hold a fresh record; other groups keep what they have."""
    touched = members.join(fresh, "nid", "left_semi").select("grp").distinct()
    inside = stored(members.join(touched, "grp", "left_semi"), "touched-members")
    return attach(inside, rule_groups(inside), "grp", "nid", rows).select("nid", "rule", "hub")


def new_scored(people: DataFrame, rows: int, model: Model = Model()) -> DataFrame:
    """Scored profile pairs with a fresh record on at least one side."""
    fresh = people.filter("fresh")
    pairs = (fuzzy.candidates(fresh, rows, model, against=people)
             .unionByName(fuzzy.candidates(people, rows, model, against=fresh)).distinct())
    return fuzzy.score(pairs, people, model)


def _state(spine: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Each record with its old cluster, confidence and method, all NULL if it is fresh.

    Fresh are new and changed records, and all records of a cluster that lost
    one or had one changed: what held the cluster together may be gone.
    """
    digested = with_digest(spine)
    if earlier is None:
        return digested.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("old_cluster", "string"), ("match_confidence", "decimal(4,3)"),
            ("match_method", "string"))])
    old = earlier.select(*KEY, F.col("digest").alias("old_digest"),
                         F.col("cluster_id").alias("old_cluster"), "match_confidence",
                         "match_method")
    joined = stored(digested.join(old, KEY, "full"), "incremental-state")
    lost = F.col("nid").isNull() | (F.col("digest") != F.col("old_digest"))
    broken = joined.filter(F.col("old_cluster").isNotNull() & lost).select(
        "old_cluster").distinct().withColumn("broken", F.lit(True))
    known = joined.filter("nid IS NOT NULL").join(broken, "old_cluster", "left")
    kept = F.col("broken").isNull() & F.col("old_cluster").isNotNull()
    return known.select(*digested.columns, *[F.when(kept, F.col(c)).alias(c) for c in (
        "old_cluster", "match_confidence", "match_method")])


def indexed_members(index: MatchIndex, state: DataFrame, fresh_records: DataFrame) -> DataFrame:
    """Rule members of the fresh records and of all that share a key with them."""
    touched = index.rule_records(fresh_records)
    return rule_members(state.join(touched, [*KEY, "digest"], "left_semi"))


def indexed_people(index: MatchIndex, flagged: DataFrame,
                   fresh_records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles of the fresh records and of those that agree enough with them, and the pairs.

    Only these are grouped; of all other records nothing is made but their digest.
    """
    tagged = stored(fuzzy.with_profile(fresh_records), "fresh-profiles")
    pairs = stored(index.profile_pairs(tagged), "indexed-pairs")
    involved = (tagged.select("profile").unionByName(pairs.select("profile_a").toDF("profile"))
                .unionByName(pairs.select("profile_b").toDF("profile")).distinct())
    people = stored(_people(flagged.join(involved, "profile", "left_semi")), "incremental-people")
    reps = people.select("profile", "rep")
    named = (pairs.join(reps.toDF("profile_a", "rep_a"), "profile_a")
             .join(reps.toDF("profile_b", "rep_b"), "profile_b").select("rep_a", "rep_b"))
    return people, named


def _people(flagged: DataFrame) -> DataFrame:
    return (flagged.groupBy("profile", "system", *fuzzy.TRAITS)
            .agg(F.min("nid").alias("rep"), F.count("*").alias("n"),
                 F.max(F.coalesce("new", F.lit(False))).alias("fresh")))


def rematch(spine: DataFrame, earlier: DataFrame | None, model: Model = Model(),
            index: MatchIndex | None = None) -> DataFrame:
    """Crosswalk of the whole spine, matching only what involves fresh records.

    With `index`, which must hold the keys of all records of `earlier`, fresh
    records are added to it and probe it; else the keys of all records are made
    anew. The result is the same.

    `earlier` is the stored crosswalk of a former run, with its `digest` (None at
    the very start). An intact old cluster enters as one node, its smallest
    record, so only new ties are followed; its confidences stay as evidence.
    Patient ids derive from the cluster's first record, so they stay unless a
    cluster gains an earlier record, loses its first one or merges.
    """
    rows = spine.count()
    state = stored(_state(spine, earlier), "incremental-known")
    fresh_records = state.filter("old_cluster IS NULL").select(*spine.columns, "digest")
    fresh = fresh_records.select("nid")
    flagged = fuzzy.with_profile(spine).join(fresh.withColumn("new", F.lit(True)), "nid", "left")
    if index is None:
        members = rule_members(spine)
        people = stored(_people(flagged), "incremental-people")
    else:
        index.add(fresh_records)
        members = indexed_members(index, state, fresh_records)
        people, pairs = indexed_people(index, flagged, fresh_records)
    members = stored(members, "incremental-members")
    links = stored(new_rule_links(members, fresh, rows * len(RULES)), "incremental-links")
    scored = stored(new_scored(people, people.count(), model) if index is None
                    else fuzzy.score(pairs, people, model), "incremental-scored")
    fuzzy_rows = stored(fuzzy.fuzzy_members(flagged, people, scored, rows), "incremental-fuzzy")

    sizes = state.filter("old_cluster IS NOT NULL").groupBy("old_cluster").agg(
        F.min("nid").alias("root"), F.count("*").alias("n"))
    roots = stored(attach(state.filter("old_cluster IS NOT NULL").select("nid", "old_cluster"),
                          sizes, "old_cluster", "nid", rows).select("nid", "root"),
                   "incremental-roots")
    ties = identity.match_edges(links, fuzzy_rows, scored)
    for end in ("u", "v"):
        ties = ties.join(roots.withColumnRenamed("nid", end), end, "left").withColumn(
            end, F.coalesce("root", end)).drop("root")
    found = connected_components(ties.filter("u <> v"))
    names = state.select("nid").join(roots, "nid", "left").withColumn(
        "root", F.coalesce("root", "nid"))
    labels = names.join(found.withColumnRenamed("id", "root"), "root", "left").select(
        "nid", F.coalesce("component", "root").alias("label"))
    # earlier evidence joins the new on equal terms
    ranks = {name: i for i, name in enumerate(r.name for r in RULES)}
    old_rule = F.coalesce(*[F.when(F.col("match_method") == n, F.lit(i)) for n, i in ranks.items()])
    matched = state.filter(f"match_method <> '{identity.SINGLETON}'").withColumn("rule", old_rule)
    old_links = matched.filter("rule IS NOT NULL").select(
        "nid", "rule", F.lit(None).cast("long").alias("hub"))
    old_scores = matched.filter("rule IS NULL").select(
        "nid", F.lit(None).cast("long").alias("rep"), F.col("match_confidence").alias("confidence"))
    walked = identity.crosswalk(spine, labels, links.unionByName(old_links),
                                fuzzy_rows.unionByName(old_scores), rows, stable_ids=True)
    return walked.join(state.select("nid", "digest"), "nid")
