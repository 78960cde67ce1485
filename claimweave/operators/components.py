"""Connected components and bounded label passes over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .skew import attach, dealt

MAX_ROUNDS = 60
DEALT_EDGES = 100_000  # from here on the minima are shuffled, not sent through the driver


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], int(row["h"])


def connected_components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(id, component) for every id on an edge; the component is its smallest id.

    Alternates the large-star and small-star steps of Kiveris et al.,
    "Connected Components in MapReduce and Beyond" (SoCC 2014), until the edge
    set stops changing. `edges` has numeric columns `u` and `v`. Minima are
    partially aggregated before the shuffle, and joined back with hot ids
    spread, so a hub with a large share of all edges does not slow a round.
    Whether minima may be broadcast is settled by the number of edges: the sizes
    that Spark knows are those of the plan that made them.
    """
    pair = edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u"))
    current = materialise(pair.filter("u <> v").distinct())
    state = _state(current)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        shuffled = dealt if state[0] > DEALT_EDGES else lambda side: side
        # large star: every larger neighbour points to the smallest id around
        both = current.select("u", "v").unionByName(
            current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        centre = both.groupBy("u").agg(
            F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = materialise(attach(both.filter("v > u"), shuffled(centre), "u", "v", 2 * state[0])
                            .select("v", F.col("m").alias("u")))
        # small star: smaller neighbours and the id itself point to the smallest of them
        floor = large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
        moved = (attach(large, shuffled(floor), "v", "u", 2 * state[0])
                 .filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")))
        current = materialise(
            moved.unionByName(floor.select("v", F.col("m").alias("u"))).distinct())
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"components still changing after {max_rounds} rounds")
    roots = current.select(F.col("u").alias("id")).distinct().withColumn("component", F.col("id"))
    return current.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(roots)


def label_passes(nodes: DataFrame, members: DataFrame, links: DataFrame, passes: int,
                 rows: int) -> DataFrame:
    """Spread the smallest label for a fixed number of synchronous passes.

    `nodes` has `id`; `members` (id, box) says which boxes a node is in;
    `links` (box, other) says that every node of `box` neighbours every node
    of `other`. One pass takes the minimum per box, carries it over the links
    and hands it to the members, so neighbour pairs are never listed.
    """
    members, links = materialise(members), materialise(links)
    sizes = members.groupBy("box").agg(F.count("*").alias("n"))
    labels = nodes.select("id", F.col("id").alias("label"))
    for _ in range(passes):
        inside = members.join(labels, "id").groupBy("box").agg(F.min("label").alias("low"))
        around = (links.join(inside.withColumnRenamed("box", "other"), "other")
                  .groupBy("box").agg(F.min("low").alias("low")).join(sizes, "box"))
        heard = (attach(members, around, "box", "id", rows)
                 .groupBy("id").agg(F.min("low").alias("low")))
        labels = materialise(labels.join(heard, "id", "left").select(
            "id", F.least("label", F.coalesce("low", "label")).alias("label")))
    return labels
