"""Pairs of rows that are alike in several token sets at once, without comparing all pairs.

Two sets with a Jaccard similarity of t share a token among the first few of
either, if tokens are put in one order: the prefix filter of Chaudhuri, Ganti
and Kaushik. With the rarest tokens first, the shared one is seldom a common
one. A row's keys combine one prefix token of each set, so a pair must meet in
all sets; sizes and places in the order rule out most others before the sets
themselves are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .skew import dealt, meet

_SLACK = 1e-9


def grams(text: Column, size: int = 3) -> Column:
    """Distinct substrings of `size` characters; a shorter text is its own only one."""
    last = F.greatest(F.length(text) - (size - 1), F.lit(1))
    return F.when(F.length(text) > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(size)))))


def words(text: Column) -> Column:
    """Distinct words of a text."""
    return F.array_distinct(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def _rarest_first(rows: DataFrame, column: str) -> DataFrame:
    """(rep, `column`): each row's tokens in order of their frequency over all rows."""
    told = rows.select("rep", F.explode(column).alias("token"))
    often = told.groupBy("token").agg(F.count("*").alias("often"))
    return (told.join(dealt(often), "token").groupBy("rep")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("often", "token"))),
                             lambda x: x["token"]).alias(column)))


def _prefix(column: str, least: float) -> Column:
    size = F.size(column)
    return F.slice(column, F.lit(1), (size - F.ceil(size * least - _SLACK) + 1).cast("int"))


def _may(column: str, least: float) -> Column:
    """Whether sizes, and places of the shared token, leave room for the similarity.

    Alike sets also meet in the first token they share, and all they share lies from there on;
    so the tokens before it count for nothing.
    """
    a, b = F.col(f"{column}_size_a"), F.col(f"{column}_size_b")
    needed = (a + b) * (least / (1 + least)) - _SLACK
    after = F.least(a - F.col(f"{column}_at_a"), b - F.col(f"{column}_at_b"))
    return (F.least(a, b) >= F.greatest(a, b) * least - _SLACK) & (after >= needed)


def alike(rows: DataFrame, least: dict[str, float], id_column: str = "id"
          ) -> tuple[DataFrame, DataFrame]:
    """(id, rep) of rows with all the sets, and (rep_a, rep_b) of alike ones.

    `least` names array columns of distinct tokens and the Jaccard similarity
    needed in each. Rows that are equal in all of them have one representative,
    their smallest id, so copies are compared once; `rep_a < rep_b`. Rows with a
    set that is NULL or empty are alike to none and left out. Sets that must be
    equal count as one token.
    """
    if any(not 0 < t <= 1 for t in least.values()):
        raise ValueError("similarities lie above 0, up to 1")
    columns = list(least)
    equal = {c for c in columns if least[c] == 1}
    full = reduce(Column.__and__, [F.coalesce(F.size(F.col(c)) > 0, F.lit(False)) for c in columns])
    sets = rows.filter(full).select(F.col(id_column).alias("id"),
                                    *[F.array_sort(c).alias(c) for c in columns])
    told = stored(sets.groupBy(*columns).agg(F.min("id").alias("rep")), "token-sets")
    members = sets.join(dealt(told), columns).select("id", "rep")
    ordered = told.select("rep", *[F.array(F.xxhash64(c)).alias(c) for c in equal])
    for c in columns:
        if c not in equal:
            ordered = ordered.join(dealt(_rarest_first(told, c)), "rep")
    ordered = stored(ordered, "token-orders")
    keys = ordered.select("rep", *[F.size(c).alias(f"{c}_size") for c in columns], *[
        _prefix(c, least[c]).alias(c) for c in columns])
    for c in columns:
        keys = keys.select("*", F.posexplode(c).alias(f"{c}_at", f"{c}_token"))
    key = F.xxhash64(*[f"{c}_token" for c in columns])
    told_of = [x for c in columns for x in (f"{c}_size", f"{c}_at")]

    def side(tag: str) -> DataFrame:
        return keys.select(key.alias("k"), F.col("rep").alias(f"rep_{tag}"),
                           *[F.col(x).alias(f"{x}_{tag}") for x in told_of])

    # a set's prefix has at most as many tokens as the set
    most = ordered.select(F.sum(reduce(Column.__mul__, [F.size(c).cast("long") for c in columns]))
                          ).first()[0] or 0
    met = (meet(side("a"), dealt(side("b")), "k", "rep_a", "rep_b", most)
           .filter(F.col("rep_a") < F.col("rep_b"))
           .filter(reduce(Column.__and__, [_may(c, least[c]) for c in columns]))
           .select("rep_a", "rep_b").distinct())
    for tag in ("a", "b"):
        met = met.join(dealt(told.select(F.col("rep").alias(f"rep_{tag}"), *[
            F.col(c).alias(f"{c}_{tag}") for c in columns])), f"rep_{tag}")
    enough = [jaccard(F.col(f"{c}_a"), F.col(f"{c}_b")) >= t for c, t in least.items()]
    return members, met.filter(reduce(Column.__and__, enough)).select("rep_a", "rep_b")
