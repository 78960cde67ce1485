"""Exact-identifier match rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import attach, meet
from ..session import stored


@dataclass(frozen=True)
class Rule:
    """Records sharing all keys match; `keys` may differ by system.

    `filled` columns must also be non-empty. `across` limits the rule to pairs
    from different systems.
    """

    name: str
    confidence: str
    keys: dict[str | None, tuple[str, ...]]
    across: bool = False
    filled: tuple[str, ...] = ()


# Rule names and confidences, best first (confidence, then name).
RULES = (
    Rule("deterministic_id_link", "1.000",
         {"emr": ("source_patient_key",), "rcm": ("emr_patient_id_link",)}, across=True),
    Rule("deterministic_mrn", "1.000", {None: ("mrn",)}),
    Rule("deterministic_ssn_dob", "1.000", {None: ("ssn_last4", "dob")}),
    Rule("deterministic_email_dob", "0.950", {None: ("email", "dob")}, True, ("email",)),
    Rule("deterministic_phone_dob", "0.950", {None: ("phone", "dob")}, True, ("phone",)),
    Rule("deterministic_phone_lastname", "0.900", {None: ("phone", "lower(last_name)")}, True,
         ("phone",)),
)


def rule_name(rank: Column, rules=RULES) -> Column:
    return F.element_at(F.array(*[F.lit(r.name) for r in rules]), rank + 1)


def rule_confidence(rank: Column, rules=RULES) -> Column:
    values = F.array(*[F.lit(r.confidence).cast("decimal(4,3)") for r in rules])
    return F.element_at(values, rank + 1)


def rule_members(spine: DataFrame, rules=RULES) -> DataFrame:
    """(nid, system, rule, grp): one row per record and rule key it carries.

    One scan of the spine serves all rules; a group is the records that share
    the rule's key.
    """
    entries = []
    for rank, rule in enumerate(rules):
        for system, keys in rule.keys.items():
            parts = [F.expr(k).cast("string") for k in keys]
            usable = F.lit(True) if system is None else F.col("source_system") == system
            for part in parts:
                usable = usable & part.isNotNull()
            for column in rule.filled:
                usable = usable & (F.col(column) != "")
            group = F.concat_ws("\x1f", F.lit(str(rank)), *parts)
            entries.append(F.when(usable, F.struct(F.lit(rank).alias("rule"), group.alias("grp"))))
    keyed = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return (spine.select("nid", F.col("source_system").alias("system"), F.explode(keyed).alias("e"))
            .select("nid", "system", "e.rule", "e.grp"))


def _may_match(rules) -> Column:
    """True where the rule allows pairs inside one system."""
    return F.element_at(F.array(*[F.lit(not r.across) for r in rules]), F.col("rule") + 1)


def rule_pairs(members: DataFrame, rows: int, rules=RULES) -> DataFrame:
    """(nid_a, nid_b, rule): every matching pair per rule, the smaller record first.

    All rules share one join. Its output is as large as the answer, so nothing
    downstream of matching depends on it; clusters use `rule_links`.
    """
    left = members.select("grp", "rule", F.col("nid").alias("nid_a"), F.col("system").alias("sa"))
    right = members.select("grp", F.col("nid").alias("nid_b"), F.col("system").alias("sb"))
    return (meet(left, right, "grp", "nid_a", "nid_b", rows)
            .filter((F.col("nid_a") < F.col("nid_b"))
                    & (_may_match(rules) | (F.col("sa") != F.col("sb"))))
            .select("nid_a", "nid_b", "rule"))


def best_rule_pairs(pairs: DataFrame) -> DataFrame:
    """One row per pair with its best rule: rules are ranked, so the best is a minimum."""
    return pairs.groupBy("nid_a", "nid_b").agg(F.min("rule").alias("rule"))


def rule_groups(members: DataFrame, rules=RULES) -> DataFrame:
    """Groups in which every record has a partner, with size and smallest record.

    Systems are told apart by their hashes: numbers are added up in place, where
    the minimum of a text would have all members sorted first.
    """
    system = F.when(F.col("system").isNotNull(), F.xxhash64("system"))
    return (members.groupBy("grp", "rule")
            .agg(F.count("*").alias("n"), F.min("nid").alias("hub"),
                 F.min(system).alias("s0"), F.max(system).alias("s1"))
            .filter((F.col("s0") != F.col("s1")) | (_may_match(rules) & (F.col("n") > 1)))
            .select("grp", "n", "hub"))


def rule_links(members: DataFrame, rows: int, rules=RULES) -> DataFrame:
    """(nid, rule, hub): each matched record tied to the smallest of its group.

    Same components and same best rule per record as all pairs, in linear size.
    The groups are stored, as the join reads them twice.
    """
    groups = stored(rule_groups(members, rules), "rule-groups")
    return attach(members, groups, "grp", "nid", rows).select("nid", "rule", "hub")
