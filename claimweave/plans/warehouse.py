"""All tables by name, each built once from the tables it needs."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.agreement import Model
from ..operators.quality import Check, run_checks
from ..operators.skew import attach
from ..operators.typed import check_contract, clean
from ..session import stored as store_rows
from ..sources.layout import SOURCES
from ..sources.sinks import read_table, write_table
from . import dimensions, facts, fuzzy, identity, rules as rule_plan, spine as spine_plan

# Stored tables that are split by the month of a date column.
BY_MONTH = {"fact_receivable": "snapshot_date", "fact_patient_balance": "snapshot_date"}


PAIR_TABLES = ("deterministic_match", "probabilistic_match")


class Warehouse:
    """Tables of the cleaned, linkage and star layers over landed sources.

    `landed` returns a landed table by name. Tables are remembered; what several
    tables reuse in the linkage is stored in the checkpoint folder. With
    `store`, every table asked for is written there and read back, so that no
    table is computed twice; `by_month` splits the stored facts by month.
    `max_passes` bounds label spreading; by default clusters are complete
    components.
    """

    def __init__(self, spark: SparkSession, landed: Callable[[str], DataFrame],
                 store: str | None = None, model: Model = Model(),
                 max_passes: int | None = None, stable_ids: bool = False,
                 by_month: bool = False):
        self.spark = spark
        self.landed = landed
        self.store = store
        self.model = model
        self.max_passes = max_passes
        self.stable_ids = stable_ids
        self.by_month = by_month
        self._tables: dict[str, DataFrame] = {}
        self._counts: dict[str, int] = {}

    def _once(self, name: str, make: Callable[[], DataFrame], stored: bool = False) -> DataFrame:
        if name not in self._tables:
            df = make()
            self._tables[name] = store_rows(df, name.strip("_").split()[0]) if stored else df
        return self._tables[name]

    def once(self, name: str, make: Callable[[], object]):
        """What `make` returns, made on the first call and remembered under `name`."""
        return self._once(f"once {name}", make)

    def _rows(self, name: str, df: DataFrame) -> int:
        if name not in self._counts:
            self._counts[name] = df.count()
        return self._counts[name]

    # cleaned layer

    def clean(self, name: str) -> DataFrame:
        return self.table(name)

    def _cleaned(self, name: str) -> DataFrame:
        source = SOURCES[name]
        return check_contract(clean(self.landed(name), source), source.clean_schema())

    # linkage layer

    def spine(self) -> DataFrame:
        return self._once("_spine", lambda: spine_plan.numbered(spine_plan.spine(
            self.clean("emr_patient"), self.clean("rcm_patient_account"),
            self.clean("referral_order"))))

    def spine_rows(self) -> int:
        return self._rows("_spine", self.spine())

    def members(self) -> DataFrame:
        return self._once("_members", lambda: rule_plan.rule_members(self.spine()))

    def links(self) -> DataFrame:
        return self._once("_links", lambda: rule_plan.rule_links(
            self.members(), self.spine_rows() * len(rule_plan.RULES)), stored=True)

    def tagged(self) -> DataFrame:
        return self._once("_tagged", lambda: fuzzy.with_profile(self.spine()))

    def people(self) -> DataFrame:
        return self._once("_people", lambda: fuzzy.profiles(self.tagged()), stored=True)

    def people_rows(self) -> int:
        return self._rows("_people", self.people())

    def candidates_for(self, model: Model) -> DataFrame:
        return self._once(f"_candidates {model}", lambda: fuzzy.candidates(
            self.people(), self.people_rows(), model), stored=True)

    def scored_for(self, model: Model) -> DataFrame:
        return self._once(f"_scored {model}", lambda: fuzzy.score(
            self.candidates_for(model), self.people(), model), stored=True)

    def scored(self) -> DataFrame:
        return self.scored_for(self.model)

    def fuzzy_members_for(self, model: Model) -> DataFrame:
        return self._once(f"_fuzzy {model}", lambda: fuzzy.fuzzy_members(
            self.tagged(), self.people(), self.scored_for(model), self.spine_rows()), stored=True)

    def record_pairs(self, model: Model | None = None) -> DataFrame:
        model = model or self.model
        return fuzzy.record_pairs(self.scored_for(model), self.fuzzy_members_for(model),
                                  self.spine_rows())

    def edit_pairs(self) -> DataFrame:
        """(nid_a, nid_b, edit_score): record pairs of the plain blocks by the other score."""
        def make():
            pairs = store_rows(fuzzy.edit_candidates(self.people(), self.people_rows()),
                               "edit-candidates")
            scored = store_rows(fuzzy.edit_distance_score(pairs, self.people()), "edit-scored")
            reps = (scored.select(F.col("rep_a").alias("rep"))
                    .unionByName(scored.select(F.col("rep_b").alias("rep"))).distinct())
            known = self.people().select("profile", "rep", "n").join(reps, "rep")
            members = attach(self.tagged().select("nid", "profile"), known, "profile", "nid",
                             self.spine_rows()).select("nid", "rep")
            return fuzzy.record_pairs(scored, members, self.spine_rows())
        return self._once("_edit_pairs", make, stored=True)

    def review_records(self, floor: Model) -> DataFrame:
        """Records without an accepted match, with their best pair from the floor's threshold on.

        Of equally good others the one with the smallest record counts.
        """
        scored = self.scored_for(floor)
        ends = (scored.select(F.col("rep_a").alias("rep"), F.col("rep_b").alias("other"),
                              "confidence")
                .unionByName(scored.select("rep_b", "rep_a", "confidence")
                             .toDF("rep", "other", "confidence")))
        best = ends.groupBy("rep").agg(
            F.max_by("other", F.struct("confidence", -F.col("other"))).alias("other"),
            F.max("confidence").alias("best_confidence"))
        known = self.people().select("profile", "rep", "n").join(best, "rep")
        found = attach(self.tagged().select("nid", "profile"), known, "profile", "nid",
                       self.spine_rows()).select("nid", "other", "best_confidence")
        names = self.spine().select(F.col("nid").alias("other"),
                                    F.col("source_system").alias("candidate_system"),
                                    F.col("source_patient_key").alias("candidate_key"))
        open_records = self.walk().filter(F.col("match_method") == identity.SINGLETON)
        return (open_records.select("nid", "source_system", "source_patient_key")
                .join(found, "nid", "left").join(names, "other", "left")
                .select("source_system", "source_patient_key", "best_confidence",
                        "candidate_system", "candidate_key"))

    def fuzzy_members(self) -> DataFrame:
        return self.fuzzy_members_for(self.model)

    def labels(self, max_passes: int | None = None) -> DataFrame:
        if max_passes is None:
            return self._once("_labels", lambda: identity.clusters(
                self.links(), self.fuzzy_members(), self.scored()), stored=True)
        return self._once(f"_labels {max_passes}", lambda: identity.clusters_after(
            max_passes, self.spine(), self.members(), self.fuzzy_members(), self.scored(),
            self.spine_rows()), stored=True)

    def walk(self, max_passes: int | None = None) -> DataFrame:
        return self._once(f"_walk {max_passes}", lambda: identity.crosswalk(
            self.spine(), self.labels(max_passes), self.links(), self.fuzzy_members(),
            self.spine_rows(), self.stable_ids), stored=True)

    def rule_pairs(self) -> DataFrame:
        return self._once("_rule_pairs", lambda: rule_plan.rule_pairs(
            self.members(), self.spine_rows() * len(rule_plan.RULES)))

    def named_pairs(self, pairs: DataFrame) -> DataFrame:
        """Replace nid_a / nid_b by system and key of both records."""
        def side(tag):
            return self.spine().select(
                F.col("nid").alias(f"nid_{tag}"),
                F.col("source_system").alias(f"source_system_{tag}"),
                F.col("source_patient_key").alias(f"source_key_{tag}"))
        ends = ["source_system_a", "source_key_a", "source_system_b", "source_key_b"]
        rest = [c for c in pairs.columns if c not in ("nid_a", "nid_b")]
        return pairs.join(side("a"), "nid_a").join(side("b"), "nid_b").select(*ends, *rest)

    def deterministic_match(self) -> DataFrame:
        best = rule_plan.best_rule_pairs(self.rule_pairs())
        rule = F.col("rule")
        return self.named_pairs(best).select(
            "source_system_a", "source_key_a", "source_system_b", "source_key_b",
            rule_plan.rule_confidence(rule).alias("confidence"),
            rule_plan.rule_name(rule).alias("match_method"))

    def probabilistic_match(self, model: Model | None = None) -> DataFrame:
        model = model or self.model
        pairs = self.record_pairs(model)
        return self.named_pairs(pairs).select(
            "source_system_a", "source_key_a", "source_system_b", "source_key_b",
            "confidence", F.lit("probabilistic").alias("match_method"), *fuzzy.COMPONENTS)

    # tables by public name

    def _makers(self) -> dict[str, Callable[[], DataFrame]]:
        c = self.clean
        return {
            "patient_spine": lambda: self.spine().select(*spine_plan.SPINE_COLUMNS),
            "deterministic_match": self.deterministic_match,
            "probabilistic_match": self.probabilistic_match,
            "final_match": lambda: self.walk(self.max_passes).drop("nid"),
            "dim_patient": lambda: identity.survive(self.walk(self.max_passes), self.spine()),
            "patient_source_xref": lambda: identity.source_xref(self.walk(self.max_passes)),
            "dim_date": lambda: dimensions.dim_date(
                self.table("fact_receivable"), self.table("fact_claim_line")),
            "dim_provider": lambda: dimensions.dim_provider(
                c("emr_provider"), c("rcm_claim_header"), c("referral_order")),
            "dim_facility": lambda: dimensions.dim_facility(
                c("emr_encounter"), c("rcm_claim_header"), c("referral_order")),
            "dim_counterparty_org": lambda: dimensions.dim_counterparty_org(c("referral_order")),
            "dim_payer": lambda: dimensions.dim_payer(c("rcm_claim_header")),
            "bridge_patient_counterparty": lambda: dimensions.bridge_patient_counterparty(
                self.table("patient_source_xref"), c("referral_order"),
                self.table("dim_counterparty_org")),
            "bridge_pair": lambda: dimensions.bridge_pair(
                self.table("bridge_patient_counterparty")),
            "fact_receivable": lambda: facts.fact_receivable(
                c("rcm_ar_balance_snapshot"), c("rcm_claim_header"),
                self.table("patient_source_xref"), self.table("dim_payer"),
                self.table("dim_facility")),
            "fact_patient_balance": lambda: facts.fact_patient_balance(
                self.table("fact_receivable")),
            "fact_claim_line": lambda: facts.fact_claim_line(
                c("rcm_claim_line"), c("rcm_claim_header"), self.table("patient_source_xref"),
                self.table("dim_payer"), self.table("dim_facility")),
        }

    @property
    def names(self) -> list[str]:
        return [*SOURCES, *self._makers()]

    def _path(self, name: str) -> str:
        return os.path.join(self.store, "silver" if name in SOURCES else "gold", name)

    def table(self, name: str) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        df = self._cleaned(name) if name in SOURCES else self._makers()[name]()
        if self.store:
            write_table(df, self._path(name), BY_MONTH.get(name) if self.by_month else None)
            df = read_table(self.spark, self._path(name))
        self._tables[name] = df
        return df

    def check(self, checks: list[Check]) -> DataFrame:
        wanted = {c.table for c in checks} | {c.args[0] for c in checks if c.kind == "relationship"}
        return run_checks({t: self.table(t) for t in wanted}, checks)

    def build(self, pairs: bool = False) -> dict[str, str]:
        """Write every table under `store`, in dependency order; returns the paths.

        The tables of all matching pairs, which no other table needs and which
        grow with the square of a group, are written only if `pairs` are asked for.
        """
        if not self.store:
            raise ValueError("a warehouse needs a store folder to build into")
        wanted = [n for n in self.names if pairs or n not in PAIR_TABLES]
        for name in wanted:
            self.table(name)
        return {name: self._path(name) for name in wanted}
