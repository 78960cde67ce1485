"""Every query by name, over a folder of test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.draws import pick
from ..operators.agreement import Model
from ..operators import quality, sketches
from ..operators.forest import spanning_forest
from ..operators.quality import freshness, load_volumes, masked, reconcile
from ..operators.skew import meet
from ..operators.typed import clean
from ..session import checkpoint_dir, discard, stored
from ..sources.delimited import land_folder, landing_log, register_views
from ..sources.layout import SOURCES
from ..sources.lineage import audit_columns
from ..sources.samples import PAYERS, external, landed
from ..sources.sinks import write_csv
from ..streaming import changes as changefeed, volumes
from ..streaming.upsert import current_rows, start_upsert
from . import (checks, clinical, consistency, dimensions, evaluation, fixtures, graph, history,
               identity, incremental, reports, resolve, rules as rule_plan)
from .match_index import MatchIndex
from .spine import numbered
from .warehouse import Warehouse

_BUILT: dict[tuple[str, str], Warehouse] = {}

# Pairs that score at least this much, but too little to be accepted, are worth a look by hand.
REVIEW_FLOOR = "0.65"
REVIEW = Model(threshold=REVIEW_FLOOR, by_names=True)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over `sf_dir`, kept for the life of the Spark application.

    Its tables are written on first use, so reports run over stored tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        store = f"{checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}"
        _BUILT[key] = Warehouse(spark, partial(landed, spark, sf_dir), store)
    return _BUILT[key]


def forget() -> None:
    """Build the tables anew when they are asked for again."""
    _BUILT.clear()


def _table(name: str, drop: tuple[str, ...] = ()):
    return lambda spark, sf: warehouse(spark, sf).table(name).drop(*drop)


def _over(make: Callable[..., DataFrame], *names: str, **options):
    """Query that applies `make` to warehouse tables."""
    def run(spark, sf):
        house = warehouse(spark, sf)
        return make(*[house.table(n) for n in names], **options)
    return run


def _row_hashes(spark, sf):
    parts = [landed(spark, sf, n).select(F.lit(n).alias("table_name"), "_row_hash")
             for n in SOURCES]
    return reduce(DataFrame.unionByName, parts)


def _raw_key_diagnosis(spark, sf):
    return clean(landed(spark, sf, "emr_diagnosis"), SOURCES["emr_diagnosis"],
                 raw_key=True).drop("_silver_loaded_at")


def _one_rule(rank: int):
    def run(spark, sf):
        house = warehouse(spark, sf)
        members = house.members().filter(F.col("rule") == rank)
        pairs = rule_plan.rule_pairs(members, house.spine_rows())
        rule = F.col("rule")
        return house.named_pairs(pairs).select(
            "source_system_a", "source_key_a", "source_system_b", "source_key_b",
            rule_plan.rule_confidence(rule).alias("confidence"),
            rule_plan.rule_name(rule).alias("match_method"))
    return run


def _candidates(spark, sf):
    house = warehouse(spark, sf)
    pairs = house.candidates_for(house.model)
    named = pairs.select(F.col("rep_a").alias("nid_a"), F.col("rep_b").alias("nid_b"))
    return house.named_pairs(named)


def _review_queue(spark, sf):
    return warehouse(spark, sf).probabilistic_match(REVIEW).filter("confidence < 0.70").drop(
        "match_method")


def _edit_distance(spark, sf):
    """Record pairs of the plain blocks that the edit-distance score accepts."""
    house = warehouse(spark, sf)
    return house.named_pairs(house.edit_pairs())


def _review_records(spark, sf):
    return warehouse(spark, sf).review_records(REVIEW)


def _hot_key_pairs(spark, sf):
    """Pairs of orders per customer, with a third of all orders under one customer."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")).alias("k"),
        "o_orderkey")
    left = orders.select("k", F.col("o_orderkey").alias("a"))
    right = orders.select("k", F.col("o_orderkey").alias("b"))
    pairs = meet(left, right, "k", "a", "b", orders.count()).filter("a < b")
    return pairs.groupBy("k").agg(F.count("*").alias("pairs"))


def _evidence(spark, sf):
    house = warehouse(spark, sf)
    scored = house.record_pairs()
    return house.named_pairs(evaluation.match_evidence(house.rule_pairs(), scored))


def _clusters(passes):
    def run(spark, sf):
        house = warehouse(spark, sf)
        return house.walk(passes).select("source_system", "source_patient_key", "cluster_id")
    return run


def _final_match(passes):
    return lambda spark, sf: warehouse(spark, sf).walk(passes).drop("nid")


def _record_level(spark, sf):
    house = warehouse(spark, sf)
    return identity.survive(house.walk(), house.spine(), record_level=True)


def _quality(spark, sf):
    house = warehouse(spark, sf)
    truth = evaluation.sample_truth(house.spine(), landed_orders(spark, sf))
    return evaluation.pairwise_quality(house.walk(), truth)


def _threshold_curve(spark, sf):
    """Quality of the clusters at every threshold from that of the review floor on."""
    house = warehouse(spark, sf)
    truth = evaluation.sample_truth(house.spine(), landed_orders(spark, sf))
    ties = evaluation.weighted_ties(house.links(), house.fuzzy_members_for(REVIEW),
                                    house.scored_for(REVIEW))
    return evaluation.threshold_curve(spanning_forest(ties), truth)


def landed_orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey")


def _checks(declared):
    return lambda spark, sf: warehouse(spark, sf).check(declared)


def _load_quality(spark, sf):
    return reduce(DataFrame.unionByName, [
        quality.load_quality(landed(spark, sf, n), s.columns) for n, s in SOURCES.items()])


DIMENSION_MEMBERS = {
    "provider": ("emr_provider", "emr_provider_id"), "payer": ("rcm_claim_header", "payer_name"),
    "facility": ("emr_encounter", "facility_id"), "patient": ("emr_patient", "emr_patient_id"),
    "counterparty": ("referral_order", "counterparty_org_name")}


def _cardinality(spark, sf):
    members = reduce(DataFrame.unionByName, [
        landed(spark, sf, table).select(
            F.lit(name).alias("dimension"), F.col(column).alias("member"),
            F.col("_ingested_at").cast("date").alias("load_day"))
        for name, (table, column) in DIMENSION_MEMBERS.items()])
    return quality.cardinality(members, tolerance=0.5)


# every column of every feed that names a member of a dimension
ALL_MEMBERS = {
    "provider": (("emr_provider", "npi"), ("rcm_claim_header", "billing_provider_npi"),
                 ("rcm_claim_header", "rendering_provider_npi"),
                 ("referral_order", "referring_provider_npi")),
    "facility": (("emr_encounter", "facility_id"), ("rcm_claim_header", "facility_id"),
                 ("referral_order", "receiving_facility_id")),
    "payer": (("rcm_claim_header", "payer_name"),),
    "patient": (("emr_patient", "emr_patient_id"), ("rcm_patient_account", "rcm_account_id"),
                ("referral_order", "referral_order_id")),
    "counterparty": (("referral_order", "counterparty_org_name"),)}


def _cardinality_sketch(spark, sf):
    """One stored table of sketches, added to by load day, then spikes from the sketches alone."""
    members = reduce(DataFrame.unionByName, [
        landed(spark, sf, table).select(
            F.lit(name).alias("dimension"), F.col(column).alias("member"),
            F.col("_ingested_at").cast("date").alias("load_day"))
        for name, columns in ALL_MEMBERS.items() for table, column in columns])
    return sketches.growth_by_load(stored(sketches.load_sketches(members), "sketches"),
                                   tolerance=0.5)


def _fact_volumes(spark, sf):
    house = warehouse(spark, sf)
    return quality.fact_volumes({
        "fact_receivable": (house.table("fact_receivable"), "snapshot_date"),
        "fact_patient_balance": (house.table("fact_patient_balance"), "snapshot_date"),
        "fact_claim_line": (house.table("fact_claim_line"), "submitted_date")}, tolerance=0.2)


def _reconcile_balances(spark, sf):
    house = warehouse(spark, sf)
    return reconcile(house.table("fact_patient_balance"),
                     house.table("fact_receivable").filter("patient_id IS NOT NULL"), {
                         "outstanding": ("total_outstanding", "total_ar_balance"),
                         "payer": ("total_payer_balance", "payer_balance"),
                         "patient": ("total_patient_balance", "patient_balance")})


def _orphans(spark, sf):
    house = warehouse(spark, sf)
    lines = reports.orphans(house.clean("rcm_claim_line"), house.clean("rcm_claim_header"),
                            "claim_id")
    visits = reports.orphans(house.clean("emr_encounter"), house.clean("emr_patient"),
                             "emr_patient_id")
    facts = reports.orphans(house.table("fact_receivable"), house.table("dim_patient"),
                            "patient_id")
    named = [("claim_line_to_header", lines), ("encounter_to_patient", visits),
             ("receivable_to_patient", facts)]
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(n).alias("reference"), F.count("*").alias("orphan_rows")) for n, df in named])


def _reconcile(fact, source, pairs):
    return _over(partial(reconcile, pairs=pairs), fact, source)


def _masked(spark, sf):
    key = spark.conf.get(quality.MASKING_KEY_SETTING, quality.TEST_KEY)
    return masked(warehouse(spark, sf).clean("emr_patient"), ["ssn_last4"], ["phone"], key).select(
        "emr_patient_id", "ssn_last4", "phone")


def _audit(spark, sf):
    source = SOURCES["rcm_remittance_835"]
    rows = landed(spark, sf, source.name)
    return audit_columns(rows, list(source.key), "batch-1").select(
        "remit_id", "source_record_id", "batch_id", "payload_json")


PAYER_NAMES = PAYERS.split(",")
LOADED_AT = "2024-01-15 08:00:00"


def _volumes(spark, sf):
    return load_volumes([landed(spark, sf, n) for n in SOURCES], tolerance=0.5)


def _freshness(spark, sf):
    return freshness([landed(spark, sf, n) for n in SOURCES], "2024-06-10", max_days=7)


def _loaded(house) -> DataFrame:
    """Keys of the patient records with the time they were loaded."""
    return house.clean("emr_patient").select(
        F.lit("emr").alias("source_system"), F.col("emr_patient_id").alias("source_patient_key"),
        "_ingested_at").unionByName(house.clean("rcm_patient_account").select(
            F.lit("rcm"), "rcm_account_id", "_ingested_at").toDF(
                "source_system", "source_patient_key", "_ingested_at")).unionByName(
        house.clean("referral_order").select(
            F.lit("referral"), "referral_order_id", "_ingested_at").toDF(
                "source_system", "source_patient_key", "_ingested_at"))


def _last_day(house) -> DataFrame:
    """Keys of the patient records of the last load day."""
    return _loaded(house).filter("_ingested_at >= timestamp_ntz'2024-06-03 00:00:00'")


def _history(house) -> DataFrame:
    days = _loaded(house).select(*incremental.KEY, F.to_date("_ingested_at").alias("load_day"))
    return house.once("xref history", lambda: history.over_days(house.spine(), days))


def _receivable_as_of(spark, sf):
    """Receivables with the patient as known on the day they were loaded, and as known last."""
    house = warehouse(spark, sf)
    versions = _history(house)
    rows = house.clean("rcm_ar_balance_snapshot").select(
        "claim_id", "rcm_account_id", "snapshot_date", "payer_responsibility_balance",
        "patient_responsibility_balance", F.to_date("_ingested_at").alias("known_on"))
    key = {"source_system": F.lit("rcm"), "source_patient_key": F.col("rcm_account_id")}
    told = history.as_of(rows, versions, key, "known_on", ("patient_id", "match_method"))
    last = versions.filter("effective_to IS NULL AND source_system = 'rcm'").select(
        F.col("source_patient_key").alias("rcm_account_id"),
        F.col("patient_id").alias("patient_id_now"))
    return told.join(last, "rcm_account_id", "left")


def _after(earlier_spine, spine) -> DataFrame:
    index = MatchIndex(spine.sparkSession)
    earlier = stored(incremental.rematch(earlier_spine, None, index=index), "earlier-match")
    return incremental.rematch(spine, earlier, index=index).select(
        "source_system", "source_patient_key", "cluster_id", "match_confidence", "match_method",
        "patient_id")


def _incremental(spark, sf):
    """All but the last load day matched first, the rest added to it."""
    house = warehouse(spark, sf)
    before = house.spine().join(_last_day(house), ["source_system", "source_patient_key"],
                                "left_anti")
    return _after(before, house.spine())


def _incremental_changed(spark, sf):
    """The last load day's records matched first with the phone and zip of others, then as they are."""
    house = warehouse(spark, sf)
    marked = house.spine().join(_last_day(house).withColumn("_late", F.lit(True)).drop(
        "_ingested_at"), ["source_system", "source_patient_key"], "left")
    late = F.col("_late").isNotNull()
    before = marked.withColumns({
        "phone": F.when(late, F.lit("4150000000")).otherwise(F.col("phone")),
        "mrn": F.when(late, F.concat(F.lit("SHARED"), F.right("mrn", F.lit(1))))
        .otherwise(F.col("mrn")),
        "last_name": F.when(late, F.upper("first_name")).otherwise(F.col("last_name"))}).drop("_late")
    return _after(before.select(house.spine().columns), house.spine())


def _incremental_withdrawn(spark, sf):
    """Matched first with a second copy of the last load day's records, which is then withdrawn.

    The copies come first in order, so they name clusters and tie others together.
    """
    house = warehouse(spark, sf)
    spine = house.spine()
    copies = spine.join(_last_day(house), ["source_system", "source_patient_key"],
                        "left_semi").withColumns({
        "source_patient_key": F.concat(F.lit("0"), "source_patient_key"),
        "mrn": F.concat(F.lit("SHARED"), F.right("mrn", F.lit(1)))})
    before = numbered(spine.drop("nid", "node").unionByName(copies.drop("nid", "node")))
    return _after(before.select(spine.columns), spine)


def _csv_round_trip(spark, sf):
    """Every source written as CSV with other columns, landed again, one row hash per row."""
    base = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    for name, source in SOURCES.items():
        rows = landed(spark, sf, name)
        # last column first, one column missing, one too many
        shuffled = [source.columns[-1], *source.columns[:-1]]
        missing = _missing_column(source)
        write_csv(rows.select(*[c for c in shuffled if c != missing],
                              F.lit("surplus").alias("not_declared")),
                  f"{base}/feeds/{source.system}/{source.file}")
        # a feed goes once it is landed: one at a time lies beside the landed tables
        land_folder(spark, f"{base}/feeds", f"{base}/landed", "batch-1", [source])
        discard(spark, f"{base}/feeds")
    views = register_views(spark, f"{base}/landed")
    return reduce(DataFrame.unionByName, [
        spark.table(view).select(
            F.lit(name).alias("table_name"),
            F.md5(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("nan"))
                                     for c in SOURCES[name].columns])).alias("values_hash"))
        for name, view in zip(SOURCES, views)])


# feeds that the tolerant load meets in a bad state
BAD_FEEDS = {"emr_provider": "missing", "emr_procedure": "empty", "rcm_remittance_835": "failed"}


def _load_log(spark, sf):
    """Log of a load of all feeds, of which one is missing, one empty and one unreadable."""
    base = f"{checkpoint_dir(spark)}/load-{uuid.uuid4().hex}"
    for name, source in SOURCES.items():
        rows = landed(spark, sf, name).select(*source.columns)
        path, state = f"{base}/feeds/{source.system}/{source.file}", BAD_FEEDS.get(name)
        if state == "failed":
            # two layouts in one folder, as after a half-finished change
            for column in source.columns[:2]:
                (rows.limit(1).withColumn(f"_by_{column}", F.lit("1")).write.mode("append")
                 .partitionBy(f"_by_{column}").option("header", True).csv(path))
        elif state != "missing":
            write_csv(rows if state is None else rows.filter(F.lit(False)), path)
    log = land_folder(spark, f"{base}/feeds", f"{base}/landed", "batch-1")
    return landing_log(spark, log).select("table_name", "source_file", "row_count", "status")


def _missing_column(source) -> str:
    """The column that the round trip leaves out: the last but one that is no key."""
    return [c for c in source.columns if c not in source.key][-1]


def _stream_merged(spark, sf):
    """Claims written as CSV in three batches, the later ones with earlier rows again, as a stream."""
    source = SOURCES["rcm_claim_header"]
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = landed(spark, sf, source.name).select(*source.columns)
    share = F.pmod(F.xxhash64("claim_id"), F.lit(9))
    for wanted in ((0, 1, 2), (0, 3, 4, 5), (1, 3, 6, 7, 8)):
        write_csv(rows.filter(share.isin(*wanted)), f"{base}/feed", mode="append")
        start_upsert(spark, f"{base}/feed", f"{base}/table", f"{base}/progress", source.name,
                     once=True).awaitTermination()
    return current_rows(spark, f"{base}/table", source.name).select(*source.columns)


LATE_BY_HOURS = 12
ARRIVALS = 4


def _arrival() -> Column:
    """Batch in which an event arrives: by its time, every seventh one batch late, every
    eleventh two."""
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    due = F.floor((at - F.col("_first")) * ARRIVALS / (F.col("_last") - F.col("_first") + 1))
    late = F.when(F.col("event_id") % 11 == 0, 2).when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    return F.least(due + late, F.lit(ARRIVALS - 1)).cast("int")


def _stream_volumes(spark, sf):
    """Events per type and hour as a stream of four batches, of which late rows are dropped."""
    base = f"{checkpoint_dir(spark)}/volumes-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    first, last = rows.agg(F.min(F.unix_timestamp("ts")), F.max(F.unix_timestamp("ts"))).first()
    dealt = rows.withColumns({"_first": F.lit(first), "_last": F.lit(last)}).withColumn(
        "_batch", _arrival()).drop("_first", "_last")
    for batch in range(ARRIVALS):
        # one file a batch, as the stream takes a file at a time
        dealt.filter(F.col("_batch") == batch).drop("_batch").coalesce(1).write.mode(
            "append").parquet(f"{base}/feed")
        volumes.start_volumes(spark, f"{base}/feed", rows.schema, f"{base}/windows",
                              f"{base}/progress", "event_type", "ts", f"{LATE_BY_HOURS} hours",
                              once=True, files_per_batch=1).awaitTermination()
    return spark.read.parquet(f"{base}/windows").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "first_seen", "last_seen")})


def _stream_changes(spark, sf):
    """Claims as a change feed in three batches: new ones, then changes and deletions, then some
    that come back and old changes that come late."""
    base = f"{checkpoint_dir(spark)}/changes-{uuid.uuid4().hex}"
    k = F.substring("claim_id", 2, 20).cast("long")
    claims = warehouse(spark, sf).clean("rcm_claim_header").select(
        "claim_id", "payer_name", "claim_status", "total_charge_amount")

    def changes(rows, seq, op="upsert", **columns):
        return rows.withColumns({c: F.lit(v) for c, v in columns.items()}).withColumns(
            {changefeed.OPERATION: F.lit(op), changefeed.SEQUENCE: F.lit(seq).cast("long")})

    batches = [
        changes(claims, 1),
        changes(claims.filter(k % 4 == 0), 3, claim_status="appealed").unionByName(
            changes(claims.filter(k % 5 == 0), 4, changefeed.DELETE)),
        changes(claims.filter(k % 10 == 0), 5, claim_status="reopened").unionByName(
            changes(claims.filter(k % 3 == 0), 2, claim_status="late"))]
    schema = batches[0].schema
    for batch in batches:
        batch.write.mode("append").parquet(f"{base}/feed")
        changefeed.start_changes(spark, f"{base}/feed", schema, f"{base}/table", f"{base}/progress",
                                 ["claim_id"], once=True).awaitTermination()
    return changefeed.current(spark, f"{base}/table", schema, ["claim_id"])


def _filled(spark, sf):
    rules = {"payer_name": pick("claim_id", "payer", PAYER_NAMES),
             "claim_status": F.lit("submitted")}
    headers = warehouse(spark, sf).clean("rcm_claim_header")
    return fixtures.fill_missing(headers.select("claim_id", "payer_name", "claim_status"), rules)


def _external_patients(spark, sf):
    return clinical.patients(external(spark, sf, "patients"), LOADED_AT)


def _external_head(spark, sf):
    return clinical.patients(external(spark, sf, "patients"), LOADED_AT, limit=100)


def _external_providers(spark, sf):
    return clinical.providers(external(spark, sf, "providers"),
                              external(spark, sf, "organizations"))


def _external_of(make, table):
    def run(spark, sf):
        return make(external(spark, sf, table), _external_patients(spark, sf))
    return run


def _external_procedures(spark, sf):
    mapping = clinical.procedure_map(external(spark, sf, "crosswalk"), "line")
    return clinical.procedures(external(spark, sf, "procedures"), _external_patients(spark, sf),
                               mapping)


def _registry_providers(spark, sf):
    house = warehouse(spark, sf)
    return dimensions.dim_provider(
        house.clean("emr_provider"), house.clean("rcm_claim_header"),
        house.clean("referral_order"), external(spark, sf, "registry"))


def _resolved(spark, sf):
    house = warehouse(spark, sf)
    return house, *house.once("resolved", lambda: resolve.resolved(resolve.mentions(
        house.table("dim_provider"), house.table("referral_order"),
        external(spark, sf, "providers"))))


def _resolved_entities(spark, sf):
    _, named, evidence = _resolved(spark, sf)
    return resolve.entities(named, evidence)


def _resolved_edges(spark, sf):
    house, named, _ = _resolved(spark, sf)
    return resolve.edges(named, graph.links(*[house.table(n) for n in (
        "dim_provider", "referral_order", "rcm_claim_header")]))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {"bronze_row_hash": _row_hashes, "bronze_audit_columns": _audit}
    out |= {f"silver_{n}": _table(n, ("_silver_loaded_at",)) for n in SOURCES}
    out["silver_emr_diagnosis_raw_key"] = _raw_key_diagnosis
    out["er_spine"] = _table("patient_spine")
    out |= {f"er_rule_{r.name.removeprefix('deterministic_')}": _one_rule(i)
            for i, r in enumerate(rule_plan.RULES)}
    out |= {
        "er_deterministic": _table("deterministic_match"),
        "er_candidates_pruned": _candidates,
        "er_probabilistic": _table("probabilistic_match"),
        "er_review_queue": _review_queue,
        "er_levenshtein_score": _edit_distance,
        "er_match_evidence": _evidence,
        "er_clusters": _clusters(None),
        "er_clusters_4pass": _clusters(4),
        "er_crosswalk": _final_match(None),
        "er_crosswalk_4pass": _final_match(4),
        "er_match_quality": _quality,
        "er_threshold_curve": _threshold_curve,
        "gold_patient_source_xref": _table("patient_source_xref",
                                           ("effective_from", "effective_to")),
        "gold_dim_patient": _table("dim_patient"),
        "gold_dim_patient_record_level": _record_level,
    }
    out |= {n: _table(n) for n in (
        "dim_date", "dim_provider", "dim_facility", "dim_counterparty_org", "dim_payer",
        "bridge_patient_counterparty", "bridge_pair", "fact_receivable", "fact_patient_balance",
        "fact_claim_line")}
    receivable, lines = "fact_receivable", "fact_claim_line"
    out |= {
        "bi_top_counterparties": _over(reports.top_counterparties, receivable,
                                       "bridge_patient_counterparty", "dim_counterparty_org"),
        "bi_top_counterparties_once": _over(reports.top_counterparties, receivable,
                                            "bridge_pair", "dim_counterparty_org"),
        "bi_top_balances": _over(reports.top_balances, "fact_patient_balance", "dim_patient"),
        "bi_top20_balances": _over(reports.top_balances, "fact_patient_balance", "dim_patient",
                                   limit=20),
        "bi_ar_aging_payer": _over(reports.ar_aging, receivable, "dim_payer",
                                   key="payer_key", name="payer_name"),
        "bi_ar_aging_facility": _over(reports.ar_aging, receivable, "dim_facility",
                                      key="facility_key", name="facility_name"),
        "bi_denial_rate_payer": _over(reports.denial_rate, lines, "dim_payer"),
        "bi_denial_payer_cpt_facility": _over(reports.denial_by_payer_cpt_facility, lines),
        "bi_bucket_summary": _over(reports.bucket_summary, receivable),
        "bi_aging_levels": _over(reports.aging_levels, receivable, "bridge_pair", "dim_counterparty_org"),
        "bi_turnaround": _over(reports.turnaround, "referral_order_status_history"),
        "bi_turnaround_summary": _over(reports.turnaround_summary,
                                       "referral_order_status_history"),
        "bi_metrics_by_facility_month": lambda spark, sf: reports.metrics(
            warehouse(spark, sf).table(receivable).withColumn(
                "snapshot_month", F.date_format("snapshot_date", "yyyy-MM")),
            ["facility_key", "snapshot_month"],
            ["ar_balance", "payer_ar", "patient_ar", "overdue_ar", "receivable_rows", "claims"]),
        "bi_metrics_by_cpt": _over(reports.metrics, lines, by=["cpt_code"], names=[
            "total_lines", "denied_lines", "denial_rate_pct", "charged", "paid",
            "collection_pct"]),
        "er_incremental": _incremental,
        "er_incremental_changed": _incremental_changed,
        "er_incremental_withdrawn": _incremental_withdrawn,
        "gold_xref_history": lambda spark, sf: _history(warehouse(spark, sf)),
        "fact_receivable_as_of": _receivable_as_of,
        "er_hot_key_pairs": _hot_key_pairs,
        "er_review_records": _review_records,
        "bronze_csv_round_trip": _csv_round_trip,
        "stream_merged_claims": _stream_merged,
        "bronze_load_log": _load_log,
        "stream_volumes": _stream_volumes,
        "stream_changes": _stream_changes,
        "bi_ar_by_fiscal_period": _over(reports.ar_by_fiscal_period, receivable, "dim_date"),
        "bi_denial_by_fiscal_period": _over(reports.denial_by_fiscal_period, lines, "dim_date"),
        "bi_ar_aging_counterparty": _over(reports.aging_by_counterparty, receivable,
                                          "bridge_pair", "dim_counterparty_org"),
        "dq_cardinality": _cardinality,
        "dq_cardinality_sketch": _cardinality_sketch,
        "bi_metrics_cube": _over(reports.receivables_cube, receivable),
        "dq_fact_volumes": _fact_volumes,
        "dq_reconcile_claim_line": _reconcile(lines, "rcm_claim_line", {
            c: (f"{c}_amount", f"{c}_amount") for c in ("charge", "allowed", "paid")}),
        "dq_reconcile_patient_balance": _reconcile_balances,
        "external_patients_head": _external_head,
        "dim_provider_registry": _registry_providers,
        "graph_entities": _over(graph.entities, "dim_provider", "referral_order"),
        "graph_identifiers": _over(graph.identifiers, "dim_provider", "referral_order"),
        "graph_edges": _over(graph.edges, "dim_provider", "referral_order", "rcm_claim_header"),
        "graph_resolved_entities": _resolved_entities,
        "graph_resolved_edges": _resolved_edges,
        "fixture_accounts": _over(consistency.account_drift, "rcm_patient_account",
                                  "emr_patient"),
        "fixture_money_lines": _over(consistency.money_by_claim, "rcm_claim_line"),
        "fixture_balances": _over(consistency.balances_by_claim, "rcm_ar_balance_snapshot"),
        "fixture_status_history": _over(consistency.status_steps,
                                        "referral_order_status_history"),
        "fixture_assigned_accounts": _over(consistency.account_of_claims, "rcm_claim_header",
                                           "rcm_patient_account"),
        "fixture_claims_of_encounters": _over(consistency.claims_by_encounter, "emr_encounter",
                                              "rcm_patient_account", "rcm_claim_header"),
        "fixture_filled_headers": _filled,
        "external_patients": _external_patients,
        "external_providers": _external_providers,
        "external_encounters": _external_of(clinical.encounters, "encounters"),
        "external_diagnoses": _external_of(clinical.diagnoses, "conditions"),
        "external_procedures": _external_procedures,
        "dq_load_volumes": _volumes,
        "dq_freshness": _freshness,
        "dq_dimension_coverage": _over(reports.dimension_coverage, receivable),
        "dq_orphans": _orphans,
        "dq_load_quality": _load_quality,
        "dq_reconcile_receivable": _reconcile(receivable, "rcm_ar_balance_snapshot", {
            "payer": ("payer_balance", "payer_responsibility_balance"),
            "patient": ("patient_balance", "patient_responsibility_balance")}),
        "dq_masked_patient": _masked,
        "dq_checks_clean": _checks(checks.CLEAN_CHECKS),
        "dq_checks_linkage": _checks(checks.LINKAGE_CHECKS),
        "dq_checks_star": _checks(checks.STAR_CHECKS),
    }
    return out
