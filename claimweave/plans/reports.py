"""Reports over the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import bitmaps
from ..session import stored
from ..sources.layout import OVERDUE_BUCKETS
from .facts import MONEY_SUM


def _money(column: str) -> Column:
    return F.sum(column).cast(MONEY_SUM)


def _share_pct(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") * 100.0 / whole.cast("double"), 2)


_LATE = ", ".join(f"'{b}'" for b in OVERDUE_BUCKETS)

# Measures that can be asked for at any grain.
METRICS = {
    "ar_balance": f"cast(sum(total_ar_balance) as {MONEY_SUM})",
    "payer_ar": f"cast(sum(payer_balance) as {MONEY_SUM})",
    "patient_ar": f"cast(sum(patient_balance) as {MONEY_SUM})",
    "overdue_ar": f"cast(sum(CASE WHEN aging_bucket IN ({_LATE}) THEN total_ar_balance END)"
                  f" as {MONEY_SUM})",
    "receivable_rows": "count(*)",
    "claims": "count(DISTINCT claim_id)",
    "claims_approx": "approx_count_distinct(claim_id)",
    "total_lines": "count(*)",
    "denied_lines": "sum(cast(is_denied as int))",
    "denial_rate_pct": "round(100.0D * sum(cast(is_denied as int)) / count(*), 2)",
    "charged": f"cast(sum(charge_amount) as {MONEY_SUM})",
    "paid": f"cast(sum(paid_amount) as {MONEY_SUM})",
    "collection_pct": "round(100.0D * cast(sum(paid_amount) as double)"
                      " / cast(sum(charge_amount) as double), 2)",
}


def metrics(fact: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Named measures of a fact table at the grain `by`, in one aggregation."""
    return fact.groupBy(*by).agg(*[F.expr(METRICS[n]).alias(n) for n in names])


def top_counterparties(receivable: DataFrame, bridge: DataFrame, firms: DataFrame,
                       limit: int | None = None) -> DataFrame:
    """Overdue receivables by firm. A balance counts once per bridge row of its patient.

    Both sides are added up per patient before they meet, so the join sees one
    row per patient and claim against one row per patient and firm.
    """
    due = (receivable.filter(F.col("aging_bucket").isin(*OVERDUE_BUCKETS))
           .groupBy("patient_id", "claim_id").agg(_money("total_ar_balance").alias("ar")))
    firm = ["counterparty_org_name", "counterparty_org_type"]
    ties = (bridge.select("patient_id", "counterparty_org_key")
            .join(firms.select("counterparty_org_key", *firm), "counterparty_org_key")
            .groupBy("patient_id", *firm).agg(F.count("*").alias("times")))
    per_claim = (due.join(ties, "patient_id")
                 .groupBy(*firm, "claim_id")
                 .agg(F.sum(F.col("ar").cast("decimal(27,2)") * F.col("times").cast("decimal(10,0)"))
                      .alias("ar")))
    out = (per_claim.groupBy(*firm)
           .agg(F.sum("ar").cast(MONEY_SUM).alias("total_pending_ar"),
                F.count("claim_id").alias("claim_count"))
           .orderBy(F.desc("total_pending_ar"), "counterparty_org_name"))
    return out.limit(limit) if limit else out


def top_balances(balances: DataFrame, patients: DataFrame,
                 limit: int | None = None) -> DataFrame:
    name = F.concat("best_first_name", F.lit(" "), "best_last_name")
    out = (balances.join(patients, "patient_id")
           .select("patient_id", name.alias("patient_name"), "snapshot_date",
                   "total_outstanding", "overdue_amount", "open_claim_count")
           .orderBy(F.desc("total_outstanding"), "patient_id", "snapshot_date"))
    return out.limit(limit) if limit else out


def ar_aging(receivable: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Balances and claims by a dimension's name and aging bucket."""
    return (receivable.groupBy(key, "aging_bucket", "claim_id")
            .agg(F.sum("total_ar_balance").alias("ar"))
            .groupBy(key, "aging_bucket")
            .agg(F.sum("ar").cast(MONEY_SUM).alias("total_ar"), F.count("claim_id").alias("claims"))
            .join(dim.select(key, name), key, "left")
            .select(name, "aging_bucket", "total_ar", "claims")
            .orderBy(F.asc_nulls_last(name), F.asc_nulls_last("aging_bucket")))


def denial_rate(lines: DataFrame, payers: DataFrame) -> DataFrame:
    counted = metrics(lines, ["payer_key"], ["total_lines", "denied_lines", "denial_rate_pct"])
    return (counted.join(payers, "payer_key", "left")
            .select("payer_name", "total_lines", "denied_lines", "denial_rate_pct")
            .orderBy(F.desc("denial_rate_pct"), F.asc_nulls_last("payer_name")))


def denial_by_payer_cpt_facility(lines: DataFrame) -> DataFrame:
    return (metrics(lines, ["payer_key", "cpt_code", "facility_key"],
                    ["total_lines", "denied_lines", "denial_rate_pct"])
            .orderBy(F.desc("denial_rate_pct"), *[F.asc_nulls_last(c) for c in
                                                  ("payer_key", "cpt_code", "facility_key")]))


def bucket_summary(receivable: DataFrame, snapshot_date: str | None = None) -> DataFrame:
    """Rows, sum and average balance per aging bucket, of one day or of all."""
    rows = receivable
    if snapshot_date:
        rows = rows.filter(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
    total = F.sum("total_ar_balance")
    return (rows.groupBy("aging_bucket")
            .agg(F.count("*").alias("receivable_rows"), total.cast(MONEY_SUM).alias("total_ar"),
                 F.round(total.cast("double") / F.count("*"), 2).alias("average_ar")))


def aging_by_counterparty(receivable: DataFrame, pairs: DataFrame,
                          firms: DataFrame) -> DataFrame:
    """Balances by firm and aging bucket; a balance counts for every firm of its patient.

    Balances are added up per patient before they meet the firms.
    """
    per_claim = receivable.groupBy("patient_id", "aging_bucket", "claim_id").agg(
        F.sum("total_ar_balance").alias("ar"), F.count("*").alias("n"))
    per_patient = per_claim.groupBy("patient_id", "aging_bucket").agg(
        F.sum("ar").alias("ar"), F.count("*").alias("claims"), F.sum("n").alias("n"))
    return (per_patient.join(pairs.select("patient_id", "counterparty_org_key"), "patient_id")
            .groupBy("counterparty_org_key", "aging_bucket")
            .agg(F.sum("ar").cast(MONEY_SUM).alias("total_ar"), F.sum("claims").alias("claims"),
                 F.sum("n").alias("receivable_rows"))
            .join(firms.select("counterparty_org_key", "counterparty_org_name"),
                  "counterparty_org_key")
            .select("counterparty_org_key", "counterparty_org_name", "aging_bucket", "total_ar",
                    "claims", "receivable_rows"))


def ar_by_fiscal_period(receivable: DataFrame, dates: DataFrame) -> DataFrame:
    """Receivables by fiscal year, fiscal month and kind of day of their snapshot."""
    period = ["fiscal_year", "fiscal_month", "is_weekend"]
    daily = metrics(receivable, ["snapshot_date"], ["ar_balance", "overdue_ar", "receivable_rows"])
    return (daily.join(dates.select(F.col("date_key").alias("snapshot_date"), *period),
                       "snapshot_date")
            .groupBy(*period).agg(_money("ar_balance").alias("total_ar"),
                                  _money("overdue_ar").alias("overdue_ar"),
                                  F.sum("receivable_rows").alias("receivable_rows")))


def denial_by_fiscal_period(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Denial rate by fiscal year and month of submission."""
    daily = metrics(lines, ["submitted_date"], ["total_lines", "denied_lines"])
    period = ["fiscal_year", "fiscal_month"]
    return (daily.join(dates.select(F.col("date_key").alias("submitted_date"), *period),
                       "submitted_date")
            .groupBy(*period).agg(F.sum("total_lines").alias("total_lines"),
                                  F.sum("denied_lines").alias("denied_lines"))
            .withColumn("denial_rate_pct", _share_pct(F.col("denied_lines"),
                                                      F.col("total_lines"))))


def aging_levels(receivable: DataFrame, pairs: DataFrame, firms: DataFrame) -> DataFrame:
    """Aging by payer, by facility and overall in one pass of grouping sets, and by firm."""
    by_firm = aging_by_counterparty(receivable, pairs, firms).select(
        F.lit("counterparty").alias("level"), F.lit(None).cast("string").alias("payer_key"),
        F.lit(None).cast("string").alias("facility_key"), "counterparty_org_key", "aging_bucket",
        "total_ar", "receivable_rows")
    receivable = receivable.select("payer_key", "facility_key", "aging_bucket", "total_ar_balance")
    level = F.grouping_id("payer_key", "facility_key", "aging_bucket")
    sets = [[F.col("payer_key"), F.col("aging_bucket")],
            [F.col("facility_key"), F.col("aging_bucket")], [F.col("aging_bucket")]]
    # grouping ids of the three sets: a bit is 1 where the column is not grouped
    label = F.when(level == 2, "payer").when(level == 4, "facility").otherwise("all")
    return (receivable.groupingSets(sets, "payer_key", "facility_key", "aging_bucket")
            .agg(label.alias("level"), _money("total_ar_balance").alias("total_ar"),
                 F.count("*").alias("receivable_rows"))
            .select("level", "payer_key", "facility_key",
                    F.lit(None).cast("string").alias("counterparty_org_key"), "aging_bucket",
                    "total_ar", "receivable_rows")
            .unionByName(by_firm))


def turnaround(history: DataFrame) -> DataFrame:
    """Days from first `received` to first `completed`, per order that has both."""
    def first(status):
        return F.min(F.when(F.col("status") == status, F.col("status_time")))
    return (history.groupBy("referral_order_id")
            .agg(first("received").alias("received_at"), first("completed").alias("completed_at"))
            .filter("received_at IS NOT NULL AND completed_at IS NOT NULL")
            .withColumn("turnaround_days", F.datediff("completed_at", "received_at")))


def turnaround_summary(history: DataFrame) -> DataFrame:
    days = F.col("turnaround_days")
    return turnaround(history).agg(
        F.count("*").alias("orders"), F.round(F.avg(days), 4).alias("average_days"),
        F.min(days).alias("fastest_days"), F.max(days).alias("slowest_days"))


def dimension_coverage(receivable: DataFrame) -> DataFrame:
    """Share of receivable rows that carry each dimension key."""
    keys = ("patient_id", "facility_key", "payer_key", "aging_bucket")
    counted = receivable.agg(F.count("*").alias("n"), *[F.count(k).alias(k) for k in keys])
    listed = F.explode(F.array(*[
        F.struct(F.lit(k).alias("dimension"), F.col(k).alias("filled")) for k in keys]))
    return (counted.select("n", listed.alias("e"))
            .select("e.dimension", "e.filled", F.col("n").alias("total"),
                    _share_pct(F.col("e.filled"), F.col("n")).alias("coverage_pct")))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is set but not in the parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


CUBE = ["payer_key", "facility_key", "month"]
CUBE_GRAINS = [CUBE, ["payer_key", "month"], ["facility_key", "month"], ["month"],
               ["payer_key", "facility_key"], ["payer_key"], ["facility_key"], []]


def receivables_cube(receivable: DataFrame) -> DataFrame:
    """Rows, claims, patients and closing balance by payer, facility and month, and by every
    coarser grain.

    Distinct counts come from bitmaps made once. A balance is a level, not a
    flow, so it is not added up over days: the closing balance of a period is
    that of each claim's last snapshot in it, and over all months that of its
    last snapshot of all. `grain` names the columns that count; in them NULL is
    a missing key, elsewhere it is all.
    """
    dated = receivable.withColumn("month", F.date_format("snapshot_date", "yyyy-MM"))
    rows = bitmaps.numbered(bitmaps.numbered(dated, "claim_id", "_claim"), "patient_id", "_patient")
    last = F.max("snapshot_date")
    # one row a claim and month, small beside the facts; hot claims are added up before the shuffle
    in_month = dated.groupBy("claim_id", "month").agg(last.alias("_last_in_month"))
    overall = in_month.groupBy("claim_id").agg(F.max("_last_in_month").alias("_last"))
    kept = stored(rows.join(in_month, ["claim_id", "month"], "left").join(overall, "claim_id", "left"),
                  "cube-rows")
    balance, zero = F.col("total_ar_balance"), F.lit(0).cast("decimal(38,2)")

    def closing(day: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("snapshot_date") == F.col(day), balance)),
                          zero).cast("decimal(38,2)")

    flows = stored(kept.groupBy(*CUBE).agg(
        F.count("*").alias("receivable_rows"), closing("_last_in_month").alias("_by_month"),
        closing("_last").alias("_by_all")), "cube-cells")
    out = None
    for grain in CUBE_GRAINS:
        level = "_by_month" if "month" in grain else "_by_all"
        told = flows.groupBy(*grain).agg(
            F.sum("receivable_rows").cast("long").alias("receivable_rows"),
            F.sum(level).cast("decimal(38,2)").alias("closing_balance"))
        told = told.select(*[F.col(c) if c in grain else F.lit(None).cast("string").alias(c)
                             for c in CUBE], F.lit(",".join(grain)).alias("grain"),
                           "receivable_rows", "closing_balance")
        out = told if out is None else out.unionByName(told)
    for number, name in (("_claim", "claims"), ("_patient", "patients")):
        found = bitmaps.cells(kept.filter(F.col(number).isNotNull()), CUBE, number)
        counted = bitmaps.distinct_by(found, CUBE_GRAINS, CUBE, name)
        same = [out[c].eqNullSafe(counted[c]) for c in (*CUBE, "grain")]
        out = out.join(counted, reduce(Column.__and__, same), "left").select(
            *[out[c] for c in out.columns], F.coalesce(counted[name], F.lit(0)).alias(name))
    return out
