"""Time the headline queries; prints one JSON line.

Stages are timed in dependency order in one session, as the tables would be
built: the linkage stages store what later ones reuse, so each figure is what
that stage adds and the total is the time for the whole chain. `warm` has the
same stages once more, with all tables built anew in the warm session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

STAGES = (
    "silver_emr_diagnosis", "silver_rcm_claim_header", "silver_rcm_claim_line",
    "silver_rcm_ar_balance_snapshot", "er_spine", "er_deterministic", "er_candidates_pruned",
    "er_probabilistic", "er_clusters", "er_crosswalk", "gold_dim_patient", "dim_provider",
    "dim_facility", "dim_counterparty_org", "dim_payer", "fact_receivable",
    "fact_patient_balance", "fact_claim_line", "bi_top_counterparties", "bi_top_balances",
    "bi_ar_aging_payer", "bi_denial_rate_payer", "dq_checks_star",
)


def main() -> None:
    from claimweave.plans.queries import all_queries, forget
    from claimweave.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    queries = all_queries()

    def timed() -> dict[str, float]:
        seconds = {}
        for name in STAGES:
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        forget()
        return seconds

    cold, warm = timed(), timed()
    print(json.dumps({"metric": "linkage_and_star_total", "value": round(sum(cold.values()), 3),
                      "unit": "sec", "queries": cold, "warm": warm,
                      "warm_total": round(sum(warm.values()), 3),
                      "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
