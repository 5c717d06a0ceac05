"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Each
query runs to completion into Spark's no-op sink, after one small query has
started the session. With BENCH_REPEAT the best of several runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.queries import QUERIES  # noqa: E402
from riskweave.session import get_spark  # noqa: E402

HEADLINE = (
    "dim_customer",
    "fact_transaction",
    "fact_login_attempt",
    "v_transaction",
    "v_login_attempt",
    "asof_last_login",
    "failed_logins_24h",
    "enriched_transactions",
    "amount_zscore",
    "rule_scores",
    "rule_alerts",
    "top_risky_customers",
    "stratified_split",
    "model_alerts",
    "dq_not_null",
    "dq_unique",
    "scoring_sample",
    "rule_scores_hot",
    "incremental_alerts",
    "stream_failed_logins",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark("riskweave-bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["source_counts"](spark, folder).collect()

    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
