"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

`pipeline_build` is the whole job from the driver's tables to published marts
in a fresh folder, nothing reused. `identity_graph_build` is edges and graph in
a fresh folder. Every other entry is one registered query, its result written
to the no-op sink; those that read marts read the ones published once before.
Each figure is the median of $BENCH_RUNS runs (default 3) after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wayfare.plans.catalog import PARAMS, registered, warehouse
from wayfare.plans.warehouse import Warehouse
from wayfare.session import build_session
from wayfare.sources.testbed import load_bronze

HEADLINE = [
    "identity_edges",
    "identity_graph",
    "identity_kpass",
    "sessions_stitched",
    "fct_sessions",
    "fct_funnel_steps",
    "all_touches",
    "touchpoints_enriched",
    "attribution_ranked",
    "touchpoints_attribution",
    "attribution_time_decay",
    "attribution_pivot",
    "fct_conversions",
    "dim_users",
    "dim_users_scd2",
    "facts_asof_user",
    "kpi_overview",
    "attribution_by_channel",
    "attribution_delta",
    "weekly_cohort",
    "top_metrics",
    "unification_per_source",
    "consent_registry",
    "attribution_panel",
    "gdpr_breakdown",
    "pipeline_health",
    "system_signals",
    "source_freshness",
    "quality_scan",
    "forget_resolve",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def median(job) -> float:
        job()
        seconds = []
        for _ in range(runs):
            started = time.perf_counter()
            job()
            seconds.append(time.perf_counter() - started)
        return round(statistics.median(seconds), 3)

    def fresh() -> Warehouse:
        return Warehouse(spark, load_bronze(spark, sf_dir), PARAMS)

    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    if not sys.argv[1:]:
        seconds["pipeline_build"] = median(lambda: fresh().publish_marts())
        seconds["identity_graph_build"] = median(lambda: fresh().table("identity_graph"))
    w = warehouse(spark, sf_dir)
    w.publish_marts()
    queries = registered()
    for name in chosen:
        seconds[name] = median(
            lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
