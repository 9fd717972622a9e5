"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from strataflow.functions import session
from strataflow.plans import catalogue

HEADLINE = [
    "rig_summary", "daily_activity", "report_variables", "top_wells", "worst_variables", "day_detail", "activity_calendar", "latest_per_key", "invalid_pairs_not_in", "interval_nearest_event", "provenance_join",
    "curve_stats", "curve_gradient_peaks", "curve_moving_var", "curve_outliers", "fuzzy_match", "well_match", "coverage_report", "mention_candidates", "fragments", "lexicon_mentions", "conflict_sets", "fact_versions", "graph_bfs", "canonical_urls", "html_structure",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session.local("bench", cpus=int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalogue.queries(), {}
    queries["latest_snapshot"](spark, sf_dir).collect()  # the session's own start isn't a query's time
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
