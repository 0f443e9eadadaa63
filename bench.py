"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Every query runs to completion into Spark's no-op sink, twice:
``queries`` holds the faster run, ``first_run`` the first, which also pays for
code generation. The table builds run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.bindings.queries import QUERIES  # noqa: E402
from tidemark.bindings.training_log import warehouse  # noqa: E402
from tidemark.plans.warehouse import TABLES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "daily_load_ratio_events", "clean_sets", "session_summary", "clean_measurements", "interpolate_daily",
    "daily_load_ratio", "category_week", "week_balance", "progression", "progression_single_log",
    "q_fatigue", "q_volume", "q_balance", "q_strength", "q_pr", "q_sessions", "q_raw_sets",
    "dedup_exact", "set_occurrence", "set_occurrence_sliced", "typed_parse", "range_lookup", "dim_lookup_ci",
    "calendar_windows", "complete_grid", "nested_flatten", "load_csv", "load_jsonl", "upsert_incremental",
    "upsert_partitions", "refresh_sets", "stream_ingest", "text_fingerprint", "route_questions",
    "dialog_context", "dialog_recent_messages", "knn_topk", "dq_suite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.log.level": "ERROR",
        },
    )
    only = sys.argv[1:] or HEADLINE
    # Start-up of the JVM and of the code generator is not part of any query.
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    timings: dict[str, float] = {}
    started = time.perf_counter()
    wh = warehouse(spark, sf_dir)
    timings["build_bronze"] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    for layer, name in TABLES:
        wh.table(layer, name)
    timings["build_silver_gold"] = round(time.perf_counter() - started, 3)
    first_run: dict[str, float] = {}
    for name in only:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - started, 3))
        first_run[name], timings[name] = runs[0], min(runs)
    line = {
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "first_run": first_run,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
