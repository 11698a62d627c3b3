"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
Results are written to Spark's ``noop`` sink, so all rows are computed and none
is collected.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from strata.plans.queries import QUERIES

try:
    from strata.llm.queries import QUERIES as LLM_QUERIES
except ImportError:
    LLM_QUERIES = {}

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# Stored-table and whole-load queries write their tables anew on every run.
HEADLINE = (
    "silver",
    "latest_quotes",
    "daily_metrics",
    "official_gap",
    "newer_than",
    "high_water",
    "upsert_quotes",
    "split_and_validate",
    "valid_records",
    "bronze_projection",
    "latest_order_per_customer",
    "order_upsert",
    "monthly_lineitem_metrics",
    "partitioned_round_trip",
    "full_refresh",
    "incremental_refresh",
    "merge_duplicate_keys",
    "many_months_rebuild",
    "stream_repeated_snapshots",
    "merge_changed_only",
    "evolving_merge",
    "bucketed_merge",
    "newer_than_with_ties",
)

# These run once, unwarmed: whole loads of several runs.
ONCE = ("incremental_new_files", "quarantined_records", "stream_unchanged_poll")

# These pass over whole texts, some of them after training; each runs once, unwarmed.
LLM_HEADLINE = (
    "op1_exact_dedup",
    "op2_secrets",
    "op3_chat_formatting",
    "op4_toxicity",
    "op5_length_packing",
    "op6_warc",
    "op7_substring_dedup",
    "op8_minhash",
    "op9_mixing",
    "op10_simhash",
    "op11_conversation_repair",
    "op12_quality_rules",
    "op13_hard_negatives",
)


def main() -> None:
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(query) -> float:
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:
        times = [timed(QUERIES[name]) for _ in range(RUNS + 1)]
        seconds[name] = round(statistics.median(times[1:]), 3)
    for name in ONCE:
        seconds[name] = round(timed(QUERIES[name]), 3)
    for name in LLM_HEADLINE:
        if name in LLM_QUERIES:
            seconds[name] = round(timed(LLM_QUERIES[name]), 3)
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
