"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from blocktide import schemas as S
from blocktide.plans.queries import QUERIES, RANGE, replay
from blocktide.session import new_work_dir
from blocktide.sinks.aggregates_table import (
    query_aggregates,
    read_table,
    recent_aggregates,
    upsert_aggregates,
)

HEADLINE = [
    "validate_rejects_by_reason",
    "normalized_events",
    "dedup_first_seen",
    "window_metrics_long",
    "replay_late_flags",
    "replay_closed_metrics",
    "replay_flush_metrics",
    "upsert_latest",
    "aggregates_range",
    "pipeline_totals",
    "ingest_rate",
    "freshness_quantiles",
    "group_lag",
    "decode_chain_blocks",
    "stream_exact_metrics",
    "stream_native_metrics",
    "stream_normalized",
]


def drain(df: DataFrame) -> None:
    """Compute every row and column without bringing them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def time_reads(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Reads of a stored table alone, without the work that fills it."""
    table = new_work_dir(spark, "bench-aggregates")
    upsert_aggregates(replay(spark, sf_dir).metrics(flush=True), table)
    reads = {
        "range_read_only": lambda: query_aggregates(
            read_table(spark, table), "ethereum", S.METRIC_EVENTS, *RANGE
        ),
        "recent_read_only": lambda: recent_aggregates(read_table(spark, table)),
        "stored_totals_only": lambda: read_table(spark, table).groupBy("metric").count(),
    }
    seconds = {}
    for name, read in reads.items():
        drain(read())  # lists the table's files once
        start = time.perf_counter()
        drain(read())
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Skips call-site capture for every column expression built in Python.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    for name in ("validate_rejects_by_reason", "replay_closed_metrics"):  # warm the JVM
        drain(QUERIES[name](spark, sf_dir))
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        drain(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    if len(sys.argv) == 1:
        seconds |= time_reads(spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": events,
                "events_per_sec": {n: round(events / s) for n, s in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
