"""Per-chain tumbling-window metrics.

Columns used throughout: ``we`` is the window end in epoch microseconds,
``n_<TYPE>`` the event count of one type. A window is first one wide row,
then expanded to the long form with one row per metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.functions import wei
from blocktide.functions.timebucket import Duration, window_end_us, window_micros

GAS = "decimal(20,0)"
COUNTS = tuple(f"n_{t}" for t in S.EVENT_TYPES)
SUMS = (*COUNTS, "n_events", "gas_used", *wei.PARTS)


def with_window_end(events: DataFrame, size_us: int) -> DataFrame:
    return events.withColumn("we", window_end_us(F.col("block_time"), size_us))


def measures(events: DataFrame, *extra: str) -> DataFrame:
    """Project events to the window key and the addends of every metric."""
    return wei.with_parts(
        events.select(
            *extra,
            "chain",
            "we",
            "type",
            F.nullif(F.col("from_address"), F.lit("")).alias("from_address"),
            F.col("gas_used").cast(GAS).alias("gas_used"),
            "value_wei",
        )
    )


def event_sums() -> list[Column]:
    """Aggregates over ``measures`` rows that add up across any split."""
    return [
        *[F.count_if(F.col("type") == t).alias(n) for t, n in zip(S.EVENT_TYPES, COUNTS)],
        F.count("*").alias("n_events"),
        F.sum("gas_used").alias("gas_used"),
        *wei.sum_parts(),
    ]


def merge_sums() -> list[Column]:
    """The same aggregates, combined from partial rows."""
    return [F.sum(name).alias(name) for name in SUMS]


def wide_metrics(events: DataFrame) -> DataFrame:
    """One row per ``(chain, we)``.

    The distinct sender count is planned as partial aggregation on
    ``(chain, we, sender)`` first, so one busy window spreads over many tasks.
    """
    return (
        measures(events)
        .groupBy("chain", "we")
        .agg(*event_sums(), F.count_distinct("from_address").alias("n_addresses"))
    )


def _entry(metric: str, value: Column, exact: Column, type_name: str = "") -> Column:
    if type_name:
        labels = F.create_map(F.lit("type"), F.lit(type_name))
        key = f"type={type_name}"
    else:
        labels = F.create_map().cast("map<string,string>")
        key = ""
    return F.struct(
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        exact.cast("string").alias("value_exact"),
        labels.alias("labels"),
        F.lit(key).alias("labels_key"),
    )


def long_metrics(wide: DataFrame, size_us: int) -> DataFrame:
    """Rows in the aggregate layout: one per type seen plus four per window."""
    gas = F.coalesce(F.col("gas_used"), F.lit(0).cast("decimal(30,0)"))
    entries = [
        *[
            _entry(S.METRIC_EVENTS, F.col(n), F.col(n), t)
            for t, n in zip(S.EVENT_TYPES, COUNTS)
        ],
        _entry(S.METRIC_EVENTS, F.col("n_events"), F.col("n_events")),
        _entry(S.METRIC_GAS, gas, gas),
        _entry(S.METRIC_WEI, F.col("wei_value"), F.col("wei_exact")),
        _entry(S.METRIC_ADDRESSES, F.col("n_addresses"), F.col("n_addresses")),
    ]
    rows = wei.with_totals(wide).select(
        "chain",
        F.timestamp_micros(F.col("we") - F.lit(size_us)).alias("window_start"),
        F.timestamp_micros(F.col("we")).alias("window_end"),
        F.inline(F.array(*entries)),
    )
    type_not_seen = (F.col("labels_key") != "") & (F.col("value") == 0)
    return rows.filter(~type_not_seen).select(*S.AGGREGATE.names)


def window_metrics(events: DataFrame, size: Duration = S.DEFAULT_WINDOW) -> DataFrame:
    """Metrics of every window of a static table, with no lateness rule."""
    size_us = window_micros(size)
    return long_metrics(wide_metrics(with_window_end(events, size_us)), size_us)


def events_by_type(events: DataFrame, size: Duration = S.DEFAULT_WINDOW) -> DataFrame:
    """Only the event counts: per type and overall."""
    size_us = window_micros(size)
    counts = (
        with_window_end(events, size_us)
        .groupBy("chain", "we")
        .agg(
            *[F.count_if(F.col("type") == t).alias(n) for t, n in zip(S.EVENT_TYPES, COUNTS)],
            F.count("*").alias("n_events"),
        )
    )
    entries = [
        F.struct(F.lit(t).alias("type"), F.col(n).alias("events"))
        for t, n in [*zip(S.EVENT_TYPES, COUNTS), ("", "n_events")]
    ]
    return counts.select(
        "chain",
        F.timestamp_micros(F.col("we") - F.lit(size_us)).alias("window_start"),
        F.timestamp_micros(F.col("we")).alias("window_end"),
        F.inline(F.array(*entries)),
    ).filter(F.col("events") > 0)
