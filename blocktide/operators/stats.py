"""Pipeline counters and rates derived from the event and aggregate tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide.functions.timebucket import Duration, micros, time_bucket
from blocktide.operators.validate import with_reject_reason
from blocktide.session import materialize


def _per_second(count: Column, interval: Duration) -> Column:
    return count / F.lit(micros(interval) / 1_000_000)


def ingest_rate(events: DataFrame, interval: Duration = "1 minute") -> DataFrame:
    """Events per second by arrival interval, chain and type."""
    bucket = time_bucket(F.col("observed_at"), interval).alias("bucket")
    return (
        events.groupBy(bucket, "chain", "type")
        .agg(F.count("*").alias("events"))
        .withColumn("per_second", _per_second(F.col("events"), interval))
    )


def reject_counts(events: DataFrame) -> DataFrame:
    return (
        with_reject_reason(events)
        .filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count("*").alias("events"))
    )


def reject_rate(events: DataFrame, interval: Duration = "5 minutes") -> DataFrame:
    """Rejected events per second by arrival interval and reason."""
    bucket = time_bucket(F.col("observed_at"), interval).alias("bucket")
    return (
        with_reject_reason(events)
        .filter(F.col("reject_reason").isNotNull())
        .groupBy(bucket, "reject_reason")
        .agg(F.count("*").alias("events"))
        .withColumn("per_second", _per_second(F.col("events"), interval))
    )


def throughput_funnel(events: DataFrame, interval: Duration = "1 minute") -> DataFrame:
    """Ingested against normalized events per arrival interval, in one pass."""
    bucket = time_bucket(F.col("observed_at"), interval).alias("bucket")
    return (
        with_reject_reason(events)
        .groupBy(bucket)
        .agg(
            F.count("*").alias("ingested"),
            F.count_if(F.col("reject_reason").isNull()).alias("normalized"),
        )
    )


def rows_by_metric(aggregates: DataFrame) -> DataFrame:
    """Emitted aggregate rows per metric, and how many windows they describe."""
    return aggregates.groupBy("metric").agg(
        F.count("*").alias("aggregates_emitted"),
        # Every window has exactly one row per metric with no labels.
        F.count_if(F.col("labels_key") == "").alias("windows_closed"),
    )


def emission_rate(aggregates: DataFrame, interval: Duration = "5 minutes") -> DataFrame:
    """Aggregate rows per second of event time, by metric."""
    bucket = time_bucket(F.col("window_end"), interval).alias("bucket")
    return (
        aggregates.groupBy(bucket, "metric")
        .agg(F.count("*").alias("aggregates_emitted"))
        .withColumn("per_second", _per_second(F.col("aggregates_emitted"), interval))
    )


def late_counts(flagged: DataFrame) -> DataFrame:
    """Late and accepted events per chain."""
    return flagged.groupBy("chain").agg(
        F.count_if("is_late").alias("late"), F.count_if(~F.col("is_late")).alias("accepted")
    )


def late_rate(flagged: DataFrame, interval: Duration = "5 minutes") -> DataFrame:
    bucket = time_bucket(F.col("observed_at"), interval).alias("bucket")
    return (
        flagged.filter("is_late")
        .groupBy("chain", bucket)
        .agg(F.count("*").alias("late"))
        .withColumn("per_second", _per_second(F.col("late"), interval))
    )


def pipeline_totals(
    raw: DataFrame, aggregates: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """One row: events ingested and normalized, aggregate rows, 1-minute rate, since.

    The rate covers the 60 seconds up to ``as_of``, by default the latest
    arrival, in whole seconds. Rolling up per second first means the events
    are scanned once and only one row per second goes on.
    """
    per_second, _ = materialize(
        with_reject_reason(raw)
        .groupBy(F.date_trunc("second", "observed_at").alias("second"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("reject_reason").isNull()).alias("valid"),
            F.min("observed_at").alias("since"),
        ),
        "per-second",
    )
    if as_of is None:
        as_of = per_second.agg(F.max("second")).first()[0]
    end = F.date_trunc("second", F.lit(as_of))
    in_last_minute = (F.col("second") > end - F.expr("interval 60 seconds")) & (
        F.col("second") <= end
    )
    totals = per_second.agg(
        F.sum("n").alias("events_ingested"),
        F.sum("valid").alias("events_normalized"),
        (F.sum(F.when(in_last_minute, F.col("n")).otherwise(0)) / F.lit(60.0)).alias(
            "events_per_second"
        ),
        F.min("since").alias("since"),
    )
    emitted = aggregates.agg(F.count("*").alias("aggregates_emitted"))
    # Both sides are a single row.
    return totals.withColumn("_one", F.lit(1)).join(
        emitted.withColumn("_one", F.lit(1)), "_one"
    ).drop("_one")
