"""Latency quantiles: exact by selection, from mergeable bucket counts, or from a histogram.

The exact ones take two passes of plain counting. The first counts delays by
bucket, on a scale that is finer than the delay by a fixed factor at any size; the running
counts of a group name the buckets that hold the ranks asked for. The second
counts single delays in those buckets alone. No state holds the delays of
a group, and the counts of the first pass, which add up over windows or days,
can be stored and asked by themselves.

Histogram quantiles are read from a fixed set of cumulative buckets with linear
interpolation inside the bucket, so a group's state is a few counters however
many events it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocktide.operators.lateness import SMALL_ROWS
from blocktide.session import materialize

# Default upper bounds in seconds of the usual latency histogram.
DEFAULT_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
DEFAULT_QUANTILES = (0.5, 0.95, 0.99)

#: Buckets for each factor of e between two delays; a bucket spans 1/8192 of its delay.
BUCKETS_PER_E = 8192


def staleness_seconds() -> Column:
    """Arrival minus event time."""
    return (F.unix_micros("observed_at") - F.unix_micros("block_time")) / F.lit(1e6)


def latency_histogram(
    events: DataFrame,
    keys: Sequence[str],
    latency: Column,
    bounds: Sequence[float] = DEFAULT_BOUNDS,
) -> DataFrame:
    """Cumulative counts ``le_0 .. le_n`` per group plus ``events``."""
    counts = [
        F.count_if(F.col("latency") <= F.lit(float(b))).alias(f"le_{i}")
        for i, b in enumerate(bounds)
    ]
    return (
        events.select(*keys, latency.alias("latency"))
        .groupBy(*keys)
        .agg(*counts, F.count("*").alias("events"))
    )


def histogram_quantile(q: float, bounds: Sequence[float] = DEFAULT_BOUNDS) -> Column:
    """Quantile of a ``latency_histogram`` row.

    The rank is placed in the first bucket that reaches it and interpolated
    linearly; past the last bound the last bound is the answer.
    """
    rank = F.col("events") * F.lit(q)
    result = F
    for i, upper in enumerate(bounds):
        lower = float(bounds[i - 1]) if i else 0.0
        before = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"le_{i}") - before
        value = F.lit(lower) + F.lit(float(upper) - lower) * (rank - before) / inside
        result = result.when(F.col(f"le_{i}") >= rank, value)
    return F.when(F.col("events") > 0, result.otherwise(F.lit(float(bounds[-1]))))


def delay_micros() -> Column:
    return F.unix_micros("observed_at") - F.unix_micros("block_time")


def delay_bucket(delay: Column) -> Column:
    """Rises with the delay, of either sign; null without one."""
    size = F.floor(F.log(F.abs(delay) + 1) * BUCKETS_PER_E)
    return F.when(delay < 0, -size - 1).otherwise(size)


def delay_counts(events: DataFrame, keys: Sequence[str] = ("chain",)) -> DataFrame:
    """``(*keys, bucket, events)``: a sketch of delays; sums of such rows are one again.

    A group has as many rows as buckets with events, some ten thousand at most
    for delays between a millisecond and a day, however many events there are.
    Events without a delay stand under a null bucket.
    """
    return events.groupBy(*keys, delay_bucket(delay_micros()).alias("bucket")).agg(
        F.count(F.lit(1)).alias("events")
    )


def merged_counts(sketches: DataFrame, keys: Sequence[str] = ("chain",)) -> DataFrame:
    """The sketch of all events of several ones, say of all windows of a day."""
    return sketches.groupBy(*keys, "bucket").agg(F.sum("events").alias("events"))


def _position(quantile: float) -> Column:
    """Where a quantile lies among the ``n`` delays of a group, counted from 0."""
    return F.lit(float(quantile)) * (F.col("n") - 1)


def _holding(counts: DataFrame, keys: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Buckets that hold a rank asked for, with what stands before them and the ranks.

    A rank is named by its quantile and side: the delays beside the position.
    """
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.array(
        *[
            F.struct(F.lit(i).alias("quantile"), F.lit(side).alias("side"), near(_position(q)).alias("rank"))
            for i, q in enumerate(quantiles)
            for side, near in enumerate((F.floor, F.ceil))
        ]
    )
    before = F.sum("events").over(so_far) - F.col("events")
    placed = (
        counts.filter(F.col("bucket").isNotNull())
        .withColumns({"n": F.sum("events").over(group), "before": before})
        .withColumn("ranks", ranks)
    )
    inside = F.filter(
        "ranks",
        lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("events")),
    )
    return placed.withColumn("ranks", inside).filter(F.size("ranks") > 0).select(*keys, "bucket", "n", "before", "ranks")


def _interpolated(found: DataFrame, keys: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Quantiles from rows ``(*keys, n, quantile, side, seconds)``, and ``(*keys, total)`` of the rest."""
    at = {
        (i, side): F.max(F.when((F.col("quantile") == i) & (F.col("side") == side), F.col("seconds")))
        for i in range(len(quantiles))
        for side in (0, 1)
    }
    values = found.groupBy(*keys).agg(
        F.sum("total").alias("events"),
        F.max("n").alias("n"),
        *[value.alias(f"_{i}_{side}") for (i, side), value in at.items()],
    )
    out = []
    for i, q in enumerate(quantiles):
        low, high, share = F.col(f"_{i}_0"), F.col(f"_{i}_1"), _position(q) - F.floor(_position(q))
        out.append(((1 - share) * low + share * high).alias(f"p{round(q * 100)}"))
    return values.select(*keys, "events", *out)


def _answered(
    counts: DataFrame, found: DataFrame, keys: Sequence[str], quantiles: Sequence[float]
) -> DataFrame:
    totals = counts.groupBy(*keys).agg(F.sum("events").alias("total"))
    return _interpolated(totals.unionByName(found, allowMissingColumns=True), keys, quantiles)


def freshness_quantiles(
    events: DataFrame,
    keys: Sequence[str] = ("chain",),
    quantiles: Sequence[float] = DEFAULT_QUANTILES,
) -> DataFrame:
    """Exact p50, p95, p99 of arrival delay per group, interpolated between ranks.

    Two passes over the events (see the module); a group of any size is counted by
    all tasks. Events without a delay count as events only.
    """
    counts, _ = materialize(delay_counts(events, keys), "delay-counts")
    holding, rows = materialize(_holding(counts, keys, quantiles), "delay-buckets")
    wanted = holding.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bucket").alias("_bucket"), "n", "before", "ranks")
    delays = events.select(*keys, delay_micros().alias("delay")).withColumn("bucket", delay_bucket(F.col("delay")))
    same = F.col("bucket") == F.col("_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    if rows <= SMALL_ROWS:
        few = F.broadcast(wanted.select(*[f"_{k}" for k in keys], "_bucket"))
        delays = delays.join(few, same, "left_semi")
    # Counted before the ranks are joined, so a hot bucket is no hot key.
    single = delays.groupBy(*keys, "bucket", "delay").agg(F.count(F.lit(1)).alias("events"))
    inside = (
        Window.partitionBy(*keys, "bucket").orderBy("delay").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        single.withColumn("upto", F.sum("events").over(inside))
        .join(wanted, same)
        .withColumn("rank_from", F.col("before") + F.col("upto") - F.col("events"))
    )
    hit = F.filter(
        "ranks",
        lambda r: (r["rank"] >= F.col("rank_from")) & (r["rank"] < F.col("before") + F.col("upto")),
    )
    found = placed.select(
        *keys, "n", F.explode(hit).alias("r"), (F.col("delay") / F.lit(1e6)).alias("seconds")
    ).select(*keys, "n", "r.quantile", "r.side", "seconds")
    return _answered(counts, found, keys, quantiles)


def sketched_quantiles(
    counts: DataFrame,
    keys: Sequence[str] = ("chain",),
    quantiles: Sequence[float] = DEFAULT_QUANTILES,
) -> DataFrame:
    """The same from ``delay_counts`` alone, off by one bucket at most (1/8192 of the delay)."""
    size = F.when(F.col("bucket") < 0, -F.col("bucket") - 1).otherwise(F.col("bucket"))
    middle = (F.exp((size + 0.5) / BUCKETS_PER_E) - 1) / F.lit(1e6)
    found = _holding(counts, keys, quantiles).select(
        *keys, "n", F.explode("ranks").alias("r"), F.when(F.col("bucket") < 0, -middle).otherwise(middle).alias("seconds")
    )
    return _answered(counts, found.select(*keys, "n", "r.quantile", "r.side", "seconds"), keys, quantiles)


def freshness_histogram(
    events: DataFrame,
    keys: Sequence[str] = ("chain",),
    bounds: Sequence[float] = DEFAULT_BOUNDS,
    quantiles: Sequence[float] = DEFAULT_QUANTILES,
) -> DataFrame:
    """The same from fixed buckets; ``above`` counts events past the last bound, where
    a quantile can only say that bound."""
    histogram = latency_histogram(events, keys, staleness_seconds(), bounds)
    return histogram.select(
        *keys,
        "events",
        (F.col("events") - F.col(f"le_{len(bounds) - 1}")).alias("above"),
        *[histogram_quantile(q, bounds).alias(f"p{round(q * 100)}") for q in quantiles],
    )


def freshness_percentiles(
    events: DataFrame,
    keys: Sequence[str] = ("chain",),
    quantiles: Sequence[float] = DEFAULT_QUANTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """The same from a bounded quantile sketch instead of fixed buckets."""
    sketch = F.percentile_approx(staleness_seconds(), list(quantiles), accuracy)
    return (
        events.groupBy(*keys)
        .agg(F.count("*").alias("events"), sketch.alias("p"))
        .select(
            *keys,
            "events",
            *[F.col("p")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)],
        )
    )
