"""Window metrics on the engine's own watermark.

Scales like any stateful aggregation and recovers from the state store, with
two differences from the exact rule: the watermark is one for all chains, and
it moves between micro-batches instead of per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.functions.timebucket import (
    Duration,
    lateness_micros,
    native_window,
    window_micros,
)
from blocktide.operators.window_metrics import (
    event_sums,
    long_metrics,
    measures,
    merge_sums,
)


def native_metrics(
    events: DataFrame,
    size: Duration = S.DEFAULT_WINDOW,
    lateness: Duration = S.DEFAULT_LATENESS,
) -> DataFrame:
    """Aggregate rows of windows the watermark has passed (append mode).

    Two chained aggregations: per (window, chain, sender), then per (window,
    chain). Distinct senders are exact, are kept as state rows rather than
    arrays, and a busy window spreads over all state partitions.
    """
    size_us = window_micros(size)
    timed = events.withWatermark("block_time", f"{lateness_micros(lateness)} microseconds")
    keyed = timed.withColumn("w", native_window(F.col("block_time"), size)).withColumn(
        "we", F.unix_micros("w.end")
    )
    per_sender = (
        measures(keyed, "w").groupBy("w", "chain", "from_address").agg(*event_sums())
    )
    wide = per_sender.groupBy("w", "chain").agg(
        *merge_sums(), F.count("from_address").alias("n_addresses")
    )
    return long_metrics(wide.withColumn("we", F.unix_micros("w.end")), size_us)
