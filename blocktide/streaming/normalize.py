"""Raw to normalized events as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from blocktide.functions.timebucket import Duration
from blocktide.operators.dedup import (
    AGAIN,
    drop_redelivered,
    first_seen,
    first_unseen,
    ids_again,
    seen_keys,
    unseen,
)
from blocktide.operators.enrich import enrich
from blocktide.operators.validate import valid_events, with_reject_reason
from blocktide.sinks.records import write_batch
from blocktide.streaming.logstate import LogState

#: Keys and arrivals of accepted ids; 24 bytes each.
SEEN = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("observed_at", T.TimestampType())]
)
#: Batches up to this many good events broadcast their keys to the remembered ones; of larger
#: ones only events whose id comes again are shuffled.
SMALL_BATCH = 200_000


def normalized_stream(
    raw: DataFrame,
    contracts: DataFrame | None = None,
    dedup: bool = True,
    counters: str | None = None,
    remember: Duration | None = "1 day",
) -> DataFrame:
    """Valid, deduplicated, enriched events in append mode.

    Ids are remembered for ``remember`` of processing time (see ``drop_redelivered``).

    With ``counters``, each progress report of the query carries observed
    metrics under that name (``received``) and ``<counters>_valid`` and
    ``<counters>_kept``; valid less kept is the number of suppressed repeats.
    """

    def observed(events: DataFrame, suffix: str, count: str) -> DataFrame:
        if counters is None:
            return events
        return events.observe(counters + suffix, F.count(F.lit(1)).alias(count))

    events = observed(valid_events(observed(raw, "", "received")), "_valid", "valid")
    if dedup:
        events = observed(drop_redelivered(events, remember), "_kept", "kept")
    return enrich(events, contracts)


def normalize_with_rejects(
    raw: DataFrame,
    good_path: str,
    reject_path: str,
    checkpoint: str,
    contracts: DataFrame | None = None,
    seen_path: str | None = None,
    horizon: Duration = "1 hour",
    counts_path: str | None = None,
    remember: int = 10_000_000,
) -> DataStreamWriter:
    """Write good and rejected events of each micro-batch as one unit.

    With ``seen_path`` good events whose id was accepted before are suppressed
    (see ``unseen``). The last ``remember`` accepted ids are kept there, first in
    first out (see ``LogState``; one generation more at most), so neither the state
    nor what a batch reads grows with the stream. ``counts_path`` gets a row
    per batch: received, rejected, kept and suppressed events, exactly.

    All folders are named by batch id and replaced on retry; the batch is
    committed only after they are complete.
    """

    state = LogState(seen_path, SEEN, capacity=remember) if seen_path is not None else None

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        flagged = with_reject_reason(batch).persist()
        try:
            good = flagged.filter(F.col("reject_reason").isNull()).drop(
                "reject_reason", "_corrupt_record"
            )
            if state is not None:
                seen = state.read(spark, batch_id - 1)
                if good.count() <= SMALL_BATCH:
                    good = unseen(first_seen(good), seen, horizon, small=True)
                else:
                    filter_path = f"{seen_path}/again"  # of this batch only
                    ids_again(good, seen).write.mode("overwrite").parquet(filter_path)
                    again = spark.read.schema(AGAIN).parquet(filter_path)
                    good = first_unseen(good, seen, again, horizon)
            write_batch(enrich(good, contracts), good_path, batch_id)
            bad = flagged.filter(F.col("reject_reason").isNotNull())
            write_batch(bad, reject_path, batch_id)
            kept = spark.read.schema(good.select("id", "observed_at").schema).parquet(
                f"{good_path}/batch_id={batch_id}"
            )
            if counts_path is not None:
                # One row each, so the product is one row.
                totals = flagged.agg(
                    F.count(F.lit(1)).alias("received"), F.count("reject_reason").alias("rejected")
                ).crossJoin(kept.agg(F.count(F.lit(1)).alias("kept")))
                left = F.col("received") - F.col("rejected") - F.col("kept")
                write_batch(totals.withColumn("suppressed", left), counts_path, batch_id)
            if state is not None:
                state.append(seen_keys(kept), batch_id)
                state.compact(spark, batch_id)
        finally:
            flagged.unpersist()

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
