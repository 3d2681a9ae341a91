"""Block heads and bodies as streams: which body belongs to which head, in bounded state.

Heads go to a log first, each once, as it first arrived. The log is a stream again:
its rows are the block events, and they meet the bodies in a stream-stream
join. Both sides wait for each other for a stretch of processing time, which only
goes forward, so no order of landing loses anything and the state holds no more than lands in
that time. A head whose body did not come in time is told of as unanswered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from blocktide.functions.hexnum import hex_to_timestamp
from blocktide.functions.timebucket import Duration, micros
from blocktide.sinks.records import write_batch
from blocktide.sources.chain_json import block_event_row, decoded_heads, keyed_bodies, transaction_events
from blocktide.streaming.logstate import LogState

#: Heads of the log, one for each (number, hash).
HEAD = T.StructType(
    [
        T.StructField("number", T.DecimalType(20, 0)),
        T.StructField("block_hash", T.StringType()),
        T.StructField("block_time", T.TimestampType()),
        T.StructField("observed_at", T.TimestampType()),
    ]
)
_SEEN = T.StructType(HEAD.fields[:2])


def log_heads(
    landed: DataFrame,
    log_path: str,
    state_path: str,
    checkpoint: str,
    rejects_path: str | None = None,
    remember: int = 10_000_000,
) -> DataStreamWriter:
    """Write each head of a stream of landed JSON ``(value, observed_at)`` once.

    Of redelivered heads the first counts: within a batch the one that arrived
    first, over batches the one of the earliest. The last ``remember`` (number, hash)
    pairs are known again. An unreadable time falls back to the arrival; heads
    without a readable number go to ``rejects_path``, if it is given. A batch
    replaces its own folders when it is retried.
    """
    state = LogState(state_path, _SEEN, capacity=remember)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        heads = decoded_heads(batch).persist()
        try:
            if rejects_path is not None:
                bad = heads.filter(F.col("number").isNull()).select("value", "observed_at")
                write_batch(bad, rejects_path, batch_id)
            firsts = (
                heads.filter(F.col("number").isNotNull())
                .groupBy("number", F.col("hash").alias("block_hash"))
                .agg(F.min("observed_at").alias("observed_at"), F.min("stamp").alias("stamp"))
            )
            time = F.coalesce(hex_to_timestamp(F.col("stamp")), "observed_at").alias("block_time")
            known = state.read(spark, batch_id - 1)
            fresh = firsts.join(known, ["number", "block_hash"], "left_anti")
            write_batch(fresh.select("number", "block_hash", time, "observed_at"), log_path, batch_id)
            written = spark.read.schema(HEAD).parquet(f"{log_path}/batch_id={batch_id}")
            state.append(written, batch_id)
            state.compact(spark, batch_id)
        finally:
            heads.unpersist()

    return landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_head_log(spark, log_path: str, stream: bool = True) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(HEAD).parquet(log_path).select(*HEAD.names)


def block_events(heads: DataFrame, chain: str = "ethereum") -> DataFrame:
    """One BLOCK event per head of the log, static or streaming."""
    return heads.select(*block_event_row(chain))


def _landing(stream: DataFrame, clock: str, wait: Duration) -> DataFrame:
    return stream.withColumn(clock, F.current_timestamp()).withWatermark(clock, f"{micros(wait)} microseconds")


def matched_bodies(heads: DataFrame, bodies: DataFrame, wait: Duration = "10 minutes") -> DataFrame:
    """``(number, block_hash, block_time, observed_at, transactions, answered)``, streaming.

    ``heads`` is the log, ``bodies`` landed JSON ``(value, observed_at)``. A head
    takes a body that names its hash, and one that names only the number. The body
    may land before or after it, at most ``wait`` of processing time apart. A head
    without any comes once, with ``answered`` false, when that time is over. The
    streams' clocks are one, so with ``spark.sql.streaming.multipleWatermarkPolicy``
    set to ``max`` that also happens while one of them stands still.
    """
    # A retried batch of the log or a redelivered body is no second one.
    left = _landing(heads, "_head_at", wait).dropDuplicatesWithinWatermark(["number", "block_hash"])
    right = _landing(
        keyed_bodies(bodies).drop("observed_at").withColumnRenamed("number", "_number"), "_body_at", wait
    ).dropDuplicatesWithinWatermark(["_number", "body_hash"])
    reach = F.expr(f"interval {micros(wait)} microseconds")
    same = (
        (F.col("number") == F.col("_number"))
        & ((F.col("body_hash") == F.col("block_hash")) | (F.col("body_hash") == ""))
        & F.col("_body_at").between(F.col("_head_at") - reach, F.col("_head_at") + reach)
    )
    return left.join(right, same, "left_outer").select(
        *HEAD.names, "transactions", F.col("_number").isNotNull().alias("answered")
    )


def decode_transactions(
    heads: DataFrame,
    bodies: DataFrame,
    events_path: str,
    unanswered_path: str,
    checkpoint: str,
    chain: str = "ethereum",
    wait: Duration = "10 minutes",
) -> DataStreamWriter:
    """Write the TRANSACTION events of matched bodies, and the heads left without one.

    Both folders have one sub-folder per batch, replaced on retry.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        matched = batch.persist()
        try:
            write_batch(transaction_events(matched.filter("answered"), chain), events_path, batch_id)
            write_batch(matched.filter(~F.col("answered")).select(*HEAD.names), unanswered_path, batch_id)
        finally:
            matched.unpersist()

    return (
        matched_bodies(heads, bodies, wait)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
