"""Record sinks: keyed appends, per-batch folders, NDJSON and CSV exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from blocktide.operators.filters import partition_key


def json_value(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns))


def keyed_events(events: DataFrame) -> DataFrame:
    """``(key, value)`` records of events, keyed by sender."""
    return events.select(partition_key().alias("key"), json_value(events).alias("value"))


def keyed_aggregates(aggregates: DataFrame) -> DataFrame:
    """``(key, value)`` records of aggregate rows, keyed by chain."""
    return aggregates.select(F.col("chain").alias("key"), json_value(aggregates).alias("value"))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch to its own folder; a retry replaces exactly that folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only file sink; the checkpoint commits a batch after its files."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def kafka_stream(
    records: DataFrame, servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    """The same records to a Kafka topic; needs the Kafka connector on the cluster."""
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("checkpointLocation", checkpoint)
    )


def ndjson_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row in a single ``value`` column."""
    return df.select(json_value(df).alias("value"))


def write_ndjson(df: DataFrame, path: str) -> None:
    ndjson_lines(df).write.mode("overwrite").text(path)


LAG_COLUMNS = ("label", "elapsed_s", "group", "records_lag", "committed", "end_offset")


def lag_rows(samples: DataFrame) -> DataFrame:
    """Lag samples in export layout: fixed column order, elapsed with one decimal."""
    return samples.select(*LAG_COLUMNS).withColumn("elapsed_s", F.format_string("%.1f", "elapsed_s"))


def write_lag_csv(samples: DataFrame, path: str) -> None:
    lag_rows(samples).write.mode("overwrite").option("header", True).csv(path)
