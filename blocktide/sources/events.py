"""Event sources. Anything with the event columns can feed the pipeline."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocktide.operators.filters import filter_events
from blocktide.schemas import CHAIN_EVENT

#: Partition column of landed events.
ARRIVAL_DAY = "arrival_day"
#: Files that a landing writes for one day, at most.
FILES_PER_DAY = 8

# Loaders by name, for callers that pick a source from configuration.
_LOADERS: dict[str, Callable[..., DataFrame]] = {}


def register_source(name: str, loader: Callable[..., DataFrame]) -> None:
    _LOADERS[name] = loader


def load_source(name: str, *args, **kwargs) -> DataFrame:
    if name not in _LOADERS:
        raise ValueError(f"unknown source {name!r}, registered: {sorted(_LOADERS)}")
    return _LOADERS[name](*args, **kwargs)


def read_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(CHAIN_EVENT).format(fmt).load(path)


def stream_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    schema: T.StructType = CHAIN_EVENT,
) -> DataFrame:
    """Landing folder as a stream, from its first file; progress is the checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def land_by_day(events: DataFrame, path: str) -> None:
    """Append events to a landing folder with a sub-folder for each day of arrival.

    Events without an arrival stand in one of their own, which no tail reads.
    """
    dated = events.withColumn(ARRIVAL_DAY, F.to_date("observed_at"))
    # Each task writes the days it holds; a busy day is spread over several files.
    spread = dated.repartition(ARRIVAL_DAY, F.pmod(F.xxhash64("id"), F.lit(FILES_PER_DAY)))
    spread.write.mode("append").partitionBy(ARRIVAL_DAY).parquet(path)


def stream_by_day(spark: SparkSession, path: str, schema: T.StructType = CHAIN_EVENT) -> DataFrame:
    """The folder of ``land_by_day`` as a stream, with the day as its last column."""
    dated = T.StructType([*schema.fields, T.StructField(ARRIVAL_DAY, T.DateType())])
    return stream_events(spark, path, schema=dated)


def decode_events(records: DataFrame, column: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """Events from JSON text, one object per record.

    An unreadable record keeps its text in ``_corrupt_record`` and is later
    rejected as undecodable; ``FAILFAST`` stops the job instead.
    """
    if mode == "PERMISSIVE":
        schema = T.StructType(
            [*CHAIN_EVENT.fields, T.StructField("_corrupt_record", T.StringType())]
        )
        options = {"mode": mode, "columnNameOfCorruptRecord": "_corrupt_record"}
    else:
        schema, options = CHAIN_EVENT, {"mode": mode}
    return records.select(F.from_json(F.col(column), schema, options).alias("e")).select("e.*")


def kafka_events(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Events of a Kafka topic; needs the Kafka connector on the cluster."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return decode_events(records.select(F.col("value").cast("string").alias("value")))


def tail_events(
    stream: DataFrame,
    start: dt.datetime,
    chain: str = "",
    types: tuple = (),
    address: str = "",
    normalized: bool = False,
) -> DataFrame:
    """Live tail: events that arrive from ``start`` on and match the filter.

    Start one query per tail; each gets every matching event. Of a folder with
    a sub-folder for each day of arrival (``land_by_day``) no file of an earlier day is opened.
    """
    live = stream.filter(F.col("observed_at") >= F.lit(start))
    if ARRIVAL_DAY in stream.columns:
        live = live.filter(F.col(ARRIVAL_DAY) >= F.to_date(F.lit(start)))
    return filter_events(live, chain, types, address, normalized)


register_source("parquet", read_events)
register_source("stream", stream_events)
register_source("kafka", kafka_events)
