"""Registered queries: every operator run over the driver's whole events table.

Each takes ``(spark, sf_dir)``. Timestamps are rendered as text and wide
numbers as digits, so results compare equal across engines.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.functions.hexnum import (
    hex_to_decimal_string,
    hex_to_timestamp,
    hex_to_uint64,
)
from blocktide.functions.labels import labels_from_json, labels_json, labels_key
from blocktide.operators import lag, latency, stats
from blocktide.operators.dedup import dropped_per_interval, first_seen
from blocktide.operators.enrich import enrich
from blocktide.operators.filters import filter_events, partition_key, write_filterable
from blocktide.operators.lateness import Replay
from blocktide.operators.validate import valid_events, with_reject_reason
from blocktide.operators.window_metrics import events_by_type, window_metrics
from blocktide.session import materialize, new_work_dir
from blocktide.sinks.aggregates_table import (
    READ_ORDER,
    query_aggregates,
    read_table,
    recent_aggregates,
    upsert_aggregates,
)
from blocktide.sinks.records import (
    append_stream,
    keyed_aggregates,
    keyed_events,
    write_lag_csv,
    write_ndjson,
)
from blocktide.sources.chain_json import decode_blocks
from blocktide.sources.driver_events import load_feed, redelivered_feed
from blocktide.schemas import OFFSET_SNAPSHOT
from blocktide.sources.events import (
    ARRIVAL_DAY,
    decode_events,
    land_by_day,
    load_source,
    stream_by_day,
    stream_events,
    tail_events,
)
from blocktide.sources.offsets import read_offsets
from blocktide.streaming.decode import block_events, decode_transactions, log_heads, read_head_log
from blocktide.streaming.exact import ExactWindows
from blocktide.streaming.native import native_metrics
from blocktide.streaming.normalize import normalize_with_rejects, normalized_stream

# The table's events are minutes apart, hence wider settings than the defaults.
WINDOW = "1 hour"
LATENESS = "30 minutes"
RANGE = (dt.datetime(2024, 1, 5, 12), dt.datetime(2024, 1, 20, 6))
TAIL_START = dt.datetime(2024, 1, 16)
FRESHNESS_BOUNDS = (60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0, 7200.0, 10800.0, 14400.0)
PARTITIONS = 6
GROUP_DELAY_S = {"normalizer": 90, "aggregator": 1200}
FILTER = {
    "chain": "ETHEREUM",
    "types": (S.TYPE_TRANSACTION, S.TYPE_LOG),
    "address": "0xA0B86991C6218B36C1D19D4A2E9EB0CE3606EB48",
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _utc(moment: dt.datetime) -> dt.datetime:
    return moment.replace(tzinfo=dt.timezone.utc)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(valid_events(load_feed(spark, sf_dir)))


def replay(spark: SparkSession, sf_dir: str) -> Replay:
    return Replay(normalized(spark, sf_dir), WINDOW, LATENESS)


def show_aggregates(rows: DataFrame) -> DataFrame:
    return rows.select(
        "chain",
        "metric",
        _stamp("window_start"),
        _stamp("window_end"),
        "labels_key",
        labels_json(F.col("labels")).alias("labels"),
        "value",
        "value_exact",
    )


# -- validate, enrich, filter, key -------------------------------------------


@query
def validate_rejects_by_reason(spark, sf_dir):
    return stats.reject_counts(load_feed(spark, sf_dir))


@query
def reject_rate(spark, sf_dir):
    return stats.reject_rate(load_feed(spark, sf_dir)).withColumn("bucket", _stamp("bucket"))


@query
def normalized_events(spark, sf_dir):
    return normalized(spark, sf_dir).select(
        "id",
        "chain",
        "type",
        "block_number",
        "tx_hash",
        "from_address",
        "to_address",
        labels_json(F.col("attributes")).alias("attributes"),
    )


@query
def contract_activity(spark, sf_dir):
    """Label and kind with the contract table given as a joined dimension."""
    return _contract_activity(spark, sf_dir)


@query
def contract_activity_shuffled(spark, sf_dir):
    """The same by the path of contract tables too large to broadcast."""
    return _contract_activity(spark, sf_dir, broadcast_rows=0)


def _contract_activity(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    contracts = spark.createDataFrame(
        list(S.KNOWN_CONTRACTS.items()), "address string, label string"
    )
    rows = enrich(valid_events(load_feed(spark, sf_dir)), contracts, **how)
    keys = {k: F.try_element_at("attributes", F.lit(k)) for k in ("contract_label", "tx_kind")}
    return (
        rows.select("type", *[F.coalesce(c, F.lit("")).alias(k) for k, c in keys.items()])
        .groupBy("type", *keys)
        .agg(F.count("*").alias("events"))
    )


@query
def filtered_events(spark, sf_dir):
    return filter_events(normalized(spark, sf_dir), **FILTER).select(
        "id", "chain", "type", "from_address", "to_address"
    )


@query
def filtered_stored_events(spark, sf_dir):
    """The same from a stored table of normalized events, laid out for this filter."""
    table = new_work_dir(spark, "events")
    write_filterable(normalized(spark, sf_dir).drop("event_id"), table)
    return filter_events(spark.read.parquet(table), **FILTER, normalized=True).select(
        "id", "chain", "type", "from_address", "to_address"
    )


@query
def partition_key_counts(spark, sf_dir):
    return (
        load_feed(spark, sf_dir)
        .groupBy(partition_key().alias("key"))
        .agg(F.count("*").alias("events"))
    )


@query
def labels_forms(spark, sf_dir):
    attributes = F.col("attributes")
    return (
        normalized(spark, sf_dir)
        .select(
            labels_key(attributes).alias("labels_key"),
            labels_json(labels_from_json(labels_json(attributes))).alias("labels"),
        )
        .groupBy("labels_key", "labels")
        .agg(F.count("*").alias("events"))
    )


# -- dedup --------------------------------------------------------------------


@query
def dedup_first_seen(spark, sf_dir):
    feed = valid_events(redelivered_feed(load_feed(spark, sf_dir)))
    return first_seen(feed).select("id", "chain", "type", "block_number", _stamp("observed_at"))


@query
def dedup_dropped_per_minute(spark, sf_dir):
    feed = valid_events(redelivered_feed(load_feed(spark, sf_dir)))
    return dropped_per_interval(feed).withColumn("bucket", _stamp("bucket"))


# -- windows on a static table ------------------------------------------------


@query
def window_events_by_type(spark, sf_dir):
    rows = events_by_type(normalized(spark, sf_dir), WINDOW)
    return rows.select("chain", _stamp("window_start"), "type", "events")


@query
def window_metrics_long(spark, sf_dir):
    return show_aggregates(window_metrics(normalized(spark, sf_dir), WINDOW))


@query
def window_metrics_weekly(spark, sf_dir):
    """Seven-day windows, whose boundaries count from year one."""
    return show_aggregates(window_metrics(normalized(spark, sf_dir), "7 days"))


@query
def replay_late_flags(spark, sf_dir):
    return replay(spark, sf_dir).flagged().select("id", "chain", "is_late")


@query
def replay_late_flags_partitioned(spark, sf_dir):
    """The same by the path of large tables: hot windows broadcast, others joined."""
    large = Replay(normalized(spark, sf_dir), WINDOW, LATENESS, small_rows=0, hot_events=50)
    return large.flagged().select("id", "chain", "is_late")


@query
def replay_late_flags_by_position(spark, sf_dir):
    """The same path with a numeric arrival key and without the time of arrival."""
    rank = F.struct(F.unix_micros("observed_at").alias("at"), "id")
    events = normalized(spark, sf_dir).select("id", "chain", "block_time", rank.alias("position"))
    large = Replay(events, WINDOW, LATENESS, arrival=("position",), small_rows=0, hot_events=50)
    return large.flagged().select("id", "chain", "is_late")


@query
def replay_closed_metrics(spark, sf_dir):
    return show_aggregates(replay(spark, sf_dir).metrics())


@query
def replay_flush_metrics(spark, sf_dir):
    return show_aggregates(replay(spark, sf_dir).metrics(flush=True))


# -- stored aggregates --------------------------------------------------------


@query
def upsert_latest(spark, sf_dir):
    """Windows stored without the late rule, then overwritten by the exact ones."""
    table = new_work_dir(spark, "aggregates")
    events = normalized(spark, sf_dir)
    upsert_aggregates(window_metrics(events, WINDOW), table)
    upsert_aggregates(Replay(events, WINDOW, LATENESS).metrics(flush=True), table)
    return show_aggregates(read_table(spark, table))


def _stored_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_work_dir(spark, "aggregates")
    upsert_aggregates(replay(spark, sf_dir).metrics(flush=True), table)
    return read_table(spark, table)


@query
def aggregates_range(spark, sf_dir):
    since, until = map(_utc, RANGE)
    rows = query_aggregates(
        _stored_replay(spark, sf_dir), "ethereum", S.METRIC_EVENTS, since, until
    )
    return rows.select(
        "chain",
        "metric",
        _stamp("window_start"),
        labels_json(F.col("labels")).alias("labels"),
        F.col("labels").isNull().alias("no_labels"),
        "value",
    )


@query
def aggregates_pages(spark, sf_dir):
    """All stored rows in pages of half the table, each going on after the last."""
    stored = _stored_replay(spark, sf_dir)
    size = stored.count() // 2 + 1
    first = query_aggregates(stored, limit=size)
    last = first.orderBy(*[F.desc(c) for c in READ_ORDER]).select(*READ_ORDER).first()
    pages = [first]
    if last:
        pages.append(query_aggregates(stored, limit=None, after=tuple(last)))
    return functools.reduce(DataFrame.unionByName, pages).select(
        "chain", "metric", _stamp("window_start"), "labels_key", "value"
    )


@query
def recent_rows(spark, sf_dir):
    rows = recent_aggregates(_stored_replay(spark, sf_dir))
    return rows.withColumn("window_start", _stamp("window_start"))


# -- statistics ---------------------------------------------------------------


@query
def pipeline_totals(spark, sf_dir):
    feed = load_feed(spark, sf_dir)
    rows = stats.pipeline_totals(feed, replay(spark, sf_dir).metrics())
    return rows.withColumn("since", _stamp("since"))


@query
def ingest_rate(spark, sf_dir):
    return stats.ingest_rate(load_feed(spark, sf_dir)).withColumn("bucket", _stamp("bucket"))


@query
def funnel_per_minute(spark, sf_dir):
    return stats.throughput_funnel(load_feed(spark, sf_dir)).withColumn("bucket", _stamp("bucket"))


@query
def rows_by_metric(spark, sf_dir):
    return stats.rows_by_metric(replay(spark, sf_dir).metrics())


@query
def emission_rate(spark, sf_dir):
    rows = stats.emission_rate(replay(spark, sf_dir).metrics())
    return rows.withColumn("bucket", _stamp("bucket"))


@query
def late_per_chain(spark, sf_dir):
    return stats.late_counts(replay(spark, sf_dir).flagged())


@query
def late_rate(spark, sf_dir):
    rows = stats.late_rate(replay(spark, sf_dir).flagged())
    return rows.withColumn("bucket", _stamp("bucket"))


@query
def freshness_quantiles(spark, sf_dir):
    rows = latency.freshness_quantiles(normalized(spark, sf_dir), ("chain", "type"))
    # Engines interpolate in different orders of operations.
    return rows.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})


@query
def freshness_histogram(spark, sf_dir):
    return latency.freshness_histogram(
        normalized(spark, sf_dir), ("chain", "type"), FRESHNESS_BOUNDS
    )


# -- consumer lag -------------------------------------------------------------


def offset_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily per-partition offsets of two groups trailing the feed by fixed delays.

    Events are counted per partition and day before anything else, so the
    running totals go over one row per partition and day.
    """
    feed = load_feed(spark, sf_dir).select(
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.unix_seconds("observed_at").alias("at"),
    )
    day = 86_400

    def bucket(delay: int) -> Column:
        return F.call_function("div", F.col("at") + F.lit(delay), F.lit(day).cast("bigint"))

    marks = [("end", 0), *GROUP_DELAY_S.items()]
    daily = (
        feed.select(
            "partition",
            F.inline(
                F.array(
                    *[F.struct(F.lit(k).alias("k"), bucket(d).alias("day")) for k, d in marks]
                )
            ),
        )
        .groupBy("partition", "day")
        .agg(*[F.count_if(F.col("k") == k).alias(k) for k, _ in marks])
    )
    span = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    spine = span.select(F.col("lo"), F.explode(F.sequence("lo", "hi")).alias("day")).select(
        "lo", "day", F.explode(F.sequence(F.lit(0), F.lit(PARTITIONS - 1))).alias("partition")
    )
    so_far = Window.partitionBy("partition").orderBy("day")
    totals = spine.join(daily, ["partition", "day"], "left").select(
        "partition",
        ((F.col("day") - F.col("lo")) * float(day)).alias("elapsed_s"),
        *[F.sum(F.coalesce(k, F.lit(0))).over(so_far).alias(k) for k, _ in marks],
    )
    groups = [
        F.struct(
            F.concat(F.lit("run-"), F.lit(g)).alias("label"),
            F.lit(g).alias("group"),
            F.col(g).alias("committed"),
        )
        for g in GROUP_DELAY_S
    ]
    return totals.select(
        "elapsed_s", "partition", F.col("end").alias("end_offset"), F.inline(F.array(*groups))
    )


@query
def group_lag(spark, sf_dir):
    return lag.group_lag(offset_snapshots(spark, sf_dir))


@query
def group_lag_scanned(spark, sf_dir):
    """The same from stored snapshots."""
    work = new_work_dir(spark, "offsets")
    offset_snapshots(spark, sf_dir).select(*OFFSET_SNAPSHOT.names).write.parquet(work)
    return lag.group_lag(read_offsets(spark, work))


@query
def peak_lag(spark, sf_dir):
    return lag.peak_lag(lag.group_lag(offset_snapshots(spark, sf_dir)))


@query
def lag_csv(spark, sf_dir):
    """Lag samples written as CSV and read back."""
    path = new_work_dir(spark, "lag-csv")
    write_lag_csv(lag.group_lag(offset_snapshots(spark, sf_dir)), path)
    return spark.read.option("header", True).csv(path)


# -- decode and export --------------------------------------------------------


def landed_chain_json(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Heads (each delivered twice) and bodies in the node's JSON, from the feed.

    A block holds twelve consecutive rows of the table at most, so the
    transaction lists are small by construction. Where a row has no block time,
    its block's head carries one that cannot be read.
    """
    feed = load_feed(spark, sf_dir)
    e = F.col("event_id")
    number = F.concat(F.lit("0x"), F.lower(F.hex("block_number")))
    cents = F.regexp_replace("value_wei", "0{14}$", "").try_cast("bigint")
    value = F.when(cents.isNull(), F.lit("0xzz")).otherwise(
        F.concat(F.lit("0x"), F.lower(F.hex(cents)), F.lit("0" * 12))
    )
    is_tx = (F.col("type") == S.TYPE_TRANSACTION) & (F.col("tx_hash") != "")
    tx = F.struct(
        e,
        F.col("tx_hash").alias("hash"),
        F.col("from_address").alias("from"),
        F.nullif(F.col("to_address"), F.lit("")).alias("to"),
        value.alias("value"),
    )
    per_block = feed.groupBy("block_number", "block_hash").agg(
        F.coalesce(F.min("block_time"), F.min("observed_at")).alias("t"),
        F.bool_or(F.col("block_time").isNull()).alias("undated"),
        F.array_sort(F.collect_list(F.when(is_tx, tx))).alias("txs"),
    )
    seconds = F.unix_seconds("t")
    stamp = F.concat(F.lit("0x"), F.lower(F.hex(seconds)))
    head = F.to_json(
        F.struct(
            number.alias("number"),
            F.col("block_hash").alias("hash"),
            F.when(F.col("undated"), F.lit("0xnone")).otherwise(stamp).alias("timestamp"),
        )
    )
    heads = per_block.select(
        head.alias("value"),
        F.explode(F.array(*[F.timestamp_seconds(seconds + s) for s in (2, 9)])).alias(
            "observed_at"
        ),
    )
    body = F.to_json(
        F.struct(
            number.alias("number"),
            F.transform(
                "txs", lambda x: F.struct(*[x[n].alias(n) for n in ("hash", "from", "to", "value")])
            ).alias("transactions"),
        )
    )
    bodies = per_block.select(
        body.alias("value"), F.timestamp_seconds(seconds + 3).alias("observed_at")
    )
    return heads, bodies


def _show_decoded(events: DataFrame) -> DataFrame:
    return events.select(
        "id",
        "type",
        F.col("block_number").cast("bigint").alias("block_number"),
        "block_hash",
        "tx_hash",
        "from_address",
        "to_address",
        "value_wei",
        _stamp("observed_at"),
        _stamp("block_time"),
    )


@query
def decode_chain_blocks(spark, sf_dir):
    heads, bodies = landed_chain_json(spark, sf_dir)
    return _show_decoded(decode_blocks(heads, bodies))


@query
def decode_heads_only(spark, sf_dir):
    heads, _ = landed_chain_json(spark, sf_dir)
    return _show_decoded(decode_blocks(heads, fetch_bodies=False))


@query
def stream_decode_blocks(spark, sf_dir):
    """Heads and bodies landing in four parts each, in different orders, decoded as streams."""
    work = new_work_dir(spark, "stream-decode")
    landed = dict(zip(("heads", "bodies"), landed_chain_json(spark, sf_dir)))
    number = F.conv(F.substring(F.get_json_object("value", "$.number"), 3, 16), 16, 10).cast("bigint")
    parts = {n: df.withColumn("part", number % 4) for n, df in landed.items()}
    # The first body lands a round before its head, the third a round after it.
    for round_ in ({"heads": (1, 2), "bodies": (0, 1)}, {"heads": (3, 0), "bodies": (3, 2)}):
        for name, order in round_.items():
            for part in order:
                some = parts[name].filter(F.col("part") == part).drop("part")
                some.write.mode("append").parquet(f"{work}/{name}")
        streams = {
            n: stream_events(spark, f"{work}/{n}", schema=df.schema) for n, df in landed.items()
        }
        _run_to_end(
            log_heads(streams["heads"], f"{work}/log", f"{work}/seen", f"{work}/checkpoint-heads")
        )
        _run_to_end(
            decode_transactions(
                read_head_log(spark, f"{work}/log"), streams["bodies"], f"{work}/events",
                f"{work}/unanswered", f"{work}/checkpoint-bodies",
            )
        )
    blocks = block_events(read_head_log(spark, f"{work}/log", stream=False))
    transactions = spark.read.schema(blocks.schema).parquet(f"{work}/events")
    return _show_decoded(blocks.unionByName(transactions.select(*blocks.columns)))


@query
def hex_quantities(spark, sf_dir):
    """Hash prefixes of every event read as 64-bit, 120-bit and 128-bit quantities."""
    digest = F.substring("block_hash", 3, 32)
    return load_feed(spark, sf_dir).select(
        "event_id",
        hex_to_uint64(F.concat(F.lit("0x"), F.substring(digest, 1, 16))).cast("string").alias("u64"),
        hex_to_uint64(F.concat(F.lit("0x1"), F.substring(digest, 1, 16))).isNull().alias("too_wide"),
        hex_to_decimal_string(F.concat(F.lit("0x"), F.substring(digest, 1, 30))).alias("u120"),
        hex_to_decimal_string(F.concat(F.lit("0x"), digest)).alias("u128"),
        F.date_format(
            hex_to_timestamp(F.concat(F.lit("0x"), F.substring(digest, 1, 8))),
            "yyyy-MM-dd HH:mm:ss",
        ).alias("at"),
    )


@query
def decode_json_records(spark, sf_dir):
    """Events through their JSON form, with every 97th record cut short."""
    feed = load_feed(spark, sf_dir)
    record = F.to_json(F.struct(*[c for c in feed.columns if c != "event_id"]))
    broken = F.col("event_id") % 97 == 0
    lines = feed.select(
        F.when(broken, F.substring(record, 1, 20)).otherwise(record).alias("value")
    )
    return (
        with_reject_reason(decode_events(lines))
        .groupBy(F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))
        .agg(
            F.count("*").alias("events"),
            F.sum(F.col("gas_used")).cast("string").alias("gas_used"),
            F.count("block_time").alias("with_block_time"),
        )
    )


@query
def ndjson_export(spark, sf_dir):
    path = new_work_dir(spark, "ndjson")
    rows = normalized(spark, sf_dir).select(
        "id", "chain", "type", "block_number", "from_address", "to_address", "value_wei",
        "gas_used", _stamp("block_time"),
    )
    write_ndjson(rows, path)
    return spark.read.text(path)


@query
def keyed_aggregate_records(spark, sf_dir):
    rows = replay(spark, sf_dir).metrics().select(
        "chain", "metric", _stamp("window_start"), "labels_key", "value_exact"
    )
    return keyed_aggregates(rows)


# -- streams ------------------------------------------------------------------


def _run_to_end(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


@contextlib.contextmanager
def _only_batches_with_data(spark: SparkSession) -> Iterator[None]:
    """For streams whose expiring state emits nothing: no extra batch just to expire it."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@query
def stream_exact_metrics(spark, sf_dir):
    """The normalized feed landed in two arrival slices, the stream restarted in between."""
    _, work = _exact_stream(spark, sf_dir, 2)
    return show_aggregates(read_table(spark, f"{work}/table"))


EXACT_COLUMNS = (
    "id", "chain", "type", "from_address", "value_wei", "gas_used", "observed_at", "block_time"
)


def _exact_stream(spark: SparkSession, sf_dir: str, slices: int) -> tuple[ExactWindows, str]:
    """The exact stream over the feed in so many arrival slices, restarted for each.

    The feed is normalized once and stored; the slices are cut from what was stored.
    """
    events, _ = materialize(normalized(spark, sf_dir).select(*EXACT_COLUMNS), "feed")
    work = new_work_dir(spark, "stream-exact")
    job = ExactWindows(f"{work}/state", f"{work}/table", f"{work}/log", WINDOW, LATENESS)
    at = F.unix_micros("observed_at")
    lo, hi = events.agg(F.min(at), F.max(at)).first()
    edges = [] if lo is None else [lo - 1 + (hi - lo + 1) * k // slices for k in range(slices + 1)]
    events.limit(0).write.parquet(f"{work}/in")
    for start, end in zip(edges, edges[1:]):
        events.filter((at > start) & (at <= end)).write.mode("append").parquet(f"{work}/in")
        stream = stream_events(spark, f"{work}/in", schema=events.schema)
        _run_to_end(job.start(stream, f"{work}/checkpoint"))
    return job, work


@query
def stream_exact_many_batches(spark, sf_dir):
    """Five batches; closed windows from the log of emitted rows, each emitted once."""
    _, work = _exact_stream(spark, sf_dir, 5)
    return show_aggregates(spark.read.schema(S.AGGREGATE).parquet(f"{work}/log"))


@query
def stream_exact_late_counts(spark, sf_dir):
    job, _ = _exact_stream(spark, sf_dir, 3)
    return job.late_counts(spark)


@query
def stream_exact_flush(spark, sf_dir):
    """Windows that closed, and those still open when the stream ended."""
    job, work = _exact_stream(spark, sf_dir, 3)
    stored = read_table(spark, f"{work}/table").select(*S.AGGREGATE.names)
    return show_aggregates(stored.unionByName(job.flush(spark, 2)))


@query
def stream_native_metrics(spark, sf_dir):
    """The normalized feed as one micro-batch through the engine's own watermark."""
    work = new_work_dir(spark, "stream-native")
    events = normalized(spark, sf_dir).select(
        "chain", "type", "from_address", "value_wei", "gas_used", "block_time"
    )
    events.write.parquet(f"{work}/in")
    stream = stream_events(spark, f"{work}/in", schema=events.schema)
    rows = native_metrics(stream, WINDOW, LATENESS)
    _run_to_end(append_stream(rows, f"{work}/out", f"{work}/checkpoint"))
    return show_aggregates(spark.read.schema(S.AGGREGATE).parquet(f"{work}/out"))


@query
def stream_normalized(spark, sf_dir):
    """The redelivered raw feed through streaming validate, dedup and enrich."""
    work = new_work_dir(spark, "stream-normalize")
    with _only_batches_with_data(spark):
        for stream in _landed_out_of_order(spark, sf_dir, f"{work}/in"):
            _run_to_end(append_stream(normalized_stream(stream), f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out").select(
        "id", "chain", "type", "from_address", "to_address",
        labels_json(F.col("attributes")).alias("attributes"),
    )


def _by_quarter(raw: DataFrame) -> DataFrame:
    """``raw`` with ``q``, the quarter of its days of arrival."""
    quarter = F.ntile(4).over(Window.orderBy("day"))
    days = raw.select(F.to_date("observed_at").alias("day")).distinct().withColumn("q", quarter)
    # A row a day: broadcast whatever the feed's size suggests, so that no landing shuffles the feed.
    return raw.join(F.broadcast(days), F.to_date("observed_at") == F.col("day")).drop("day")


def _landed_out_of_order(spark: SparkSession, sf_dir: str, path: str) -> Iterator[DataFrame]:
    """The redelivered raw feed landing in four quarters, the oldest arrivals last.

    Gives the stream over the folder after each landing, to be run to its end
    before the next one, so a quarter may have any number of files.
    """
    raw = redelivered_feed(load_feed(spark, sf_dir)).drop("event_id")
    split = _by_quarter(raw)
    for q in (2, 3, 4, 1):
        split.filter(F.col("q") == q).drop("q").write.mode("append").parquet(path)
        yield stream_events(spark, path, schema=raw.schema)


@query
def stream_deduplicated(spark, sf_dir):
    """The same feed with rejects and seen ids: events per outcome, over all batches."""
    work = new_work_dir(spark, "stream-dedup")
    for stream in _landed_out_of_order(spark, sf_dir, f"{work}/in"):
        _run_to_end(
            normalize_with_rejects(
                stream, f"{work}/good", f"{work}/bad", f"{work}/checkpoint",
                seen_path=f"{work}/seen", counts_path=f"{work}/counts",
            )
        )
    totals = spark.read.parquet(f"{work}/counts").groupBy().agg(
        *[F.sum(c).alias(c) for c in ("received", "rejected", "kept", "suppressed")]
    )
    ids = spark.read.parquet(f"{work}/good").agg(F.count_distinct("id").alias("ids"))
    return totals.crossJoin(ids)  # one row each


@query
def stream_rejects(spark, sf_dir):
    """Good and rejected events of the raw feed, committed together per batch."""
    work = new_work_dir(spark, "stream-rejects")
    raw = load_feed(spark, sf_dir).drop("event_id")
    raw.write.parquet(f"{work}/in")
    stream = stream_events(spark, f"{work}/in", schema=raw.schema)
    _run_to_end(
        normalize_with_rejects(stream, f"{work}/good", f"{work}/bad", f"{work}/checkpoint")
    )
    good = spark.read.parquet(f"{work}/good").select(F.lit("").alias("reject_reason"))
    bad = spark.read.parquet(f"{work}/bad").select("reject_reason")
    return good.unionByName(bad).groupBy("reject_reason").agg(F.count("*").alias("events"))


@query
def stream_keyed_events(spark, sf_dir):
    """Raw events from a source chosen by name, appended as keyed records: records per key."""
    work = new_work_dir(spark, "stream-keyed")
    raw = load_feed(spark, sf_dir).drop("event_id")
    raw.write.parquet(f"{work}/in")
    stream = load_source("stream", spark, f"{work}/in", schema=raw.schema)
    _run_to_end(append_stream(keyed_events(stream), f"{work}/out", f"{work}/checkpoint"))
    records = spark.read.schema("key string, value string").parquet(f"{work}/out")
    return records.groupBy("key").agg(F.count("value").alias("events"))


@query
def stream_tail(spark, sf_dir):
    """A live tail from a start moment, filtered by chain and type."""
    work = new_work_dir(spark, "stream-tail")
    events = normalized(spark, sf_dir).drop("attributes", "event_id")
    late = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    for part in (late, ~late):  # the second half lands when the first has been read
        land_by_day(events.filter(part), f"{work}/in")
        stream = stream_by_day(spark, f"{work}/in", events.schema)
        tail = tail_events(stream, _utc(TAIL_START), chain="Solana", types=(S.TYPE_TRANSACTION,))
        _run_to_end(append_stream(tail.drop(ARRIVAL_DAY), f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out").select("id", "from_address", _stamp("observed_at"))
