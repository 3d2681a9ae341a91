"""Suppression of events whose id was seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocktide.functions.timebucket import Duration, micros, time_bucket

DEFAULT_ARRIVAL = ("observed_at",)
#: Bits of the filter of ids that come again, a power of two: 16 MB in all.
AGAIN_BITS = 1 << 27
AGAIN = "bucket long, map binary"


def first_seen(events: DataFrame, arrival: Sequence[str] = DEFAULT_ARRIVAL) -> DataFrame:
    """First row per id in arrival order.

    ``rank = 1`` over a window is trimmed per input partition before the
    shuffle, so an id that holds a large share of all rows leaves each map
    task as a single row. Rows that tie on ``arrival`` are told apart by
    their content, which keeps the result independent of the partitioning.
    """
    columns = events.columns
    content = F.xxhash64(
        *[
            F.map_entries(c) if dtype.startswith("map") else F.col(c)
            for c, dtype in events.dtypes
        ]
    )
    order = Window.partitionBy("id").orderBy(*arrival, "_content")
    return (
        events.withColumn("_content", content)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .select(*columns)
    )


def dropped_per_interval(events: DataFrame, interval: Duration = "1 minute") -> DataFrame:
    """Suppressed rows per interval of arrival: ``(bucket, dropped)``.

    Rows minus first sightings, so only one timestamp per id is shuffled and
    both counts combine before the exchange.
    """
    bucket = time_bucket(F.col("observed_at"), interval).alias("bucket")
    firsts = events.groupBy("id").agg(F.min("observed_at").alias("observed_at"))
    rows = events.groupBy(bucket).agg(F.count("*").alias("n"))
    seen = firsts.groupBy(bucket).agg((-F.count("*")).alias("n"))
    return (
        rows.unionByName(seen)
        .groupBy("bucket")
        .agg(F.sum("n").alias("dropped"))
        .filter(F.col("dropped") > 0)
    )


def drop_redelivered(stream: DataFrame, remember: Duration | None = "1 day") -> DataFrame:
    """Streaming form: an id that came before is dropped.

    An id is remembered for ``remember`` from the moment it was processed, and then
    leaves the state. That clock only goes forward, so no event is ever dropped
    for being old, and neither arrival time nor event time matters, null or not.
    With None every id is kept for ever. Either state belongs in a disk-backed state store.
    """
    if remember is None:
        return stream.dropDuplicates(["id"])
    landed = stream.withColumn("_landed_at", F.current_timestamp())
    clock = landed.withWatermark("_landed_at", f"{micros(remember)} microseconds")
    return clock.dropDuplicatesWithinWatermark(["id"]).drop("_landed_at")


def seen_keys(events: DataFrame) -> DataFrame:
    """What is remembered of an event: the 128-bit digest of its id, and its arrival."""
    return events.select(F.unhex(F.md5("id")).alias("key"), "observed_at")


def unseen(
    firsts: DataFrame, seen: DataFrame, horizon: Duration, small: bool = False
) -> DataFrame:
    """Rows of ``firsts`` (one per id) whose id is not among ``seen`` (see ``seen_keys``).

    ``horizon`` says how far apart in arrival time repeats are recognised. It is
    no lateness limit: an id that was not seen passes however old it is. Where an
    arrival is not known, on either side, it is taken as within the horizon.
    With ``small``, ``firsts`` was counted to be few: then its keys go to the
    seen ones, which are not shuffled.
    """
    keyed = firsts.withColumn("_key", F.unhex(F.md5("id")))
    known = seen.select(F.col("key").alias("_key"), F.col("observed_at").alias("_at"))
    if small:
        known = F.broadcast(known.join(F.broadcast(keyed.select("_key")), "_key", "left_semi"))
    apart = F.abs(F.unix_micros(keyed["observed_at"]) - F.unix_micros("_at"))
    near = F.coalesce(apart <= micros(horizon), F.lit(True))
    same = (keyed["_key"] == known["_key"]) & near
    return keyed.join(known, same, "left_anti").drop("_key")


def _place(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(AGAIN_BITS - 1)) + 1


def ids_again(events: DataFrame, seen: DataFrame) -> DataFrame:
    """A filter, as bitmaps ``(bucket, map)``, of the ids that ``events`` hold more than once
    or that are among ``seen``. It misses none; of the others it lets a few through.

    Only a hash and two counts per id are shuffled; the filter has AGAIN_BITS at most.
    """
    new = events.select(F.xxhash64(F.unhex(F.md5("id"))).alias("h"), F.lit(1).alias("n"), F.lit(0).alias("old"))
    old = seen.select(F.xxhash64("key").alias("h"), F.lit(0).alias("n"), F.lit(1).alias("old"))
    again = (
        new.unionByName(old)
        .groupBy("h")
        .agg(F.sum("n").alias("n"), F.max("old").alias("old"))
        .filter("n > 1 OR n = 1 AND old = 1")
    )
    place = F.col("h").bitwiseAND(F.lit(AGAIN_BITS - 1)) + 1
    return again.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map")
    )


def _marked(rows: DataFrame, key: Column, again: DataFrame) -> DataFrame:
    """``rows`` with ``_again``: whether the filter knows their key."""
    placed = rows.withColumn("_place", _place(key))
    found = placed.join(F.broadcast(again), F.bitmap_bucket_number("_place") == F.col("bucket"), "left")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("map", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (bit % 8).cast("int")) == 1
    return found.withColumn("_again", F.coalesce(is_set, F.lit(False))).drop("_place", "bucket", "map")


def first_unseen(events: DataFrame, seen: DataFrame, again: DataFrame, horizon: Duration) -> DataFrame:
    """``unseen(first_seen(events), seen, horizon)``; only events whose id comes again, by
    ``again`` (the stored filter of ``ids_again``), are shuffled, the others pass as they are."""
    columns = events.columns
    marked = _marked(events, F.unhex(F.md5("id")), again)
    known = _marked(seen, F.col("key"), again).filter("_again").drop("_again")
    repeats = marked.filter("_again").select(*columns)
    return marked.filter(~F.col("_again")).select(*columns).unionByName(
        unseen(first_seen(repeats), known, horizon)
    )
