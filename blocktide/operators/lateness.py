"""Exact late-event handling with one watermark per chain, as set operations.

Semantics, in arrival order per chain: the watermark is the largest
``block_time`` so far; a non-empty window closes as soon as its end is at or
behind ``watermark - lateness``; an event is late when a window with the same
or a later end has closed before it arrived. None of this needs a sequential
pass. With ``seq`` the arrival key and, per chain,

* ``first(e)``: smallest seq among events whose window ends at ``e``,
* ``reach(e)``: smallest seq with ``block_time - lateness >= e``,
* ``close(e) = max(first(e), reach(e))``, when window ``e`` closes,
* ``min_close(e)``: smallest ``close`` over all ends ``>= e``,

an event of window ``e`` is late exactly when ``min_close(e) < seq``.

Work is done on a *ledger* with one row per (chain, window end, reach bucket),
built in a single aggregation over the events. Only windows that really hold a
late event (*contested* ones) are joined back to the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.functions.timebucket import (
    Duration,
    bucket_start_us,
    lateness_micros,
    window_micros,
)
from blocktide.operators.window_metrics import (
    long_metrics,
    wide_metrics,
    with_window_end,
)
from blocktide.session import materialize

DEFAULT_ARRIVAL = ("observed_at", "id")

# Window-level tables up to this many rows (some tens of MB) may be broadcast
# or scanned per chain in one task; larger ones take the partitioned path.
SMALL_ROWS = 200_000
# Windows with at least this many events count as hot in the partitioned path.
HOT_EVENTS = 5_000_000
# Window slots per block of the two-level scan.
BLOCK_WINDOWS = 4096


def arrival_key(arrival: Sequence[str] = DEFAULT_ARRIVAL) -> Column:
    """Orderable arrival position; must be unique per event for exact ties.

    A single numeric column keeps the ledger on hash aggregation; several
    columns compare as a struct.
    """
    return F.col(arrival[0]) if len(arrival) == 1 else F.struct(*arrival)


def build_ledger(events: DataFrame, size_us: int, lateness_us: int, seq: Column) -> DataFrame:
    """``(chain, we, rb, first_seq, last_seq, max_t, n)`` from events with ``we``.

    ``rb`` is the largest window end the event itself reaches.
    """
    t = F.unix_micros("block_time")
    return (
        events.select(
            "chain",
            "we",
            bucket_start_us(t - F.lit(lateness_us), size_us).alias("rb"),
            t.alias("t"),
            seq.alias("seq"),
        )
        .groupBy("chain", "we", "rb")
        .agg(
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
            F.max("t").alias("max_t"),
            F.count("*").alias("n"),
        )
    )


def window_points(ledger: DataFrame) -> DataFrame:
    """What the ledger says about each (chain, e); several rows per end (``merge_points``)."""
    none = F.lit(None)
    seq_type = ledger.schema["first_seq"].dataType
    point = F.inline(
        F.array(
            F.struct(
                F.col("we").alias("e"),
                F.col("first_seq").alias("first"),
                F.col("last_seq").alias("last"),
                none.cast(seq_type).alias("reach"),
                F.col("n").alias("n"),
            ),
            F.struct(
                F.col("rb").alias("e"),
                none.cast(seq_type).alias("first"),
                none.cast(seq_type).alias("last"),
                F.col("first_seq").alias("reach"),
                F.lit(0).cast("bigint").alias("n"),
            ),
        )
    )
    return ledger.select("chain", point)


def merge_points(points: DataFrame, small: bool) -> DataFrame:
    """One row per (chain, e). A small table is laid out by chain at once, which
    the per-chain scans that follow can use without another exchange."""
    if small:
        points = points.repartition("chain")
    return points.groupBy("chain", "e").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("reach").alias("reach"),
        F.sum("n").alias("n"),
    )


def running_min_from_end(points: DataFrame, value: str, size_us: int, small: bool) -> DataFrame:
    """Replace ``value`` by its minimum over this and all later ends of the chain.

    Small tables take one window per chain. Large ones are scanned in blocks
    of consecutive window slots: a minimum per block, a scan over the few
    block minima, and a scan inside each block, so no task ever holds a whole
    chain.
    """
    if small:
        whole = (
            Window.partitionBy("chain")
            .orderBy(F.col("e").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return points.withColumn(value, F.min(value).over(whole))

    slot = F.call_function("div", F.col("e"), F.lit(size_us * BLOCK_WINDOWS))
    blocked = points.withColumn("blk", slot)
    later = (
        Window.partitionBy("chain")
        .orderBy(F.col("blk").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        blocked.groupBy("chain", "blk")
        .agg(F.min(value).alias("m"))
        .select("chain", "blk", F.min("m").over(later).alias("carry"))
    )
    inside = (
        Window.partitionBy("chain", "blk")
        .orderBy(F.col("e").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        blocked.withColumn(value, F.min(value).over(inside))
        .join(carry, ["chain", "blk"], "left")
        .withColumn(value, F.least(value, "carry"))
        .drop("blk", "carry")
    )


def close_points(points: DataFrame, size_us: int, small: bool) -> DataFrame:
    """``(chain, e, first, last, n, close, min_close)`` for every end."""
    reached = running_min_from_end(points, "reach", size_us, small)
    closed = reached.withColumn(
        "close",
        F.when(
            F.col("first").isNotNull() & F.col("reach").isNotNull(),
            F.greatest("first", "reach"),
        ),
    ).withColumn("min_close", F.col("close"))
    return running_min_from_end(closed, "min_close", size_us, small).drop("reach")


def verdicts(points: DataFrame, *extra: str) -> DataFrame:
    """``(chain, we, min_close, closed, n, *extra)``; ``min_close`` only for contested windows.

    A window is contested when its last arrival is past a close, that is when
    it has at least one late event.
    """
    return points.filter(F.col("first").isNotNull()).select(
        "chain",
        F.col("e").alias("we"),
        F.when(F.col("min_close") < F.col("last"), F.col("min_close")).alias("min_close"),
        F.col("close").isNotNull().alias("closed"),
        "n",
        *extra,
    )


def is_late(seq: Column) -> Column:
    return F.col("min_close").isNotNull() & (F.col("min_close") < seq)


def with_verdicts(events: DataFrame, windows: DataFrame, seq: Column) -> DataFrame:
    """Events with ``is_late`` and ``closed``; ``windows`` was counted to be small."""
    table = F.broadcast(windows.select("chain", "we", "min_close", "closed"))
    joined = events.join(table, ["chain", "we"], "left")
    return joined.withColumn("is_late", is_late(seq)).drop("min_close")


def flag_late(
    events: DataFrame, contested: DataFrame, seq: Column, hot_events: int = HOT_EVENTS
) -> DataFrame:
    """Add ``is_late`` where the contested windows are too many to broadcast.

    Hot windows are counted and broadcast (each holds ``hot_events`` rows or
    more, so there are few), and the rest meet in a shuffle join in which no key is
    hot; events of hot windows get a scattered key that matches nothing there.
    """
    hot, n_hot = materialize(
        contested.filter(F.col("n") >= hot_events).select(
            "chain", "we", F.col("min_close").alias("hot_close")
        ),
        "hot",
    )
    if n_hot > SMALL_ROWS:
        raise ValueError(f"{n_hot} windows hold {hot_events} events or more; raise hot_events")
    cold = contested.filter(F.col("n") < hot_events).select(
        F.col("chain").alias("cold_chain"), F.col("we").alias("cold_we"), "min_close"
    )
    scattered = F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string"))
    key = F.when(F.col("hot_close").isNull(), F.col("chain")).otherwise(scattered)
    joined = (
        events.join(F.broadcast(hot), ["chain", "we"], "left")
        .withColumn("cold_key", key)
        .join(
            cold,
            (F.col("cold_key") == F.col("cold_chain")) & (F.col("we") == F.col("cold_we")),
            "left",
        )
        .withColumn("min_close", F.coalesce("hot_close", "min_close"))
    )
    return joined.withColumn("is_late", is_late(seq)).drop(
        "hot_close", "cold_key", "cold_chain", "cold_we", "min_close"
    )


class Replay:
    """Exact close and late verdicts for a static table of valid events.

    Building one runs a single job over the events (the ledger). Up to
    ``small_rows`` ledger rows, the verdicts of all windows are broadcast to
    the events; beyond that only contested windows are looked up, by broadcast
    if they were counted to be few and by ``flag_late`` otherwise. Events that
    share an arrival key are taken as simultaneous.
    """

    def __init__(
        self,
        events: DataFrame,
        size: Duration = S.DEFAULT_WINDOW,
        lateness: Duration = S.DEFAULT_LATENESS,
        arrival: Sequence[str] = DEFAULT_ARRIVAL,
        small_rows: int = SMALL_ROWS,
        hot_events: int = HOT_EVENTS,
    ):
        self.size_us = window_micros(size)
        self.seq = arrival_key(arrival)
        events = with_window_end(events, self.size_us)
        ledger, rows = materialize(
            build_ledger(events, self.size_us, lateness_micros(lateness), self.seq), "ledger"
        )
        self.small = rows <= small_rows
        points = merge_points(window_points(ledger), self.small)
        windows = verdicts(close_points(points, self.size_us, self.small))
        if self.small:
            self.windows = windows
            self._flagged = with_verdicts(events, windows, self.seq)
            return
        self.windows, _ = materialize(windows, "verdicts")
        contested, rows = materialize(
            self.windows.filter(F.col("min_close").isNotNull()), "contested"
        )
        if rows <= small_rows:
            self._flagged = with_verdicts(events, contested, self.seq)
        else:
            self._flagged = flag_late(events, contested, self.seq, hot_events)

    def flagged(self) -> DataFrame:
        """Events plus ``is_late``."""
        return self._flagged.drop("we", "closed")

    def accepted(self) -> DataFrame:
        """Events that count, with their window end ``we``."""
        return self._flagged.filter(~F.col("is_late"))

    def metrics(self, flush: bool = False) -> DataFrame:
        """Aggregate rows of windows closed by the watermark; with ``flush`` of all."""
        if flush:
            return long_metrics(wide_metrics(self.accepted()), self.size_us)
        if self.small:
            wide = wide_metrics(self.accepted().filter("closed"))
        else:
            # Keys are unique on both sides; an inner join stays above the aggregation.
            closed = self.windows.filter("closed").select("chain", "we")
            wide = wide_metrics(self.accepted()).join(closed, ["chain", "we"])
        return long_metrics(wide, self.size_us)
