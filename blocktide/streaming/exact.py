"""Exact per-chain lateness on a stream, micro-batch by micro-batch.

Each batch runs the set-based close rule of ``operators.lateness`` over its
own events plus a carried state:

* ``chains``: watermark and last closed end per chain, written anew by each batch,
* ``windows``: windows that were opened,
* ``partials``: sums per window and sender of accepted events,
* ``late``: late and accepted events per chain.

The last three are logs (``LogState``): a batch appends what it adds, and reads
them by what is still open, so what it writes follows its own events and not the
windows that are open. Rows of closed windows leave when a log is merged, which costs each
row a bounded number of times; the state follows the open windows, not the batches.

State lives in the shared folder. Batch N reads what earlier batches wrote and replaces only
what it wrote itself, so a retried batch gives the same result, and losing executors
costs nothing but a task rerun. The events of a batch are read three times (ledger,
late counts, partials); all other work is on one row per window, or on the partials
of the windows that close.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from blocktide import schemas as S
from blocktide.functions import wei
from blocktide.functions.timebucket import (
    Duration,
    bucket_start_us,
    lateness_micros,
    window_micros,
)
from blocktide.operators.lateness import (
    DEFAULT_ARRIVAL,
    SMALL_ROWS,
    build_ledger,
    close_points,
    flag_late,
    merge_points,
    verdicts,
    window_points,
    with_verdicts,
)
from blocktide.operators.stats import late_counts
from blocktide.operators.window_metrics import (
    COUNTS,
    event_sums,
    long_metrics,
    measures,
    merge_sums,
    with_window_end,
)
from blocktide.session import delete_path, path_exists
from blocktide.sinks.aggregates_table import upsert_aggregates
from blocktide.sinks.records import write_batch
from blocktide.streaming.logstate import LogState

CHAINS = T.StructType(
    [
        T.StructField("chain", T.StringType()),
        T.StructField("watermark", T.LongType()),
        T.StructField("closed_up_to", T.LongType()),
    ]
)
WINDOWS = T.StructType(
    [
        T.StructField("chain", T.StringType()),
        T.StructField("we", T.LongType()),
    ]
)
_DECIMAL = T.DecimalType(38, 0)
PARTIALS = T.StructType(
    [
        T.StructField("chain", T.StringType()),
        T.StructField("we", T.LongType()),
        T.StructField("from_address", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in (*COUNTS, "n_events")],
        T.StructField("gas_used", _DECIMAL),
        *[T.StructField(name, _DECIMAL) for name in wei.PARTS if name != "wei_beyond"],
        T.StructField("wei_beyond", T.DoubleType()),
    ]
)
LATE = T.StructType(
    [
        T.StructField("chain", T.StringType()),
        T.StructField("late", T.LongType()),
        T.StructField("accepted", T.LongType()),
    ]
)
KEYS = ("chain", "we", "from_address")


def _summed(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*KEYS).agg(*merge_sums())


def _counted(late: DataFrame) -> DataFrame:
    return late.groupBy("chain").agg(F.sum("late").alias("late"), F.sum("accepted").alias("accepted"))


class ExactWindows:
    """Window close rule over a stream; give ``process`` to ``foreachBatch``.

    Closed windows go to the aggregates table (upsert) and then to the log of
    emitted rows, both before the batch is committed.
    """

    def __init__(
        self,
        state_path: str,
        table_path: str,
        log_path: str | None = None,
        size: Duration = S.DEFAULT_WINDOW,
        lateness: Duration = S.DEFAULT_LATENESS,
        arrival: Sequence[str] = DEFAULT_ARRIVAL,
        small_rows: int = SMALL_ROWS,
    ):
        self.state_path = state_path
        #: Names stages and log folders, so that another stream's are never mistaken for ours.
        self.run = hashlib.sha256(state_path.encode()).hexdigest()[:16]
        self.table_path = table_path
        self.log_path = log_path
        self.size_us = window_micros(size)
        self.lateness_us = lateness_micros(lateness)
        self.arrival = tuple(arrival)
        self.small_rows = small_rows
        # Sorted by window, so that row groups of other windows are skipped.
        self.partials = LogState(f"{state_path}/partials", PARTIALS, merge=_summed, order=("we",))
        self.windows = LogState(f"{state_path}/windows", WINDOWS)
        self.late = LogState(f"{state_path}/late", LATE, merge=_counted)
        self._session: SparkSession | None = None

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> DataStreamWriter:
        # A running stream's own session plans without adaptive execution; work
        # on written state goes through the session the stream was built in.
        self._session = events.sparkSession
        writer = events.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", checkpoint
        )
        return writer.trigger(**trigger) if trigger else writer

    # -- state folders -------------------------------------------------------

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.state_path}/{kind}/batch={batch_id}"

    def _read(
        self, spark: SparkSession, kind: str, batch_id: int, schema: T.StructType
    ) -> DataFrame:
        """State of one batch; empty before the first batch, an error if missing later."""
        if batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._folder(kind, batch_id))

    def _open(self, spark: SparkSession, batch_id: int):
        """Keeps the rows (chain, we, ...) of windows that are open after ``batch_id``:
        those behind the last closed end, since all windows up to it have closed."""
        closed = self._read(spark, "chains", batch_id, CHAINS).filter("closed_up_to IS NOT NULL")
        passed = closed.select(F.col("chain").alias("_chain"), "closed_up_to")
        gone = (F.col("chain") == F.col("_chain")) & (F.col("we") <= F.col("closed_up_to"))
        return lambda rows: rows.join(F.broadcast(passed), gone, "left_anti")

    # -- one micro-batch -----------------------------------------------------

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = self._session or batch.sparkSession
        events = with_window_end(batch, self.size_us).persist()
        try:
            self._advance(events, spark, batch_id)
        finally:
            events.unpersist()
        self._emit(spark, batch_id)
        still_open = self._open(spark, batch_id)
        self.partials.compact(spark, batch_id, still_open)
        self.windows.compact(spark, batch_id, still_open)
        self.late.compact(spark, batch_id)
        self._forget(spark, batch_id)

    def _advance(self, events: DataFrame, spark: SparkSession, batch_id: int) -> None:
        chains = self._read(spark, "chains", batch_id - 1, CHAINS)
        windows = self._open(spark, batch_id - 1)(self.windows.read(spark, batch_id - 1))

        # Everything carried over (phase 0) precedes the events of this batch.
        types = dict(events.select(*self.arrival).dtypes)
        seq = F.struct(F.lit(1).alias("phase"), *self.arrival)
        before = F.struct(
            F.lit(0).alias("phase"), *[F.lit(None).cast(types[c]).alias(c) for c in self.arrival]
        )
        found = build_ledger(events, self.size_us, self.lateness_us, seq)
        self._write(found, "ledger", batch_id)
        ledger = self._read(spark, "ledger", batch_id, found.schema)
        pieces = self._pieces(ledger, chains, windows, before)
        small = pieces.count() <= self.small_rows
        points = close_points(merge_points(pieces, small), self.size_us, small)
        # Windows at or behind the last closed end are late whatever the batch holds.
        cut = chains.select("chain", "closed_up_to")
        gone = F.coalesce(F.col("e") <= F.col("closed_up_to"), F.lit(False))
        points = points.join(cut, "chain", "left").withColumns(
            {
                "min_close": F.when(gone, before).otherwise(F.col("min_close")),
                "close": F.when(~gone, F.col("close")),
                "fresh": F.col("first.phase") == 1,
            }
        )
        windows_now = verdicts(points, "fresh")
        # Of windows that stay open without an event of this batch there is nothing to say.
        self._write(windows_now.filter("closed OR n > 0"), "verdicts", batch_id)
        judged = self._read(spark, "verdicts", batch_id, windows_now.schema)

        contested = self._read(events.sparkSession, "verdicts", batch_id, windows_now.schema)
        if not small:
            contested = contested.filter(F.col("min_close").isNotNull())
        if small or contested.count() <= self.small_rows:
            flagged = with_verdicts(events, contested, seq)
        else:
            flagged = flag_late(events, contested, seq)
        accepted = flagged.filter(~F.col("is_late"))
        self.late.append(late_counts(flagged), batch_id)
        self.partials.append(measures(accepted).groupBy(*KEYS).agg(*event_sums()), batch_id)

        # A window held back by its cut has the carried position as its close.
        cut_off = F.coalesce(F.col("min_close.phase") == 0, F.lit(False))
        self.windows.append(judged.filter(~F.col("closed") & ~cut_off & F.col("fresh")), batch_id)
        none = F.lit(None).cast("bigint")
        seen = ledger.select("chain", F.col("max_t").alias("watermark"), none.alias("closed_up_to"))
        closed = judged.filter("closed").select(
            "chain", none.alias("watermark"), F.col("we").alias("closed_up_to")
        )
        self._write(
            seen.unionByName(closed)
            .unionByName(chains)
            .groupBy("chain")
            .agg(F.max("watermark").alias("watermark"), F.max("closed_up_to").alias("closed_up_to")),
            "chains",
            batch_id,
        )

    def _pieces(
        self, ledger: DataFrame, chains: DataFrame, windows: DataFrame, before: Column
    ) -> DataFrame:
        """The batch's ledger points plus those of the carried state."""
        none = F.lit(None).cast(ledger.schema["first_seq"].dataType)
        zero = F.lit(0).cast("bigint").alias("n")
        reached = bucket_start_us(F.col("watermark") - F.lit(self.lateness_us), self.size_us)
        opened = windows.select(
            "chain", F.col("we").alias("e"), before.alias("first"), none.alias("last"),
            none.alias("reach"), zero,
        )
        passed = chains.select(
            "chain", reached.alias("e"), none.alias("first"), none.alias("last"),
            before.alias("reach"), zero,
        )
        return window_points(ledger).unionByName(opened).unionByName(passed)

    def _write(self, df: DataFrame, kind: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(kind, batch_id))

    # -- emission ------------------------------------------------------------

    def _rows(self, spark: SparkSession, windows: DataFrame, batch_id: int) -> DataFrame:
        """Aggregate rows of the given windows from the partials of ``batch_id``."""
        keys = windows.select("chain", "we")
        first, last = keys.agg(F.min("we"), F.max("we")).first()
        partials = self.partials.read(spark, batch_id).filter(F.col("we").between(first, last))
        wide = (
            _summed(partials.join(keys, ["chain", "we"], "left_semi"))
            .groupBy("chain", "we")
            .agg(*merge_sums(), F.count("from_address").alias("n_addresses"))
        )
        return long_metrics(wide, self.size_us)

    def _emit(self, spark: SparkSession, batch_id: int) -> None:
        closed = spark.read.parquet(self._folder("verdicts", batch_id)).filter("closed")
        if closed.isEmpty():
            return
        self._write(self._rows(spark, closed, batch_id), "emitted", batch_id)
        emitted = self._read(spark, "emitted", batch_id, S.AGGREGATE)
        upsert_aggregates(emitted, self.table_path, batch_id, stored=True, run=self.run)
        if self.log_path:
            write_batch(emitted, f"{self.log_path}/run={self.run}", batch_id)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Drop state that neither the next batch nor a retry of this one can read."""
        gone = batch_id - 2
        if gone < 0:
            return
        for kind in ("ledger", "verdicts", "emitted", "chains"):
            folder = self._folder(kind, gone)
            if path_exists(spark, folder):
                delete_path(spark, folder)

    def late_counts(self, spark: SparkSession) -> DataFrame:
        """Late and accepted events per chain so far, each batch counted once."""
        return _counted(self.late.read(spark, self.late.latest(spark)))

    # -- end of stream -------------------------------------------------------

    def flush(self, spark: SparkSession, last_batch: int) -> DataFrame:
        """Aggregate rows of the windows still open after ``last_batch``.

        For a stream that has ended. The state is left as it is; storing the
        rows and then resuming the stream would replace them window by window.
        """
        still_open = self._open(spark, last_batch)(self.windows.read(spark, last_batch))
        return self._rows(spark, still_open, last_batch)


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
