"""Event filter, aggregate range filter and the record key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FOLDED = "chain_folded"


def write_filterable(events: DataFrame, path: str) -> None:
    """Append normalized events to a table laid out for ``filter_events``.

    A folder for each chain, without case, so that others are never listed. Within
    one, rows are dealt by ranges of the sender and sorted by it, so row groups are skipped by
    their range, and both addresses have Bloom filters, which tell of nearly all others
    that they cannot hold an address.
    """
    folded = events.withColumn(FOLDED, F.lower("chain"))
    rows = folded.repartitionByRange(FOLDED, "from_address", F.xxhash64("id"))
    writer = rows.sortWithinPartitions(FOLDED, "from_address").write.mode("append").partitionBy(FOLDED)
    for column in ("from_address", "to_address"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def _same_text(column: str, text: str) -> Column:
    return F.lower(F.col(column)) == F.lower(F.lit(text))


def filter_events(
    events: DataFrame,
    chain: str = "",
    types: Iterable[str] = (),
    address: str = "",
    normalized: bool = False,
) -> DataFrame:
    """Events matching every given criterion; an unset one adds no predicate.

    Chain and address compare without case; the address may be either end.
    ``normalized`` says that stored addresses are lower-case, as ``enrich`` leaves
    them: then the bare columns are compared, which reaches the Parquet scan, and
    so is a column ``chain_folded``, if there is one (``write_filterable``).
    """
    if chain and normalized and FOLDED in events.columns:
        events = events.filter(F.col(FOLDED) == chain.lower())
    elif chain:
        events = events.filter(_same_text("chain", chain))
    types = list(types)
    if types:
        events = events.filter(F.col("type").isin(types))
    if address and normalized:
        wanted = address.lower()
        events = events.filter(
            (F.col("from_address") == wanted) | (F.col("to_address") == wanted)
        )
    elif address:
        events = events.filter(
            _same_text("from_address", address) | _same_text("to_address", address)
        )
    return events


def filter_aggregates(
    aggregates: DataFrame,
    chain: str = "",
    metric: str = "",
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> DataFrame:
    """Rows with ``since <= window_start < until``; chain and metric match exactly.

    A table partitioned by ``window_date`` gets the matching date predicate,
    so whole days outside the range are never listed.
    """
    if chain:
        aggregates = aggregates.filter(F.col("chain") == chain)
    if metric:
        aggregates = aggregates.filter(F.col("metric") == metric)
    partitioned = "window_date" in aggregates.columns
    if since is not None:
        aggregates = aggregates.filter(F.col("window_start") >= F.lit(since))
        if partitioned:
            aggregates = aggregates.filter(F.col("window_date") >= F.lit(_utc_date(since)))
    if until is not None:
        aggregates = aggregates.filter(F.col("window_start") < F.lit(until))
        if partitioned:
            aggregates = aggregates.filter(F.col("window_date") <= F.lit(_utc_date(until)))
    return aggregates


def _utc_date(moment: dt.datetime) -> dt.date:
    # A naive moment is local wall time, the way F.lit() reads it.
    return moment.astimezone(dt.timezone.utc).date()


def partition_key() -> Column:
    """Sender, else block hash, else chain: the first that is not empty."""
    return F.coalesce(
        F.nullif(F.col("from_address"), F.lit("")),
        F.nullif(F.col("block_hash"), F.lit("")),
        F.col("chain"),
    )
