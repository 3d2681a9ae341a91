"""Event validation: the first failing check names the reject reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide import schemas as S


def _missing(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def reject_reason(columns: list[str] | None = None) -> Column:
    """NULL for a good event, else the reason.

    Missing text and NULL mean the same. A record the reader could not decode
    carries its text in ``_corrupt_record`` and is rejected before any other
    check, as is a type outside the closed enum.
    """
    reason = F
    if columns and "_corrupt_record" in columns:
        reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit(S.REASON_UNDECODABLE))
    return (
        reason.when(_missing("id"), F.lit(S.REASON_MISSING_ID))
        .when(_missing("chain"), F.lit(S.REASON_MISSING_CHAIN))
        .when(
            _missing("type") | (F.col("type") == S.TYPE_UNSPECIFIED),
            F.lit(S.REASON_UNSPECIFIED_TYPE),
        )
        .when(~F.col("type").isin(*S.EVENT_TYPES), F.lit(S.REASON_UNDECODABLE))
        .when(F.col("block_time").isNull(), F.lit(S.REASON_MISSING_BLOCK_TIME))
        .when(
            (F.col("type") == S.TYPE_TRANSACTION) & _missing("tx_hash"),
            F.lit(S.REASON_MISSING_TX_HASH),
        )
    )


def with_reject_reason(events: DataFrame) -> DataFrame:
    return events.withColumn("reject_reason", reject_reason(events.columns))


def valid_events(events: DataFrame) -> DataFrame:
    """Events that pass every check, without helper columns.

    The same rule as ``reject_reason``, as plain conditions that a Parquet
    scan can take over.
    """
    is_tx = F.col("type") == S.TYPE_TRANSACTION
    accepted = [t for t in S.EVENT_TYPES if t != S.TYPE_UNSPECIFIED]
    if "_corrupt_record" in events.columns:
        events = events.filter(F.col("_corrupt_record").isNull())
    return (
        events.filter(F.col("id") != "")
        .filter(F.col("chain") != "")
        .filter(F.col("type").isin(*accepted))
        .filter(F.col("block_time").isNotNull())
        .filter(~is_tx | (F.col("tx_hash") != ""))
        .drop("_corrupt_record")
    )


def rejected_events(events: DataFrame) -> DataFrame:
    return with_reject_reason(events).filter(F.col("reject_reason").isNotNull())
