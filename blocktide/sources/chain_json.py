"""Events from landed chain JSON: block heads and block bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.functions.hexnum import (
    hex_to_decimal_string,
    hex_to_timestamp,
    hex_to_uint64,
)


def event_id(chain: str, hash_column: Column) -> Column:
    return F.concat(F.lit(f"evt:{chain}:"), hash_column)


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def parse_heads(landed: DataFrame) -> DataFrame:
    """``(number, hash, block_time, observed_at)`` from ``(value, observed_at)``.

    A head with no readable number is dropped here (see ``bad_heads``). An
    unreadable timestamp falls back to the arrival time. Redelivered heads
    collapse to their first arrival before anything is joined.
    """
    return (
        decoded_heads(landed)
        .filter(F.col("number").isNotNull())
        .groupBy("number", "hash")
        .agg(F.min("observed_at").alias("observed_at"), F.min("stamp").alias("stamp"))
        .select(
            "number",
            "hash",
            F.coalesce(hex_to_timestamp(F.col("stamp")), "observed_at").alias("block_time"),
            "observed_at",
        )
    )


def bad_heads(landed: DataFrame) -> DataFrame:
    return decoded_heads(landed).filter(F.col("number").isNull()).select("value", "observed_at")


def decoded_heads(landed: DataFrame) -> DataFrame:
    return landed.withColumn("h", F.from_json("value", S.CHAIN_HEAD)).select(
        "value",
        "observed_at",
        hex_to_uint64(F.col("h.number")).alias("number"),
        _text(F.col("h.hash")).alias("hash"),
        F.col("h.timestamp").alias("stamp"),
    )


def keyed_bodies(landed: DataFrame) -> DataFrame:
    """``(number, body_hash, transactions, observed_at)`` of every readable body.

    ``body_hash`` is empty where the body does not carry its own hash.
    """
    return (
        landed.withColumn("b", F.from_json("value", S.CHAIN_BLOCK))
        .select(
            hex_to_uint64(F.col("b.number")).alias("number"),
            _text(F.col("b.hash")).alias("body_hash"),
            "b.transactions",
            "observed_at",
        )
        .filter(F.col("number").isNotNull())
    )


def parse_blocks(landed: DataFrame) -> DataFrame:
    """``(number, body_hash, transactions)``: the first landed body of each block."""
    return (
        keyed_bodies(landed)
        .groupBy("number", "body_hash")
        .agg(F.min_by("transactions", "observed_at").alias("transactions"))
    )


def _event_row(type_name: str, chain: str, **columns: Column) -> list[Column]:
    blank = F.lit("")
    row = {
        "id": event_id(chain, columns["hash"]),
        "chain": F.lit(chain),
        "type": F.lit(type_name),
        "block_number": F.col("number"),
        "block_hash": F.col("block_hash"),
        "tx_hash": columns.get("tx_hash", blank),
        "from_address": columns.get("from_address", blank),
        "to_address": columns.get("to_address", blank),
        "value_wei": columns.get("value_wei", blank),
        "gas_used": F.lit(0).cast("decimal(20,0)"),
        "observed_at": F.col("observed_at"),
        "block_time": F.col("block_time"),
        "attributes": F.create_map().cast("map<string,string>"),
    }
    return [column.alias(name) for name, column in row.items()]


def block_event_row(chain: str) -> list[Column]:
    """The columns of a BLOCK event, from a head's ``block_hash``, number and times."""
    return _event_row(S.TYPE_BLOCK, chain, hash=F.col("block_hash"))


def transaction_events(matched: DataFrame, chain: str) -> DataFrame:
    """One TRANSACTION event per transaction of heads that have their body's list."""
    listed = matched.select(
        "number", "block_hash", "block_time", "observed_at", F.explode("transactions").alias("tx")
    )
    tx_hash = _text(F.col("tx.hash"))
    return listed.select(
        *_event_row(
            S.TYPE_TRANSACTION,
            chain,
            hash=tx_hash,
            tx_hash=tx_hash,
            from_address=_text(F.col("tx.from")),
            to_address=_text(F.col("tx.to")),
            value_wei=F.coalesce(hex_to_decimal_string(_text(F.col("tx.value"))), F.lit("0")),
        )
    )


def decode_blocks(
    heads: DataFrame,
    blocks: DataFrame | None = None,
    chain: str = "ethereum",
    fetch_bodies: bool = True,
) -> DataFrame:
    """One BLOCK event per head and one TRANSACTION event per transaction.

    Both inputs are landed JSON ``(value, observed_at)``. A transaction takes
    number, hash and times from its head. Gas is not part of a block body and
    stays 0. Repeated ids are left for the dedup step. ``streaming.decode`` does
    the same for streams.
    """
    parsed = parse_heads(heads).withColumnRenamed("hash", "block_hash")
    block_events = parsed.select(*block_event_row(chain))
    if not fetch_bodies or blocks is None:
        return block_events
    # A head takes the body with its own hash, and one that names only the number.
    keyed = parsed.withColumn(
        "body_hash", F.explode(F.array_distinct(F.array("block_hash", F.lit(""))))
    )
    matched = keyed.join(parse_blocks(blocks), ["number", "body_hash"])
    return block_events.unionByName(transaction_events(matched, chain))
