"""The driver's generic ``events`` table seen as a chain-event feed.

A fixed column mapping (stated rule by rule below) turns every row of the
table into one event, with malformed, unlabelled and late rows at known rates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocktide.session import pin_utc


def load_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table; its zone-less ``ts`` becomes a UTC timestamp."""
    raw = pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


# The mapping, one rule per column; ``e`` is the event id.
_BASE = {
    "e": "event_id",
    "base": "element_at(array('ethereum', 'synthetic', 'solana'), cast(user_id % 3 + 1 as int))",
    "ty": """
        CASE WHEN event_type IN ('click', 'purchase') THEN 'EVENT_TYPE_TRANSACTION'
             WHEN event_type = 'signup' THEN 'EVENT_TYPE_BLOCK'
             ELSE 'EVENT_TYPE_LOG' END""",
    "delay_s": "event_id * 37 % 600 + if(event_id % 29 = 0, 10800, 0)",
}
_FEED = {
    "id": "if(e % 103 = 0, '', concat('evt:', base, ':', e))",
    "chain": "if(e % 107 = 0, '', base)",
    "type": "if(e % 101 = 0, 'EVENT_TYPE_UNSPECIFIED', ty)",
    "block_number": "20000000 + e div 12",
    "block_hash": "concat('0x', md5(concat('b', e div 12)))",
    "tx_hash": """
        if(ty = 'EVENT_TYPE_TRANSACTION' AND e % 113 <> 0,
           concat('0x', md5(cast(e as string))), '')""",
    "from_address": """
        if(ty = 'EVENT_TYPE_BLOCK', '', concat('0x', upper(md5(concat('u', user_id)))))""",
    "to_address": """
        CASE WHEN ty = 'EVENT_TYPE_TRANSACTION' THEN
               CASE e % 7 WHEN 0 THEN '0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48'
                          WHEN 1 THEN '0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2'
                          WHEN 2 THEN ''
                          ELSE concat('0x', md5(concat('t', e % 50))) END
             WHEN ty = 'EVENT_TYPE_LOG' AND e % 5 = 0
               THEN '0xdAC17F958D2ee523a2206206994597C13D831ec7'
             ELSE '' END""",
    "value_wei": """
        CASE WHEN ty <> 'EVENT_TYPE_TRANSACTION' THEN ''
             WHEN e % 127 = 0 THEN 'not-a-number'
             ELSE concat(cast(round(value * 100) as bigint), '00000000000000') END""",
    "gas_used": "if(ty = 'EVENT_TYPE_TRANSACTION', 21000 + e % 180000, 0)",
    "observed_at": "timestamp_micros(unix_micros(ts) + delay_s * 1000000)",
    "block_time": "if(e % 109 <> 0, ts, null)",
    "attributes": "map('k', get_json_object(props, '$.k'))",
    "event_id": "e",
}


def chain_feed(table: DataFrame) -> DataFrame:
    """One event per row, plus ``event_id``."""
    base = [f"{rule} AS {name}" for name, rule in _BASE.items()]
    feed = [f"{rule} AS {name}" for name, rule in _FEED.items()]
    return table.selectExpr("ts", "user_id", "value", "props", *base).selectExpr(*feed)


def load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_feed(load_events_table(spark, sf_dir))


def redelivered_feed(feed: DataFrame) -> DataFrame:
    """The feed followed by a second copy, five seconds later, of every 17th row."""
    copies = feed.filter(F.col("event_id") % 17 == 0).withColumn(
        "observed_at", F.timestamp_micros(F.unix_micros("observed_at") + 5_000_000)
    )
    return feed.unionByName(copies)
