"""Column contracts shared by every job.

Event type names, reject reasons, metric names and the contract table are
fixed values: downstream consumers compare against them literally.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
TYPE_UNSPECIFIED = "EVENT_TYPE_UNSPECIFIED"
TYPE_BLOCK = "EVENT_TYPE_BLOCK"
TYPE_TRANSACTION = "EVENT_TYPE_TRANSACTION"
TYPE_LOG = "EVENT_TYPE_LOG"

# Sorted by name; the order in which per-type rows of a window are listed.
EVENT_TYPES = (TYPE_BLOCK, TYPE_LOG, TYPE_TRANSACTION, TYPE_UNSPECIFIED)

REASON_MISSING_ID = "missing_id"
REASON_MISSING_CHAIN = "missing_chain"
REASON_UNSPECIFIED_TYPE = "unspecified_type"
REASON_MISSING_BLOCK_TIME = "missing_block_time"
REASON_MISSING_TX_HASH = "missing_tx_hash"
REASON_UNDECODABLE = "undecodable"

METRIC_EVENTS = "events_total"
METRIC_GAS = "gas_used_total"
METRIC_WEI = "value_wei_total"
METRIC_ADDRESSES = "active_addresses"

KNOWN_CONTRACTS = {
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "USDC",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "WETH",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "USDT",
    "0x6b175474e89094c44da98b954eedeac495271d0f": "DAI",
    "0x2260fac5e5542a773aa44fbcfedf7c193bc2c599": "WBTC",
}

DEFAULT_WINDOW = "1 minute"
DEFAULT_LATENESS = "30 seconds"
MAX_QUERY_ROWS = 10_000
RECENT_ROWS = 25
# ----------------------------------------------------------------------------

CHAIN_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("chain", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("block_number", T.DecimalType(20, 0)),
        T.StructField("block_hash", T.StringType()),
        T.StructField("tx_hash", T.StringType()),
        T.StructField("from_address", T.StringType()),
        T.StructField("to_address", T.StringType()),
        T.StructField("value_wei", T.StringType()),
        T.StructField("gas_used", T.DecimalType(20, 0)),
        T.StructField("observed_at", T.TimestampType()),
        T.StructField("block_time", T.TimestampType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

AGGREGATE = T.StructType(
    [
        T.StructField("chain", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("value_exact", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("labels_key", T.StringType()),
    ]
)

AGGREGATE_KEY = ("chain", "metric", "window_start", "labels_key")

CHAIN_HEAD = T.StructType(
    [
        T.StructField("number", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

CHAIN_BLOCK = T.StructType(
    [
        T.StructField("number", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField(
            "transactions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("hash", T.StringType()),
                        T.StructField("from", T.StringType()),
                        T.StructField("to", T.StringType()),
                        T.StructField("value", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

OFFSET_SNAPSHOT = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("elapsed_s", T.DoubleType()),
        T.StructField("group", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("committed", T.LongType()),
        T.StructField("end_offset", T.LongType()),
    ]
)
