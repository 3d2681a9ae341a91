"""Chain-event analytics as Spark jobs.

The names here are the public surface; every one takes and returns DataFrames.
"""

from blocktide.operators.dedup import drop_redelivered, dropped_per_interval, first_seen
from blocktide.operators.enrich import enrich
from blocktide.operators.filters import filter_aggregates, filter_events, partition_key
from blocktide.operators.lateness import Replay
from blocktide.operators.validate import rejected_events, valid_events, with_reject_reason
from blocktide.operators.window_metrics import window_metrics
from blocktide.sinks.aggregates_table import (
    query_aggregates,
    read_table,
    recent_aggregates,
    upsert_aggregates,
)
from blocktide.sources.chain_json import decode_blocks
from blocktide.sources.events import (
    decode_events,
    kafka_events,
    read_events,
    stream_events,
    tail_events,
)
from blocktide.streaming.exact import ExactWindows
from blocktide.streaming.native import native_metrics
from blocktide.streaming.decode import decode_transactions, log_heads, matched_bodies
from blocktide.streaming.normalize import normalize_with_rejects, normalized_stream

__all__ = [
    "ExactWindows",
    "Replay",
    "decode_blocks",
    "decode_events",
    "decode_transactions",
    "drop_redelivered",
    "dropped_per_interval",
    "enrich",
    "filter_aggregates",
    "filter_events",
    "first_seen",
    "kafka_events",
    "native_metrics",
    "log_heads",
    "matched_bodies",
    "normalize_with_rejects",
    "normalized_stream",
    "partition_key",
    "query_aggregates",
    "read_events",
    "read_table",
    "recent_aggregates",
    "rejected_events",
    "stream_events",
    "tail_events",
    "upsert_aggregates",
    "valid_events",
    "window_metrics",
    "with_reject_reason",
]
