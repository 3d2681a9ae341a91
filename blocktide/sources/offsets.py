"""Offset snapshots: one row per sample, group and partition."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from blocktide.schemas import OFFSET_SNAPSHOT


def read_offsets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(OFFSET_SNAPSHOT).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def _partitions(offsets: str | Mapping | None) -> dict[tuple[str, str], int]:
    parsed = json.loads(offsets) if isinstance(offsets, str) else offsets
    return {
        (topic, partition): offset
        for topic, partitions in (parsed or {}).items()
        for partition, offset in partitions.items()
    }


def offsets_from_progress(
    spark: SparkSession,
    progress: Iterable[Mapping],
    label: str,
    group: str,
    started_s: float = 0.0,
) -> DataFrame:
    """Snapshots from a query's own progress reports (``json.loads(p.json)``).

    Uses the committed and latest offsets of log sources: one row per report
    and partition, which is metadata of the driver to begin with. ``started_s``
    is the epoch second elapsed time counts from.
    """
    rows = []
    for report in progress:
        at = _epoch_seconds(report["timestamp"]) - started_s
        for source in report["sources"]:
            committed = _partitions(source.get("endOffset"))
            latest = _partitions(source.get("latestOffset"))
            for key, end in latest.items():
                rows.append((label, at, group, int(key[1]), committed.get(key), end))
    return spark.createDataFrame(rows, OFFSET_SNAPSHOT)


def _epoch_seconds(text: str) -> float:
    return dt.datetime.fromisoformat(text).timestamp()
