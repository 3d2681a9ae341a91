"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only when its counted rows are at most this many.
BROADCAST_ROWS = 200_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` allow it, else as it is."""
    return F.broadcast(df) if rows <= limit else df


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_column: str, text_column: str) -> list[Column]:
    """Names a row by its id and its text: repeated rows are one document.

    Unlike a generated row number it is the same in every run of a task.
    """
    return [F.col(id_column).alias("key_id"), F.md5(text_or_empty(text_column)).alias("key_text")]


def sliced(parts: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python strings at a time.

    Memory that a batch has freed goes back before the next one is read.
    """
    for part in parts:
        for at in range(0, part.num_rows, rows):
            yield part.slice(at, rows)
        del part
        pa.default_memory_pool().release_unused()


def batches_of(texts: Iterable[str], limit: int):
    """Slices of row numbers whose texts hold about ``limit`` characters."""
    start = size = 0
    end = -1
    for end, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield slice(start, end + 1)
            start, size = end + 1, 0
    if end >= start:
        yield slice(start, end + 1)


def drawn(hashed: Column, share: Column | float) -> Column:
    """Whether a row with this 64-bit hash is in a sample of about ``share`` of all rows."""
    return F.shiftrightunsigned(hashed, 11) < F.lit(float(1 << 53)) * share


def share_for(rows: int, total: int) -> float:
    """A share with which a sample has at least ``rows`` of ``total`` rows, almost surely."""
    return min(1.0, (1.2 * rows + 200) / max(total, 1))
