"""Tumbling-window arithmetic on whole microseconds.

Windows are aligned to 0001-01-01, not to the Unix epoch, so sizes that do
not divide that distance (7 minutes, 7 days) land on shifted boundaries.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: microseconds from 0001-01-01 to 1970-01-01.
ORIGIN_US = 62_135_596_800 * 1_000_000

Duration = str | int | float | dt.timedelta


def micros(duration: Duration) -> int:
    """Duration as microseconds; numbers are seconds, text is e.g. ``"1 minute"``."""
    if isinstance(duration, (int, float)):
        return round(duration * 1_000_000)
    return pd.Timedelta(duration).value // 1000


def window_micros(size: Duration) -> int:
    us = micros(size)
    if us <= 0:
        raise ValueError(f"window size must be > 0, got {size!r}")
    return us


def lateness_micros(lateness: Duration) -> int:
    us = micros(lateness)
    if us < 0:
        raise ValueError(f"allowed lateness must be >= 0, got {lateness!r}")
    return us


def bucket_start_us(ts_us: Column, size_us: int) -> Column:
    """Start of the bucket holding ``ts_us``, both in epoch microseconds."""
    return ts_us - F.pmod(ts_us + F.lit(ORIGIN_US), F.lit(size_us))


def window_end_us(ts: Column, size_us: int) -> Column:
    return bucket_start_us(F.unix_micros(ts), size_us) + F.lit(size_us)


def time_bucket(ts: Column, size: Duration) -> Column:
    """Start timestamp of the tumbling window holding ``ts``."""
    return F.timestamp_micros(bucket_start_us(F.unix_micros(ts), window_micros(size)))


def native_window(ts: Column, size: Duration) -> Column:
    """The same windows through ``F.window``, which a stream watermark understands."""
    size_us = window_micros(size)
    offset_us = -ORIGIN_US % size_us
    return F.window(
        ts,
        f"{size_us} microseconds",
        f"{size_us} microseconds",
        f"{offset_us} microseconds",
    )
