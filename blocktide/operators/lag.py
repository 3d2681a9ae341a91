"""Consumer lag from per-partition offset snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_lag(snapshots: DataFrame) -> DataFrame:
    """Lag of a group per sample, summed over its partitions.

    A partition with no commit counts from offset 0.
    """
    committed = F.coalesce(F.col("committed"), F.lit(0).cast("bigint"))
    return snapshots.groupBy("label", "elapsed_s", "group").agg(
        F.sum(F.col("end_offset") - committed).alias("records_lag"),
        F.sum(committed).alias("committed"),
        F.sum("end_offset").alias("end_offset"),
    )


def peak_lag(samples: DataFrame) -> DataFrame:
    """Largest sampled lag of each labelled run."""
    return samples.groupBy("label").agg(F.max("records_lag").alias("peak_lag"))
