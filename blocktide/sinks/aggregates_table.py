"""The stored aggregates: Parquet partitioned by window day, upserted by key.

A write puts the days it merged into a folder of its own and then publishes a
manifest, which says for every day in which folder it stands. Manifests are
numbered and written once, so a reader has one of them as a whole, old or new, and of
two writers that started from the same one the second is refused. Files of the last
KEPT manifests stay for readers that still use them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocktide import schemas as S
from blocktide.functions.labels import labels_key
from blocktide.operators.filters import filter_aggregates
from blocktide.session import child_names, create_text, delete_path, path_exists, read_text

READ_ORDER = ("window_start", "metric", "chain", "labels_key")
#: Days that an upsert may touch and still name in a partition filter.
MOST_DAYS = 10_000
#: Folders of writes are named like those of a partition, so that readers find the day's column.
VERSION = "version"
#: Manifests whose files stay.
KEPT = 10
#: Names of writes that a manifest remembers, so that a retry does not repeat one.
REMEMBERED = 100
STORED = T.StructType([*S.AGGREGATE.fields, T.StructField("window_date", T.DateType())])


def _in_table_layout(rows: DataFrame) -> DataFrame:
    if "labels_key" not in rows.columns:
        rows = rows.withColumn("labels_key", labels_key(F.col("labels")))
    if "value_exact" not in rows.columns:
        rows = rows.withColumn("value_exact", F.lit(None).cast("string"))
    return rows.withColumn("window_date", F.to_date("window_start")).select(*STORED.fieldNames())


def _newest_per_key(rows: DataFrame) -> DataFrame:
    """One row per key; of equal keys the largest (window end, value) stays."""
    newest = Window.partitionBy(*S.AGGREGATE_KEY).orderBy(
        F.col("window_end").desc(), F.col("value").desc(), F.col("value_exact").desc()
    )
    return (
        rows.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


class ConcurrentWrite(Exception):
    """Another writer published a version in the meantime; nothing was changed."""


def _manifest_path(path: str, number: int) -> str:
    return f"{path}/_versions/{number:012d}.json"


def _manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    """A manifest, or None while it is being written or if it is gone."""
    name = _manifest_path(path, number)
    if not path_exists(spark, name):
        return None
    try:
        return json.loads(read_text(spark, name))
    except json.JSONDecodeError:
        return None


def current_version(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content (folder by day, last writes) of the newest complete manifest.

    A table without any, say one laid out by another tool, is version 0: its days as they stand.
    """
    numbers = sorted(int(n[: -len(".json")]) for n in child_names(spark, f"{path}/_versions", "*.json"))
    for number in reversed(numbers):
        found = _manifest(spark, path, number)
        if found is not None:
            return number, found
    days = child_names(spark, path, "window_date=*")
    return 0, {"days": {d.split("=", 1)[1]: d for d in days}, "writes": []}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it was published last; later writes do not change what is read."""
    number, manifest = current_version(spark, path)
    reader = spark.read.schema(STORED)
    if not number:
        return reader.parquet(path)
    reader = reader.option("basePath", path)
    folders = manifest["days"].values()
    table = reader.parquet(*[f"{path}/{f}" for f in folders if f.startswith(VERSION)]).drop(VERSION)
    plain = [f"{path}/{f}" for f in folders if not f.startswith(VERSION)]
    return table.unionByName(reader.parquet(*plain)) if plain else table


def upsert_aggregates(
    rows: DataFrame,
    path: str,
    version: int | str | None = None,
    stored: bool = False,
    run: str = "",
) -> None:
    """Insert ``rows`` into the table at ``path``, replacing rows of equal key.

    Only the days present in ``rows`` are read and written; all of them are
    published at once. ``version`` names the write for retries (a stream passes its
    batch id), ``run`` the stream: a write that was published is not repeated, and
    one that was not is done anew. ``stored`` says that ``rows`` come from files
    and hold each key once, so they need not be staged first. No rows, no change.

    Raises ``ConcurrentWrite`` if another writer published first.
    """
    spark = rows.sparkSession
    name = uuid.uuid4().hex if version is None else f"{run}-{version}" if run else str(version)
    number, manifest = current_version(spark, path)
    if name in manifest["writes"]:
        return
    stage, merged = f"{path}/_upsert/{name}", f"{VERSION}=v{number + 1}-{name}"
    if stored:
        new = _in_table_layout(rows)
    else:
        _newest_per_key(_in_table_layout(rows)).write.mode("overwrite").parquet(f"{stage}/rows")
        new = spark.read.schema(STORED).parquet(f"{stage}/rows")
    result = new
    if manifest["days"]:
        old = in_days(read_table(spark, path), new)
        result = old.join(new, list(S.AGGREGATE_KEY), "left_anti").unionByName(new)
    # Rebalancing writes few files per day and still splits a heavy day.
    (
        result.hint("rebalance", "window_date")
        .write.mode("overwrite")
        .partitionBy("window_date")
        .parquet(f"{path}/{merged}")
    )
    days = {d.split("=", 1)[1]: f"{merged}/{d}" for d in child_names(spark, f"{path}/{merged}", "window_date=*")}
    if days:
        _publish(spark, path, number, manifest, days, name)
        _forget(spark, path, number + 1)
    else:
        delete_path(spark, f"{path}/{merged}")
    delete_path(spark, stage)


def _publish(
    spark: SparkSession, path: str, number: int, manifest: dict, days: dict[str, str], name: str
) -> None:
    """Make ``days`` part of the table, as the version after ``number``."""
    content = {
        "days": dict(sorted({**manifest["days"], **days}.items())),
        "writes": [*manifest["writes"], name][-REMEMBERED:],
    }
    if not create_text(spark, _manifest_path(path, number + 1), json.dumps(content)):
        raise ConcurrentWrite(f"version {number + 1} of {path} is there already")


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Delete the files that only manifests older than the last KEPT ones list."""
    old = _manifest(spark, path, number - KEPT)
    if old is None:
        return
    later = [_manifest(spark, path, n) for n in range(number - KEPT + 1, number + 1)]
    needed = {folder for m in later if m for folder in m["days"].values()}
    for folder in set(old["days"].values()) - needed:
        delete_path(spark, f"{path}/{folder}")
    delete_path(spark, _manifest_path(path, number - KEPT))


def in_days(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` cut to the days of ``rows``: a partition filter while those are few."""
    days = rows.select("window_date").distinct()
    found = [r[0] for r in days.limit(MOST_DAYS + 1).collect()]
    if len(found) > MOST_DAYS:
        return table.join(days, "window_date", "left_semi")
    return table.filter(F.col("window_date").isin(found))


def in_read_order(aggregates: DataFrame, limit: int | None = S.MAX_QUERY_ROWS) -> DataFrame:
    """Oldest window first, at most ``limit`` rows (None: all); ties broken by the rest of the key."""
    rows = aggregates.orderBy(*READ_ORDER)
    return rows if limit is None else rows.limit(limit)


def query_aggregates(
    aggregates: DataFrame,
    chain: str = "",
    metric: str = "",
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    limit: int | None = S.MAX_QUERY_ROWS,
    after: tuple | None = None,
) -> DataFrame:
    """Range read over the table; an empty label map comes back as NULL.

    A read that returned ``limit`` rows may go on: give the ``READ_ORDER`` values
    of its last row as ``after``. ``limit=None`` returns everything.
    """
    found = filter_aggregates(aggregates, chain, metric, since, until)
    if after is not None:
        found = found.filter(
            F.struct(*READ_ORDER) > F.struct(*[F.lit(v).alias(c) for c, v in zip(READ_ORDER, after)])
        )
    rows = in_read_order(found, limit)
    return rows.withColumn("labels", F.when(F.size("labels") > 0, F.col("labels")))


def recent_aggregates(
    aggregates: DataFrame, metric: str = S.METRIC_EVENTS, n: int = S.RECENT_ROWS
) -> DataFrame:
    """Newest ``n`` rows of a metric, newest first, with a readable metric name."""
    type_label = F.try_element_at("labels", F.lit("type"))
    title = F.when(
        type_label.isNotNull(), F.concat("metric", F.lit(" ("), type_label, F.lit(")"))
    ).otherwise(F.col("metric"))
    return (
        filter_aggregates(aggregates, metric=metric)
        .orderBy(*[F.col(c).desc() for c in ("window_start", "metric", "chain", "labels_key")])
        .limit(n)
        .select("chain", title.alias("title"), "window_start", "value")
    )
