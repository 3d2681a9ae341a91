"""Every registered query against its SQL, and fixed counts of the feed."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from blocktide.operators.validate import with_reject_reason
from blocktide.plans import queries as Q
from blocktide.sources.driver_events import load_feed
from tests.compare import compare, duck

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(MEDIUM), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(Q.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, Q.QUERIES[name], entry.oracle_sql()[name], SMALL) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_feed_counts_at_sf001(spark):
    rows = with_reject_reason(load_feed(spark, MEDIUM)).groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in rows} == {
        None: 9585,
        "missing_id": 98,
        "missing_chain": 93,
        "unspecified_type": 99,
        "missing_block_time": 91,
        "missing_tx_hash": 34,
    }
    late = Q.late_per_chain(spark, MEDIUM).agg(F.sum("late"), F.sum("accepted")).first()
    assert tuple(late) == (331, 9254)
    totals = Q.replay_flush_metrics(spark, MEDIUM).filter("labels_key = ''").groupBy("metric")
    exact = totals.agg(F.sum(F.col("value_exact").cast("decimal(38,0)")).alias("v")).collect()
    got = {r.metric: int(r.v) for r in exact}
    assert got["gas_used_total"] == 95_815_158
    assert got["value_wei_total"] == 1_810_941_000_000_000_000_000


def test_quarters_land_in_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = spark.read.parquet(f"{SMALL}/events.parquet").repartition(4)
        spread.write.parquet(str(tmp_path / "sf" / "events.parquet"))
        seen, added = set(), []
        for _ in Q._landed_out_of_order(spark, str(tmp_path / "sf"), str(tmp_path / "in")):
            files = set((tmp_path / "in").glob("*.parquet"))
            added.append(len(files - seen))
            seen = files
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(added) == 4 and min(added) > 1
