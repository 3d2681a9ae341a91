"""Aggregates table, range and recent reads, NDJSON and CSV."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.sinks.aggregates_table import (
    READ_ORDER,
    ConcurrentWrite,
    _publish,
    current_version,
    in_days,
    query_aggregates,
    read_table,
    recent_aggregates,
    upsert_aggregates,
)
from blocktide.sinks.records import keyed_events, write_lag_csv, write_ndjson

BASE = dt.datetime(2026, 1, 1)
MINUTE = dt.timedelta(minutes=1)


def row(chain, metric, start, value, labels=None):
    return (chain, metric, start, start + MINUTE, float(value), str(value), labels or {}, "")


def rows(spark, *items):
    return spark.createDataFrame(list(items), S.AGGREGATE).drop("labels_key")


def stored(spark, path):
    return sorted(
        (r.chain, r.metric, r.window_start, r.labels_key, r.value)
        for r in read_table(spark, path).collect()
    )


def test_upsert_overwrites_equal_keys_and_keeps_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [
        row("eth", "m", BASE, 10),
        row("eth", "m", BASE + MINUTE, 5),
        row("eth", "m", BASE - 2 * MINUTE, 7),  # the day before
    ]
    upsert_aggregates(rows(spark, *old), path)
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 42), row("sol", "m", BASE, 1)), path)
    assert stored(spark, path) == [
        ("eth", "m", BASE - 2 * MINUTE, "", 7.0),
        ("eth", "m", BASE, "", 42.0),
        ("eth", "m", BASE + MINUTE, "", 5.0),
        ("sol", "m", BASE, "", 1.0),
    ]
    before = stored(spark, path)
    upsert_aggregates(rows(spark), path)
    assert stored(spark, path) == before
    assert not list((tmp_path / "t" / "_upsert").iterdir())


def test_upsert_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 1), row("eth", "m", BASE - MINUTE, 1)), path)
    before = current_version(spark, path)[1]["days"]
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 2)), path)
    after = current_version(spark, path)[1]["days"]
    assert after["2025-12-31"] == before["2025-12-31"] and after["2026-01-01"] != before["2026-01-01"]


def test_retries_publish_once(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 1)), path, version=1)
    # A crash before publishing: what was merged is there, but no manifest lists it.
    read_table(spark, path).withColumn("value", F.lit(7.0)).write.partitionBy("window_date").parquet(f"{path}/version=v2-2")
    assert stored(spark, path) == [("eth", "m", BASE, "", 1.0)]
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 9)), path, version=2)
    assert stored(spark, path) == [("eth", "m", BASE, "", 9.0)]
    number = current_version(spark, path)[0]
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 5)), path, version=2)  # published before
    assert current_version(spark, path)[0] == number and stored(spark, path) == [("eth", "m", BASE, "", 9.0)]
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 3)), path, version=2, run="other")
    assert stored(spark, path) == [("eth", "m", BASE, "", 3.0)]


def test_a_reader_sees_one_version(spark, tmp_path):
    """Old or new, whenever it runs: two days never come from different versions."""
    path, day = str(tmp_path / "t"), dt.timedelta(days=1)
    readers = []
    for n in range(6):
        upsert_aggregates(rows(spark, *[row("eth", "m", BASE + d * day, n) for d in range(3)]), path)
        readers.append(read_table(spark, path))
    # A write that has put its files there but has not published them.
    readers[-1].withColumn("value", F.lit(99.0)).write.partitionBy("window_date").parquet(f"{path}/version=v7-unfinished")
    (tmp_path / "t" / "_versions" / "000000000007.json").write_text('{"days": {"2026-01')
    readers.append(read_table(spark, path))
    for n, table in enumerate(readers):
        assert {r.value for r in table.collect()} == {float(min(n, 5))} and table.count() == 3


def test_the_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 1)), path)
    number, manifest = current_version(spark, path)
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 2)), path)
    with pytest.raises(ConcurrentWrite):
        _publish(spark, path, number, manifest, {"2026-01-01": "version=v2-late/window_date=2026-01-01"}, "late")
    assert stored(spark, path) == [("eth", "m", BASE, "", 2.0)]


def test_files_of_old_versions_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("blocktide.sinks.aggregates_table.KEPT", 3)
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, row("eth", "m", BASE - MINUTE, 8)), path)
    for n in range(6):
        upsert_aggregates(rows(spark, row("eth", "m", BASE, n)), path)
    assert len(list((tmp_path / "t" / "_versions").glob("*.json"))) == 3
    assert len(list((tmp_path / "t").glob("version=*/window_date=2026-01-01"))) == 3
    assert [r[-1] for r in stored(spark, path)] == [8.0, 5.0]


def test_a_plain_table_can_be_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 1), row("eth", "m", BASE - MINUTE, 1)), str(tmp_path / "other"))
    read_table(spark, str(tmp_path / "other")).write.partitionBy("window_date").parquet(path)
    upsert_aggregates(rows(spark, row("eth", "m", BASE, 2)), path)
    assert [r[-1] for r in stored(spark, path)] == [1.0, 2.0]


def test_upsert_reads_only_the_days_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    day = dt.timedelta(days=1)
    upsert_aggregates(rows(spark, *[row("eth", "m", BASE + d * day, d) for d in range(40)]), path)
    new = rows(spark, row("eth", "m", BASE + day, 5)).withColumn("window_date", F.to_date("window_start"))
    cut = in_days(read_table(spark, path), new)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan and "Join" not in plan
    assert cut.count() == 1
    broken = next((tmp_path / "t").glob("version=*/window_date=2026-01-20/*.parquet"))
    broken.write_bytes(b"not a table")
    upsert_aggregates(rows(spark, row("eth", "m", BASE + day, 5)), path)
    assert read_table(spark, path).filter(F.col("window_date") == F.to_date(F.lit("2026-01-02"))).first().value == 5


def test_reads_can_go_on_after_the_last_row(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, *[row(c, "m", BASE + i * MINUTE, i) for c in "ab" for i in range(7)]), path)
    table, got, after = read_table(spark, path), [], None
    while True:
        page = query_aggregates(table, limit=4, after=after).collect()
        if not page:
            break
        got += [(r.window_start, r.chain) for r in page]
        after = tuple(page[-1][c] for c in READ_ORDER)
    everything = query_aggregates(table, limit=None).collect()
    assert got == [(r.window_start, r.chain) for r in everything] and len(got) == 14


def test_label_sets_are_distinct_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sets = [None, {"type": "a"}, {"type": "b"}]
    upsert_aggregates(rows(spark, *[row("eth", "m", BASE, 1, x) for x in sets]), path)
    assert [r[3] for r in stored(spark, path)] == ["", "type=a", "type=b"]


@pytest.mark.parametrize(
    "criteria, values",
    [
        ({}, [10, 99, 500, 20]),
        ({"chain": "solana"}, [99]),
        ({"chain": "ethereum", "metric": "gas_used_total"}, [500]),
        ({"chain": "Ethereum"}, []),
        ({"chain": "ethereum", "metric": "events_total", "until": BASE + MINUTE / 2}, [10]),
        ({"chain": "ethereum", "metric": "events_total", "since": BASE + MINUTE / 2}, [20]),
        ({"since": BASE, "until": BASE + MINUTE}, [10, 99, 500]),
        ({"limit": 2}, [10, 99]),
    ],
)
def test_range_read(spark, tmp_path, criteria, values):
    path = str(tmp_path / "t")
    upsert_aggregates(
        rows(
            spark,
            row("ethereum", "events_total", BASE, 10),
            row("ethereum", "gas_used_total", BASE, 500),
            row("ethereum", "events_total", BASE + MINUTE, 20),
            row("solana", "events_total", BASE, 99),
        ),
        path,
    )
    got = query_aggregates(read_table(spark, path), **criteria)
    assert [r.value for r in got.collect()] == values
    assert all(r.labels is None for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    if "since" in criteria:
        assert "PartitionFilters: [isnotnull(window_date" in plan


def test_recent_rows(spark, tmp_path):
    items = [row("eth", "events_total", BASE + i * MINUTE, i) for i in range(30)]
    items.append(row("eth", "events_total", BASE + 29 * MINUTE, 7, {"type": "LOG"}))
    items.append(row("eth", "gas_used_total", BASE + 40 * MINUTE, 1))
    path = str(tmp_path / "t")
    upsert_aggregates(rows(spark, *items), path)
    got = recent_aggregates(read_table(spark, path)).collect()
    assert len(got) == 25
    assert [(r.title, r.value) for r in got[:3]] == [
        ("events_total (LOG)", 7.0),
        ("events_total", 29.0),
        ("events_total", 28.0),
    ]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("run", 2.04, "g", 3, 5, 8)],
                               "label string, elapsed_s double, group string, "
                               "records_lag bigint, committed bigint, end_offset bigint").coalesce(1)
    write_lag_csv(df, str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert text == "label,elapsed_s,group,records_lag,committed,end_offset\nrun,2.0,g,3,5,8\n"
    write_ndjson(df, str(tmp_path / "json"))
    line = "".join(p.read_text() for p in (tmp_path / "json").glob("*.txt"))
    assert json.loads(line)["records_lag"] == 3


def test_keyed_records(spark):
    df = spark.createDataFrame([("f", "h", "c", "1")], "from_address string, block_hash string, chain string, id string")
    record = keyed_events(df).first()
    assert record.key == "f" and json.loads(record.value)["id"] == "1"
