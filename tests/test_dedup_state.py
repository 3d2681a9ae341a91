"""Bounded memory of seen ids, and the log of generations that holds it."""

import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocktide import schemas as S
from blocktide.operators.dedup import (
    AGAIN,
    _marked,
    first_seen,
    first_unseen,
    ids_again,
    seen_keys,
    unseen,
)
from blocktide.plans import queries as Q
from blocktide.sinks.records import append_stream
from blocktide.streaming.logstate import LogState
from blocktide.streaming.normalize import normalize_with_rejects, normalized_stream

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def size_on_disk(path):
    return sum(p.stat().st_size for p in path.rglob("*") if p.is_file())


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_state_is_what_was_appended(spark, tmp_path):
    state = LogState(str(tmp_path / "s"), SCHEMA, fanout=3)
    assert content(state.read(spark, -1)) == content(state.read(spark, 0)) == []
    everything = []
    for b in range(11):
        rows = [(b, i) for i in range(b % 3 + 1)] if b != 4 else []
        state.append(table(spark, rows), b)
        if b in (3, 6):  # a retry, before and after merging
            state.compact(spark, b)
            state.append(table(spark, rows), b)
        everything += rows
        assert content(state.read(spark, b)) == sorted(everything)
        state.compact(spark, b)
        assert content(state.read(spark, b)) == sorted(everything) and state.rows(spark, b) == len(everything)
    assert len(folders(tmp_path / "s")) <= 9  # of 11 batches, with those a retry may need
    with pytest.raises(Exception):
        state.read(spark, 99).collect()


def test_dead_rows_leave_and_merging_is_amortised(spark, tmp_path):
    """State follows what lives; what is written follows what is added."""
    summed = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    state = LogState(str(tmp_path / "s"), SCHEMA, merge=summed)
    written, rows_held = 0, []
    for b in range(16):
        state.append(table(spark, [(k, 1) for k in range(b, b + 10)]), b)
        before = set(folders(tmp_path / "s"))
        state.compact(spark, b, live=lambda df, b=b: df.filter(F.col("k") > b))
        written += 10 + sum(
            spark.read.parquet(str(tmp_path / "s" / f)).count() for f in set(folders(tmp_path / "s")) - before
        )
        rows_held.append(state.rows(spark, b))
        alive = {}
        for past in range(b + 1):
            for k in range(past, past + 10):
                alive[k] = alive.get(k, 0) + 1
        got = dict(content(summed(state.read(spark, b)).filter(F.col("k") > b)))
        assert got == {k: n for k, n in alive.items() if k > b}
    assert max(rows_held[4:]) <= 70 and written <= 16 * 10 * 3


def test_oldest_are_forgotten_first(spark, tmp_path):
    state = LogState(str(tmp_path / "s"), SCHEMA, fanout=2, capacity=100)
    for b in range(16):
        state.append(table(spark, [(b, i) for i in range(10)]), b)
        state.compact(spark, b)
        kept = {k for k, _ in content(state.read(spark, b))}
        assert kept == set(range(min(kept), b + 1)) and min(100, 10 * (b + 1)) <= 10 * len(kept) <= 120
    assert len(folders(tmp_path / "s")) <= 16


def events(spark, rows):
    """(id, arrival second or None) as valid events."""
    df = spark.createDataFrame(rows, "id string, at long")
    blank = {c: F.lit("") for c in ("tx_hash", "from_address", "to_address")}
    return df.select(
        "id", F.lit("eth").alias("chain"), F.lit(S.TYPE_LOG).alias("type"), *[c.alias(n) for n, c in blank.items()],
        F.timestamp_seconds("at").alias("observed_at"), F.timestamp_seconds(F.lit(5)).alias("block_time"),
        F.create_map().cast("map<string,string>").alias("attributes"),
    )


@pytest.mark.parametrize("small", [True, False])
def test_unseen_takes_an_unknown_arrival_as_near(spark, small):
    seen = seen_keys(events(spark, [("a", 0), ("b", None), ("c", 0), ("c", 5000), ("e", 9000)]))
    firsts = events(spark, [("a", 100), ("b", 100), ("c", 5001), ("d", None), ("e", 100), ("a2", 0)])
    left = unseen(firsts, seen, "1 minute", small)
    assert sorted(r.id for r in left.collect()) == ["a", "a2", "d", "e"]
    assert left.columns == firsts.columns
    again = unseen(events(spark, [("a", None), ("x", None)]), seen, "1 minute", small)
    assert [r.id for r in again.collect()] == ["x"]


def run(spark, tmp_path, rows, remember, small=200_000):
    schema = events(spark, [("x", 1)]).schema
    events(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query = (
        normalize_with_rejects(
            spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "good"), str(tmp_path / "bad"),
            str(tmp_path / "cp"), seen_path=str(tmp_path / "seen"), horizon="1 day", counts_path=str(tmp_path / "counts"),
            remember=remember,
        ).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(180)


def test_twenty_batches_with_constant_state(spark, tmp_path):
    """Repeats within the last ids are suppressed, with or without arrival; the state stays."""
    rng = random.Random(1)
    sizes, sent = [], 0
    for b in range(20):
        fresh = [(f"e{100 * b + i}", rng.choice([None, 10 * b + i])) for i in range(100)]
        repeats = [(f"e{max(0, 100 * b - rng.randint(1, 150))}", rng.choice([None, 10 * b])) for _ in range(20)] if b else []
        sent += len(fresh) + len(repeats)
        run(spark, tmp_path, fresh + repeats, remember=400)
        sizes.append(size_on_disk(tmp_path / "seen"))
    good = [r.id for r in spark.read.parquet(str(tmp_path / "good")).collect()]
    assert sorted(good) == sorted(f"e{i}" for i in range(2000))
    total = spark.read.parquet(str(tmp_path / "counts")).agg(F.sum("received"), F.sum("kept"), F.sum("suppressed")).first()
    assert tuple(total) == (sent, 2000, sent - 2000)
    assert max(sizes[10:]) <= 1.2 * max(sizes[5:10])


def test_forgotten_ids_pass_again_and_unseen_ones_always(spark, tmp_path):
    for b in range(4):
        run(spark, tmp_path, [(f"e{b}-{i}", 1000 - b) for i in range(10)], remember=10)
    run(spark, tmp_path, [("e0-1", 1000), ("e3-1", 997), ("old", -10**9)], remember=10)
    good = [r.id for r in spark.read.parquet(str(tmp_path / "good")).collect()]
    assert good.count("e0-1") == 2 and good.count("e3-1") == 1 and good.count("old") == 1


def test_native_form_loses_no_unseen_id(spark, tmp_path):
    """Whatever the arrival times, which need not rise or be known."""
    schema = events(spark, [("x", 1)]).schema
    for b in range(4):
        fresh = [(f"e{50 * b + i}", -b * 10**6 if i % 2 else None) for i in range(50)]
        repeats = [(f"e{50 * b - 5}", 0)] if b else []
        events(spark, fresh + repeats).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    writer = append_stream(normalized_stream(stream, remember="5 minutes"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query = writer.trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == sorted(f"e{i}" for i in range(200))
    assert not [c for c in out.columns if c.startswith("_")]


def test_native_state_expires(spark, tmp_path):
    schema = events(spark, [("x", 1)]).schema
    sizes = []
    for b in range(5):
        events(spark, [(f"e{b}-{i}", None) for i in range(50)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = normalized_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), remember="1 second")
        query = append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
        time.sleep(1.5)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 250
    assert max(sizes) <= 150


def test_only_ids_that_come_again_are_shuffled(spark, tmp_path):
    """The filter keeps them all and few others; the rest passes, and the result is the same."""
    rng = random.Random(3)
    ids = [f"e{i}" for i in range(3000)]
    rows = [(i, rng.randint(0, 9000)) for i in ids]
    rows += [(f"e{i}", rng.randint(0, 9000)) for i in range(0, 200, 2)] + [(None, 5), (None, 6), ("e7", None)]
    old = [(f"e{i}", rng.choice([None, rng.randint(0, 9000)])) for i in range(1, 300, 3)] + [("gone", 1), (None, 2)]
    batch, before = (
        spark.createDataFrame(some, "id string, s long").select("id", F.timestamp_seconds("s").alias("observed_at"))
        for some in (rows, old)
    )
    seen = seen_keys(before)
    path = str(tmp_path / "again")
    ids_again(batch, seen).write.parquet(path)
    again = spark.read.schema(AGAIN).parquet(path)
    found = first_unseen(batch, seen, again, "1 hour")
    expected = unseen(first_seen(batch), seen, "1 hour")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    marked = _marked(batch, F.unhex(F.md5("id")), again).filter("_again")
    held = {r["id"] for r in marked.collect()}
    must = {f"e{i}" for i in range(0, 200, 2)} | {f"e{i}" for i in range(1, 300, 3)} | {None, "e7"}
    assert must <= held and len(held) <= len(must) + 20


def test_landing_does_not_shuffle_the_feed(spark):
    """However large the tables seem, only the days are dealt out."""
    feed = spark.range(400).selectExpr("id", "timestamp_seconds(1704067200 + id * 3600) AS observed_at")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = Q._by_quarter(feed)
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert {r["q"] for r in split.select("q").distinct().collect()} == {1, 2, 3, 4} and split.count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_exact_slices_are_cut_from_a_feed_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    rows = spark.range(60).selectExpr(
        "concat('e', id) AS id", "'eth' AS chain", f"'{S.TYPE_LOG}' AS type", "'' AS from_address",
        "'' AS value_wei", "0L AS gas_used", "timestamp_seconds(1704067200 + id * 600) AS observed_at",
        "timestamp_seconds(1704067200 + id * 600) AS block_time",
    )

    def counted(parts):
        for part in parts:
            made.add(part.num_rows)
            yield part

    monkeypatch.setattr(Q, "normalized", lambda *_: rows.mapInArrow(counted, rows.schema))
    job, _ = Q._exact_stream(spark, "", 2)
    assert made.value == 60  # once, and not for the edges and each slice
    assert [tuple(r) for r in job.late_counts(spark).collect()] == [("eth", 0, 60)]
