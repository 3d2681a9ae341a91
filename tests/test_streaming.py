"""Streams: exact windows over any batch split, restarts, native windows, normalize, tail."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.operators.lateness import Replay
from blocktide.sinks.aggregates_table import read_table
from blocktide.sources.events import land_by_day, stream_by_day, stream_events, tail_events
from blocktide.streaming.exact import ExactWindows
from blocktide.streaming.native import native_metrics
from blocktide.operators.stats import late_counts
from blocktide.sinks.records import append_stream
from blocktide.streaming.normalize import normalize_with_rejects, normalized_stream
from tests.model import random_times
from tests.test_lateness import frame, totals


def keyed(df):
    columns = ("chain", "metric", "window_start", "window_end", "labels_key", "value_exact")
    return sorted(tuple(r) for r in df.select(*columns).collect())


def feed(spark, seed, chains=25):
    rng = random.Random(seed)
    rows = []
    for c in range(chains):
        for i, t in enumerate(random_times(rng, rng.randrange(1, 60))):
            kind = rng.choice([S.TYPE_TRANSACTION, S.TYPE_LOG])
            sender = rng.choice(["", "a", "b", "c", "d"])
            rows.append((f"c{c}", i, t, kind, sender, str(rng.randrange(10**20)), rng.randrange(10**6)))
    return frame(spark, rows).cache()


def split(events, cuts):
    """Consecutive slices by arrival second."""
    at = F.unix_seconds("observed_at")
    edges = [-1, *cuts, 10**9]
    return [events.filter((at > lo) & (at <= hi)) for lo, hi in zip(edges, edges[1:])]


@pytest.mark.parametrize(
    "seed, cuts, size, lateness, small_rows",
    [
        (1, [20], 60, 30, 200_000),
        (2, [3, 4, 15, 40], 420, 0, 200_000),
        (3, [10, 30], 37, 90, 0),
    ],
)
def test_exact_stream_equals_replay(spark, tmp_path, seed, cuts, size, lateness, small_rows):
    events = feed(spark, seed)
    job = ExactWindows(
        str(tmp_path / "state"), str(tmp_path / "table"), str(tmp_path / "log"),
        size=size, lateness=lateness, small_rows=small_rows,
    )
    slices = split(events, cuts)
    for n, part in enumerate(slices):
        job.process(part, n)
        if n == 1:  # A retry of a finished batch changes nothing.
            job.process(part, n)
    replay = Replay(events, size=size, lateness=lateness)
    expected = keyed(replay.metrics())
    assert keyed(read_table(spark, str(tmp_path / "table"))) == expected
    # Every window was emitted exactly once.
    assert keyed(spark.read.parquet(str(tmp_path / "log"))) == expected
    rest = job.flush(spark, len(slices) - 1)
    assert sorted(expected + keyed(rest)) == keyed(replay.metrics(flush=True))


def test_exact_stream_restarts_from_its_checkpoint(spark, tmp_path):
    events = feed(spark, 5, chains=8)
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def run():
        job = ExactWindows(str(tmp_path / "state"), str(tmp_path / "table"), size=60, lateness=30)
        stream = stream_events(spark, landing, max_files=1, schema=events.schema)
        query = job.start(stream, checkpoint, availableNow=True).start()
        assert query.awaitTermination(120)

    for part in split(events, [15, 35]):
        part.coalesce(1).write.mode("append").parquet(landing)
        run()
    expected = keyed(Replay(events, size=60, lateness=30).metrics())
    assert keyed(read_table(spark, str(tmp_path / "table"))) == expected


def test_exact_stream_takes_empty_batches(spark, tmp_path):
    events = frame(spark, [("eth", 0, 10), ("eth", 5, 90)])
    job = ExactWindows(str(tmp_path / "state"), str(tmp_path / "table"), size=60, lateness=0)
    none = events.filter("chain = 'none'")
    for n, part in enumerate([none, events, none]):
        job.process(part, n)
    assert totals(read_table(spark, str(tmp_path / "table"))) == {("eth", 0): 1}
    assert totals(job.flush(spark, 2)) == {("eth", 60): 1}


def bytes_of(path):
    return {p: p.stat().st_size for p in path.rglob("part-*") if p.is_file()}


def test_exact_stream_drops_old_state(spark, tmp_path):
    events = feed(spark, 6, chains=3)
    job = ExactWindows(str(tmp_path / "state"), str(tmp_path / "table"), size=60, lateness=0)
    for n, part in enumerate(split(events, [5, 10, 15, 20, 25])):
        job.process(part, n)
    assert sorted(p.name for p in (tmp_path / "state" / "chains").iterdir()) == ["batch=4", "batch=5"]
    for log in ("windows", "partials", "late"):
        manifests = sorted(p.name for p in (tmp_path / "state" / log).glob("manifest-*"))
        assert manifests == ["manifest-4.json", "manifest-5.json"]


def test_a_silent_chain_does_not_grow_the_state(spark, tmp_path):
    busy = [("busy", t, t) for t in range(0, 600, 20)]
    events = frame(spark, [("silent", 1, 5), *busy])
    job = ExactWindows(str(tmp_path / "state"), str(tmp_path / "table"), size=60, lateness=0)
    for n, part in enumerate(split(events, [50 * k for k in range(1, 10)])):
        job.process(part, n)
        state = job.partials.read(spark, n)
        assert state.filter("chain = 'silent'").count() == 1
        assert state.count() <= 12
        assert len([p for p in (tmp_path / "state" / "partials").iterdir() if p.is_dir()]) <= 12
    assert totals(job.flush(spark, 9))[("silent", 0)] == 1


def test_a_batch_writes_what_it_adds(spark, tmp_path):
    """Not what is open: of a hundred open windows each batch touches one."""
    chains, batches = 100, 9
    open_ones = [(f"c{c}", c, 60 * c) for c in range(chains)]
    later = [(f"c{k}", 1000 + 10 * k, 60 * k + 1) for k in range(batches)]
    events = frame(spark, open_ones + later)
    job = ExactWindows(str(tmp_path / "state"), str(tmp_path / "table"), size=60, lateness="1 day")
    added, before = [], {}
    for n, part in enumerate(split(events, [999, *[1005 + 10 * k for k in range(batches - 1)]])):
        job.process(part, n)
        now = bytes_of(tmp_path / "state")
        added.append(sum(spark.read.parquet(str(p)).count() for p in now if p not in before) - chains)  # a row a chain
        before = now
    # Each log is merged as a whole once, when as much was added as had been left.
    assert sum(a <= 6 for a in added[1:]) >= batches - 3
    assert sum(added[1:]) <= 3 * chains + 6 * batches
    assert sum(totals(job.flush(spark, batches)).values()) == chains + batches


def test_late_events_are_counted_once(spark, tmp_path):
    events = feed(spark, 9, chains=6)
    job = ExactWindows(str(tmp_path / "state"), str(tmp_path / "table"), size=60, lateness=10)
    for n, part in enumerate(split(events, [10, 20, 30])):
        job.process(part, n)
        job.process(part, n)  # a retry
    want = late_counts(Replay(events, size=60, lateness=10).flagged())
    assert sorted(map(tuple, job.late_counts(spark).collect())) == sorted(map(tuple, want.collect()))


def test_native_stream_closes_passed_windows(spark, tmp_path):
    events = feed(spark, 7, chains=4)
    landing = str(tmp_path / "in")
    events.coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(events.schema).parquet(landing)
    query = (
        native_metrics(stream, size=60, lateness=30)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    # One batch: nothing is late, and everything behind the common watermark is emitted.
    last = events.agg(F.unix_seconds(F.max("block_time"))).first()[0]
    replay = Replay(events, size=60, lateness="1000 days").metrics(flush=True)
    expected = replay.filter(F.unix_seconds("window_end") <= last - 30)
    assert keyed(spark.read.parquet(str(tmp_path / "out"))) == keyed(expected)


def raw_events(spark):
    rows = [
        ("e1", "eth", S.TYPE_TRANSACTION, "0xh1", "0xFROM", "0xTO", 10, 10),
        ("e1", "eth", S.TYPE_TRANSACTION, "0xh1", "0xFROM", "0xTO", 12, 10),
        ("", "eth", S.TYPE_BLOCK, "", "", "", 13, 10),
        ("e2", "eth", S.TYPE_TRANSACTION, "", "", "", 14, 10),
        ("e3", "eth", S.TYPE_BLOCK, "", "", "", 15, 11),
    ]
    df = spark.createDataFrame(
        rows,
        "id string, chain string, type string, tx_hash string, from_address string, "
        "to_address string, o bigint, t bigint",
    )
    return df.withColumns(
        {
            "observed_at": F.timestamp_seconds("o"),
            "block_time": F.timestamp_seconds("t"),
            "attributes": F.create_map().cast("map<string,string>"),
        }
    ).drop("o", "t")


def test_normalize_stream_drops_redelivered(spark, tmp_path):
    raw = raw_events(spark)
    raw.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (
        normalized_stream(stream, counters="feed")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.id for r in out) == ["e1", "e3"]
    counted = next(p.observedMetrics for p in query.recentProgress if p.numInputRows)
    assert counted["feed"].received == 5
    assert (counted["feed_valid"].valid, counted["feed_kept"].kept) == (3, 2)
    assert {r.from_address for r in out} == {"0xfrom", ""}


def test_normalize_with_rejects_commits_both(spark, tmp_path):
    raw = raw_events(spark)
    raw.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (
        normalize_with_rejects(
            stream, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "checkpoint")
        )
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3
    bad = spark.read.parquet(str(tmp_path / "bad")).select("reject_reason").collect()
    assert sorted(r[0] for r in bad) == ["missing_id", "missing_tx_hash"]


def test_old_ids_that_land_late_are_kept(spark, tmp_path):
    """Unseen ids pass however old they are; repeats are suppressed and counted."""
    def delivery(ids, at):
        return [(f"e{i}", "eth", S.TYPE_LOG, "", "a", "b", at + i, 10) for i in ids]

    schema = raw_events(spark).schema
    columns = (
        "id string, chain string, type string, tx_hash string, from_address string, "
        "to_address string, o bigint, t bigint"
    )
    deliveries = [delivery(range(50, 100), 900_000), delivery(range(50), 0), delivery(range(40, 60), 900_005)]
    paths = {n: str(tmp_path / n) for n in ("in", "good", "bad", "seen", "counts", "checkpoint", "plain", "plaincp")}
    for rows_ in deliveries:
        frame_ = spark.createDataFrame(rows_, columns).withColumns(
            {"observed_at": F.timestamp_seconds("o"), "block_time": F.timestamp_seconds("t"),
             "attributes": F.create_map().cast("map<string,string>")}
        ).drop("o", "t")
        frame_.coalesce(1).write.mode("append").parquet(paths["in"])
        query = (
            normalize_with_rejects(
                spark.readStream.schema(schema).parquet(paths["in"]), paths["good"], paths["bad"],
                paths["checkpoint"], seen_path=paths["seen"], horizon="20 days", counts_path=paths["counts"],
            ).trigger(availableNow=True).start()
        )
        assert query.awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(paths["good"]).collect()) == sorted(f"e{i}" for i in range(100))
    counts = spark.read.parquet(paths["counts"]).orderBy("batch_id").collect()
    assert [(r.received, r.rejected, r.kept, r.suppressed) for r in counts] == [(50, 0, 50, 0), (50, 0, 50, 0), (20, 0, 0, 20)]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(paths["in"])
    query = append_stream(normalized_stream(stream), paths["plain"], paths["plaincp"])
    assert query.trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(paths["plain"]).count() == 100


def test_two_tails_each_see_every_new_match(spark, tmp_path):
    raw = raw_events(spark)
    raw.coalesce(1).write.parquet(str(tmp_path / "in"))
    start = raw.agg(F.max("observed_at")).first()[0]
    for n in range(2):
        stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
        query = (
            tail_events(stream, start, chain="ETH")
            .writeStream.format("parquet")
            .option("path", str(tmp_path / f"out{n}"))
            .option("checkpointLocation", str(tmp_path / f"checkpoint{n}"))
            .trigger(availableNow=True)
            .start()
        )
        assert query.awaitTermination(120)
        assert [r.id for r in spark.read.parquet(str(tmp_path / f"out{n}")).collect()] == ["e3"]


def test_a_tail_opens_no_file_of_earlier_days(spark, tmp_path):
    """Old days hold a broken file: only a reader that opens it can fail on it."""
    raw = raw_events(spark).withColumn("day", F.explode(F.array(*[F.lit(k) for k in range(5)])))
    events = raw.withColumn("observed_at", F.timestamp_seconds(F.unix_seconds("observed_at") + F.col("day") * 86_400)).drop("day")
    path = str(tmp_path / "in")
    land_by_day(events, path)
    for old in ("1970-01-01", "1970-01-02"):
        for file in (tmp_path / "in" / f"arrival_day={old}").glob("*.parquet"):
            file.write_bytes(b"not a table")
        for file in (tmp_path / "in" / f"arrival_day={old}").glob(".*.crc"):
            file.unlink()
    start = dt.datetime(1970, 1, 3, 0, 0, 12, tzinfo=dt.timezone.utc)

    def run(n):
        tail = tail_events(stream_by_day(spark, path, events.schema), start, chain="ETH")
        query = append_stream(tail, str(tmp_path / f"out{n}"), str(tmp_path / f"cp{n}")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return query.lastProgress.numInputRows

    for n in range(2):
        assert run(n) == 15  # the rows of three days
    land_by_day(events.filter(F.col("observed_at") > F.lit(start)), path)
    for n in range(2):
        run(n)
        seen = spark.read.parquet(str(tmp_path / f"out{n}")).count()
        assert seen == 2 * events.filter((F.col("observed_at") >= F.lit(start)) & (F.col("chain") == "eth")).count() - 1
