"""Close and late rules: hand cases, random trials against the model, partitioned path."""

import random
import re

import pytest
from pyspark.sql import functions as F

from blocktide import schemas as S
from blocktide.operators.enrich import enrich
from blocktide.operators.lateness import Replay, running_min_from_end
from blocktide.operators.validate import valid_events
from tests.model import random_times, run_chain

COLUMNS = (
    "id string, chain string, type string, from_address string, value_wei string, "
    "gas_used bigint, at bigint, t bigint"
)


def frame(spark, rows):
    """Rows of (chain, arrival second, block second[, type, from, value, gas])."""
    full = []
    for i, (chain, at, t, *rest) in enumerate(rows):
        type_name, sender, value, gas = [*rest, *[S.TYPE_BLOCK, "", "", 0][len(rest):]]
        full.append((f"e{i:06d}", chain, type_name, sender, value, gas, at, t))
    df = spark.createDataFrame(full, COLUMNS)
    return df.withColumns(
        {"observed_at": F.timestamp_seconds("at"), "block_time": F.timestamp_seconds("t")}
    ).drop("at", "t")


def sequence(spark, *events):
    return frame(spark, [(c, i, t, *rest) for i, (c, t, *rest) in enumerate(events)])


def totals(df):
    rows = df.filter("metric = 'events_total' and labels_key = ''")
    return {
        (r.chain, r.s): r.value
        for r in rows.select("chain", F.unix_seconds("window_start").alias("s"), "value").collect()
    }


def late_ids(replay):
    return sorted(r.id for r in replay.flagged().filter("is_late").select("id").collect())


@pytest.mark.parametrize(
    "events, lateness, late, closed",
    [
        # One open window; then an event that reaches its end; windows are 60 s.
        ([("base", 185), ("base", 239)], 0, [], {}),
        ([("base", 181), ("base", 199), ("base", 305)], 0, [], {("base", 180): 2}),
        ([("base", 200), ("base", 301), ("base", 188)], 0, [2], {("base", 180): 1}),
        ([("base", 202), ("base", 255), ("base", 231), ("base", 290)], 50, [], {("base", 180): 2}),
        ([("base", 200), ("base", 310), ("op", 12)], 0, [], {("base", 180): 1}),
        # An old event is still taken while nothing that late has closed, and closes at once.
        ([("base", 4000), ("base", 700), ("base", 715)], 0, [2], {("base", 660): 1}),
    ],
)
def test_hand_cases(spark, events, lateness, late, closed):
    replay = Replay(sequence(spark, *events), size=60, lateness=lateness)
    assert late_ids(replay) == [f"e{i:06d}" for i in late]
    assert totals(replay.metrics()) == closed


def test_flush_emits_open_windows(spark):
    replay = Replay(sequence(spark, ("eth", 10), ("sol", 5)), size=60, lateness=0)
    assert totals(replay.metrics()) == {}
    assert totals(replay.metrics(flush=True)) == {("eth", 0): 1, ("sol", 0): 1}


def test_metric_contents(spark):
    tx = S.TYPE_TRANSACTION
    events = sequence(
        spark,
        ("eth", 1, tx, "alice", "1000000000000000000", 21000),
        ("eth", 2, tx, "bob", "2000000000000000000", 21000),
        ("eth", 3, tx, "alice", "500000000000000000", 50000),
        ("eth", 4),
    )
    rows = Replay(events, size=60, lateness=0).metrics(flush=True).collect()
    got = {(r.metric, r.labels_key): (r.value, r.value_exact) for r in rows}
    assert got == {
        ("events_total", "type=EVENT_TYPE_BLOCK"): (1.0, "1"),
        ("events_total", "type=EVENT_TYPE_TRANSACTION"): (3.0, "3"),
        ("events_total", ""): (4.0, "4"),
        ("gas_used_total", ""): (92000.0, "92000"),
        ("value_wei_total", ""): (3.5e18, "3500000000000000000"),
        ("active_addresses", ""): (2.0, "2"),
    }
    assert {r.labels_key: r.labels for r in rows if r.labels_key} == {
        f"type={t}": {"type": t} for t in (S.TYPE_BLOCK, tx)
    }


def test_malformed_wei_counts_as_zero(spark):
    event = ("eth", 1, S.TYPE_TRANSACTION, "alice", "not-a-number", 1)
    rows = Replay(sequence(spark, event), size=60, lateness=0).metrics(flush=True).collect()
    got = {r.metric: r.value for r in rows if not r.labels_key}
    assert got["value_wei_total"] == 0 and got["events_total"] == 1


def trial(spark, seed, chains=120):
    rng = random.Random(seed)
    size, lateness = rng.choice([60, 420, 37]), rng.choice([0, 30, 90])
    rows, expect_late, expect_closed, expect_flushed = [], set(), {}, {}
    for c in range(chains):
        times = random_times(rng, rng.randrange(1, 40))
        late, closed, still_open = run_chain(times, size, lateness)
        first = len(rows)
        rows += [(f"c{c}", i, t) for i, t in enumerate(times)]
        expect_late |= {f"e{first + i:06d}" for i, flag in enumerate(late) if flag}
        expect_closed |= {(f"c{c}", e - size): len(m) for e, m in closed}
        expect_flushed |= {(f"c{c}", e - size): len(m) for e, m in still_open.items()}
    expect_flushed |= expect_closed
    return frame(spark, rows), size, lateness, expect_late, expect_closed, expect_flushed


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("path", [{}, {"small_rows": 0, "hot_events": 3}])
def test_replay_equals_model(spark, seed, path):
    events, size, lateness, late, closed, flushed = trial(spark, seed)
    replay = Replay(events, size=size, lateness=lateness, **path)
    assert replay.small != bool(path)
    assert set(late_ids(replay)) == late
    assert totals(replay.metrics()) == closed
    assert totals(replay.metrics(flush=True)) == flushed


def test_no_events(spark):
    events = sequence(spark, ("eth", 10)).filter("chain = 'none'")
    replay = Replay(events, size=60, lateness=0)
    assert late_ids(replay) == [] and totals(replay.metrics(flush=True)) == {}


def test_numeric_arrival_key(spark):
    events, size, lateness, late, closed, _ = trial(spark, 11, chains=40)
    replay = Replay(
        events.withColumn("seq", F.unix_seconds("observed_at")),
        size=size,
        lateness=lateness,
        arrival=["seq"],
    )
    assert set(late_ids(replay)) == late
    assert totals(replay.metrics()) == closed


def test_ties_in_arrival_time_follow_the_id(spark):
    # Same arrival second: the first id closes window 0, so the second one is late.
    rows = [("eth", 0, 10), ("eth", 5, 90), ("eth", 5, 20)]
    replay = Replay(frame(spark, rows), size=60, lateness=0)
    assert late_ids(replay) == ["e000002"]


def test_blocked_scan_equals_plain_scan(spark):
    rng = random.Random(3)
    size = 1_000_000
    rows = [
        (f"c{c}", e * size, rng.randrange(1000) if rng.random() < 0.7 else None)
        for c in range(3)
        for e in rng.sample(range(60_000), 400)
    ]
    df = spark.createDataFrame(rows, "chain string, e bigint, v bigint")
    plain = running_min_from_end(df, "v", size, small=True)
    blocked = running_min_from_end(df, "v", size, small=False)
    assert sorted(plain.collect(), key=str) == sorted(blocked.collect(), key=str)


def test_event_scans_are_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([], S.CHAIN_EVENT).write.parquet(path)
    events = enrich(valid_events(spark.read.schema(S.CHAIN_EVENT).parquet(path)))
    metrics = Replay(events).metrics()
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "value_wei" in line)
    columns = set(re.search(r"FileScan parquet \[(.*?)\]", scan).group(1).split(","))
    names = {c.split("#")[0] for c in columns}
    assert not names & {"attributes", "to_address", "block_hash", "block_number"}
    logical = metrics._jdf.queryExecution().optimizedPlan().toString()
    pushed = scan.split("PushedFilters: ")[1]
    assert "Not(EqualTo(id,))" in pushed and "In(type" in pushed
    assert "contract_label" not in logical
