"""Heads and bodies as streams: any landing order, redelivery, retries, bounded state."""

import json
import time

from pyspark.sql import functions as F

from blocktide.sources.chain_json import decode_blocks
from blocktide.sources.events import stream_events
from blocktide.streaming.decode import block_events, decode_transactions, log_heads, matched_bodies, read_head_log

LANDED = "value string, observed_at timestamp"
SHOWN = ("id", "type", "block_number", "block_hash", "tx_hash", "value_wei", "observed_at", "block_time")


def landed(spark, rows):
    df = spark.createDataFrame([(json.dumps(v) if isinstance(v, dict) else v, at) for v, at in rows], "value string, at long")
    return df.select("value", F.timestamp_seconds("at").alias("observed_at"))


def head(number, at=100, suffix="", stamp=True):
    return {"number": hex(number), "hash": f"0xh{number}{suffix}", "timestamp": hex(at) if stamp else "soon"}


def body(number, n=2, own_hash=None):
    txs = [{"hash": f"0xt{number}-{k}", "from": "0xA", "to": None, "value": hex(10**19 + k)} for k in range(n)]
    return {"number": hex(number), "transactions": txs} | ({"hash": own_hash} if own_hash else {})


class Job:
    def __init__(self, spark, path, wait="10 minutes", remember=10_000_000):
        self.spark, self.path, self.wait, self.remember = spark, str(path), wait, remember
        self.progress = []
        for name in ("heads", "bodies"):
            landed(spark, [("", 0)]).limit(0).write.parquet(f"{self.path}/{name}")

    def land(self, name, rows):
        landed(self.spark, rows).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def run(self):
        p, spark = self.path, self.spark
        streams = {n: stream_events(spark, f"{p}/{n}", schema=LANDED) for n in ("heads", "bodies")}
        writers = (
            lambda: log_heads(streams["heads"], f"{p}/log", f"{p}/seen", f"{p}/cp1", f"{p}/bad", self.remember),
            lambda: decode_transactions(
                read_head_log(spark, f"{p}/log"), streams["bodies"], f"{p}/events", f"{p}/unanswered", f"{p}/cp2",
                wait=self.wait,
            ),
        )
        for make in writers:
            query = make().trigger(availableNow=True).start()
            assert query.awaitTermination(180)
            self.progress.append(query.lastProgress)

    def events(self):
        blocks = block_events(read_head_log(self.spark, f"{self.path}/log", stream=False))
        txs = self.spark.read.schema(blocks.schema).parquet(f"{self.path}/events").select(*blocks.columns)
        return sorted(tuple(r) for r in blocks.unionByName(txs).select(*SHOWN).collect())

    def unanswered(self):
        return sorted(int(r.number) for r in self.spark.read.parquet(f"{self.path}/unanswered").collect())


def test_any_landing_order_equals_the_static_decoder(spark, tmp_path):
    job = Job(spark, tmp_path)
    heads = [(head(n, 100 + n), 200 + n) for n in range(12)]
    heads += [(head(3, 103, "fork"), 300), (head(5, 105, stamp=False), 190), (head(20, stamp=False), 240)]
    bodies = [(body(n, n % 3), 250 + n) for n in range(12) if n not in (3, 4)]
    bodies += [(body(3, 2, own_hash="0xh3fork"), 260), (body(20), 261), (body(99), 262)]
    job.land("bodies", bodies[6:])
    job.land("heads", heads[:5])
    job.run()
    job.land("heads", heads[10:])
    job.run()
    job.land("bodies", bodies[:6])
    job.land("heads", heads[5:10])
    job.run()
    static = decode_blocks(landed(spark, heads), landed(spark, bodies)).select(*SHOWN)
    got = job.events()
    # The second report of head 5 came a batch later, so its time is that of the first batch.
    assert {r[:6] for r in got} == {tuple(r)[:6] for r in static.collect()}
    assert [r for r in got if "h5" not in r[3]] == sorted(tuple(r) for r in static.collect() if "h5" not in r.block_hash)
    assert job.unanswered() == []


def test_redelivery_and_retries_add_nothing(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.land("heads", [(head(1), 9), (head(1), 7), (head(2), 8), ({"number": "zz"}, 8), ("{", 8)])
    job.land("bodies", [(body(1), 9), (body(1), 10)])
    job.run()
    first = job.events()
    assert len(first) == 4 and min(r[6] for r in first if r[1].endswith("BLOCK")).second == 7
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    job.land("heads", [(head(1), 50)])
    job.land("bodies", [(body(1), 51), (body(2), 52)])
    job.run()
    assert len(job.events()) == 6 and set(first) < set(job.events())
    # A lost commit makes the last batch of the log run again; the stream behind it sees new files.
    (tmp_path / "cp1" / "commits" / "1").unlink()
    (tmp_path / "cp1" / "commits" / ".1.crc").unlink(missing_ok=True)
    before = job.events()
    job.run()
    assert job.events() == before


def test_unanswered_heads_are_told_of_and_state_is_bounded(spark, tmp_path):
    job = Job(spark, tmp_path, wait="2 seconds")
    sizes = []
    for n in range(7):
        job.land("heads", [(head(10 * n + k), 5) for k in range(10)])
        job.land("bodies", [(body(10 * n + k), 6) for k in range(1, 10)])
        job.run()
        sizes.append(sum(s.numRowsTotal for s in job.progress[-1].stateOperators))
        time.sleep(2)
    told = job.unanswered()
    assert told[:5] == [0, 10, 20, 30, 40] and len(told) == len(set(told)) and all(n % 10 == 0 for n in told)
    assert max(sizes[3:]) <= max(sizes[:3])
    assert len([r for r in job.events() if r[1].endswith("TRANSACTION")]) == 7 * 9 * 2


def test_remembered_heads_are_bounded(spark, tmp_path):
    job = Job(spark, tmp_path, remember=20)
    sizes = []
    for n in range(5):
        job.land("heads", [(head(10 * n + k), 5) for k in range(10)] + [(head(10 * n - 1), 6)] * (n > 0))
        query = log_heads(
            stream_events(spark, f"{tmp_path}/heads", schema=LANDED), f"{tmp_path}/log", f"{tmp_path}/seen", f"{tmp_path}/cp1",
            remember=20,
        ).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        (manifest,) = [p for p in (tmp_path / "seen").glob(f"manifest-{n}.json")]
        sizes.append(sum(g["rows"] for g in json.loads(manifest.read_text())))
    numbers = [int(r.number) for r in read_head_log(spark, f"{tmp_path}/log", stream=False).collect()]
    assert sorted(numbers) == list(range(50))
    assert max(sizes) <= 30


def test_joined_stream_keeps_its_columns(spark, tmp_path):
    job = Job(spark, tmp_path)
    log = landed(spark, []).select(
        F.lit(1).cast("decimal(20,0)").alias("number"), F.lit("h").alias("block_hash"),
        F.col("observed_at").alias("block_time"), "observed_at",
    )
    log.write.parquet(f"{job.path}/log")
    joined = matched_bodies(read_head_log(spark, f"{job.path}/log"), stream_events(spark, f"{job.path}/bodies", schema=LANDED))
    assert joined.isStreaming
    assert joined.columns == ["number", "block_hash", "block_time", "observed_at", "transactions", "answered"]


def test_no_bodies_at_all(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.land("heads", [(head(1), 5)])
    job.run()
    assert len(job.events()) == 1
