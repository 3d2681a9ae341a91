import zlib

from pyspark.sql import functions as F

from blocktide.llm.sharding import assign_shards, shard_documents, write_shards
from tests.llm.cases import ODD_ROWS, SMALL, no_documents, odd_documents


def test_law_sizes_slots_and_growth(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = shard_documents(docs, 40).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    seen = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        seen.setdefault(r.shard, []).append(r.slot)
    for slots in seen.values():
        assert sorted(slots) == list(range(len(slots)))
    again = {r.doc_id: r.shard for r in shard_documents(docs.repartition(5), 40).collect()}
    assert again == {r.doc_id: r.shard for r in rows}


def test_shares_follow_weights_and_few_move(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "key")
    placed = assign_shards(ids, "key", {0: 1.0, 1: 2.0, 2: 5.0, 3: 0.0})
    placed = assign_shards(placed, "key", {0: 1.0, 1: 2.0, 2: 5.0, 4: 2.0}, "grown")
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert set(counts) == {0, 1, 2}
    for shard, share in ((0, 1 / 8), (1, 2 / 8), (2, 5 / 8)):
        assert abs(counts[shard] / 40_000 - share) < 0.015
    moved = placed.filter("shard <> grown")
    assert moved.filter("grown <> 4").count() == 0
    assert abs(moved.count() / 40_000 - 0.2) < 0.015


def test_odd_rows(spark, tmp_path):
    rows = shard_documents(odd_documents(spark), 3).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id in (3, 4)} == {(16, 0)}
    assert len({r.shard for r in rows if r.doc_id == 2}) == 1
    assert shard_documents(no_documents(spark), 3).count() == 0
    placed = assign_shards(odd_documents(spark).select("doc_id", "text"), "doc_id", [1.0] * 3)
    write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("doc_id", F.col("shard").cast("int")).exceptAll(
        placed.select("doc_id", "shard")
    ).count() == 0 and back.count() == len(ODD_ROWS)
