"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair gets a pseudo-random number ``u``; a record goes to the
shard with the smallest ``-ln(u) / weight``. A shard's share follows its weight,
the key and the shards alone decide, and a new shard only takes records into
itself, because the scores of the old shards stay as they were.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide.llm.common import text_or_empty
from blocktide.session import materialize

#: Rows numbered by one window; more rows make more blocks, never larger ones.
BLOCK_ROWS = 1024


def rendezvous(key: Column, weights: Mapping[int, float] | Sequence[float]) -> Column:
    """The shard of ``key`` among ``weights`` (shard id to weight, or a list).

    A null key is a key like any other, so such rows share a shard. Shards of
    weight 0 take nothing; ties go to the smaller shard id.
    """
    pairs = weights.items() if isinstance(weights, Mapping) else enumerate(weights)
    live = sorted((int(s), float(w)) for s, w in pairs if w > 0)
    if not live:
        raise ValueError("no shard has a weight above 0")
    shards = F.array(*[F.struct(F.lit(s).alias("id"), F.lit(w).alias("w")) for s, w in live])

    def score(shard: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, shard["id"]), 11)
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.ln(u) / shard["w"]).alias("score"), shard["id"].alias("id"))

    return F.array_min(F.transform(shards, score))["id"]


def assign_shards(
    df: DataFrame, key: str, weights: Mapping[int, float] | Sequence[float], out: str = "shard"
) -> DataFrame:
    """``df`` with column ``out`` added; a narrow projection, no shuffle."""
    return df.withColumn(out, rendezvous(F.col(key), weights))


def number_slots(df: DataFrame, order: Sequence[str], shard: str = "shard") -> DataFrame:
    """``df`` with ``slot``: 0, 1, ... without gaps inside each shard.

    Rows are dealt over many blocks of a shard, numbered inside their block and
    moved up by the sizes of the blocks before it. The block holds a row number,
    so equal rows spread; it is written first, so every retry sees the same one.
    """
    rows_written, rows = materialize(
        df.withColumn("_row", F.monotonically_increasing_id()), "slots"
    )
    shards = max(1, rows_written.select(shard).distinct().count())
    blocks = max(1, rows // (shards * BLOCK_ROWS))
    dealt = rows_written.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    counts = dealt.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.selectExpr(
        f"`{shard}` AS _shard",
        "_block AS _at",
        f"sum(_n) OVER (PARTITION BY `{shard}` ORDER BY _block) - _n AS _before",
    )
    keys = ", ".join(f"`{c}`" for c in [*order, "_row"])
    numbered = dealt.withColumn(
        "_in_block", F.expr(f"row_number() OVER (PARTITION BY `{shard}`, _block ORDER BY {keys})")
    )
    joined = numbered.join(
        before, (F.col(shard) == F.col("_shard")) & (F.col("_block") == F.col("_at"))
    )
    slot = (F.col("_before") + F.col("_in_block") - 1).cast("long")
    return joined.withColumn("slot", slot).select(*df.columns, "slot")


def write_shards(assigned: DataFrame, path: str, files: int = 1, shard: str = "shard") -> None:
    """Write one folder for each shard, each of about ``files`` files."""
    n = assigned.select(shard).distinct().count() * files
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files))
    dealt = assigned.withColumn("_part", spread).repartition(max(1, n), shard, "_part")
    dealt.drop("_part").write.partitionBy(shard).parquet(path)


def shard_documents(
    docs: DataFrame,
    shards: int,
    weights: Sequence[float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each document: where it goes now, and with one more shard.

    Null texts have size 16 and the checksum of the empty text; repeated rows
    get one shard and a slot each; an empty table gives no rows. Only the id and
    text columns are read.
    """
    base = list(weights) if weights is not None else [1.0] * shards
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign_shards(rows, "doc_id", base)
    placed = assign_shards(placed, "doc_id", [*base, 1.0], "grown_shard")
    return number_slots(placed, ["doc_id"])
