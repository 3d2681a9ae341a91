"""Benchmark decontamination by a prefix-filtered set join.

An item's windows of consecutive words are compared with the documents exactly.
A first pass counts the items' shingles in the documents; the shingles of a window
are ordered by how rare they are. As the whole window has to be contained, its
prefix is one shingle, the rarest: only where that occurs can the window occur. The
second pass joins prefixes only. The place of the shingle and the lengths bound
where the window starts, and there all of its words are compared.

Shingles are 64-bit hashes: two that share one cost a comparison more.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide.llm.common import BROADCAST_ROWS, row_key, small_side, text_or_empty
from blocktide.session import materialize

#: What separates words: ASCII other than digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a shingle; windows of fewer words have one shingle.
SHINGLE = 3
#: A shingle with this many occurrences is never a key of a shuffle.
HOT = 100_000


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only. Pure ASCII takes the fast function."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(slow)


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN), "")


def shingles(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """(*keep, pos, shingle) for each run of ``size`` words of the array ``w``."""
    count = F.greatest(F.size("w") - (size - 1), F.lit(0))
    runs = F.arrays_zip(*[F.slice("w", k + 1, count) for k in range(size)])
    placed = rows.select(*keep, F.posexplode(runs).alias("pos", "run"))
    said = [F.col("run").getField(str(k)) for k in range(size)]
    return placed.select(*keep, "pos", F.xxhash64(F.lit(size), *said).alias("shingle"))


def all_shingles(rows: DataFrame, sizes: list[int], met: DataFrame | None = None) -> DataFrame:
    """Just the shingles, of all ``sizes``; with ``met`` those that are in it."""
    found = [shingles(rows, s).select("shingle") for s in sizes]
    if met is not None:
        found = [f.join(met, "shingle", "left_semi") for f in found]
    return reduce(DataFrame.unionAll, found)


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, said, n_said): the distinct windows of each item."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words(text_or_empty("text")).alias("w"),
    ).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = items.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("w"))
    return cut.select("item", F.array_join("w", " ").alias("said"), F.size("w").alias("n_said")).distinct()


def rarest_shingles(
    rows: DataFrame, said: DataFrame, sizes: list[int], few: int
) -> tuple[DataFrame, int]:
    """(said, n_said, size, shingle, offset, n): the prefix of each window, and their number.

    Windows with a shingle that no document holds are left out. Counts cover all
    documents and are added up in the tasks before they are shuffled.
    """
    cut = said.withColumn("w", F.split("said", " "))
    size = F.least("n_said", F.lit(SHINGLE))
    spread = reduce(
        DataFrame.unionAll,
        [
            shingles(cut.filter(size == s), s, "said", "n_said").withColumn("size", F.lit(s))
            for s in sizes
        ],
    )
    wanted, n_wanted = materialize(spread.select("shingle").distinct(), "shingles")
    # Of many wanted ones, the counts of all shingles meet them, one row each.
    only = F.broadcast(wanted) if n_wanted <= few else None
    here = all_shingles(rows.select("w"), sizes, met=only)
    counts = here.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    counts, _ = materialize(counts.join(wanted, "shingle", "left_semi"), "counts")
    chosen = spread.join(counts, "shingle", "left").groupBy("said", "n_said", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", F.col("pos").alias("offset"))).alias("p")
    )
    return materialize(
        chosen.filter(F.col("p.n") > 0).select("said", "n_said", "size", "p.shingle", "p.offset", "p.n"),
        "prefixes",
    )


def occurs(start: Column) -> Column:
    """Whether window ``said`` stands in the words ``w`` from ``start``, bounds first."""
    inside = (start >= 0) & (start + F.col("n_said") <= F.size("w"))
    # A slice must not begin before the array, even where the bounds say no.
    there = F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("n_said"))
    return inside & (F.array_join(there, " ") == F.col("said"))


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int,
    id_column: str,
    text_column: str,
    few: int = BROADCAST_ROWS,
    hot: int = HOT,
) -> tuple[DataFrame, DataFrame]:
    """Where windows occur, (key_id, key_text, start, n_said, said), and the windows.

    Up to ``few`` prefixes are broadcast to the documents and their windows
    compared in the row. Of more, those that occur ``hot`` times or more are broadcast
    in blocks; the others, none of them a hot key, meet the documents in a shuffle.
    """
    if not 0 < window <= 60:
        raise ValueError("window must be between 1 and 60 words")
    windows, _ = materialize(item_windows(benchmark, window), "windows")
    said = windows.select("said", "n_said").distinct()
    lengths = said.select(F.least("n_said", F.lit(SHINGLE)).alias("size")).distinct()
    sizes = sorted(r["size"] for r in lengths.collect())  # at most SHINGLE
    rows = docs.select(*row_key(id_column, text_column), words(text_or_empty(text_column)).alias("w"))
    columns = ["key_id", "key_text", "start", "n_said", "said"]
    if not sizes:  # no item has a word
        none = rows.select("key_id", "key_text", F.lit(0).alias("start"), F.lit(0).alias("n_said"), F.lit("").alias("said"))
        return none.filter(F.lit(False)), windows
    prefixes, n_prefixes = rarest_shingles(rows, said, sizes, few)
    start = F.col("pos") - F.col("offset")

    def met(some: DataFrame) -> DataFrame:
        # Words stay in the row's own stage: only windows that occur leave it.
        found = [
            shingles(rows, s, "key_id", "key_text", "w")
            .join(F.broadcast(some.filter(F.col("size") == s)), "shingle")
            .filter(occurs(start))
            .select("key_id", "key_text", start.alias("start"), "n_said", "said")
            for s in sizes
        ]
        return reduce(DataFrame.unionAll, found)

    if n_prefixes <= few:
        return met(prefixes), windows
    frequent = prefixes.filter(F.col("n") >= hot)
    blocks = -(-frequent.count() // few)
    found = [met(frequent.filter(F.pmod(F.xxhash64("said"), F.lit(blocks)) == b)) for b in range(blocks)]
    others = prefixes.filter(F.col("n") < hot).drop("size").hint("shuffle_hash")
    placed = reduce(
        DataFrame.unionAll, [shingles(rows, s, "key_id", "key_text") for s in sizes]
    ).join(others, "shingle")
    starts = placed.select("key_id", "key_text", start.alias("start"), "n_said", "said").distinct()
    keyed = rows.select(F.col("key_id").alias("_id"), F.col("key_text").alias("_text"), "w").join(
        starts, F.col("_id").eqNullSafe(F.col("key_id")) & (F.col("_text") == F.col("key_text"))
    )
    found.append(keyed.filter(occurs(F.col("start"))).select(*columns))
    return reduce(DataFrame.unionAll, found), windows


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    A word is hit if some occurrence of a window covers it. Items with fewer
    words than ``window`` are one window, items without words have none; null and
    empty texts have no words. Repeated documents and items count once each and
    every row gets its result; a null item_id is the empty string; empty tables
    give no rows or no hits. Other columns are ignored.
    """
    found, windows = find_windows(docs, benchmark, window, id_column, text_column)
    hits, _ = materialize(found, "hits")
    covered = hits.select("key_id", "key_text", "start", (F.col("start") + F.col("n_said")).alias("end"))
    covered = covered.groupBy("key_id", "key_text", "start").agg(F.max("end").alias("end"))
    before = F.expr(
        "coalesce(max(end) OVER (PARTITION BY key_id, key_text ORDER BY start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    fresh = covered.withColumn("before", before)
    fresh = fresh.select("key_id", "key_text", F.expr("greatest(0, end - greatest(start, before))").alias("n"))
    n_hit = fresh.groupBy("key_id", "key_text").agg(F.sum("n").alias("n_hit"))
    n_windows = windows.count()
    named = hits.select("key_id", "key_text", "said").distinct().join(
        small_side(windows.select("said", "item"), n_windows), "said"
    )
    items = named.groupBy("key_id", "key_text").agg(F.collect_set("item").alias("items"))
    of_key = (
        n_hit.withColumn("items", F.lit(None).cast("array<string>"))
        .unionByName(items.withColumn("n_hit", F.lit(None).cast("long")))
        .groupBy(F.col("key_id").alias("_id"), F.col("key_text").alias("_text"))
        .agg(F.max("n_hit").alias("n_hit"), F.array_sort(F.max("items")).alias("items"))
    )
    rows = docs.select(*row_key(id_column, text_column), F.size(words(text_or_empty(text_column))).alias("n_words"))
    joined = rows.join(
        of_key,
        F.col("key_id").eqNullSafe(F.col("_id")) & (F.col("key_text") == F.col("_text")),
        "left",
    )
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("key_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, whole, in which no window of an item occurs."""
    found, _ = find_windows(docs, benchmark, window, id_column, text_column)
    bad, n_bad = materialize(
        found.select(F.col("key_id").alias("_id"), F.col("key_text").alias("_text")).distinct(), "bad"
    )
    key_id, key_text = row_key(id_column, text_column)
    return docs.join(
        small_side(bad, n_bad), key_id.eqNullSafe(bad["_id"]) & (key_text == bad["_text"]), "left_anti"
    )
