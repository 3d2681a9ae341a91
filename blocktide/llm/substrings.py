"""Removal of repeated substrings with suffix arrays.

Every byte is removed that lies in a string of ``length`` bytes which starts
anywhere else, too. Strings are dealt to shards by an anchor: the smallest hash
among the substrings of ``GRAM`` bytes in it, so equal strings meet. Consecutive
strings with one anchor form a segment. Segments whose anchor stands in one
place hold nothing repeated; equal segments are repeated throughout; of the others each
shard builds a suffix array and compares neighbours in it.

Passages of ``words`` words that also stand in another text are found along the way and
counted, not removed: these may have fewer bytes than ``length``. They are dealt in the same
manner, with words in place of bytes; the lowest bit of an anchor tells the two apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocktide.llm.common import small_side, text_or_empty
from blocktide.llm.suffixes import permuted_prefixes, suffix_array
from blocktide.session import materialize

#: Bytes of an anchor, half of a string or less.
GRAM = 200
#: Words of an anchor of a passage.
WORD_GRAM = 16
#: Starts in a segment, at most; a text of one repeated character has one anchor throughout.
SEGMENT_STARTS = 512
#: Bytes that one suffix array covers, about. Anchors whose segments do not fit in one are
#: compared string by string, spread over all tasks.
SHARD_BYTES = 1_000_000
#: Bytes of texts that are handed on together, about.
TOGETHER = 500_000
#: Starts of a long text that are hashed at once.
CHUNK = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.frombuffer(hashlib.shake_128(b"bytes").digest(256 * 8), np.uint64)
_WHITE = np.zeros(256, np.bool_)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True  # as bytes.split() takes it


def powers(count: int, base: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Grams:
    """Hashes of consecutive values, by differences of running sums."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self.up):
            inverse = pow(int(_BASE), -1, 1 << 64)
            count = max(len(values) + 1, min(2 * len(values), CHUNK))
            self.up, self.down = powers(count, int(_BASE)), powers(count, inverse)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return sums

    def __call__(self, values: np.ndarray, width: int) -> np.ndarray:
        """Of each ``width`` values."""
        sums = self.sums(values)
        return mixed((sums[width:] - sums[:-width]) * self.down[: len(values) - width + 1])

    def words(self, data: bytes, at: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Of each word that stands in the bytes from ``at`` to ``until``."""
        whole, out, k = np.frombuffer(data, np.uint8), np.empty(len(at), np.uint64), 0
        while k < len(at):
            end = np.searchsorted(until, at[k] + CHUNK, side="right")
            if end == k:  # longer than a chunk
                out[k] = xxhash.xxh3_64_intdigest(data[at[k] : until[k]])
                k += 1
                continue
            sums = self.sums(_BYTES[whole[at[k] : until[end - 1]]])
            first = at[k:end] - at[k]
            out[k:end] = mixed((sums[until[k:end] - at[k]] - sums[first]) * self.down[first])
            k = end
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from minima within blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    inside = np.zeros(len(data) + 2, np.bool_)
    inside[1:-1] = ~_WHITE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def joined(texts: list[bytes]) -> tuple:
    """The texts in one, where its words begin and end, and for each text the number of words up to its end, and in it."""
    data = b" ".join(texts)
    at, until = word_places(data)
    ends = np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts]))
    return data, at, until, ends, np.diff(ends, prepend=0)


def segments(
    units: np.ndarray, length: int, gram: int, grams: Grams, breaks: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors, first starts and last starts (inclusive) of the segments of a text, and
    whether the anchor stands in more than one place: then a string may repeat inside.

    ``units`` are the bytes of the text, or hashes of words; ``gram`` of them are an anchor.
    A segment begins at each of ``breaks``, too.
    """
    starts = len(units) - length + 1
    for at in range(0, max(0, starts), CHUNK):
        n = min(CHUNK, starts - at)
        values = units[at : at + n + length - 1]
        hashes = grams(_BYTES[values] if units.dtype == np.uint8 else values, gram)
        anchor = sliding_least(hashes, length - gram + 1)
        first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        if breaks is not None:
            first = np.union1d(first, breaks[(breaks > at) & (breaks < at + n)] - at)
        last = np.concatenate((first[1:], [n])) - 1
        if (last - first).max() >= SEGMENT_STARTS:
            first = np.concatenate([np.arange(f, e + 1, SEGMENT_STARTS) for f, e in zip(first, last)])
            last = np.concatenate((first[1:], [n])) - 1
        around = np.lib.stride_tricks.sliding_window_view(hashes, length - gram + 1)
        leftmost = first + around[first].argmin(axis=1)
        rightmost = last + length - gram - around[last][:, ::-1].argmin(axis=1)
        yield anchor[first], first + at, last + at, leftmost != rightmost


SEGMENTS = (
    "name binary, anchor long, segment long, first long, last long, inner boolean, at long, until long"
)


def _anchors(rows: DataFrame, length: int, words: int) -> DataFrame:
    """(name, anchor, segment, first, last, inner, at, until) of every segment.

    ``segment`` hashes what is in it. ``first`` and ``last`` count bytes, or words where the
    anchor is odd; the words stand in the bytes from ``at`` to ``until``. A task tells of equal
    texts once: that they are copies is counted elsewhere.
    """

    def hashed(units: np.ndarray, width: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        view, size = memoryview(units).cast("B"), units.itemsize
        starts, ends = (first * size).tolist(), ((last + width) * size).tolist()
        return np.array([xxhash.xxh3_64_intdigest(view[f:e]) for f, e in zip(starts, ends)], np.uint64)

    def by_byte(texts: list[bytes], grams: Grams) -> Iterator[tuple[np.ndarray, ...]]:
        for k, data in enumerate(texts):
            units = np.frombuffer(data, np.uint8)
            for anchor, first, last, inner in segments(units, length, GRAM, grams):
                yield np.full(len(first), k), anchor & ~np.uint64(1), hashed(units, length, first, last), first, last, inner

    def by_word(texts: list[bytes], grams: Grams) -> Iterator[tuple[np.ndarray, ...]]:
        data, at, until, ends, counts = joined(texts)
        begins, units = ends - counts, grams.words(data, at, until)
        breaks = np.union1d(begins, np.maximum(ends - words + 1, begins))
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        for anchor, first, last, inner in segments(units, words, WORD_GRAM, grams, breaks):
            text = np.searchsorted(ends, first, side="right")
            whole = first + words <= ends[text]
            anchor, first, last, inner, text = (c[whole] for c in (anchor, first, last, inner, text))
            yield (
                text, anchor | np.uint64(1), hashed(units, words, first, last), first - begins[text], last - begins[text],
                inner, at[first] - offsets[text], until[last + words - 1] - offsets[text],
            )

    def batches(names: list[bytes], texts: list[bytes], grams: Grams) -> Iterator[pa.RecordBatch]:
        for rows in (list(by_byte(texts, grams)), list(by_word(texts, grams))):
            if not rows:
                continue
            text, anchor, segment, *rest = (np.concatenate(c) for c in zip(*rows))
            if len(rest) == 3:
                rest += [pa.nulls(len(text), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.binary()).take(pa.array(text)),
                    pa.array(anchor.view(np.int64)),
                    pa.array(segment.view(np.int64)),
                    *(pa.array(c) for c in rest),
                ],
                names=["name", "anchor", "segment", "first", "last", "inner", "at", "until"],
            )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seen = Grams(), set()
        names, texts, size = [], [], 0
        for part in parts:
            for name, text in zip(part.column(0).to_pylist(), part.column(1)):
                if name in seen:
                    continue
                seen.add(name)
                names.append(name)
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size >= TOGETHER:
                    yield from batches(names, texts, grams)
                    names, texts, size = [], [], 0
        if names:
            yield from batches(names, texts, grams)

    return rows.mapInArrow(run, SEGMENTS)


def _gathered(run, rows: int = 20_000):
    """``run`` with its small batches put together."""

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in run(parts):
            held.append(batch)
            count += batch.num_rows
            if count >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gather


def repeated_starts(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, where strings start that start elsewhere in the parts, too."""
    sizes = np.array([len(p) for p in parts], np.int64)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(parts), np.int64)
    valid = np.zeros(len(text), np.bool_)
    for part, at in zip(parts, offsets):
        text[at : at + len(part)] = np.frombuffer(part, np.uint8)
        text[at : at + len(part)] += 2
        text[at + len(part)] = 1  # ends a part; equal strings never reach it
        valid[at : at + len(part) - length + 1] = True
    text[-1] = 0
    order = suffix_array(text, 258)
    order = order[valid[order]]
    before, after = permuted_prefixes(np.where(text > 1, text - 2, 0), order, length)
    found = valid & ((before >= length) | (after >= length))
    return [np.flatnonzero(found[at : at + size]) for at, size in zip(offsets, sizes)]


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))]


FOUND = "anchor long, segment long, first long, last long"


def _by_suffix_array(pieces: DataFrame, length: int) -> DataFrame:
    """Runs of repeated starts in ``pieces`` (anchor, segment, bytes), from the segment's first."""

    def shard(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        out: list[list[int]] = [[], [], [], []]
        for (anchor, segment, _), starts in zip(rows, repeated_starts([r[2] for r in rows], length)):
            for first, last in zip(*runs_of(starts)):
                for column, value in zip(out, (anchor, segment, int(first), int(last))):
                    column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out], names=["anchor", "segment", "first", "last"]
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        size, last = 0, None
        for part in parts:
            for anchor, segment, data in zip(*(c.to_pylist() for c in part.columns)):
                if (anchor, segment) == last:
                    continue  # a repeated row
                if size >= SHARD_BYTES and anchor != last[0]:  # one anchor more at most
                    yield shard(rows)
                    rows, size = [], 0
                rows.append((anchor, segment, data))
                size += len(data)
                last = (anchor, segment)
        if rows:
            yield shard(rows)

    sorted_pieces = pieces.repartition("anchor").sortWithinPartitions("anchor", "segment")
    return sorted_pieces.mapInArrow(run, FOUND)


def _by_string(pieces: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many segments: a row for each string, counted by its hash."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for anchor, segment, data in zip(*(c.to_pylist() for c in part.columns)):
                view = memoryview(data)
                n = len(data) - length + 1
                hashed = [xxhash.xxh3_128_digest(view[i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([anchor] * n, pa.int64()),
                        pa.array([segment] * n, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.array(hashed, pa.binary()),
                    ],
                    names=["anchor", "segment", "first", "string"],
                )

    strings, _ = materialize(
        pieces.dropDuplicates(["anchor", "segment"]).mapInArrow(
            _gathered(run), "anchor long, segment long, first long, string binary"
        ),
        "strings",
    )
    counts = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again, _ = materialize(counts.select("string"), "repeated-strings")
    return strings.join(again, "string").select("anchor", "segment", "first", F.col("first").alias("last"))


def windows(pieces: list[bytes], words: int, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the passages of ``words`` words in the pieces; the piece of each, and its number there."""
    data, at, until, ends, counts = joined(pieces)
    piece = np.repeat(np.arange(len(pieces)), counts)
    number = np.arange(len(at)) - np.repeat(ends - counts, counts)
    valid = np.flatnonzero(number + words <= np.repeat(counts, counts))
    return grams(grams.words(data, at, until), words)[valid], piece[valid], number[valid]


def _by_window(pieces: DataFrame, words: int) -> DataFrame:
    """Runs of passages in ``pieces`` (anchor, segment, bytes, owner) that stand in another text.

    ``owner`` is the one text of a segment; it is null where several texts hold it.
    """

    def shard(rows: list[tuple], grams: Grams) -> pa.RecordBatch:
        anchors, segments_, pieces_, owned = zip(*rows)
        hashes, piece, number = windows(pieces_, words, grams)
        single = np.array([o is not None for o in owned])[piece]
        owners = np.array([o or 0 for o in owned], np.int64)[piece]
        order = np.argsort(hashes)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(hashes[order])) + 1))
        least, most = (f.reduceat(owners[order], edges) for f in (np.minimum, np.maximum))
        apart = (least != most) | ~np.logical_and.reduceat(single[order], edges)
        found = np.empty(len(hashes), np.bool_)
        found[order] = np.repeat(apart, np.diff(edges, append=len(hashes)))
        found &= single
        linked = found[1:] & found[:-1] & (number[1:] > 0)
        first = np.flatnonzero(found & ~np.concatenate(([False], linked)))
        last = np.flatnonzero(found & ~np.concatenate((linked, [False])))
        columns = (np.array(anchors)[piece[first]], np.array(segments_)[piece[first]], number[first], number[last])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["anchor", "segment", "first", "last"]
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        rows: list[tuple] = []
        size, last = 0, None
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:2] == last:
                    continue  # a repeated row
                if size >= SHARD_BYTES and row[0] != last[0]:  # one anchor more at most
                    yield shard(rows, grams)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
                last = row[:2]
        if rows:
            yield shard(rows, grams)

    sorted_pieces = pieces.repartition("anchor").sortWithinPartitions("anchor", "segment")
    return sorted_pieces.mapInArrow(run, FOUND)


def _by_window_string(pieces: DataFrame, words: int) -> DataFrame:
    """The same for anchors with many segments: a row for each passage, counted by its hash."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for part in parts:
            for at in range(0, part.num_rows, 1_000):
                anchors, segments_, pieces_, owned = (c.to_pylist() for c in part.slice(at, 1_000).columns)
                hashes, piece, number = windows(pieces_, words, grams)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors).take(pa.array(piece)),
                        pa.array(segments_).take(pa.array(piece)),
                        pa.array(number),
                        pa.array(hashes.view(np.int64)),
                        pa.array(owned, pa.int64()).take(pa.array(piece)),
                    ],
                    names=["anchor", "segment", "first", "string", "owner"],
                )

    strings, _ = materialize(
        pieces.dropDuplicates(["anchor", "segment"]).mapInArrow(
            _gathered(run), "anchor long, segment long, first long, string long, owner long"
        ),
        "passages",
    )
    apart = (F.min("owner") != F.max("owner")) | (F.count("owner") < F.count(F.lit(1)))
    counts = strings.groupBy("string").agg(apart.alias("apart")).filter("apart")
    again, _ = materialize(counts.select("string"), "repeated-passages")
    return (
        strings.filter("owner IS NOT NULL")
        .join(again, "string")
        .select("anchor", "segment", "first", F.col("first").alias("last"))
    )


def repeated_runs(docs: DataFrame, length: int, words: int) -> DataFrame:
    """(name, by_word, first, last): runs of starts of repeated strings, by digest of the text.

    The starts count bytes, or words where ``by_word``; there ``last`` is null for a text with copies.
    """
    named = docs.select(F.unhex(F.md5("text")).alias("name"), "text").filter(
        F.octet_length("text") >= min(length, 2 * words - 1)
    )
    by_word = F.col("anchor").bitwiseAND(F.lit(1)) == 1
    texts = named.groupBy("name").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text")).cast("long").alias("bytes")
    )
    copied = texts.filter("copies > 1")
    whole = copied.filter(F.col("bytes") >= length).selectExpr(
        "name", "false AS by_word", "0L AS first", f"bytes - {length} AS last"
    ).unionByName(copied.selectExpr("name", "true AS by_word", "0L AS first", "CAST(NULL AS long) AS last"))
    single = named.select("name", "text")

    anchors, _ = materialize(_anchors(single, length, words), "anchors")
    seen = anchors.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("segment").alias("lo"), F.max("segment").alias("hi"),
        F.max("inner").alias("inner"),
    )
    again, _ = materialize(
        seen.filter("n > 1 OR inner").selectExpr("anchor AS _anchor", "lo <> hi OR inner AS mixed"),
        "repeated-anchors",
    )
    places, _ = materialize(
        anchors.join(again, F.col("anchor") == F.col("_anchor")).drop("_anchor", "inner"),
        "places",
    )
    kinds, _ = materialize(
        places.groupBy("anchor", "segment", "mixed").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("name", "first", "last", "at", "until")).alias("at"),
            F.max("name").alias("other"),
        ),
        "segments",
    )
    apart = F.col("at.name") != F.col("other")
    equal = kinds.filter(F.when(by_word, apart).otherwise(F.col("n") > 1)).select(
        "anchor", "segment", F.lit(0).cast("long").alias("first"), (F.col("at.last") - F.col("at.first")).alias("last")
    )
    mixed = kinds.filter("mixed").select(
        "anchor", "segment", F.col("at.name").alias("_name"),
        F.when(by_word, F.col("at.at")).otherwise(F.col("at.first")).alias("from"),
        F.when(by_word, F.col("at.until")).otherwise(F.col("at.last") + length).alias("until"),
        F.when(by_word & ~apart, F.xxhash64("other")).alias("owner"),
    )
    width = F.col("until") - F.col("from")
    data = F.substring(F.col("text").cast("binary"), F.col("from").cast("int") + 1, width.cast("int"))
    pieces, _ = materialize(
        single.dropDuplicates(["name"]).join(mixed, F.col("name") == F.col("_name")).select(
            "anchor", "segment", data.alias("bytes"), "owner"
        ),
        "pieces",
    )
    per_anchor = pieces.groupBy("anchor").agg(F.sum(F.octet_length("bytes")).alias("size"))
    hot, n_hot = materialize(per_anchor.filter(F.col("size") > SHARD_BYTES).select("anchor"), "hot-anchors")
    found = equal
    if n_hot:
        many = pieces.join(small_side(hot, n_hot), "anchor", "left_semi")
        found = found.unionByName(_by_string(many.filter(~by_word).drop("owner"), length))
        found = found.unionByName(_by_window_string(many.filter(by_word), words))
        pieces = pieces.join(small_side(hot, n_hot), "anchor", "left_anti")
    found = found.unionByName(_by_suffix_array(pieces.filter(~by_word).drop("owner"), length))
    found, _ = materialize(found.unionByName(_by_window(pieces.filter(by_word), words)), "repeated")
    inside = places.select("anchor", "segment", "name", F.col("first").alias("_at")).join(
        found, ["anchor", "segment"]
    )
    return inside.select(
        "name", by_word.alias("by_word"),
        (F.col("_at") + F.col("first")).alias("first"), (F.col("_at") + F.col("last")).alias("last"),
    ).unionByName(whole)


def remove_repeats(
    docs: DataFrame,
    length: int = 400,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 50,
) -> DataFrame:
    """What is left of each row of ``docs``: (doc_id, n_bytes, n_removed, n_spans, kept, n_repeated_words).

    Texts are UTF-8 bytes; a byte goes if a string of ``length`` bytes around it
    starts at any other place of the table, the same text included. All strings
    are judged on the input. ``kept`` holds the remaining bytes, ``n_spans``
    counts the removed runs that do not touch.

    ``n_repeated_words`` counts the words in passages of ``words`` consecutive words (between
    white space) or more that another row has, too, removed or not.

    Null texts are empty; texts shorter than ``length`` are kept. Repeated rows
    are copies of each other and go, if long enough. An empty table gives no
    rows; other columns are ignored.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    if words < 2 * WORD_GRAM:
        raise ValueError(f"words must be {2 * WORD_GRAM} or more")
    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    runs, _ = materialize(repeated_runs(rows, length, words).distinct(), "runs")
    run, by_word = F.struct("first", "last"), F.col("by_word")
    lists, _ = materialize(
        runs.groupBy("name").agg(
            F.sort_array(F.collect_list(F.when(~by_word, run))).alias("runs"),
            F.sort_array(F.collect_list(F.when(by_word, run))).alias("passages"),
        ),
        "run-lists",
    )
    with_runs = rows.withColumn("name", F.unhex(F.md5("text"))).join(
        lists, "name", "left"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, removed, spans, kept, repeated = [], [], [], [], []
            lists = [part.column(k).to_pylist() for k in range(2, 6)]
            for text, first, last, passage_first, passage_last in zip(part.column(1), *lists):
                data = text.as_buffer().to_pybytes()
                out, at, gone, count = [], 0, 0, 0
                for f, e in zip(first or (), last or ()):
                    end = e + length
                    if f > at or not count:
                        out.append(data[at:f])
                        count += 1
                        at = f
                    gone += max(0, end - at)
                    at = max(at, end)
                out.append(data[at:])
                sizes.append(len(data))
                removed.append(gone)
                spans.append(count)
                kept.append(b"".join(out))
                again = at = 0
                if None in (passage_last or ()):  # copies
                    again = len(word_places(data)[0])
                    again = again if again >= words else 0
                else:
                    for f, e in zip(passage_first or (), passage_last or ()):
                        again += max(0, e + words - max(at, f))
                        at = max(at, e + words)
                repeated.append(again)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *[pa.array(c, pa.int64()) for c in (sizes, removed, spans)],
                    pa.array(kept, pa.binary()),
                    pa.array(repeated, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_repeated_words"],
            )

    return with_runs.select(
        "doc_id", "text", "runs.first", "runs.last",
        F.col("passages.first").alias("passage_first"), F.col("passages.last").alias("passage_last"),
    ).mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, n_repeated_words long"
    )
