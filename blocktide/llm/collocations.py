"""Frequent phrases and their association, from mergeable Misra-Gries summaries.

Phrases are hashed to partitions, and each partition is summarised by so many
counters that their number exceeds the partition's share of all occurrences
divided by the threshold. A summary that overflows takes the same amount from
every counter; the sum of what was taken (``lost``) bounds by how much any counter
falls short. Summaries merge by adding counters and what they lost. While
less than the threshold was lost, no phrase that reaches it can be missing, and
a counter that stays below the threshold with ``lost`` added is ruled out. A
second pass counts what survives exactly, by the words themselves: each task what it
reads, in blocks of a hash partition, and then each partition over all tasks.

Words and pairs come first. Longer phrases are summarised only where every pair
in them survived, which no frequent phrase can fail. Survivors reach the tasks as a
filter of fixed size: where it errs, more is counted, nothing less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blocktide.llm.common import small_side, text_or_empty
from blocktide.session import materialize

#: Counters in the summary of one hash partition, about.
COUNTERS = 1 << 20
#: Hash partitions, at least.
PARTITIONS = 64
#: Counters and occurrences that a task holds before it passes its summaries on.
HELD = 3_000_000
BUFFERED = 1_000_000
#: Distinct phrases that a task counts before it passes them on.
HELD_PHRASES = 250_000
#: Counters or phrases in a row, so that batches of rows stay small.
ROW_COUNTERS = 1024
#: Survivors whose exact counts meet in one hash partition, about.
PART_PHRASES = 100_000
#: Bytes of text that are cut into words at a time; a longer text is parted between pieces.
SLICE_BYTES = 2_000_000
#: Bits of a filter, a power of two, and how many each survivor sets.
FILTER_BITS = 1 << 27
FILTER_HASHES = 4
BITMAP_BITS = 32_768  # of one value of bitmap_construct_agg
#: Salted parts in which the best phrases of a language are chosen first.
BEST_PARTS = 64

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD, _GAP, _BREAK = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK


class Words:
    """The words of some texts in a row, and which of them stand in one piece."""

    def __init__(self, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets.astype(np.int64) - int(offsets[0])
        kind = _KIND[data]
        inside = kind == _WORD
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = self.row + np.searchsorted(np.flatnonzero(kind == _BREAK), starts)
        said = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        buffers = [None, pa.py_buffer(said), pa.py_buffer(_LOWER[data[inside]])]
        coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        self.dictionary = coded.dictionary
        self.codes = coded.indices.to_numpy()

    def __len__(self) -> int:
        return len(self.codes)

    def hashes(self, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Two hash values of each word, and those of its row's language, as two columns."""

        def values(strings: list) -> np.ndarray:
            digests = b"".join(map(xxhash.xxh3_128_digest, strings))
            return np.frombuffer(digests, "<u8").reshape(-1, 2).astype(np.uint64)

        return values(self.dictionary.to_pylist())[self.codes], values(languages)[self.row]


def phrase_hashes(words: Words, languages: list[str], longest: int, both: bool = False):
    """For n from 1 on: starts of the phrases of n words, and their hash values.

    A value holds the language and the words in order. With ``both``, values
    are two independent columns, so that equal ones mean equal phrases.
    """
    word, value = words.hashes(languages)
    if not both:
        word, value = word[:, :1], value[:, :1]
    for n in range(1, longest + 1):
        m = len(words) - n + 1
        if m <= 0:
            return
        value = value[:m] * _STEP + word[n - 1 :]
        value = (value ^ (value >> np.uint64(32))) * _MIX
        value ^= value >> np.uint64(29)
        yield n, np.flatnonzero(words.piece[:m] == words.piece[n - 1 :]), value


def combine(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class Summary:
    """A Misra-Gries summary: counters by key, and what each may have lost."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lost = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, lost: int = 0) -> None:
        """Merge with counters of other occurrences."""
        self.keys, self.counts = combine(
            np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts))
        )
        self.lost += lost
        if len(self.keys) > self.capacity:
            # The largest counter that finds no place is taken from all of them.
            least = len(self.keys) - self.capacity - 1
            taken = int(np.partition(self.counts, least)[least])
            left = self.counts > taken
            self.keys, self.counts = self.keys[left], self.counts[left] - taken
            self.lost += taken


def key_width(words: int) -> int:
    """Bits of a key among so many words. Phrases that share one are counted as one phrase,
    too high if anything, and in this width hardly any do."""
    return min(62, max(32, words.bit_length() + 6))


class Plan:
    """How wide keys are, how many partitions there are, and how many counters each has."""

    def __init__(self, mass: int, threshold: int, width: int, slack: int = 1):
        # A quarter more than mass / threshold, since partitions are not quite equal.
        need = slack * 5 * mass // (4 * threshold) + 64 * PARTITIONS
        self.width = width
        self.bits = max(PARTITIONS.bit_length() - 1, (need // COUNTERS).bit_length())
        self.capacity = need // (1 << self.bits) + 64

    def part(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(self.width - self.bits)).astype(np.int64)

    def summaries(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, Summary]]:
        """Of counters in order of their keys, one summary for each partition."""
        parts = self.part(keys)
        first = np.flatnonzero(np.concatenate(([True], np.diff(parts) != 0)))
        for a, e in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
            summary = Summary(self.capacity)
            summary.add(keys[a:e], counts[a:e])
            yield int(parts[a]), summary


def shortened(values: np.ndarray, width: int) -> np.ndarray:
    """Keys of hash values: their first bits."""
    return values >> np.uint64(64 - width)


def spread(keys: np.ndarray) -> np.ndarray:
    """Keys over all 64 bits, each to another value."""
    return (keys ^ (keys >> np.uint64(29))) * _STEP


class Filter:
    """Which hash values may have their key in a set: certain for those that have,
    nearly so for others. The set holds keys as ``spread`` gives them."""

    def __init__(self, bits: np.ndarray, width: int):
        self.bits = bits
        self.width = width

    def __call__(self, values: np.ndarray) -> np.ndarray:
        keys = spread(shortened(values, self.width))
        mask = np.uint64(FILTER_BITS - 1)
        step = (keys >> np.uint64(27)) | np.uint64(1)
        found = np.ones(len(keys), np.bool_)
        for k in range(FILTER_HASHES):
            at = (keys + np.uint64(k) * step) & mask
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def collected_filter(keys: DataFrame) -> np.ndarray:
    """The filter of a table of keys; its bits are set by the tasks, by bitmap.

    What comes to the driver is the filter: FILTER_BITS at most, whatever the keys.
    """
    mask = FILTER_BITS - 1
    start = F.col("key").bitwiseAND(F.lit(mask))
    step = F.shiftrightunsigned("key", 27).bitwiseOR(F.lit(1))
    places = [(start + step * k).bitwiseAND(F.lit(mask)) + 1 for k in range(FILTER_HASHES)]
    maps = (
        keys.select(F.explode(F.array(*places)).alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    width = BITMAP_BITS // 8
    for row in maps.collect():
        bits[(row["bucket"] - 1) * width : row["bucket"] * width] = np.frombuffer(row["map"], np.uint8)
    return bits


def _parted(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts that end where a piece ends."""
    breaks = np.flatnonzero(_KIND[text] == _BREAK) + 1
    at = 0
    while at < len(text):
        next_break = int(np.searchsorted(breaks, at + SLICE_BYTES))
        to = int(breaks[next_break]) if next_break < len(breaks) else len(text)
        yield text[at:to]
        at = to


def _slices(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Words]]:
    """Languages and words of the texts that a task reads, a few megabytes at a time."""
    for part in parts:
        languages, texts = part.column(0), part.column(1).cast(pa.binary())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            begin = int(sizes[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, begin + SLICE_BYTES, side="right")))
            names = languages.slice(at, to - at).to_pylist()
            if int(sizes[to - 1]) - begin <= SLICE_BYTES:
                yield names, Words(texts.slice(at, to - at))
            else:
                for some in _parted(np.frombuffer(texts[at].as_buffer(), np.uint8)):
                    yield names, Words(pa.array([some.tobytes()], pa.binary()))
            at = to
        pa.default_memory_pool().release_unused()


def _totals(rows: DataFrame) -> DataFrame:
    """(lang, n): all words of each language."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for languages, words in _slices(parts):
            counts = np.bincount(words.row, minlength=len(languages))
            yield pa.RecordBatch.from_arrays([pa.array(languages), pa.array(counts)], names=["lang", "n"])

    return rows.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


SUMMARY = "part long, lost long, n long, first long, keys binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in the narrowest of 1, 2, 4 and 8 bytes that holds them all."""
    size = next(s for s in (1, 2, 4, 8) if int(numbers.max(initial=0)) < 1 << 8 * s)
    return numbers.astype(f"<u{size}").tobytes()


def _unpacked(data: pa.BinaryScalar, n: int) -> np.ndarray:
    buffer = data.as_buffer()
    return np.frombuffer(buffer, f"<u{buffer.size // max(n, 1) or 1}").astype(np.uint64)


def _summary_rows(found: Iterator[tuple[int, Summary]]) -> Iterator[pa.RecordBatch]:
    """Summaries in rows of bounded size; keys as their differences, which are small."""
    columns: list[list] = [[] for _ in range(6)]
    for part, summary in found:
        lost = summary.lost
        for at in range(0, max(1, len(summary.keys)), ROW_COUNTERS):  # what was lost is told anyway
            keys, counts = summary.keys[at : at + ROW_COUNTERS], summary.counts[at : at + ROW_COUNTERS]
            steps = np.diff(keys, prepend=keys[:1])
            first = int(keys[0]) if len(keys) else 0
            values = (part, lost, len(keys), first, _packed(steps), _packed(counts))
            for column, value in zip(columns, values):
                column.append(value)
            lost = 0  # told once
        if len(columns[0]) >= 1000:
            yield _summary_batch(columns)
            columns = [[] for _ in range(6)]
    if columns[0]:
        yield _summary_batch(columns)


def _summary_batch(columns: list[list]) -> pa.RecordBatch:
    types = [*[pa.int64()] * 4, pa.binary(), pa.binary()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "lost", "n", "first", "keys", "counts"])


def _frequent(rows: DataFrame, first: int, last: int, plan: Plan, threshold: int, pairs) -> tuple[DataFrame, int]:
    """Keys that phrases of ``first`` to ``last`` words with enough occurrences must have,
    and the most that the counters of a partition lost.

    ``pairs`` is the broadcast filter of pairs, if they are known.
    """

    def summarise(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(pairs.value, plan.width) if pairs is not None else None
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh: list[np.ndarray] = []
        waiting = 0

        def take_in() -> None:
            nonlocal keys, counts, fresh, waiting
            more = np.concatenate(fresh)
            keys, counts = combine(np.concatenate((keys, more)), np.concatenate((counts, np.ones(len(more), np.int64))))
            fresh, waiting = [], 0

        for languages, words in _slices(parts):
            for n, starts, value in phrase_hashes(words, languages, last):
                if n == 2 and known is not None:
                    pair = np.zeros(len(value), np.bool_)
                    pair[starts] = known(value[starts, 0])
                    usable = pair  # where a phrase of n words has only pairs that are known
                elif n > 2 and known is not None:
                    usable = usable[: len(value)] & pair[n - 2 : n - 2 + len(value)]
                    starts = starts[usable[starts]]
                if n >= first and len(starts):
                    fresh.append(shortened(value[starts, 0], plan.width))
                    waiting += len(starts)
            if waiting >= BUFFERED:
                take_in()
            if len(keys) > HELD:
                yield from _summary_rows(plan.summaries(keys, counts))
                keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if fresh:
            take_in()
        if len(keys):
            yield from _summary_rows(plan.summaries(keys, counts))

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, summary = None, None
        held: list[tuple[np.ndarray, np.ndarray, int]] = []

        def merged() -> None:
            nonlocal held
            if held:
                summary.add(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), sum(h[2] for h in held))
            held = []

        def survivors() -> pa.RecordBatch:
            # Occurrences are at most the counter and what it lost.
            keys = spread(summary.keys[summary.counts + summary.lost >= threshold])
            told = np.concatenate(([0], keys.view(np.int64)))  # the first row tells of the partition
            none = np.arange(len(told)) == 0
            return pa.RecordBatch.from_arrays(
                [pa.array(told, pa.int64(), mask=none), pa.array(np.full(len(told), summary.lost))],
                names=["key", "lost"],
            )

        size = 0
        for batch in parts:
            numbers = [batch.column(k).to_pylist() for k in range(4)]
            for part, lost, n, first, steps, counts in zip(*numbers, batch.column(4), batch.column(5)):
                if part != current:
                    if current is not None:
                        merged()
                        yield survivors()
                    current, summary, size = part, Summary(plan.capacity), 0
                keys = np.cumsum(_unpacked(steps, n)) + np.uint64(first)
                held.append((keys, _unpacked(counts, n).astype(np.int64), lost))
                size += len(held[-1][0])
                if size > BUFFERED:
                    merged()
                    size = 0
        if current is not None:
            merged()
            yield survivors()

    local = rows.mapInArrow(summarise, SUMMARY).repartition("part").sortWithinPartitions("part")
    found, _ = materialize(local.mapInArrow(merge, "key long, lost long"), "frequent")
    most = found.agg(F.max("lost")).first()[0] or 0
    return found.filter(F.col("key").isNotNull()).select("key"), int(most)


def frequent_keys(
    rows: DataFrame, first: int, last: int, words: int, threshold: int, pairs=None
) -> DataFrame:
    """``_frequent`` with as many counters as it takes for none to lose the threshold."""
    mass, width = (last - first + 1) * words, key_width(words)
    slack = 1
    while True:
        keys, lost = _frequent(rows, first, last, Plan(mass, threshold, width, slack), threshold, pairs)
        if lost < threshold:
            return keys
        slack *= 2


#: Rows of exact counts: phrases of a language in a hash partition, one to a line (no word
#: holds a line end), and how often each was counted.
BLOCKS = "part long, lang string, n long, phrases binary, counts binary"


def _block_rows(table: pa.Table, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counted phrases in rows of bounded size, each of one partition and language."""
    names = table["lang"].combine_chunks().dictionary_encode()
    languages = names.dictionary.to_pylist()
    group = parts * len(languages) + names.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    group = group[order]
    said = table["phrase"].take(pa.array(order)).combine_chunks()
    f = table["f"].to_numpy()[order]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    columns: list[list] = [[] for _ in range(5)]
    types = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "lang", "n", "phrases", "counts"])

    for a, e in zip(first.tolist(), [*first[1:].tolist(), len(group)]):
        part, language = divmod(int(group[a]), len(languages))
        for at in range(a, e, ROW_COUNTERS):
            some = said.slice(at, min(ROW_COUNTERS, e - at)).to_pylist()
            packed = _packed(f[at : at + len(some)])
            values = (part, languages[language], len(some), "\n".join(some).encode(), packed)
            for column, value in zip(columns, values):
                column.append(value)
        if len(columns[0]) >= 100:
            yield batch()
            columns = [[] for _ in range(5)]
    if columns[0]:
        yield batch()


def _phrase_blocks(rows: DataFrame, longest: int, survivors, width: int, bits: int) -> DataFrame:
    """What passes the filter, counted by each task; dealt to 2 ** ``bits`` hash partitions."""

    def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands first, in order of the keys, and the sum of its counts."""
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1))))
        return order[first], np.add.reduceat(counts[order], first)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(survivors.value, width)
        keys: list[np.ndarray] = []
        batches: list[pa.RecordBatch] = []
        waiting = 0

        def together() -> None:
            nonlocal keys, batches, waiting
            table = pa.Table.from_batches(batches).combine_chunks()
            said = np.concatenate(keys)
            at, counts = counted(said, table["f"].to_numpy())
            batches = table.take(pa.array(at)).set_column(2, "f", pa.array(counts)).combine_chunks().to_batches()
            keys, waiting = [said[at]], 0

        def blocks() -> Iterator[pa.RecordBatch]:
            part = (keys[0][:, 0] >> np.uint64(64 - bits)).astype(np.int64)
            yield from _block_rows(pa.Table.from_batches(batches), part)

        for languages, words in _slices(parts):
            names = np.array(languages, object)
            for n, starts, value in phrase_hashes(words, languages, longest, both=True):
                starts = starts[known(value[starts, 0])]
                if not len(starts):
                    continue
                some, counts = counted(value[starts], np.ones(len(starts), np.int64))
                at = starts[some]
                said = words.dictionary.take(pa.array(words.codes[at]))
                for k in range(1, n):
                    following = words.dictionary.take(pa.array(words.codes[at + k]))
                    said = pc.binary_join_element_wise(said, following, pa.scalar(b" "))
                columns = [names[words.row[at]], said.cast(pa.string()), counts]
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))]
                batches.append(pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "f"]))
                keys.append(value[at])
                waiting += len(at)
            if waiting >= HELD_PHRASES:
                together()
                if len(keys[0]) >= HELD_PHRASES:
                    yield from blocks()
                    keys, batches = [], []
        if batches:
            together()
            yield from blocks()

    return rows.mapInArrow(run, BLOCKS)


def _exact_counts(
    rows: DataFrame, longest: int, survivors, width: int, threshold: int, n_survivors: int
) -> DataFrame:
    """(lang, phrase, words, f) of what passes the filter and occurs ``threshold`` times, by the words.

    Tasks pass their phrases on in blocks, and the blocks of a partition are added up, so a
    phrase is a row of its own only once all of it is counted.
    """
    bits = max(PARTITIONS.bit_length() - 1, (n_survivors // PART_PHRASES).bit_length())

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple[int, str] | None = None
        held: list[pa.Table] = []
        waiting = 0

        def together() -> pa.Table:
            return pa.concat_tables(held).group_by("phrase").aggregate([("f", "sum")]).rename_columns(["phrase", "f"])

        def frequent() -> Iterator[pa.RecordBatch]:
            table = together()
            table = table.filter(pc.greater_equal(table["f"], threshold))
            table = table.append_column("lang", pa.array([current[1]] * len(table), pa.string()))
            size = pc.add(pc.count_substring(table["phrase"], " "), 1).cast(pa.int32())
            table = table.append_column("words", size).select(["lang", "phrase", "words", "f"])
            yield from table.to_batches(max_chunksize=20_000)

        for batch in parts:
            numbers = [batch.column(k).to_pylist() for k in range(3)]
            for part, language, n, phrases, counts in zip(*numbers, batch.column(3), batch.column(4)):
                if (part, language) != current:
                    if current is not None:
                        yield from frequent()
                    current, held, waiting = (part, language), [], 0
                said = pa.array(phrases.as_py().decode().split("\n"), pa.string())
                held.append(pa.table({"phrase": said, "f": _unpacked(counts, n).astype(np.int64)}))
                waiting += n
                if waiting >= BUFFERED:
                    held, waiting = [together()], 0
        if current is not None:
            yield from frequent()

    blocks = _phrase_blocks(rows, longest, survivors, width, bits)
    dealt = blocks.repartition("part").sortWithinPartitions("part", "lang")
    return dealt.mapInArrow(merge, "lang string, phrase string, words int, f long")


def _cut(k: Column, words: Column) -> tuple[Column, Column]:
    """The first ``k`` words of a phrase, given as an array, and the rest."""
    rest = F.slice(words, k + 1, F.size(words) - k)
    return F.array_join(F.slice(words, F.lit(1), k), " "), F.array_join(rest, " ")


def scored(counts: DataFrame, totals: DataFrame, n_counts: int, n_totals: int) -> DataFrame:
    """Every candidate with the lowest score of its cuts: (lang, phrase, words, a, l, r, n, score)."""
    cuts = (
        counts.filter("words > 1")
        .withColumnRenamed("f", "a")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    )
    head, tail = _cut(F.col("k"), F.split("phrase", " "))
    part = small_side(counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), "f"), n_counts)

    def with_count(df: DataFrame, column: str, name: str) -> DataFrame:
        same = (F.col("lang") == F.col("_lang")) & (F.col(column) == F.col("_part"))
        return df.join(part, same).withColumnRenamed("f", name).drop("_lang", "_part", column)

    cuts = cuts.withColumns({"head": head, "tail": tail})
    cuts = with_count(with_count(cuts, "head", "l"), "tail", "r").join(small_side(totals, n_totals), "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    over = F.lit(1000).cast("decimal(4,0)") * wide["a"]
    # The quotient of two whole decimals is exact.
    cuts = cuts.withColumn("score", F.call_function("div", (over * wide["n"]), (wide["l"] * wide["r"])))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "words", "a", "n").agg(best).select(
        "lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score"
    )


def collocations(
    docs: DataFrame,
    threshold: int = 100,
    longest: int = 5,
    best: int = 2000,
    language_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """The phrases of 2 to ``longest`` words that stand together most of all, by language.

    Texts are lower-cased (A to Z), cut into pieces at ``. , ; : ! ?`` and line
    ends, and those into words at spaces and tabs. A phrase is a candidate if it
    occurs ``a >= threshold`` times within pieces. Its score is the least, over its
    cuts in two, of floor(1000 * a * n / (l * r)), where l and r count the parts and
    n all words of the language; of equal cuts the first counts. A candidate
    within a longer one that occurs as often is dropped. Returned are the first
    ``best`` phrases of each language, by score and a, both falling, then
    phrase: lang, rank, phrase, a, l, r, n, score. All counts are exact.

    A null text is empty, a null language is ``und``. Repeated rows count each for
    themselves; an empty table gives no rows; other columns are ignored.
    """
    if not 2 <= longest or threshold < 2:
        raise ValueError("phrases have two words at least, and occur twice at least")
    spark: SparkSession = docs.sparkSession
    language = F.coalesce(F.col(language_column).cast("string"), F.lit("und"))
    rows = docs.select(language.alias("lang"), text_or_empty(text_column).alias("text"))
    totals, n_totals = materialize(_totals(rows), "words")
    words = int(totals.agg(F.sum("n")).first()[0] or 0)
    share = spark.sparkContext.broadcast
    keys = frequent_keys(rows, 1, 2, words, threshold)
    if longest > 2:
        pairs = share(collected_filter(keys))
        keys = keys.unionByName(frequent_keys(rows, 3, longest, words, threshold, pairs))
    survivors = share(collected_filter(keys))
    exact = _exact_counts(rows, longest, survivors, key_width(words), threshold, keys.count())
    counts, n_counts = materialize(exact, "phrase-counts")

    found = scored(counts, totals, n_counts, n_totals)
    said, size = F.split("phrase", " "), F.col("words") - 1
    inner = F.explode(F.array(*[F.array_join(F.slice(said, F.lit(k), size), " ") for k in (1, 2)]))
    # What lies in any longer candidate as frequent lies in one that is a word longer.
    within = counts.filter("words > 2").select(F.col("lang").alias("_lang"), inner.alias("_part"), F.col("f").alias("_f"))
    same = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")) & (F.col("_f") >= F.col("a"))
    found = found.join(within, same, "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First in salted parts, so that no language is sorted as a whole.
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(BEST_PARTS)))
    near = F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))
    first = salted.withColumn("_near", near).filter(F.col("_near") <= best)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    rank = F.col("rank").cast("long").alias("rank")
    return ranked.filter(F.col("rank") <= best).select("lang", rank, "phrase", "a", "l", "r", "n", "score")
