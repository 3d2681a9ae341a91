"""Periodic runs in texts: stretches of words that go on repeating.

Each text is searched by itself, so nothing is shuffled: the runs come from the
Lyndon arrays of its words under both orders (``lyndon``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocktide.llm.common import sliced
from blocktide.llm.lyndon import runs, stretches

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
#: Words that are searched at a time; a longer text is searched alone.
SLICE_WORDS = 500_000


def words_of(text: Column) -> Column:
    """The words of a text: what stands between spaces, tabs and line ends."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def periodic_runs(
    docs: DataFrame,
    words: Column,
    keep: tuple[str, ...] = ("doc_id",),
    copies: int = 4,
    shortest: int = 6,
) -> DataFrame:
    """``keep``, ``runs`` and ``collapsed`` of every row of ``docs``.

    ``words`` is a column of arrays of words. ``runs`` lists the maximal stretches
    with smallest period q that hold at least ``copies`` (3 or more) times q and
    ``shortest`` words, as (start, length, period), counted in words from 0, by
    start, then period; no two are equal. In ``collapsed`` every word that a run
    holds after its first q words is left out, and the rest is joined by spaces.

    A null or empty array has no runs and collapses to an empty text; a null word
    counts as an empty one. Repeated rows are searched each for itself; an empty
    table gives no rows; other columns than ``keep`` are ignored.
    """
    if copies < 3:
        raise ValueError("copies must be 3 or more")
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(words, F.array().cast("array<string>")).alias("_in"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def search(column: pa.Array) -> tuple[list[list], pa.Array]:
        """Runs and collapsed text of each row of an array of word lists."""
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        values = column.flatten().fill_null("")
        codes = values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at, stretch = stretches(codes, np.repeat(np.arange(len(sizes)), sizes), copies, shortest)
        found: list[list] = [[] for _ in range(len(sizes))]
        kept = np.ones(len(codes), np.bool_)
        if len(stretch):
            first = np.flatnonzero(np.concatenate(([True], np.diff(stretch) != 0)))
            for a, e in zip(first.tolist(), [*first[1:].tolist(), len(at)]):
                offset = int(at[a])
                row = int(np.searchsorted(ends, offset, side="right"))
                begin = int(ends[row] - sizes[row])
                for start, length, period in runs(codes[offset : offset + e - a], copies, shortest):
                    found[row].append((offset - begin + start, length, period))
                    kept[offset + start + period : offset + start + length] = False
        left = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], ends))]
        lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), values.filter(pa.array(kept)))
        return found, pc.binary_join(lists, " ")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(parts):
            column = part.column(part.num_columns - 1)
            total = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
            at = 0
            while at < part.num_rows:
                full = (total[at - 1] if at else 0) + SLICE_WORDS
                to = max(at + 1, int(np.searchsorted(total, full, side="right")))
                some = part.slice(at, to - at)
                found, collapsed = search(some.column(some.num_columns - 1))
                rest = [some.column(k) for k in range(some.num_columns - 1)]
                listed = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(listed, _RUN), collapsed.cast(pa.string())],
                    names=[*some.schema.names[: len(rest)], "runs", "collapsed"],
                )
                at = to

    return rows.mapInArrow(run, ", ".join([*fields, f"runs array<{RUN}>", "collapsed string"]))


def densest(runs_column: Column) -> Column:
    """The run with the greatest length per period, compared exactly; the first of equal ones.

    Runs must be in the order of ``periodic_runs``. Null if there are none.
    """
    return F.aggregate(
        runs_column,
        F.lit(None).cast(RUN),
        lambda best, x: F.when(
            best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x
        ).otherwise(best),
    )
