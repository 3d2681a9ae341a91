"""Jaccard join of word-shingle sets with signature trees, and its components.

Equal sets become one node. Nodes meet in groups: the shingles of a set are
ordered by rarity, and two sets that are similar enough share one of their
rarest, so each of those makes a group, named by its first node. The links of a
group to that node are checked first; groups that are not yet in one component
go to signature trees: leaves are sets with bitmaps, inner nodes OR their
bitmaps and hold size ranges, and a dual traversal skips pairs of nodes whose
largest possible overlap is too small. Pairs left are compared exactly, unless
they are in one component by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocktide.llm.common import sliced, small_side
from blocktide.llm.components import connected_components
from blocktide.session import materialize

SHINGLE = 5
#: Counters of the rarity sketch in each task, and the size limit of what is broadcast.
SKETCH_BITS = 22
SKETCH = 1 << SKETCH_BITS
#: Members of a group that one task holds; larger groups are compared in pairs of chunks.
CHUNK = 512
#: Lower-cases A to Z only; every kind of space is a space.
_PLAIN = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTES = np.frombuffer(hashlib.shake_128(b"shingles").digest(256 * 8), np.uint64)
_BASE = 0x9E3779B97F4A7C15
#: Longer words are replaced by their digest, and longer texts hashed in parts.
LONGEST_WORD, PART_WORDS = 4096, 20_000


class Hasher:
    """Hashes of word runs as differences of running sums over the bytes of a text."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def powers(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = 1 << (count - 1).bit_length()
            bases = (_BASE, pow(_BASE, -1, 1 << 64))
            filled = [np.full(size, base, np.uint64) for base in bases]
            for x in filled:
                x[0] = 1
            self.up, self.down = (np.multiply.accumulate(x) for x in filled)
        return self.up[:count], self.down

    def runs(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run of SHINGLE words; words are ``data[start:end]``."""
        out = []
        for i in range(0, len(starts) - SHINGLE + 1, PART_WORDS):
            first = starts[i : i + PART_WORDS + SHINGLE - 1]
            last = ends[i : i + PART_WORDS + SHINGLE - 1][SHINGLE - 1 :]
            first = first[: len(last)]
            base = first[0]
            part = data[base : last[-1]]
            up, down = self.powers(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTES[part] * up, out=sums[1:])
            h = (sums[last - base] - sums[first - base]) * down[first - base]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            out.append(h)
        return np.concatenate(out)


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with single spaces between words, and where words start and end."""
    data = np.frombuffer(raw, np.uint8)
    space = data == 32
    if len(data) and (space[0] or space[-1] or (space[1:] & space[:-1]).any()):
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        data = data[keep]
        data = data[:-1] if len(data) and data[-1] == 32 else data
        data = data[1:] if len(data) and data[0] == 32 else data
        space = data == 32
    if not len(data):
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(space)
    return data, np.concatenate(([0], at + 1)), np.concatenate((at, [len(data)]))


def shingle_set(text: str | None, hasher: Hasher) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; lower-cases A to Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)
    data, starts, ends = _words(raw)
    if len(starts) and (ends - starts).max() > LONGEST_WORD:
        short = [w if len(w) <= LONGEST_WORD else b"\0" + hashlib.sha256(w).digest().hex().encode() for w in raw.split()]
        data, starts, ends = _words(b" ".join(short))
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(starts) < SHINGLE:  # a set of its own kind
        whole = hashlib.blake2b(data.tobytes(), digest_size=8, person=b"short").digest()
        return np.frombuffer(whole, np.uint64)
    h = hasher.runs(data, starts, ends)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def least_share(n: int, percent: int) -> int:
    """The fewest shingles that a set of ``n`` shares with a similar one."""
    return -(-percent * n // 100)


def prefix(shingles: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles, one of which every similar set has among its own rarest."""
    n = len(shingles)
    order = np.lexsort((shingles, ranks[slots(shingles)]))
    return shingles[order[: n - least_share(n, percent) + 1]]


def bitmap(shingles: np.ndarray) -> tuple[int, int]:
    """Token bits as one integer, and its width: a power of two, twice the set or more."""
    width = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little"), width


def folded(bits: int, width: int, to: int) -> int:
    while width > to:
        width //= 2
        bits = (bits | bits >> width) & ((1 << width) - 1)
    return bits


class Tree:
    """A node over ``items`` (size, bits, width, mark, id), which are sorted.

    ``mark`` is whatever makes a pair uninteresting if both sides share it; a node
    has one if all its leaves have the same.
    """

    __slots__ = ("bits", "high", "id", "left", "losses", "low", "mark", "right", "width")

    def __init__(self, items: list[tuple]):
        self.left = self.right = self.id = None
        self.losses: dict[int, int] = {}
        if len(items) == 1:
            size, self.bits, self.width, self.mark, self.id = items[0]
            self.low = self.high = size
            return
        half = len(items) // 2
        a, b = self.left, self.right = Tree(items[:half]), Tree(items[half:])
        self.width = min(a.width, b.width)
        self.bits = folded(a.bits, a.width, self.width) | folded(b.bits, b.width, self.width)
        self.low, self.high = min(a.low, b.low), max(a.high, b.high)
        self.mark = a.mark if a.mark == b.mark else None

    def lost(self, width: int) -> int:
        """The most shingles that one set below has beyond its bits at ``width``."""
        known = self.losses.get(width)
        if known is None:
            if self.left is None:
                known = self.high - folded(self.bits, self.width, width).bit_count()
            else:
                known = max(self.left.lost(width), self.right.lost(width))
            self.losses[width] = known
        return known


def may_meet(a: Tree, b: Tree, percent: int) -> bool:
    """Whether some set under ``a`` and one under ``b`` could be similar."""
    if a.high * 100 < percent * b.low or b.high * 100 < percent * a.low:
        return False
    width = min(a.width, b.width)
    x, y = folded(a.bits, a.width, width), folded(b.bits, b.width, width)
    needed = -(-percent * (a.low + b.low) // (100 + percent))
    if a.left is None and b.left is None:
        most = min(a.low - (x & ~y).bit_count(), b.low - (y & ~x).bit_count())
    else:
        most = (x & y).bit_count() + min(a.lost(width), b.lost(width))
    return most >= needed


def join_trees(a: Tree, b: Tree, percent: int, done=None) -> Iterator[tuple[Tree, Tree]]:
    """Pairs of leaves, one below each node (or two below the same), that may be similar.

    Pairs with one mark are skipped, and those for which ``done`` holds; it is
    asked of inner nodes, too.
    """
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if a.mark is not None and a.mark == b.mark:
            continue
        if done is not None and done(a, b):
            continue
        if a is b:
            if a.left is not None:
                todo += [(a.left, a.left), (a.right, a.right), (a.left, a.right)]
        elif may_meet(a, b, percent):
            if a.left is None and b.left is None:
                yield a, b
            elif b.left is None or (a.left is not None and a.high - a.low >= b.high - b.low):
                todo += [(a.left, b), (a.right, b)]
            else:
                todo += [(a, b.left), (a, b.right)]


def _profile(docs: DataFrame) -> DataFrame:
    """Of every document its id, set size, set name and text key; of every task its common slots.

    A slot is told if the task counted it more than twice as often as the average
    slot, and two times more, each distinct set counted once.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts, seen = Hasher(), np.zeros(SKETCH, np.uint32), set()
        kind = None
        for part in sliced(parts):
            ids, texts, keys = part.column(0), part.column(1).to_pylist(), part.column(2)
            kind = ids.type
            sizes, names = [], []
            for text in texts:
                shingles = shingle_set(text, hasher)
                name = set_name(shingles)
                sizes.append(len(shingles))
                names.append(name)
                if name not in seen:
                    seen.add(name)
                    counts[slots(shingles)] += 1
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), keys, pa.nulls(len(ids), pa.int64())],
                names=["doc_id", "n", "name", "key_text", "slot"],
            )
        common = np.flatnonzero(counts > 2 + 2 * counts.mean())
        for at in range(0, len(common), 10_000):
            some = common[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(some), kind), pa.array(counts[some], pa.int64()), pa.nulls(len(some), pa.binary()), pa.nulls(len(some), pa.string()), pa.array(some, pa.int64())],
                names=["doc_id", "n", "name", "key_text", "slot"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n long, name binary, key_text string, slot long")


def _rank_table(common: DataFrame) -> np.ndarray:
    """How common each slot is, as the logarithm of its count: SKETCH bytes.

    Tasks put the ranks of a block of slots in a few bytes, so the driver gets
    one byte for each slot at most, however large the table is.
    """
    block = 1 << 12

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for part in parts:
            slot, n = (c.to_numpy(zero_copy_only=False) for c in part.columns)
            for b in np.unique(slot // block):
                own = slot // block == b
                ranks = blocks.setdefault(int(b), np.zeros(block, np.uint8))
                ranks[slot[own] % block] = 1 + np.log2(n[own].astype(float)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks.keys(), pa.int64()), pa.array([r.tobytes() for r in blocks.values()], pa.binary())],
            names=["block", "ranks"],
        )

    counts = common.groupBy("slot").agg(F.sum("n").alias("n"))
    dealt = counts.repartition(F.floor(F.col("slot") / block)).mapInArrow(packed, "block long, ranks binary")
    ranks = np.zeros(SKETCH, np.uint8)
    for row in dealt.collect():
        ranks[row.block * block : (row.block + 1) * block] = np.frombuffer(row.ranks, np.uint8)
    return ranks


def _signatures(docs: DataFrame, ranks, percent: int) -> DataFrame:
    """(name, n, bits, prefix) of every document with shingles, each set once in a task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for part in sliced(parts):
            names, sizes, bits, rows = [], [], [], []
            for text in part.column(1).to_pylist():
                shingles = shingle_set(text, hasher)
                name = set_name(shingles)
                if len(shingles) and name not in seen:
                    seen.add(name)
                    names.append(name)
                    sizes.append(len(shingles))
                    value, width = bitmap(shingles)
                    bits.append(value.to_bytes(width // 8, "little"))
                    rows.append(prefix(shingles, ranks.value, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), pa.array(rows, pa.list_(pa.int64()))],
                names=["name", "n", "bits", "prefix"],
            )

    return docs.mapInArrow(run, "name binary, n long, bits binary, prefix array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """(name, shingles) of every document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in sliced(parts):
            found = [shingle_set(t, hasher) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_name(s) for s in found], pa.binary()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                names=["name", "shingles"],
            )

    return docs.mapInArrow(run, "name binary, shingles array<long>")


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, compared shingle by shingle."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    either = F.size("x") + F.size("y") - both
    # The side that repeats, the first node of a group, is joined last.
    joined = pairs.join(right, "b").join(left, "a")
    return joined.filter(both * 100 >= either * percent).select("a", "b")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps leave room for enough overlap."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("n"), F.col("bits").alias("y"))
    near = F.least("m", "n") * 100 >= F.greatest("m", "n") * percent
    joined = pairs.join(right, "b").join(left, "a").filter(near)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(parts):
            keep = [
                may_meet(leaf(m, x), leaf(n, y), percent)
                for m, x, n, y in zip(*(part.column(k).to_pylist() for k in range(2, 6)))
            ]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"]
            )

    return joined.select("a", "b", "m", "x", "n", "y").mapInArrow(run, "a long, b long")


def leaf(size: int, bits: bytes) -> Tree:
    return Tree([(size, int.from_bytes(bits, "little"), len(bits) * 8, None, None)])


def _by_group(rows: DataFrame, columns: list[str], handle, schema: str) -> DataFrame:
    """``handle(i, j, members)`` for every group (hub, i, j) of ``rows``, one at a time in a task.

    Members are tuples of ``columns``; ``handle`` gives result rows.
    """
    keys = ["hub", "i", "j"]
    dealt = rows.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys, *columns[:-1])
    names = [part.split()[0] for part in schema.split(", ")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []

        def told() -> pa.RecordBatch:
            found = list(handle(*now, group))
            columns = zip(*found) if found else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for part in sliced(parts):
            for hub, i, j, *member in zip(*(c.to_pylist() for c in part.columns)):
                if (hub, i, j) != now:
                    if group:
                        yield told()
                    now, group = (hub, i, j), []
                group.append(tuple(member))
        if group:
            yield told()

    return dealt.mapInArrow(run, schema)


def _sides(i: int, j: int, items: list[tuple[int, tuple]]) -> tuple[Tree, Tree] | None:
    """The two trees of a group: chunk ``i`` against chunk ``j``, or one against itself."""
    one = [x for chunk, x in items if chunk == i]
    two = [x for chunk, x in items if chunk != i]
    if i == j:
        tree = Tree(one)
        return tree, tree
    return (Tree(one), Tree(two)) if one and two else None


def _active(open_groups: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Members of open groups that, by sizes and bitmaps, may link to another component.

    As (hub, i, j, node, component, chunk); groups of more than CHUNK members are
    compared in pairs of chunks i and j.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy("hub"))
    place = F.row_number().over(Window.partitionBy("hub").orderBy("component", "node"))
    chunked = open_groups.withColumn("chunks", F.ceil(size / CHUNK).cast("int")).withColumn(
        "chunk", ((place - 1) / CHUNK).cast("int")
    )
    dealt = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "hub", "node", "component", "chunk",
        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
    )

    def handle(hub: int, i: int, j: int, members: list[tuple]):
        items = [
            (chunk, (n, int.from_bytes(bits, "little"), len(bits) * 8, component, (node, chunk)))
            for chunk, component, n, node, bits in members
        ]
        trees = _sides(i, j, items)
        if trees is None:
            return
        seen: set[int] = set()
        quiet = {}  # inner nodes below which all are active

        def all_active(t: Tree) -> bool:
            if t.left is None:
                return t.id[0] in seen
            if id(t) not in quiet and all_active(t.left) and all_active(t.right):
                quiet[id(t)] = True
            return id(t) in quiet

        for a, b in join_trees(*trees, percent, lambda a, b: all_active(a) and all_active(b)):
            for leaf_ in (a, b):
                if leaf_.id[0] not in seen:
                    seen.add(leaf_.id[0])
                    yield hub, i, j, leaf_.id[0], leaf_.mark, leaf_.id[1]

    rows = dealt.join(nodes.select("node", "n", "bits"), "node")
    return _by_group(
        rows,
        ["chunk", "component", "n", "node", "bits"],
        handle,
        "hub long, i long, j long, node long, component long, chunk long",
    )


def _tree_links(active: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components among the active members, compared exactly.

    Within a group members that are linked already, however far apart, are not
    compared: fewer links than members come out of a group.
    """

    def handle(hub: int, i: int, j: int, members: list[tuple]):
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        arrays, items, homes = {}, [], {}
        for chunk, component, node, shingles in members:
            own = arrays[node] = np.array(shingles, np.int64).view(np.uint64)
            bits, width = bitmap(own)
            homes[node] = component
            items.append((chunk, (len(own), bits, width, component, node)))
        items.sort(key=lambda x: (x[1][3], x[1][0], x[1][4]))
        trees = _sides(i, j, items)
        if trees is None:
            return

        def linked(a: Tree, b: Tree) -> bool:
            return a.mark is not None and b.mark is not None and root(a.mark) == root(b.mark)

        for a, b in join_trees(*trees, percent, linked):
            x, y = arrays[a.id], arrays[b.id]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both * 100 >= percent * (len(x) + len(y) - both):
                up[root(a.mark)] = root(b.mark)
                yield min(a.id, b.id), max(a.id, b.id)

    rows = active.join(sets.select("node", "shingles"), "node")
    return _by_group(rows, ["chunk", "component", "node", "shingles"], handle, "a long, b long").distinct()


def _components(
    rows: DataFrame, percent: int, key_text: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Profile (doc_id, n, name, key_text) of ``rows`` (doc_id, text), and the sets by component.

    The sets as (name, first, component), ``first`` being their smallest id. With
    ``key_text`` follows ``least``, their smallest row key (unnamed, key_id,
    key_text): by id, rows without one last, then by text.
    """
    least = []
    if key_text is not None:
        key = F.struct(F.isnull("doc_id").alias("unnamed"), F.col("doc_id").alias("key_id"), "key_text")
        least = [F.min(key).alias("least")]
    else:
        key_text = F.lit(None).cast("string")
    spark = rows.sparkSession
    told, _ = materialize(_profile(rows.withColumn("key_text", key_text)), "profile")
    ranks = spark.sparkContext.broadcast(_rank_table(told.filter(F.col("slot").isNotNull())))
    profile = told.filter(F.col("slot").isNull()).drop("slot")
    classes, n_classes = materialize(
        profile.filter("n > 0")
        .groupBy("name")
        .agg(F.min("doc_id").alias("first"), *least)
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    nodes, _ = materialize(
        _signatures(rows, ranks, percent)
        .dropDuplicates(["name"])
        .join(classes.select("name", "node"), "name")
        .select("node", "n", "bits", "prefix"),
        "signatures",
    )
    of_token = Window.partitionBy("token")
    # Sets with a common token meet under the first of them; once, however many they share.
    members, _ = materialize(
        nodes.select("node", F.explode("prefix").alias("token"))
        .withColumn("hub", F.min("node").over(of_token))
        .withColumn("size", F.count(F.lit(1)).over(of_token))
        .filter("size > 1")
        .select("hub", "node")
        .distinct(),
        "members",
    )

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        """(node, shingles) of the nodes in ``wanted``, from their documents."""
        met, n_met = materialize(wanted.distinct().join(classes, "node"), f"{name}-nodes")
        ids = met.select(F.col("first").alias("_id")).distinct()
        again = rows.join(small_side(ids, n_met), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        named = _sets(again).join(met.select("name", "node"), "name").dropDuplicates(["node"])
        return materialize(named.select("node", "shingles"), f"{name}-sets")[0]

    stars = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    pairs, _ = materialize(_likely(stars, nodes, percent), "star-pairs")
    star_sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), "star")
    links, _ = materialize(_compare(pairs, star_sets, percent), "star-links")
    linked, _ = materialize(connected_components(links), "star-components")
    placed = members.join(linked, "node", "left").select(
        "hub", "node", F.coalesce("component", "node").alias("component")
    )
    # Groups that are not one component yet.
    parts = placed.groupBy("hub").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    opened = placed.join(parts.filter("lo <> hi").select("hub"), "hub", "left_semi")
    active, n_active = materialize(_active(opened, nodes, percent), "active")
    if n_active:
        tree_sets = sets_of(active.select("node"), "tree")
        more, _ = materialize(_tree_links(active, tree_sets, percent), "tree-links")
        linked, _ = materialize(connected_components(links.unionByName(more)), "components")
    return profile, classes.join(linked, "node", "left").select(
        "name", "first", *["least"] * len(least), F.coalesce("component", "node").alias("component")
    )


def similar_documents(
    docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Sets are the distinct runs of five words (fewer words: the whole sequence);
    two documents link if they share ``percent`` of all shingles of both, or
    more. ``component_id`` is the smallest id reachable over links.

    Null and empty texts have no shingles, link with nothing and are their own
    component. Repeated rows have equal sets and so one component, also rows of
    one id with different texts keep the component of their own text. Null ids
    never name a component, unless it has no other. Other columns are ignored;
    an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    profile, names = _components(rows, percent)
    least = names.groupBy("component").agg(F.min("first").alias("component_id"))
    named = names.join(least, "component").select(F.col("name").alias("_name"), "component_id")
    return profile.join(named, F.col("name") == F.col("_name"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of similar ones: that of the smallest id, nulls last.

    A row is named by its id and its text, so rows of one id with different texts
    are judged each for itself, and rows without an id as well; of rows that
    agree in both one stays. Of equal ids the smallest checksum decides.
    """
    text_key = F.md5("text")
    profile, names = _components(docs.select("doc_id", "text"), percent, text_key)
    best = names.groupBy("component").agg(F.min("least").alias("least")).select("least.key_id", "least.key_text")
    keys = profile.groupBy(F.col("doc_id").alias("key_id"), "key_text").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("rows")
    )

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a["key_id"].eqNullSafe(b["key_id"]) & a["key_text"].eqNullSafe(b["key_text"])

    keys, _ = materialize(keys, "row-keys")
    said = keys.filter("n > 0")
    gone, n_gone = materialize(said.join(best, same(said, best), "left_anti").select("key_id", "key_text"), "gone")
    often = keys.filter("rows > 1")
    twice, n_twice = materialize(
        often.join(gone, same(often, gone), "left_anti").select("key_id", "key_text"), "twice"
    )

    def against(rows: DataFrame, listed: DataFrame, count: int, how: str) -> DataFrame:
        same_row = rows["doc_id"].eqNullSafe(listed["key_id"]) & F.md5(rows["text"]).eqNullSafe(listed["key_text"])
        return rows.join(small_side(listed, count), same_row, how)

    kept = against(docs, gone, n_gone, "left_anti")
    if not n_twice:
        return kept
    once = against(kept, twice, n_twice, "left_anti")
    again = against(kept, twice, n_twice, "left_semi").withColumn("_key_text", text_key)
    return once.unionByName(again.dropDuplicates(["doc_id", "_key_text"]).drop("_key_text"))
