"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph, the graph is cut into balanced parts
with few edges between them, and a softmax classifier learns the part of a
vector. Every row is stored under its most probable part; a query visits its
several most probable parts, and distances there are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocktide.llm.common import drawn, share_for
from blocktide.session import materialize

#: Rows of the table on which graph and classifier are fitted, at most.
SAMPLE_ROWS = 4096
#: Rows that one task compares with queries, and queries that it holds.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 65_536


@dataclass
class Router:
    """Softmax scores of the parts: ``(x - mean) / scale @ weights + bias``."""

    mean: np.ndarray
    scale: float
    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    d = squared_distances(x, x)
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :degree]


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """A part for each vertex, none over 1.1 times its share, cutting few edges.

    Starts from median splits along main directions, then moves vertices to the
    part that holds most of their neighbours, largest gain first, while there is
    room.
    """
    n = len(x)
    label = np.zeros(n, np.int64)
    size = 1
    while size < parts:
        for p in range(size):
            own = np.flatnonzero(label == p)
            if len(own) > 1:
                centred = x[own] - x[own].mean(0)
                direction = np.linalg.svd(centred, full_matrices=False)[2][0]
                order = np.argsort(centred @ direction, kind="stable")
                label[own[order[len(own) // 2 :]]] += size
        size *= 2
    label %= parts
    room = int(np.ceil(1.1 * n / parts))
    edges = np.concatenate((graph.ravel(), np.repeat(np.arange(n), graph.shape[1])))
    sources = np.concatenate((np.repeat(np.arange(n), graph.shape[1]), graph.ravel()))
    for _ in range(rounds):
        near = np.zeros((n, parts))
        np.add.at(near, (sources, label[edges]), 1)
        gain = near.max(1) - near[np.arange(n), label]
        held = np.bincount(label, minlength=parts)
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            to = int(near[v].argmax())
            if held[to] < room:
                held[label[v]] -= 1
                held[to] += 1
                label[v] = to
    return label


def fit_router(
    sample: np.ndarray, parts: int, recall: float = 0.97, k: int = 10, steps: int = 300
) -> Router:
    """Graph, parts and classifier from the distinct rows of ``sample``.

    ``probes`` is the smallest number of parts with which the sample's own points
    find ``recall`` of their ``k`` nearest others in the sample.
    """
    x = np.unique(sample, axis=0)
    mean = x.mean(0)
    scale = float(np.sqrt(((x - mean) ** 2).mean())) or 1.0
    k = min(k, len(x) - 1)
    if parts <= 1 or k < 1:
        return Router(mean, scale, np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, k)
    label = balanced_parts(x, graph, parts)
    n = len(x)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), k), label[graph].ravel()), 0.5 / k)
    target[np.arange(n), label] += 0.5
    z = (x - mean) / scale
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    m, v = np.zeros((x.shape[1] + 1, parts)), np.zeros((x.shape[1] + 1, parts))
    for step in range(1, steps + 1):  # Adam on the cross entropy
        s = z @ w + b
        s = np.exp(s - s.max(1, keepdims=True))
        error = (s / s.sum(1, keepdims=True) - target) / n
        g = np.vstack((z.T @ error + 1e-5 * w, error.sum(0)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w -= move[:-1]
        b -= move[-1]
    router = Router(mean, scale, w, b, parts)
    order = np.argsort(-router.scores(x), axis=1, kind="stable")
    place = np.argsort(order, axis=1)  # how many parts are tried before this one
    needed = np.sort(place[np.arange(n)[:, None], order[graph, 0]].ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
    return router


def usable(vector: Column, dimensions: int) -> Column:
    """Not null, of this length, all components finite, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == dimensions) & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    parts: int | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row.

    Queries are the rows for which ``is_query`` holds, candidates all rows but
    the query's own; score is the Euclidean distance in double precision, ties
    go to the smaller id. Rows with a null id, or a vector that is null, zero, of
    another length than most, or not finite throughout, take no part. Repeated
    rows are candidates and queries of their own; empty tables give no rows;
    other columns are ignored.
    """
    vector = F.col(vector_column)
    lengths = vectors.filter(vector.isNotNull()).groupBy(F.size(vector).alias("d")).count()
    common = lengths.orderBy(F.desc("count"), "d").first()
    dimensions = common["d"] if common else 1
    rows = vectors.filter(F.col(id_column).isNotNull() & usable(vector, dimensions)).select(
        F.col(id_column).alias("vec_id"),
        vector.cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("row"),
    )
    n_rows = rows.count()
    hashed = F.xxhash64("vec_id", "v")
    picked = rows.filter(drawn(hashed, share_for(SAMPLE_ROWS, n_rows))).select("v", hashed.alias("h")).collect()
    picked.sort(key=lambda r: r.h & (1 << 64) - 1)
    sample = np.array([r.v for r in picked[:SAMPLE_ROWS]]).reshape(-1, dimensions)
    if parts is None:
        parts = int(np.clip(n_rows // 1024, 1, 64))
    router = fit_router(sample, parts, k=k) if len(sample) else None
    shared = vectors.sparkSession.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            order = np.argsort(-shared.value.scores(x), axis=1, kind="stable").astype(np.int32)
            visits = pa.FixedSizeListArray.from_arrays(pa.array(order.ravel()), order.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, visits.cast(pa.list_(pa.int32()))],
                names=[*batch.schema.names, "parts"],
            )

    schema = "vec_id {}, v array<double>, is_query boolean, row long, parts array<int>".format(
        rows.schema["vec_id"].dataType.simpleString()
    )
    routed = rows.mapInArrow(route, schema)
    # Rows keep their best part only, queries all of them in order.
    kept = F.when(F.col("is_query"), F.col("parts")).otherwise(F.slice("parts", 1, 1))
    stored, _ = materialize(routed.withColumn("parts", kept), "routed")
    held = {
        r.part: r["count"]
        for r in stored.groupBy(F.element_at("parts", 1).alias("part")).count().collect()
    }  # at most ``parts`` rows
    blocks = {p: -(-n // BLOCK_ROWS) for p, n in held.items()}
    n_queries = stored.filter("is_query").count()
    query_blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    block_of = F.create_map(*[F.lit(x) for p in held for x in (p, blocks[p])]) if held else None
    size_of = F.create_map(*[F.lit(x) for p in held for x in (p, held[p])]) if held else None
    if block_of is None:
        return stored.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    probes = router.probes

    part = F.element_at("parts", 1)
    candidates = stored.select(
        part.alias("part"),
        F.pmod(F.xxhash64("row"), F.element_at(block_of, part).cast("long")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        "vec_id", "v", "row",
    )
    # As many parts as are asked for, and more while those hold too few rows.
    seen = F.aggregate(
        F.filter("parts", lambda p: F.element_at(size_of, p).isNotNull()),
        F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("rows"), F.array().cast("array<int>").alias("to")),
        lambda a, p: F.when(
            (a["n"] < probes) | (a["rows"] <= k),
            F.struct(
                (a["n"] + 1).alias("n"),
                (a["rows"] + F.element_at(size_of, p)).cast("long").alias("rows"),
                F.concat(a["to"], F.array(p)).alias("to"),
            ),
        ).otherwise(a),
    )["to"]
    asked = stored.filter("is_query").select(
        F.explode(seen).alias("to_part"),
        F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int").alias("to_query_block"),
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("query"),
        F.col("row").alias("query_row"),
    )
    asked = asked.withColumn(
        "to_block", F.explode(F.sequence(F.lit(0), F.element_at(block_of, F.col("to_part")) - 1))
    )

    def compare(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(rows) and len(queries):
            x, ids, own = np.stack(rows["v"]), rows["vec_id"].to_numpy(), rows["row"].to_numpy()
            asking = np.stack(queries["query"])
            longest = (x * x).sum(1).max()
            for at in range(0, len(queries), 256):
                q = asking[at : at + 256]
                d = squared_distances(q, x)
                slack = 1e-9 * ((q * q).sum(1) + longest)
                d[own[None, :] == queries["query_row"].to_numpy()[at : at + 256, None]] = np.inf
                n = min(k, len(x)) - 1
                bound = np.partition(d, n, axis=1)[:, n] + slack
                for i in range(len(q)):
                    near = np.flatnonzero((d[i] <= bound[i]) & (d[i] < np.inf))
                    exact = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
                    best = np.lexsort((ids[near], exact))[:k]
                    found.append(
                        pd.DataFrame(
                            {
                                "query_row": queries["query_row"].iloc[at + i],
                                "query_id": queries["query_id"].iloc[at + i],
                                "vec_id": ids[near][best],
                                "score": exact[best],
                            }
                        )
                    )
        if found:
            return pd.concat(found, ignore_index=True)
        return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})

    kind = stored.schema["vec_id"].dataType.simpleString()
    near = (
        candidates.groupBy("part", "block", "query_block")
        .cogroup(asked.groupBy("to_part", "to_block", "to_query_block"))
        .applyInPandas(compare, f"query_row long, query_id {kind}, vec_id {kind}, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
