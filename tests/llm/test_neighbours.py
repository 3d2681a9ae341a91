import numpy as np
from pyspark.sql import functions as F

from blocktide.llm.neighbours import balanced_parts, nearest, neighbour_graph
from blocktide.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"
VECTORS = "vec_id long, embedding array<float>"


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[q] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), float(d[i])) for i in order if d[i] < np.inf]


def test_recall_of_the_query(spark):
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    found = {}
    for r in QUERIES["op10_neighbours"](spark, MEDIUM).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 100 == 0}
    hits = total = 0
    for q, rows in found.items():
        at = int(np.flatnonzero(ids == q)[0])
        want = brute(ids, x, at, 10)
        assert [r for r, _, _ in sorted(rows)] == list(range(1, 11))
        for _, v, score in rows:
            assert score == np.sqrt(((x[np.flatnonzero(ids == v)[0]] - x[at]) ** 2).sum())
        hits += len({v for _, v, _ in rows} & {v for v, _ in want})
        total += 10
    assert hits / total >= 0.9


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.1, (100, 8)) for c in rng.normal(0, 3, (8, 8))])
    graph = neighbour_graph(x, 5)
    label = balanced_parts(x, graph, 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(1.1 * 100) + 1
    assert (label[graph] != label[:, None]).mean() < 0.2


def test_ties_hot_vectors_and_unusable_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)]
    rows += [(i, rng.normal(0, 1, 3).tolist()) for i in range(300, 600)]
    bad = [(700, None), (800, [0.0] * 3), (900, [1.0, None, 2.0]), (1000, [float("nan"), 1.0, 1.0]),
           (1100, [float("inf"), 1.0, 1.0]), (1200, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + bad, VECTORS).selectExpr("*", "'x' AS row", "'x' AS part", "'x' AS v")
    got = {}
    for r in nearest(df.repartition(5), F.col("vec_id") % 100 == 0, k=5, parts=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 300, 400, 500}
    assert [v for _, v, _ in sorted(got[100])] == [0, 1, 2, 3, 4]
    assert [v for _, v, _ in sorted(got[0])] == [1, 2, 3, 4, 5]


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])], VECTORS)
    rows = nearest(few, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 1), (2, 1)]
    assert nearest(few.limit(0), F.lit(True)).count() == 0
    assert nearest(few.limit(1), F.lit(True)).count() == 0
