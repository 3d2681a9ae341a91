import random

import numpy as np
import pytest

from blocktide.llm import jaccard
from blocktide.llm.components import connected_components
from blocktide.llm.jaccard import Tree, bitmap, join_trees, keep_one_each, shingle_set, similar_documents
from blocktide.llm.queries import QUERIES
from tests.llm.cases import DOCS, ODD_ROWS, SMALL, documents, no_documents, odd_documents


def words_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute(texts):
    sets = {i: words_set(t) for i, t in texts.items()}
    union = Union(sets)
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                union.join(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in ids}


def near_copies():
    """Chains, stars and near misses, with a passage that all share."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(60, 160))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):  # up to five edits of five shingles each: on both sides of 0.8
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            if rng.random() < 0.5:
                base = copy
        texts.append(" ".join([word() for _ in range(20)] + passage + [word() for _ in range(rng.randint(0, 30))]))
    return [*texts, texts[0], texts[0].upper(), None, "", "one two", "One  two", "one two three four five"]


def test_components_equal_brute_force(spark):
    texts = dict(enumerate(near_copies()))
    docs = documents(spark, [t or "" for t in texts.values()])
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(docs).collect()}
    assert rows == brute(texts)
    kept = keep_one_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in rows.values()})


def test_trees_alone_find_all_links(spark, monkeypatch):
    """Without the links to the first node, chunked trees have to find everything."""
    real = jaccard._compare  # the second call is that of the trees
    first = []

    def compare(pairs, sets, percent):
        found = real(pairs, sets, percent)
        if not first:
            first.append(1)
            return found.filter("false")
        return found

    monkeypatch.setattr(jaccard, "_compare", compare)
    monkeypatch.setattr(jaccard, "CHUNK", 3)
    texts = dict(enumerate(near_copies()))
    docs = documents(spark, [t or "" for t in texts.values()])
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(docs).collect()}
    assert rows == brute(texts)


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op8_jaccard"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)


@pytest.mark.parametrize("seed", range(4))
def test_tree_join_prunes_no_similar_pair(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64)
        for _ in range(4):
            drop = rng.random(len(base)) > rng.random() * 0.25
            sets.append(np.unique(np.concatenate((base[drop], rng.integers(0, 2**63, rng.integers(0, 20), dtype=np.uint64)))))
    sets = [s for s in sets if len(s)]
    items = sorted((len(s), *bitmap(s), i, i) for i, s in enumerate(sets))
    tree = Tree(items)
    found = {(min(a.id, b.id), max(a.id, b.id)) for a, b in join_trees(tree, tree, 80)}
    similar = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                similar.add((j, i))
    assert similar <= found
    assert len(found) < 0.2 * len(sets) ** 2 / 2


def test_shingles_ignore_case_and_space_only(monkeypatch):
    words = jaccard.Hasher()
    same = [shingle_set(t, words) for t in ("A b C d e f", "a B c\nd\te  f", "a b c d e f")]
    assert all((s == same[0]).all() for s in same) and len(same[0]) == 2
    assert len(shingle_set("É b c d e", words)) == 1
    assert shingle_set("É b c d e", words)[0] != shingle_set("é b c d e", words)[0]
    parts = [f"w{i}" for i in range(50)]
    whole = shingle_set(" ".join(parts), words)
    long = "x" * 9000
    assert len(shingle_set(f"a b {long} c d e", words)) == 2 == len(shingle_set(f"{long}  a b c d {long}y", words))
    monkeypatch.setattr(jaccard, "PART_WORDS", 7)
    assert (shingle_set("  " + " \n".join(parts) + "\t", words) == whole).all()
    assert len(shingle_set(None, words)) == len(shingle_set(" \t\n", words)) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, i + 1) for i in range(0, 60)]  # a long chain
    pairs += [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(160)]
    pairs += [(500, n) for n in range(501, 540)] + [(500, 501), (7, 7)]
    rng.shuffle(pairs)
    union = Union({n for p in pairs for n in p})
    for a, b in pairs:
        union.join(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: union.find(n) for p in pairs if p[0] != p[1] for n in p}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = similar_documents(docs).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id in (3, 4)} == {(3, 0, 3), (4, 0, 4)}
    kept = keep_one_each(docs.select("doc_id", "text", "_id"))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8]
    assert similar_documents(no_documents(spark)).count() == 0
    assert keep_one_each(no_documents(spark)).count() == 0


def test_rows_are_judged_by_id_and_text(spark):
    def prose(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    a, b, c, d, e, f = (prose(x) for x in "abcdef")
    rows = [
        (1, a), (2, b), (2, c),  # one id, unlike texts
        (3, d), (4, d + " more"), (4, e),  # one of the texts is a near copy of a smaller id
        (None, a), (None, a + " more"), (None, f), (None, f + " more"), (None, f),  # without an id
        (5, b), (6, None), (6, ""), (7, "x"), (7, "x"),
    ]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS).repartition(4)
    kept = sorted(((r.doc_id or 0, r.text or "") for r in keep_one_each(docs).collect()))
    of_f = [t for i, t in kept if i == 0]
    assert len(of_f) == 1 and of_f[0] in (f, f + " more")
    assert [k for k in kept if k[0]] == [(1, a), (2, b), (2, c), (3, d), (4, e), (6, ""), (6, ""), (7, "x")]
