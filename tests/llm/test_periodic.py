import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from blocktide.llm import periodic
from blocktide.llm.lyndon import lyndon_array, runs, stretches
from blocktide.llm.periodic import densest, periodic_runs, words_of
from blocktide.llm.queries import QUERIES
from tests.llm.cases import LONG, ODD_ROWS, SMALL, documents, no_documents, odd_documents


def brute_runs(words, copies=4, shortest=6):
    """Every maximal stretch, found period by period without Lyndon words."""
    n, out = len(words), []
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(shortest, copies * q):
                part = words[i : i + length]
                if all(part[: length - d] != part[d:] for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_lyndon_array_equals_brute_force():
    rng = random.Random(1)

    def is_lyndon(w):
        return all(w < w[k:] + w[:k] for k in range(1, len(w)))

    for _ in range(1500):
        top = rng.choice([0, 1, 2, 5])
        text = [rng.randint(0, top) for _ in range(rng.randint(0, 22))]
        for sign in (1, -1):
            t = [sign * x for x in text]
            plain = [max(j - i for j in range(i + 1, len(t) + 1) if is_lyndon(t[i:j])) for i in range(len(t))]
            assert lyndon_array(t) == plain, t


def periodic_text(rng, length, top):
    out = []
    while len(out) < length:
        word = [rng.randint(0, top) for _ in range(rng.randint(1, 6))]
        out += word * rng.randint(1, 7) + word[: rng.randint(0, len(word))]
    return out


@pytest.mark.parametrize("copies,shortest", [(4, 6), (3, 1), (5, 20)])
def test_runs_equal_brute_force(copies, shortest):
    rng = random.Random(2)
    for _ in range(3000):
        text = periodic_text(rng, rng.randint(1, 60), rng.choice([1, 2, 3]))
        assert runs(np.array(text), copies, shortest) == brute_runs(text, copies, shortest), text


def test_runs_of_words_with_much_structure():
    a, b = [0], [0, 1]
    for _ in range(12):
        a, b = b, b + a  # Fibonacci words hold many runs, none of four copies
    thue = [bin(i).count("1") % 2 for i in range(2048)]  # no overlaps at all
    for text in (b, thue, [0, 0, 1] * 300 + [0, 0], [0] * 999, list(range(500)), ([0] * 9 + [1]) * 40):
        assert runs(np.array(text)) == brute_runs(text)
        assert runs(np.array(text), 3, 1) == brute_runs(text, 3, 1)


def test_stretches_keep_every_run():
    rng = random.Random(3)
    for _ in range(300):
        texts = [periodic_text(rng, rng.randint(1, 40), rng.choice([2, 9])) for _ in range(4)]
        codes = np.array([x for t in texts for x in t])
        at, stretch = stretches(codes, np.repeat(np.arange(4), [len(t) for t in texts]), 4, 6)
        inside = set(zip(at.tolist(), stretch.tolist()))
        begin = 0
        for t in texts:
            for s, length, _ in brute_runs(t):
                assert len({g for p, g in inside if begin + s <= p < begin + s + length}) == 1
                assert sum(begin + s <= p < begin + s + length for p, _ in inside) == length
            begin += len(t)


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("words_at_once", [500_000, 30])
def test_operator(spark, monkeypatch, words_at_once):
    monkeypatch.setattr(periodic, "SLICE_WORDS", words_at_once)
    rng = random.Random(4)
    texts = ["\t ".join(f"w{x}" for x in periodic_text(rng, rng.randint(1, 80), 3)) for _ in range(60)]
    texts += ["so " * 50_000, "a b c d", " x  x x x\nx x ", "one two " * 4, "one two " * 3 + "one", LONG]
    found = rows_of(periodic_runs(documents(spark, texts), words_of(F.col("text"))))
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        plain = [(0, 50_000, 1)] if text.startswith("so so") else [] if text == LONG else brute_runs(words)
        assert [tuple(x) for x in found[i].runs] == plain, text
        assert found[i].collapsed == collapse(words, plain)


def test_densest_is_exact(spark):
    many = [(0, 4 * 10**6 + 1, 10**6), (5, 4 * (10**6 + 7) + 1, 10**6 + 7), (9, 8, 2), (20, 8, 2)]
    kind = f"runs array<{periodic.RUN}>"
    df = spark.createDataFrame([(many,), (many[:2],), ([],)], kind)
    best = [r.b for r in df.select(densest(F.col("runs")).alias("b")).collect()]
    assert [b and tuple(b) for b in best] == [many[0], many[0], None]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = rows_of(QUERIES["op13_periodic"](spark, SMALL))
    assert len(rows) == len(docs)
    some = 0
    for d in docs:
        original = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, words = len(original), original
        h = zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words) if n < 4000 else runs(np.unique(words, return_inverse=True)[1])
        r = rows[d.doc_id]
        some += len(found)
        assert r.n_runs == len(found)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapse(words, found).encode()).hexdigest()
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
    assert some > 10


def test_odd_rows(spark):
    rows = periodic_runs(odd_documents(spark), words_of(F.col("text")), keep=("doc_id", "name")).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(r.name == "clash" and r.runs == [] for r in rows)
    assert periodic_runs(no_documents(spark), words_of(F.col("text"))).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None] * 6), (None, ["a"] * 6)], "doc_id long, w array<string>")
    found = rows_of(periodic_runs(odd, F.col("w")))
    assert [[tuple(x) for x in found[k].runs] for k in (1, 2, 3, None)] == [[], [], [(0, 6, 1)], [(0, 6, 1)]]
    assert [found[k].collapsed for k in (1, 2, 3, None)] == ["", "", "", "a"]
    with pytest.raises(ValueError):
        periodic_runs(odd, F.col("w"), copies=2)
