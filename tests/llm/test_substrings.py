import hashlib
import random

import numpy as np
import pytest

from blocktide.llm import substrings
from blocktide.llm.queries import QUERIES
from blocktide.llm.substrings import remove_repeats, repeated_starts
from blocktide.llm.suffixes import permuted_prefixes, suffix_array
from tests.llm.cases import LONG, ODD_ROWS, SMALL, documents, no_documents, odd_documents


def brute(texts, length):
    """(removed bytes, removed runs, kept bytes) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = {}
    for d in data:
        for k in range(len(d) - length + 1):
            counts[d[k : k + length]] = counts.get(d[k : k + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if counts[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((sum(gone), runs, bytes(x for x, g in zip(d, gone) if not g)))
    return out


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(500):
        top = rng.choice([1, 2, 3, 8])
        s = [rng.randint(1, top) for _ in range(rng.randint(0, 60))] + [0]
        order = suffix_array(np.array(s), 10)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        before, after = permuted_prefixes(np.array(s), order, 16)

        def shared(i, j):
            k = 0
            while k < 16 and max(i, j) + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            return k

        for a, b in zip(order, order[1:]):
            assert min(before[b], len(s) - max(a, b)) == min(after[a], len(s) - max(a, b)) == shared(a, b)


def test_repeated_starts_of_parts():
    rng = random.Random(2)
    for _ in range(60):
        base = bytes(rng.choice(b"ab") for _ in range(40))
        parts = [bytes(rng.choice(b"ab") for _ in range(12)) + base[rng.randint(0, 20) :] for _ in range(6)]
        got = repeated_starts(parts, 12)
        all_of = [p[k : k + 12] for p in parts for k in range(len(p) - 11)]
        for p, g in zip(parts, got):
            assert g.tolist() == [k for k in range(len(p) - 11) if all_of.count(p[k : k + 12]) > 1]


def corpus():
    rng = random.Random(7)

    def prose(n):
        return " ".join("".join(rng.choice("abcdéf") for _ in range(rng.randint(1, 9))) for _ in range(n))

    passage, line = prose(120), "- " * 260
    texts = [prose(rng.randint(1, 300)) for _ in range(30)]
    texts += [prose(40) + passage + prose(40) for _ in range(6)]
    texts += [texts[0]] * 5 + [texts[1][:900] + "x" + texts[1][900:], None, "", "ab" * 700, "z" * 2000]
    texts += [prose(20) + line + prose(30), line * 3, passage[:380], passage[:420] + prose(50)]
    texts += [passage + " and " + passage, prose(10) + "q" * 401 + prose(10), prose(10) + "k" * 400 + prose(10)]
    return texts


@pytest.mark.parametrize("shard", [5000, 600])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
    texts = corpus()
    docs = documents(spark, [t or "" for t in texts])
    rows = {r.doc_id: r for r in remove_repeats(docs).collect()}
    for i, (gone, runs, kept) in enumerate(brute(texts, 400)):
        assert (rows[i].n_removed, rows[i].n_spans, bytes(rows[i].kept)) == (gone, runs, kept), i


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = {r.doc_id: r for r in QUERIES["op7_substrings"](spark, SMALL).collect()}
    for d, (gone, runs, kept) in zip(docs, brute([d.text for d in docs], 400)):
        r = rows[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len((d.text or "").encode()), gone, runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert r.text == kept.decode("utf-8", "replace")


def test_chunks_of_long_texts_meet(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 700)
    texts = corpus()
    rows = {r.doc_id: r for r in remove_repeats(documents(spark, [t or "" for t in texts])).collect()}
    for i, (gone, runs, _) in enumerate(brute(texts, 400)):
        assert (rows[i].n_removed, rows[i].n_spans) == (gone, runs), i


def test_odd_rows(spark):
    rows = remove_repeats(odd_documents(spark)).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(r.n_removed == 0 for r in rows)
    two = spark.createDataFrame([(1, LONG), (1, LONG), (None, LONG[5000:9000])], "doc_id long, text string")
    assert [r.n_removed == r.n_bytes for r in remove_repeats(two).collect()] == [True] * 3
    assert remove_repeats(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(two, length=399)


def repeated_words(texts, words):
    """Words of each text in passages of ``words`` words that another row has, too."""
    data = [(t or "").encode().split() for t in texts]
    rows = {}
    for i, d in enumerate(data):
        for k in range(len(d) - words + 1):
            rows.setdefault(tuple(d[k : k + words]), set()).add(i)
    out = []
    for d in data:
        again = set()
        for k in range(len(d) - words + 1):
            if len(rows[tuple(d[k : k + words])]) > 1:
                again.update(range(k, k + words))
        out.append(len(again))
    return out


def passages():
    rng = random.Random(11)

    def prose(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(n)]

    short, line, inner = prose(51), prose(12), " ".join(prose(60))
    assert len(" ".join(short)) < 400
    texts = [" ".join(prose(rng.randint(40, 200))) for _ in range(20)]
    texts += [" ".join(prose(60) + short[: 49 + k % 3] + prose(60)) for k in range(9)]
    texts += ["\n\t ".join(prose(10) + short + prose(3)), " ".join(short), " ".join(short[:50]), " ".join(short[1:])]
    texts += [" ".join(line * 30), " ".join(prose(5) + line * 40), " ".join(prose(5) + ["x"] * 900), "x " * 700]
    texts += [inner + " and " + inner, texts[0], texts[0], " ".join(short[:20]), " ".join(short[:20]), None, "", " "]
    return texts


@pytest.mark.parametrize("shard", [1_000_000, 3000, 100])
def test_passages_shorter_than_a_string_are_told_of(spark, monkeypatch, shard):
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
    texts = passages()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert [rows[i].n_repeated_words for i in range(len(texts))] == repeated_words(texts, 50)
    assert [rows[i].n_repeated_words for i in range(20, 29)] == [0, 50, 51] * 3
    assert [(rows[i].n_removed, rows[i].n_spans) for i in range(len(texts))] == [r[:2] for r in brute(texts, 400)]


def test_passages_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 70)
    texts = passages()
    texts += [" ".join([*texts[0].split()[-30:], "y" * 90, *texts[1].split()[:30], x]) for x in ("k", "y" * 75)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert [rows[i].n_repeated_words for i in range(len(texts))] == repeated_words(texts, 50)


def test_query_tells_of_passages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = {r.doc_id: r.n_repeated_words for r in QUERIES["op7_substrings"](spark, SMALL).collect()}
    assert [rows[d.doc_id] for d in docs] == repeated_words([d.text for d in docs], 50)
