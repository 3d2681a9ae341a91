import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blocktide.llm import collocations as module
from blocktide.llm.collocations import Filter, Plan, Summary, Words, collected_filter, collocations, frequent_keys
from tests.llm.cases import DOCS, LONG, odd_documents, no_documents


def pieces_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, threshold, longest, best):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase in one place."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k : k + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    out = {}
    for (lang, words), a in candidates.items():
        inside = (
            len(other) > len(words) and o >= a and any(other[i : i + len(words)] == words for i in range(len(other)))
            for (at, other), o in candidates.items() if at == lang
        )
        if any(inside):
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, k = min((1000 * a * n[lang] // (left * r), k) for k, (left, r) in enumerate(cuts))
        row = (-score, -a, " ".join(words).encode(), " ".join(words), a, *cuts[k], n[lang], score)
        out.setdefault(lang, []).append(row)
    return sorted(
        (lang, rank, *row[3:]) for lang, rows in out.items() for rank, row in enumerate(sorted(rows)[:best], 1)
    )


def corpus():
    rng = random.Random(5)
    common = [f"w{i}" for i in range(12)] + ["Été", "中文", "W3"]
    rows = []
    for lang in ("en", "en", "en", "de", None):
        for _ in range(40):
            words = [rng.choice(common) for _ in range(rng.randint(0, 40))]
            words += [f"rare{rng.random()}" for _ in range(rng.randint(0, 20))]
            rng.shuffle(words)
            text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ! "]) for w in words)
            rows.append((lang, text + rng.choice(["", "New York City, new york city", "one and the same thing " * 3])))
    return rows + [("en", None), (None, ""), ("fr", " . "), ("es", "a b")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None) for i, (lang, t) in enumerate(rows)], DOCS).repartition(5)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("limits", [{}, {"HELD": 50, "BUFFERED": 20}])
def test_equals_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(module, name, value)
    rows = corpus()
    for threshold, longest, best in ((8, 5, 2000), (12, 3, 5), (3, 2, 30)):
        found = collocations(frame(spark, rows), threshold, longest, best)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        expected = brute(rows, threshold, longest, best)
        assert result(found) == expected and len(expected) > 3


def test_words_and_pieces():
    texts = ["One two,three\tFOUR", "", "five", "six.", " seven\x0beight  nine ", "É ß"]
    words = Words(pa.array(["no", *texts], pa.binary()).slice(1))
    said = [words.dictionary[int(c)].as_py().decode() for c in words.codes]
    assert said == "one two three four five six seven eight nine É ß".split()
    assert words.row.tolist() == [0, 0, 0, 0, 2, 3, 4, 4, 4, 5, 5]
    together = [bool(a == b) for a, b in zip(words.piece, words.piece[1:])]
    assert together == [True, False, True, False, False, False, False, True, False, True]


def test_slices_hold_every_piece(monkeypatch):
    """Also of a text that is longer than a slice."""
    monkeypatch.setattr(module, "SLICE_BYTES", 50)
    texts = [t or "" for _, t in corpus()] + ["one, two three. four " * 40, "word" * 100, "", ", ; " * 60]
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(len(texts))]), pa.array(texts)], names=["lang", "text"])
    found = {}
    for n, (names, words) in enumerate(module._slices(iter([batch.slice(0, 7), batch.slice(7)]))):
        for row, piece, code in zip(words.row.tolist(), words.piece.tolist(), words.codes.tolist()):
            found.setdefault(names[row], {}).setdefault((n, piece), []).append(words.dictionary[code].as_py().decode())
    for i, text in enumerate(texts):
        assert list(found.get(str(i), {}).values()) == [p for p in pieces_of(text) if p]


def test_no_summary_misses_a_frequent_key():
    """However occurrences are dealt and merged, a counter falls short by ``lost`` at most."""
    rng = np.random.default_rng(1)
    for trial in range(60):
        keys = (rng.zipf(1.3, 4000) % 900).astype(np.uint64)
        threshold = 40
        capacity = len(keys) // threshold + 1
        whole = Summary(capacity)
        for some in np.array_split(keys, rng.integers(1, 30)):
            local = Summary(capacity)
            for few in np.array_split(some, rng.integers(1, 5)):
                local.add(few, np.ones(len(few), np.int64))
            whole.add(local.keys, local.counts, local.lost)
        true = Counter(keys.tolist())
        assert len(whole.keys) <= capacity and whole.lost < threshold
        counters = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
        for key, f in true.items():
            assert counters.get(key, 0) <= f <= counters.get(key, 0) + whole.lost


def test_capacity_exceeds_mass_by_threshold():
    for mass in (0, 10**3, 10**7, 10**10, 10**14):
        plan = Plan(mass, 100, module.key_width(mass))
        assert plan.capacity << plan.bits > mass // 100
        assert plan.capacity <= module.COUNTERS * 2 + 128


def test_too_few_counters_are_noticed(spark, monkeypatch):
    """With partitions that lose too much the pass is repeated with more counters."""
    tried = []

    class Small(Plan):
        def __init__(self, mass, threshold, width, slack=1):
            super().__init__(mass, threshold, width, slack)
            self.bits, self.capacity = 6, slack
            tried.append(slack)

    monkeypatch.setattr(module, "Plan", Small)
    rows = corpus()
    assert result(collocations(frame(spark, rows), 8, 5, 2000)) == brute(rows, 8, 5, 2000)
    assert max(tried) > 1


@pytest.mark.parametrize("width", [32, 45, 62])
def test_filter_knows_its_keys(spark, width):
    values = np.random.default_rng(2).integers(0, 2**64 - 1, 3000, np.uint64)
    values[:3] = [0, 1, 2**64 - 1]
    keys = module.spread(module.shortened(values, width))
    assert len(np.unique(module.spread(np.arange(10_000, dtype=np.uint64)))) == 10_000
    df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    known = Filter(collected_filter(df), width)
    assert known(values).all()
    others = np.random.default_rng(3).integers(0, 2**64 - 1, 20_000, np.uint64)
    assert known(others).mean() < 0.01


def test_rows_of_a_summary_hold_it(spark):
    rng = np.random.default_rng(4)
    for top in (200, 2**20, 2**62):
        keys = np.unique(rng.integers(0, top, 5000).astype(np.uint64))
        summary = Summary(10**6)
        summary.add(keys, rng.integers(1, top, len(keys)), 7)
        got = pa.Table.from_batches(list(module._summary_rows(iter([(3, summary)]))))
        assert got["part"].to_pylist() == [3] * len(got) and sum(got["lost"].to_pylist()) == 7
        rows = list(zip(got["n"].to_pylist(), got["first"].to_pylist(), got["keys"], got["counts"]))
        back = [np.cumsum(module._unpacked(k, n)) + np.uint64(first) for n, first, k, _ in rows]
        assert np.array_equal(np.concatenate(back), summary.keys)
        counts = np.concatenate([module._unpacked(c, n) for n, _, _, c in rows])
        assert np.array_equal(counts.astype(np.int64), summary.counts)
    empty = Summary(2)
    empty.add(np.arange(5, dtype=np.uint64), np.ones(5, np.int64))
    (row,) = pa.Table.from_batches(list(module._summary_rows(iter([(1, empty)])))).to_pylist()
    assert (row["n"], row["lost"], row["keys"], row["counts"]) == (0, 1, b"", b"")


def test_hot_language_and_repeats(spark):
    rows = [("en", "again and again the same words")] * 500 + [("de", "so oder so")] * 3
    found = result(collocations(frame(spark, rows), 100))
    assert found == brute(rows, 100, 5, 2000)
    assert {r[2] for r in found} == {"again and again the same", "and again the same words"}


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    counts = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 7)], "lang string, phrase string, words int, f long"
    )
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    (row,) = module.scored(counts, totals, 3, 1).collect()
    assert row.score == 1000 * (big - 7) * 10**14 // (big * (big - 1))


def test_odd_rows(spark):
    odd = odd_documents(spark)
    found = collocations(odd, threshold=3, best=10)
    assert result(found) == brute([(r.lang, r.text) for r in odd.collect()], 3, 5, 10)
    assert collocations(no_documents(spark)).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None, None, None)], DOCS)).count() == 0
    for text in ("x" * 1_000_000, "a " * 300_000, "," * 100_000, LONG):
        rows = [("en", text)]
        got = result(collocations(frame(spark, rows), 1000, 3))
        assert got == brute(rows, 1000, 3, 2000)
    with pytest.raises(ValueError):
        collocations(odd, threshold=1)


def test_pairs_only_prune(spark):
    """Longer phrases are found with and without the filter of pairs."""
    rows = corpus()
    docs = frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = spark.sparkContext.broadcast(collected_filter(frequent_keys(docs, 1, 2, 10**5, 8)))
    free = {r.key for r in frequent_keys(docs, 3, 5, 10**5, 8).collect()}
    assert {r.key for r in frequent_keys(docs, 3, 5, 10**5, 8, pairs).collect()} == free


def test_tasks_hand_on_blocks_and_not_a_row_for_each_phrase(spark):
    """Rows between tasks do not grow as tasks times frequent phrases."""
    phrases, tasks = 600, 12
    text = " . ".join(f"left{i} right{i}" for i in range(phrases))
    rows = frame(spark, [("en", text)] * tasks + [("de", "left1 right1")]).select("lang", "text").repartition(tasks)
    keys = frequent_keys(rows, 1, 2, 2 * phrases * tasks, 5)
    survivors = spark.sparkContext.broadcast(collected_filter(keys))
    width = module.key_width(2 * phrases * tasks)
    blocks = module._phrase_blocks(rows, 2, survivors, width, 6)
    assert blocks.count() <= 2 * 64 * tasks  # a row each would be 1800 a task
    assert blocks.agg(F.sum("n")).first()[0] >= 3 * phrases
    found = module._exact_counts(rows, 2, survivors, width, 5, keys.count()).collect()
    assert len(found) == 3 * phrases
    assert {(r["lang"], r["f"]) for r in found} == {("en", tasks)}
    assert all(r["words"] == len(r["phrase"].split(" ")) for r in found)
