import hashlib
import random

import pytest

from blocktide.llm import sql
from blocktide.llm.decontamination import contamination, drop_contaminated, find_windows
from blocktide.llm.queries import QUERIES
from tests.compare import compare, duck
from tests.llm.cases import LONG, ODD_ROWS, SMALL, by_id, documents, no_documents, odd_documents

ITEMS = "item_id long, text string"


def test_query_equals_sql(spark):
    name = "op9_decontamination"
    assert compare(spark, duck(SMALL), name, QUERIES[name], sql.ORACLE[name], SMALL) is None


def test_windows_short_items_and_overlaps(spark):
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame(
        [(1, " ".join(words[:12])), (2, "Short ITEM!"), (3, None), (4, "..."), (10, " ".join(words[1:12])),
         (5, "one"), (None, "lonely name"), (2, "Short ITEM!")],
        ITEMS,
    )
    docs = documents(
        spark,
        [
            "x " + " ".join(words[:12]) + " y",  # three windows of item 1, two of item 10
            " ".join(words[:9]),  # one word too few
            "short, item short item",
            "SHORT-ITEM É one two",
            "Lonely name",
            " ".join(words[1:11]),
            "itÉm short ",
        ],
    )
    rows = by_id(contamination(docs, items))
    assert [(rows[i].n_hit, rows[i].n_items) for i in range(7)] == [(12, 2), (0, 0), (4, 1), (3, 2), (2, 1), (10, 2), (0, 0)]
    assert rows[0].items_sha256 == hashlib.sha256(b"1,10").hexdigest()
    assert rows[1].items_sha256 == hashlib.sha256(b"").hexdigest() and not rows[1].contaminated
    kept = drop_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 6]
    assert kept.columns == docs.columns


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "the lazy dog again and"), (2, " ".join(LONG.split()[500:530]))], ITEMS)
    items = items.selectExpr("*", "'x' AS doc_id", "'x' AS key_id")
    rows = contamination(docs, items).collect()
    assert len(rows) == len(ODD_ROWS)
    assert sorted(r.doc_id for r in rows if r.contaminated) == [1, 2, 2, 6]
    assert next(r.n_hit for r in rows if r.doc_id == 6) == 30
    assert contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert contamination(no_documents(spark), items).count() == 0
    assert drop_contaminated(docs, items).count() == len(ODD_ROWS) - 4


@pytest.mark.parametrize(("few", "hot"), [(10**6, 1), (2, 3), (2, 10**6), (1, 1)])
def test_every_way_of_joining_finds_the_same(spark, few, hot):
    rng = random.Random(7)

    def text(n):
        return " ".join(rng.choice("abcde") for _ in range(n))

    said = [text(rng.randrange(40)) for _ in range(60)]
    asked = [text(rng.choice([1, 2, 3, 4, 5, 9])) for _ in range(12)] + ["a a a a", "z z z z", "a z"]
    docs = documents(spark, [*said, *said[:5], "a " * 200])
    items = spark.createDataFrame(list(enumerate(asked)), ITEMS)
    found, _ = find_windows(docs, items, 4, "doc_id", "text", few, hot)
    got = {(r.key_id, r.start, r.said) for r in found.collect()}
    want = set()
    for r in docs.collect():
        w = r.text.split()
        for item in asked:
            i = item.split()
            for cut in {tuple(i[k : k + 4]) for k in range(max(len(i) - 3, 1))}:
                want |= {
                    (r.doc_id, k, " ".join(cut))
                    for k in range(len(w) - len(cut) + 1)
                    if tuple(w[k : k + len(cut)]) == cut
                }
    assert got == want and len(want) > 100


def test_a_text_of_one_word_and_plans_without_python(spark):
    docs = documents(spark, ["x" * 1_000_000, "y " * 500_000 + "one two", ""])
    items = spark.createDataFrame([(1, "x" * 1_000_000), (2, "y one two")], ITEMS)
    found = contamination(docs, items)
    assert [(r.n_words, r.n_hit) for r in sorted(found.collect())] == [(1, 1), (500_002, 3), (0, 0)]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
