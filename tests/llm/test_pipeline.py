"""Every stage against what its own operator, or a plain version, says of its input."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blocktide.llm.decontamination import contamination
from blocktide.llm.queries import in_fold
from tests.llm.cases import ODD_ROWS, SMALL, no_documents, odd_documents
from tests.llm.test_jaccard import brute
from tests.llm.test_pii import plain

BY_NAME = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The input of every stage and the result of the last."""
    at = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(str(at / name))
        out.append(spark.read.parquet(str(at / name)))
    return out


def test_stages_keep_the_columns(tables):
    assert all(t.dtypes == tables[0].dtypes for t in tables[:-1])


def test_clean_documents_have_a_language(tables):
    kept = {r.doc_id for r in tables[1].collect()}
    assert kept == {r.doc_id for r in tables[0].collect() if any(c.isalpha() for c in r.text or "")}


def test_one_of_each_group_stays(tables):
    want = brute({r.doc_id: r.text for r in tables[1].collect()})
    assert sorted(r.doc_id for r in tables[2].collect()) == sorted({c for _, c in want.values()})


def test_no_window_of_the_benchmark_is_left(spark, tables):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    bad = {r.doc_id for r in contamination(tables[2], items).filter("contaminated").collect()}
    assert {r.doc_id for r in tables[3].collect()} == {r.doc_id for r in tables[2].collect()} - bad
    assert contamination(tables[3], items).filter("contaminated").count() == 0


def test_strict_spans_are_gone(tables):
    before = {r.doc_id: r.text for r in tables[3].collect()}
    for r in tables[4].collect():
        assert plain(r.text) == [] and r.n_chars == len(r.text)
        if not plain(before[r.doc_id]) and "[" not in r.text:
            assert r.text == before[r.doc_id]


def test_all_tokens_are_packed(tables):
    covered = defaultdict(int)
    for r in tables[5].collect():
        covered[r.doc_id] += r.length
        total = r.doc_tokens
        assert covered[r.doc_id] <= total
    assert set(covered) == {r.doc_id for r in tables[4].collect()}


def test_run_equals_the_stages(spark, tables):
    columns = ["doc_id", "doc_tokens", "start"]
    total = corpus_pipeline.run(spark, SMALL).groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, total)) == sorted(map(tuple, tables[5].groupBy("doc_id").sum("length").collect()))
    assert set(columns) <= set(tables[5].columns)


@pytest.mark.parametrize("name", list(BY_NAME))
def test_odd_rows(spark, name):
    docs = odd_documents(spark)
    rows = BY_NAME[name](spark, docs, SMALL).collect()
    left = sorted(r.doc_id or 0 for r in rows if name != "packing" or r.start == 0)
    everything = sorted(r[0] or 0 for r in ODD_ROWS)
    want = {"language": [0, 1, 2, 2, 6, 7, 8], "near_duplicates": [0, 1, 3, 4, 5, 6, 7, 8]}
    assert left == want.get(name, everything)
    assert BY_NAME[name](spark, no_documents(spark), SMALL).count() == 0


@pytest.mark.parametrize("labels", ["none", "held out"])
def test_language_without_labels_keeps_letters(spark, labels):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lang = F.lit(None).cast("string") if labels == "none" else F.when(in_fold(2), F.col("lang"))
    docs = docs.withColumn("lang", lang)
    kept = BY_NAME["language"](spark, docs, SMALL)
    had = {r.doc_id: r.lang for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert had and {r.doc_id: r.lang for r in kept.collect()} == had
