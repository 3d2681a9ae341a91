import numpy as np
from pyspark.sql import functions as F

from blocktide.llm.language import (
    fit_language_model,
    gram_indices,
    identify_language,
    labelled_sample,
    presence,
    score_texts,
)
from blocktide.llm.queries import QUERIES
from tests.llm.cases import ODD_ROWS, by_id, no_documents, odd_documents

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_language"](spark, MEDIUM).collect()
    docs = by_id(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"))
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert 150 < len(held) < 350
    right = sum(docs[r.doc_id].lang == r.lang_pred for r in held) / len(held)
    assert right >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_kernel_is_the_share_of_common_grams():
    texts = ["der hund und die katze", "the dog and the cat", "le chien et le chat", "the dog"] * 5
    model = fit_language_model(texts, ["de", "en", "fr", "en"] * 5, landmarks=4)
    rows, sizes = presence(texts, model.classes, model.vocabulary)
    kernel = rows @ model.landmarks / np.sqrt(sizes)[:, None]
    own = set(gram_indices(texts[0], model.classes).tolist())
    other = set(gram_indices(texts[1], model.classes).tolist())
    want = len(own & other) / np.sqrt(len(own) * len(other))
    column = int(np.argmax(kernel[1]))
    assert abs(kernel[0][column] - want) < 1e-5 and abs(kernel[1][column] - 1) < 1e-5
    best, _ = score_texts(model, ["die katze und der hund", "a cat and the dog"])
    assert [model.languages[b] for b in best] == ["de", "en"]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = identify_language(docs, F.lit(True), keep=("doc_id", "score")).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id not in (3, 4, 5)} <= {"en", "fr"}
    nothing = identify_language(docs, F.lit(False), keep=("doc_id",)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert identify_language(no_documents(spark), F.lit(True), keep=("doc_id",)).count() == 0


def test_letters_of_all_planes_are_read(spark):
    """Also those above the first one: they are told apart, and learned."""
    gothic, mixed = "\U00010330\U00010331\U00010332 \U00010333\U00010334", "\U00010400\U00010428 \U00010429"
    cases = [gothic, mixed, "der hund und die katze", "the dog and the cat"]
    rows = [(i, t * 5 + " " * (i % 3), lang) for i, (t, lang) in enumerate(zip(cases * 8, ["got", "dsrt", "de", "en"] * 8))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = by_id(identify_language(docs, F.col("doc_id") < 16, keep=("doc_id",)))
    assert all(got[i].lang_pred == lang and got[i].score > 0.5 for i, _, lang in rows)
    model = fit_language_model([t for _, t, _ in rows], [x for _, _, x in rows])
    for text in (gothic, "\U0001D538\U0001D539", "\U00020000\U00020001"):
        assert (gram_indices(text, model.classes) > 0).any()


def test_fit_equals_a_plain_kernel_ridge():
    """Against sets of n-grams, a dense Nystroem map and least squares."""
    texts = [t.text for t in _sentences()]
    languages = [t.language for t in _sentences()]
    ridge, landmarks = 1e-3, 12
    model = fit_language_model(texts, languages, landmarks=landmarks, ridge=ridge)
    names = sorted(set(languages))
    turn = {}
    order = []
    for i, x in enumerate(languages):
        turn[x] = turn.get(x, -1) + 1
        order.append((turn[x], names.index(x), i))
    chosen = [i for *_, i in sorted(order)][:landmarks]
    grams = [set(gram_indices(t, model.classes).tolist()) for t in texts]
    kernel = np.array([[len(a & grams[j]) / np.sqrt(len(a) * len(grams[j])) for j in chosen] for a in grams])
    values, vectors = np.linalg.eigh(kernel[chosen])
    keep = values > values.max() * 1e-8
    features = kernel @ vectors[:, keep] / np.sqrt(values[keep])
    weights = np.array([len(texts) / len(names) / languages.count(x) for x in languages])
    targets = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    padded = np.vstack((features * np.sqrt(weights)[:, None], np.sqrt(ridge * len(texts)) * np.eye(features.shape[1])))
    aims = np.vstack((targets * np.sqrt(weights)[:, None], np.zeros((features.shape[1], len(names)))))
    plain = features @ np.linalg.lstsq(padded, aims, rcond=None)[0]
    rows, sizes = presence(texts, model.classes, model.vocabulary)
    ours = (rows @ model.landmarks / np.sqrt(sizes)[:, None]) @ model.coefficients
    assert np.abs(ours - plain).max() < 0.02
    best, _ = score_texts(model, texts)
    assert best.tolist() == plain.argmax(axis=1).tolist()


def _sentences():
    from collections import namedtuple
    from random import Random

    rng, kind = Random(3), namedtuple("Sentence", "text language")
    words = {"de": "der hund und die katze schläft im haus", "en": "the dog and the cat sleep in house", "fr": "le chien et la chatte dorment à maison"}
    return [kind(" ".join(rng.choices(words[x].split(), k=9)), x) for x in ("de", "en", "fr") for _ in range(9 if x != "fr" else 5)]


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr("blocktide.llm.language.SAMPLE_ROWS", 40)
    monkeypatch.setattr("blocktide.llm.language.SAMPLE_CHARS", 30)
    rows = [(i, f"text number {i} of {'long ' * 50}", f"l{i % 20}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = labelled_sample(docs, F.lit(True), 256, "doc_id", "text", "lang")
    assert len(sample) == 40 and len({x for _, x in sample}) == 20 and max(len(t) for t, _ in sample) == 30
