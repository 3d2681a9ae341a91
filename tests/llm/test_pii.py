import hashlib
import random
import re
import time

import pytest

from blocktide.llm import pii
from blocktide.llm.pii import detect_pii, find_spans, fit_detector, luhn, sample_texts, strict_spans as strict
from blocktide.llm.queries import QUERIES
from tests.llm.cases import ODD_ROWS, SMALL, by_id, documents, no_documents, odd_documents

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    """The strict spans by the bare patterns."""
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            ):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_query_equals_bare_patterns(spark):
    rows = by_id(QUERIES["op1_pii"](spark, SMALL))
    names = ["email", "ip", "card", "phone"]
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        spans = plain(r.text or "")
        said = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        got = rows[r.doc_id]
        assert got.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [got[f"n_{n}"] for n in names] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(said.split(",")) <= set(got.spans.split(","))


def test_strict_spans_on_random_text():
    rng = random.Random(3)
    for _ in range(4000):
        alphabet = rng.choice(["0123456789. -", "ab.@-", "+0123456789 ().-", "a1.@+- (9)", "4 -0@.é"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert strict(text) == plain(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "1 " * 150_000):
        strict(text)
    assert time.time() - start < 20


def training_texts(n=400):
    rng = random.Random(5)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    texts = []
    for _ in range(n):
        card = "4" + digits(14)
        card += next(c for c in "0123456789" if luhn(card + c))
        texts.append(
            f"some plain words stand here before, call +1 ({digits(3)}) 555-{digits(4)} or write to a{digits(2)}.b@mail{digits(1)}.example.com "
            f"with {rng.choice(['card', 'some', 'the'])} {card} {rng.choice(['', '+1 (555) 555-1234 ' + card + ' and '])}from {rng.randint(1, 255)}.{rng.randint(0, 255)}.7.1 order {digits(8)} of 2024-11-{digits(2)}"
        )
    return texts


def test_trees_add_other_forms_and_leave_numbers_alone():
    detector = fit_detector(training_texts())
    assert set(detector.trees) == {0, 1, 2, 3}
    texts = [
        "please call (415) 555-2671 today",
        "write to jane.doe (at) mail4 (dot) example (dot) com now",
        "order 12345678 of 2024-11-05, pages 10-20, version 1.2.3, total 1234567 and ratio 12.345.678",
        "plain prose without any numbers at all",
        "card 4465758382889437 4465758382889437 twice",
        "reach me under +1 (743) 555-3824 4866351201689520 now",
    ]
    found = find_spans(texts, detector)
    assert [(k, texts[0][s:e]) for s, k, e, *_ in found[0]] == [(3, "(415) 555-2671")]
    assert [(k, texts[1][s:e]) for s, k, e, *_ in found[1]] == [(0, "jane.doe (at) mail4 (dot) example (dot) com")]
    assert found[2] == [] and found[3] == []
    # The strict patterns run over both numbers and fail.
    assert plain(texts[4]) == plain(texts[5]) == []
    assert [texts[4][s:e] for s, *_, in found[4] for e in [s + 16]] == ["4465758382889437"] * 2
    assert [(k, texts[5][s:e]) for s, k, e, *_ in found[5]] == [(3, "+1 (743) 555-3824"), (2, "4866351201689520")]


def test_odd_rows_and_redaction(spark):
    rows = detect_pii(odd_documents(spark), keep=("doc_id", "spans"), redact_to="text").collect()
    assert len(rows) == len(ODD_ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[3].text is None and by[4].text == "" and by[3].spans == []
    assert by[7].text.endswith("mail [EMAIL]") and [s.kind for s in by[7].spans] == ["email"]
    assert detect_pii(no_documents(spark), keep=("doc_id",)).count() == 0


@pytest.mark.parametrize(
    ("said", "kind"),
    [("00 33 6 12 34 56 78", pii.PHONE), ("0 6 1 2 3 4 5 6 7 8", pii.PHONE), ("41 11 11 11 11 11 11 11", pii.CARD),
     (" ".join("4111111111111111"), pii.CARD), (" ".join("1234567890123456789"), pii.CARD)],
)
def test_numbers_in_many_groups_are_proposed_whole(said, kind):
    text = f"call {said} now"
    runs = [m.span() for m in pii.RUN.finditer(text)]
    assert (5, kind, 5 + len(said)) in pii.candidates(text, runs)


def test_candidates_stay_linear():
    found = {n: len(pii.candidates("1 " * n + "x", [(0, 2 * n - 1)])) for n in (1000, 2000)}
    assert found[1000] <= 1000 * 2 * 19 and found[2000] < 2.1 * found[1000]


def test_sample_takes_each_text_once(spark, monkeypatch):
    texts = [f"number {n} of {m}" for n in range(50) for m in (1, 2)]
    often = texts * 3 + ["call 555 0100 today"] * 2000
    docs = documents(spark, often)
    collected = []
    real = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: collected.append(real(df)) or collected[-1])
    sample = sample_texts(docs, 4000, 20_000, "text")
    assert sorted(sample) == sorted({*texts, "call 555 0100 today"})
    assert max(map(len, collected)) == len(sample)
    some = sample_texts(docs, 40, 20_000, "text")
    assert len(some) == len(set(some)) == 40


@pytest.mark.parametrize(
    "said",
    [
        "x" * 90 + " (at) mail (dot) example (dot) com",
        "jane (at) " + "m" * 80 + " (dot) com",
        "jane (at) " + " (dot) ".join("abcdefghijk") + " (dot) org",
    ],
)
def test_disguised_addresses_of_any_length_are_proposed_whole(said):
    text = f"please write to {said} today"
    spans = [(c[0], c[2]) for c in pii.candidates(text, []) if c[1] == 0]
    assert (16, 16 + len(said)) in spans


def test_long_disguises_take_linear_time():
    start = time.time()
    for text in ("a" * 1_000_000, "a@b " * 200_000, "x (at) y (dot) z " * 60_000, "a@" + "b." * 300_000, "a.b-c%" * 200_000 + " (at)"):
        pii.candidates(text, [])
    assert time.time() - start < 20
