"""Personal data: candidate spans judged by boosted trees.

Generators with high recall propose overlapping spans for each kind. Spans that
match a kind's strict pattern are kept as they are; the others are judged by
gradient-boosted trees over the span's format and its surroundings, with a
calibrated threshold for each kind. The trees learn from a bounded sample of the
documents themselves: strict matches, candidates that would match if a number
did not touch them, and rewritten forms, against the other candidates.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocktide.llm.boosting import Trees, calibrate, fit_trees, threshold_for
from blocktide.llm.common import drawn, share_for, sliced

#: In the order in which spans of equal start are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Every strict ip, card or phone match lies in such a run (a phone's plus before it).
RUN = re.compile(r"[0-9][0-9 ().-]*[0-9]")
IP_FORM = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_FORM = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE_FORM = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
GROUP = re.compile(r"[0-9]+")
#: Mail addresses in disguise: words for the at sign and the dots, with spaces. Of any length:
#: what was read is never given back, so the scan stays linear.
DISGUISED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
    r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)+"
)
DISGUISE = re.compile(r"\(at\)|\[at\]| @|@ |\(dot\)|\[dot\]")

#: Phone candidates have 7 to 15 digits, card candidates 12 to 19, in as many groups as they take.
MOST_DIGITS = 19
SPACED_IP = re.compile(r"(?<![0-9.])(?:[0-9]{1,3} ?\. ?){3}[0-9]{1,3}(?![0-9.])")
CONTEXT = 24
WORDS_NEAR = (
    re.compile(r"phone|tel|call|mobile|fax|whatsapp", re.I),
    re.compile(r"card|visa|credit|payment|amex", re.I),
    re.compile(r"\bip\b|host|server|address", re.I),
    re.compile(r"mail|contact|write", re.I),
)

SPANS = T.ArrayType(
    T.StructType()
    .add("kind", "string")
    .add("start", "long")
    .add("end", "long")
    .add("base", "boolean")
    .add("chance", "double")
)

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping; from each at sign back over the local part."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, EMAIL, match.end()))
            last = match.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return found


def base_numbers(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    found = []
    for start, end in runs:
        for m in IP_FORM.finditer(text, start, end):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), IP, m.end()))
        for m in CARD_FORM.finditer(text, start, end):
            if m.end() - m.start() <= 40:
                digits = re.sub("[ -]", "", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), CARD, m.end()))
        if start and text[start - 1] == "+":
            m = PHONE_FORM.match(text, start - 1, end)
            if m and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return found


def candidates(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """Overlapping proposals, strict or not; linear in the text."""
    found = []
    if "@" in text or "(at)" in text or "[at]" in text:
        found += [(m.start(), EMAIL, m.end()) for m in DISGUISED.finditer(text)]
    for start, end in runs:
        if end - start < 7:
            continue
        groups = [m.span() for m in GROUP.finditer(text, start, end)]
        found += [(m.start(), IP, m.end()) for m in SPACED_IP.finditer(text, start, end)]
        for i in range(len(groups)):
            digits = 0
            for j in range(i, len(groups)):
                digits += groups[j][1] - groups[j][0]
                if digits > MOST_DIGITS:
                    break
                if digits >= 7:
                    a, b = groups[i][0], groups[j][1]
                    if a and text[a - 1] == "(":
                        a -= 1
                    if a and text[a - 1] == "+":
                        a -= 1
                    if digits >= 12:
                        found.append((groups[i][0], CARD, b))
                    if digits <= 15:
                        found.append((a, PHONE, b))
    return found


def char_class(text: str, at: int) -> int:
    if at < 0 or at >= len(text) or text[at].isspace():
        return 0
    ch = text[at]
    return 1 if ch.isalpha() else 2 if ch.isdigit() else 3 if ch in ",;:!?)(\"'" else 4


def describe(text: str, span: Span) -> list[float]:
    """Format and context features of a candidate, the same list for all kinds."""
    start, _, end = span
    said = text[start:end]
    groups = GROUP.findall(said)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    around = text[max(0, start - CONTEXT) : start]
    domain = re.split(r"@|\(at\)|\[at\]", said)[-1]
    labels = [x for x in re.split(r" ?(?:\.|\(dot\)|\[dot\]) ?", domain) if x]
    return [
        len(said), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        said.count(" "), said.count("-"), said.count("."), said.count("("), said.count(")"),
        "  " in said or "--" in said or ".." in said,
        said.startswith("+"), said.startswith("("), luhn(digits) if digits else 0,
        all(len(g) <= 3 and int(g) <= 255 for g in groups) if groups else 0,
        len(set(digits)), int(digits[0]) if digits else -1,
        char_class(text, start - 1), char_class(text, end),
        "@" in said, bool(DISGUISE.search(said)), len(labels), len(labels[-1]) if labels else 0,
        labels[-1].isalpha() if labels else 0, len(said) - len(domain),
        *[bool(w.search(around)) for w in WORDS_NEAR],
    ]


@dataclass
class Detector:
    trees: dict[int, Trees]
    thresholds: dict[int, float]


def strict_spans(text: str) -> list[Span]:
    runs = [m.span() for m in RUN.finditer(text)]
    return sorted(base_emails(text) + base_numbers(text, runs))


def alone(kind: int, said: str) -> bool:
    """Whether a candidate would match if other characters did not touch it.

    The strict patterns run on into a number that follows and then fail as a whole.
    """
    return (0, kind, len(said)) in strict_spans(said)


def rewrites(kind: int, said: str, rng: random.Random) -> list[str]:
    """Other ways to write a strict match."""
    if kind == EMAIL:
        space = rng.choice(["", " "])
        at, dot = rng.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("@", "."), ("(at)", "."), ("[at]", ".")])
        at, dot = space + at + space, dot if dot == "." else space + dot + space
        local, _, domain = said.partition("@")
        return [local + at + domain.replace(".", dot)]
    digits = "".join(GROUP.findall(said))
    if kind == PHONE and len(digits) >= 10:
        area, mid, end = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [rng.choice([f"({area}) {mid}-{end}", f"({area}) {mid} {end}", f"+{digits[:-10]} {area}.{mid}.{end}"])]
    if kind == CARD and len(digits) == 16:
        sep = rng.choice([".", " ", "-"])
        return [sep.join(digits[i : i + 4] for i in range(0, 16, 4))]
    return []


def training_rows(texts: list[str], seed: int = 1):
    """Features, labels and fold (0 fit, 1 held out) of the candidates of each kind."""
    rng = random.Random(seed)
    rows: dict[int, list] = {k: [] for k in range(4)}
    for n, text in enumerate(texts):
        runs = [m.span() for m in RUN.finditer(text)]
        strict = strict_spans(text)
        for span in strict:
            rows[span[1]].append((describe(text, span), 1, n % 2))
            for said in rewrites(span[1], text[span[0] : span[2]], rng):
                other = text[max(0, span[0] - 40) : span[0]] + said + text[span[2] : span[2] + 40]
                start = min(40, span[0])
                rows[span[1]].append((describe(other, (start, span[1], start + len(said))), 1, n % 2))
        for span in candidates(text, runs):  # those over a strict span are never judged
            if not any(span[0] < e and s < span[2] for s, _, e in strict):
                label = int(alone(span[1], text[span[0] : span[2]]))
                rows[span[1]].append((describe(text, span), label, n % 2))
        # Numbers of no kind, so that every kind has met some.
        for _ in range(1 + len(strict)):
            sizes = [rng.randint(1, 8) for _ in range(rng.randint(1, 5))]
            parts = ["".join(rng.choice("0123456789") for _ in range(s)) for s in sizes]
            said = rng.choice([" ", "-", ".", ", ", "/"]).join(parts)
            digits = "".join(GROUP.findall(said))
            other = f"{text[:20]} {said} {text[20:40]}"
            start = len(text[:20]) + 1
            for kind in (IP, CARD, PHONE):
                if not (kind == CARD and luhn(digits) and len(digits) >= 12):
                    rows[kind].append((describe(other, (start, kind, start + len(said))), 0, n % 2))
        words = text[:200].split()
        if len(words) > 3:
            at = rng.choice(["@", "(at)", "[at]"])
            said = f"{words[0]} {at} {words[1]}. {words[2]}"
            rows[EMAIL].append((describe(said, (0, EMAIL, len(said))), 0, n % 2))
    return rows


def fit_detector(texts: list[str], precision: float = 0.995, floor: float = 0.9) -> Detector:
    """Trees and thresholds for the kinds of which the texts have at least 20 strict matches."""
    detector = Detector({}, {})
    for kind, rows in training_rows(texts).items():
        if not rows:
            continue
        x = np.array([r[0] for r in rows], float)
        y = np.array([r[1] for r in rows], float)
        held = np.array([r[2] for r in rows]) == 1
        if min(y[held].sum(), (1 - y[held]).sum(), y[~held].sum(), (1 - y[~held]).sum()) < 10:
            continue
        trees = fit_trees(x[~held], y[~held])
        calibrate(trees, x[held], y[held])
        least = threshold_for(trees.probability(x[held]), y[held], precision)
        detector.trees[kind], detector.thresholds[kind] = trees, max(floor, least)
    return detector


def find_spans(texts: list[str], detector: Detector) -> list[list[tuple[int, int, int, bool, float]]]:
    """Sorted (start, kind, end, strict, chance) of each text.

    Strict spans stay. Of the others those over the threshold that overlap no
    strict span are taken, the most probable first, without overlaps.
    """
    out, asked, features = [], [], []
    for n, text in enumerate(texts):
        runs = [m.span() for m in RUN.finditer(text)]
        strict = strict_spans(text)
        out.append([(*s, True, 1.0) for s in strict])
        taken = sorted((s, e) for s, _, e in strict)
        ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.array([])
        starts = np.array([s for s, _ in taken])
        for span in candidates(text, runs):
            if span[1] not in detector.trees:
                continue
            k = int(np.searchsorted(starts, span[2])) if taken else 0
            if not (k and ends[k - 1] > span[0]):
                asked.append((n, span))
                features.append(describe(text, span))
    if asked:
        x, kinds = np.array(features, float), np.array([s[1] for _, s in asked])
        chance = np.zeros(len(asked))
        for kind in set(kinds.tolist()):
            own = kinds == kind
            chance[own] = detector.trees[kind].probability(x[own])
        least = np.array([detector.thresholds[k] for k in kinds])
        used: dict[int, list[tuple[int, int]]] = {}
        for i in sorted(np.flatnonzero(chance >= least), key=lambda i: (-chance[i], asked[i])):
            n, (start, kind, end) = asked[i]
            mine = used.setdefault(n, [])
            if all(e <= start or end <= s for s, e in mine):
                mine.append((start, end))
                out[n].append((start, kind, end, False, float(chance[i])))
    return [sorted(spans) for spans in out]


def sample_texts(docs: DataFrame, rows: int, characters: int, text_column: str) -> list[str]:
    """Up to ``rows`` texts that hold digits or an at sign, the first by hash; long ones are not drawn.

    Copies of a text count and are drawn once, so few more than ``rows`` reach the driver.
    """
    text = F.col(text_column)
    fit = docs.filter(text.rlike("[0-9@]") & (F.length(text) <= characters))
    fit = fit.select(text.alias("t"), F.xxhash64(text).alias("h"))
    share = share_for(rows, fit.select("h").distinct().count())
    found = fit.filter(drawn(F.col("h"), share)).dropDuplicates(["h"]).collect()
    found.sort(key=lambda r: (r.h & (1 << 64) - 1, r.t))
    return [r.t for r in found[:rows]]


def detect_pii(
    docs: DataFrame,
    keep: tuple[str, ...] = (),
    sample_rows: int = 4000,
    sample_characters: int = 20_000,
    text_column: str = "text",
    redact_to: str | None = None,
) -> DataFrame:
    """Columns ``keep`` of every row, with its ``spans`` of personal data.

    A span has kind, start and end (code points, end exclusive), ``base`` (it
    matches the strict pattern) and ``chance``. Spans are ordered by start, then
    kind. The trees are fitted on at most ``sample_rows`` texts of at most
    ``sample_characters`` characters; every text is searched whole. With
    ``redact_to`` a column of that name holds the text with every span replaced
    by ``[KIND]``; overlapping spans become one, named after the first.

    Null and empty texts have no spans (a null stays null when redacted). A kind
    with too few examples to learn from keeps its strict spans only. Repeated
    rows get equal results, an empty table none. A kept column named like an
    output column is left out.
    """
    detector = fit_detector(sample_texts(docs, sample_rows, sample_characters, text_column))
    shared = docs.sparkSession.sparkContext.broadcast(detector)
    keep = [c for c in keep if c not in ("spans", redact_to)]
    rows = docs.select(*keep, F.col(text_column).alias("_text"))
    schema = T.StructType([docs.schema[c] for c in keep]).add("spans", SPANS)
    if redact_to:
        schema = schema.add(redact_to, "string")
    arrow_span = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("chance", pa.float64())]
        )
    )

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(parts):
            texts = part.column(part.num_columns - 1).to_pylist()
            found = find_spans([t or "" for t in texts], shared.value)
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "base": b, "chance": c} for s, k, e, b, c in own]
                for own in found
            ]
            columns = [part.column(i) for i in range(part.num_columns - 1)]
            columns.append(pa.array(spans, arrow_span))
            if redact_to:
                columns.append(pa.array([redacted(t, f) for t, f in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(search, schema)


def redacted(text: str | None, spans: list[tuple]) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for start, kind, end, *_ in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    said = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(said, ",")
