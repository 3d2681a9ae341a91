"""Language identification with string kernels.

The kernel of two texts is the share of character n-grams (1 to 3, blended)
that both contain: |A and B| / sqrt(|A| |B|). A bounded sample of labelled texts
gives the Nystroem landmarks; kernel ridge regression, one language against the
rest, is fitted on the sample's landmark features. Texts are scored in batches:
n-gram presence times landmark matrix, times coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocktide.llm.common import drawn, share_for, sliced

UNDETERMINED = "und"
#: Characters are mapped to this many classes, so a trigram is an index below CLASSES**3.
CLASSES = 64
GRAMS = CLASSES + CLASSES**2 + CLASSES**3
CODE_POINTS = 0x110000
#: Bounds of what is learned from, whatever the corpus: rows in all, and characters of a row.
#: With many labels each has fewer rows. Texts are predicted as a whole.
SAMPLE_ROWS = 16_384
SAMPLE_CHARS = 20_000
#: Texts whose n-grams are laid out at a time.
BLOCK_TEXTS = 256


@dataclass
class LanguageModel:
    languages: list[str]
    classes: np.ndarray  # code point to class
    vocabulary: np.ndarray  # n-gram indices that some landmark has
    landmarks: np.ndarray  # vocabulary x landmarks, columns scaled by 1/sqrt(size)
    coefficients: np.ndarray  # landmarks x languages
    sharpness: float


def char_classes(texts: list[str]) -> np.ndarray:
    """The commonest letters get a class each, other letters share the last few.

    Class 0 is everything that is not a letter.
    """
    counts: dict[str, int] = {}
    for text in texts:
        for ch in text.lower():
            counts[ch] = counts.get(ch, 0) + 1
    letters = sorted((c for c in counts if c.isalpha()), key=lambda c: (-counts[c], c))
    shared = 8
    own = {ord(c): 1 + i for i, c in enumerate(letters[: CLASSES - 1 - shared])}
    table = np.zeros(CODE_POINTS, np.uint8)
    for code in range(CODE_POINTS):
        ch = chr(code)
        if code in own:
            table[code] = own[code]
        elif ch.isalpha():
            low = ord(ch.lower()[0])
            spread = CLASSES - shared + low // 128 % shared
            table[code] = own.get(low, spread)
    return table


def gram_indices(text: str, classes: np.ndarray) -> np.ndarray:
    """Indices of the n-grams of ``text``, with repeats; runs of other characters are one space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = classes[codes].astype(np.uint32)
    if len(c) > 1:
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
    two = c[:-1] * CLASSES + c[1:]
    three = two[:-1] * CLASSES + c[2:]
    return np.concatenate((c, CLASSES + two, CLASSES + CLASSES**2 + three))


def presence(texts: list[str], classes: np.ndarray, vocabulary: np.ndarray):
    """A 0/1 row over the vocabulary for each text, and the size of its whole n-gram set."""
    rows = np.zeros((len(texts), len(vocabulary)), np.float32)
    sizes = np.zeros(len(texts), np.float32)
    seen = np.zeros(GRAMS, np.bool_)
    for i, text in enumerate(texts):
        grams = gram_indices(text, classes)
        seen[grams] = True
        rows[i] = seen[vocabulary]
        sizes[i] = max(1, np.count_nonzero(seen))
        seen[grams] = False
    return rows, sizes


def fit_language_model(
    texts: list[str], languages: list[str], landmarks: int = 192, ridge: float = 1e-3
) -> LanguageModel | None:
    """Fit on labelled texts; None if there are none."""
    if not texts:
        return None
    names = sorted(set(languages))
    labels = np.array([names.index(x) for x in languages])
    classes = char_classes(texts)
    # Landmarks in turn from each language, in the order given.
    turn = np.zeros(len(texts), int)
    for k in range(len(names)):
        turn[labels == k] = np.arange(np.count_nonzero(labels == k))
    chosen = np.lexsort((labels, turn))[: max(landmarks, len(names))]
    used = np.zeros(GRAMS, np.bool_)
    for i in chosen:
        used[gram_indices(texts[i], classes)] = True
    vocabulary = np.flatnonzero(used)
    rows, sizes = presence([texts[i] for i in chosen], classes, vocabulary)
    marks = (rows / np.sqrt(sizes)[:, None]).T.copy()
    kernel = np.empty((len(texts), len(chosen)))
    for at in range(0, len(texts), BLOCK_TEXTS):
        rows, sizes = presence(texts[at : at + BLOCK_TEXTS], classes, vocabulary)
        kernel[at : at + BLOCK_TEXTS] = rows @ marks / np.sqrt(sizes)[:, None]
    inner = kernel[chosen]
    inner = (inner + inner.T) / 2
    values, vectors = np.linalg.eigh(inner)
    keep = values > max(values.max() * 1e-8, 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    targets = np.where(labels[:, None] == np.arange(len(names)), 1.0, -1.0)
    weights = np.full(len(texts), 1.0)
    for k in range(len(names)):  # each language weighs the same
        weights[labels == k] /= np.count_nonzero(labels == k)
    weights *= len(texts) / len(names)
    gram = features.T @ (features * weights[:, None])
    gram += ridge * len(texts) * np.eye(gram.shape[0])
    solved = np.linalg.solve(gram, features.T @ (targets * weights[:, None]))
    return LanguageModel(
        names, classes, vocabulary, marks, (root @ solved).astype(np.float32), sharpness=4.0
    )


def score_texts(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its score in 0..1, for each text."""
    rows, sizes = presence(texts, model.classes, model.vocabulary)
    kernel = rows @ model.landmarks / np.sqrt(sizes)[:, None]
    raw = model.sharpness * (kernel @ model.coefficients).astype(np.float64)
    raw = np.exp(raw - raw.max(axis=1, keepdims=True))
    share = raw / raw.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    return best, share[np.arange(len(texts)), best]


def labelled_sample(
    docs: DataFrame, train: Column, per_language: int, id_column: str, text_column: str, lang: str
) -> list[tuple[str, str]]:
    """At most ``per_language`` (text, language) of each language, the first by hash of id and text.

    Rows are counted by language first, so that only a few more than asked for
    reach the driver.
    """
    rows = docs.filter(
        train & F.col(lang).isNotNull() & F.col(text_column).rlike(r"\p{L}")
    ).select(
        F.xxhash64(id_column, text_column).alias("h"),
        F.left(F.col(text_column), F.lit(SAMPLE_CHARS)).alias("t"),
        F.col(lang).alias("l"),
    )
    totals = {r.l: r["count"] for r in rows.groupBy("l").count().collect()}
    if not totals:
        return []
    if len(totals) > SAMPLE_ROWS:
        raise ValueError(f"{len(totals)} labels; at most {SAMPLE_ROWS} can be learned")
    per_language = min(per_language, SAMPLE_ROWS // len(totals))
    shares = F.create_map(
        *[F.lit(x) for name, n in totals.items() for x in (name, share_for(per_language, n))]
    )
    found = rows.filter(drawn(F.col("h"), F.element_at(shares, F.col("l")))).collect()
    found.sort(key=lambda r: (r.h & (1 << 64) - 1, r.t, r.l))
    counts = dict.fromkeys(totals, 0)
    sample = []
    for r in found:
        counts[r.l] += 1
        if counts[r.l] <= per_language:
            sample.append((r.t, r.l))
    return sample


def identify_language(
    docs: DataFrame,
    train: Column,
    per_language: int = 256,
    keep: tuple[str, ...] = (),
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    batch: int = 256,
    letters_to: str | None = None,
) -> DataFrame:
    """Columns ``keep`` of every row with ``lang_pred`` and ``score``.

    Fitted on at most ``per_language`` rows of each label (SAMPLE_ROWS in all, the
    first SAMPLE_CHARS characters of each) among those for which ``train`` holds; rows with a null text, null label or no letter teach
    nothing. Prediction sees the whole text only. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if nothing could be
    learned; with ``letters_to`` a boolean column of that name tells which texts
    have a letter. Repeated rows get equal results, an empty table none. A kept column
    named like an output column is left out.
    """
    sample = labelled_sample(docs, train, per_language, id_column, text_column, lang_column)
    model = fit_language_model([t for t, _ in sample], [x for _, x in sample])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in keep if c not in ("lang_pred", "score", letters_to)]
    rows = docs.select(*keep, F.col(text_column).alias("_text"))
    schema = T.StructType([docs.schema[c] for c in keep])
    schema = schema.add("lang_pred", "string").add("score", "double")
    if letters_to:
        schema = schema.add(letters_to, "boolean")
    letter = regex.compile(r"\p{L}")

    def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for part in sliced(parts):
            texts = part.column(part.num_columns - 1).to_pylist()
            n = len(texts)
            names, scores = np.full(n, UNDETERMINED, object), np.zeros(n)
            lettered = [i for i in range(n) if texts[i] and letter.search(texts[i])]
            known = lettered if fitted else []
            for at in range(0, len(known), batch):
                some = known[at : at + batch]
                best, share = score_texts(fitted, [texts[i] for i in some])
                names[some] = np.array(fitted.languages, object)[best]
                scores[some] = share
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            kept += [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if letters_to:
                has_letter = np.zeros(n, np.bool_)
                has_letter[lettered] = True
                kept.append(pa.array(has_letter))
            yield pa.RecordBatch.from_arrays(kept, names=schema.names)

    return rows.mapInArrow(predict, schema)
