"""From raw documents to packed training sequences, in five stages.

Every stage but the last returns rows with the five columns of ``documents`` and
no others; each is written to the shared folder and read again before the next
one starts. Empty tables pass through; repeated rows are copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocktide.llm.decontamination import drop_contaminated
from blocktide.llm.jaccard import keep_one_each
from blocktide.llm.language import UNDETERMINED, identify_language
from blocktide.llm.packing import Limits, pack
from blocktide.llm.pii import detect_pii
from blocktide.llm.queries import gpt_ids, training_rows
from blocktide.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter.

    ``lang`` is filled in where it is null, and kept where it is not. If no label
    could be learned from, it stays null.
    """
    found = identify_language(docs, training_rows(), keep=tuple(COLUMNS), letters_to="has_letter")
    predicted = F.nullif(F.col("lang_pred"), F.lit(UNDETERMINED))
    kept = found.filter("has_letter").withColumn("lang", F.coalesce("lang", predicted))
    return kept.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of similar ones."""
    return keep_one_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    return drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the new text."""
    found = detect_pii(docs, keep=("doc_id", "lang", "source"), redact_to="text")
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return pack(docs, gpt_ids, Limits())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("packing", packing),
]

#: Several stages are models or tokenisers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
