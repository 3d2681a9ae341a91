"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocktide.llm.bytebpe import decode_ids, encode_texts, token_count
from blocktide.llm.collocations import collocations
from blocktide.llm.common import documents
from blocktide.llm.decontamination import contamination
from blocktide.llm.jaccard import similar_documents
from blocktide.llm.language import identify_language
from blocktide.llm.licences import scan_licences
from blocktide.llm.neighbours import nearest
from blocktide.llm.packing import Limits, byte_bpe, pack
from blocktide.llm.periodic import densest, periodic_runs, words_of
from blocktide.llm.pii import KINDS, detect_pii, spans_text
from blocktide.llm.preference import cut_answers, preference_turns
from blocktide.llm.sharding import shard_documents
from blocktide.llm.substrings import remove_repeats

SHARDS = 40


def in_fold(remainder: int) -> Column:
    """Whether the checksum of the id, as text, leaves ``remainder`` modulo 4."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == remainder


def training_rows() -> Column:
    return F.col("doc_id").isNotNull() & ~in_fold(2)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(documents(spark, sf_dir), keep=("doc_id",))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return preference_turns(*cut_answers(turns))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), SHARDS)


def gpt_ids():
    """The tokeniser of the packing query, made once in each task."""
    import public_tokenizers

    return byte_bpe(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), gpt_ids, Limits())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(documents(spark, sf_dir), training_rows(), keep=("doc_id",))
    held_out = F.coalesce(in_fold(2), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(documents(spark, sf_dir))
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        # A string of bytes may end inside a character; what is left of one becomes U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        # A passage of 50 words may have fewer than 400 bytes: it is told of, not removed.
        "n_repeated_words",
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 100 == 0)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_texts(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return decode_ids(encoded, ranks).select(
        "doc_id",
        token_count("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_repeated_tails(words: Column) -> Column:
    """``words``, with a tail of every tenth document (by its checksum) made periodic.

    From word a on, word i becomes word a + (i - a) % p; a and p follow from the checksum.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = g % n
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.slice(words, (a + 1).cast("int"), p)
    tail = F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int")))
    whole = F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), whole).otherwise(words)


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", words_of(F.col("text")).alias("words"))
    found = periodic_runs(docs, with_repeated_tails(F.col("words")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.transform(line, lambda x: F.concat(x, F.lit("\n")))
    best = densest(F.col("runs"))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(ended, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_pii": op1_pii,
    "op2_preference": op2_preference,
    "op3_sharding": op3_sharding,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_licences": op6_licences,
    "op7_substrings": op7_substrings,
    "op8_jaccard": op8_jaccard,
    "op9_decontamination": op9_decontamination,
    "op10_neighbours": op10_neighbours,
    "op11_collocations": op11_collocations,
    "op12_bytebpe": op12_bytebpe,
    "op13_periodic": op13_periodic,
}
