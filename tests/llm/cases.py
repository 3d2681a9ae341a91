"""Small tables that every operator has to survive."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i} {'abcdefghij'[i % 10] * (i % 7 + 1)}" for i in range(30_000))
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (2, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (2, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, "12345 !!!", None, "b", 9),
    (6, LONG, "en", "b", len(LONG)),
    (7, "Être ou ne pas être, ñandú Ünïcödé 😀 mail me@site.example.org", "fr", None, 60),
    (None, "a row without a name of any kind at all", "en", "b", 39),
    (8, "One.", None, "b", 4),
]


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeats, and names that clash."""
    df = spark.createDataFrame(ODD_ROWS, DOCS)
    for name in ("_id", "_text", "_name", "row", "slot", "shard", "spans", "score", "name", "n", "part"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, texts):
    rows = [(i, t, None, None, len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


__all__ = ["DOCS", "LONG", "ODD_ROWS", "SMALL", "by_id", "documents", "no_documents", "odd_documents"]
