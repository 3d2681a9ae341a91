import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from blocktide.llm.bytebpe import Codec, decode_ids, encode_texts, read_ranks, serialise, token_count
from blocktide.llm.queries import QUERIES
from tests.llm.cases import LONG, ODD_ROWS, SMALL, documents, no_documents, odd_documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return Codec(serialise(read_ranks(RANKS)), PATTERN)


def test_mixed_scripts(library, codec):
    rng = random.Random(1)
    pool = ["a", "b", "th", "é", "ß", "中", "文", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "1", "²", "!", "'ll",
            "'s", "😀", "\x00", "ת", "ا", "́", "<|endoftext|>", "▁", "<unk>", "𝔸", "﻿"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_every_token_by_itself(library, codec):
    words = [t.decode() for t in codec.tokens if t.decode("utf-8", "ignore").encode() == t]
    for word, ids in zip(words, codec.encode(words)):
        assert ids.tolist() == library.encode_ordinary(word), word


def test_very_long_texts(library, codec):
    for text in ("a" * 300_000, "é" * 200_000, "ab cd " * 100_000, " " * 300_000, "\n \n" * 50_000, "中" * 50_000):
        (ids,) = codec.encode([text])
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    assert not [t for t in codec.known if len(t) > 64]


def test_memory_is_emptied(library, codec, monkeypatch):
    from blocktide.llm import bytebpe

    monkeypatch.setattr(bytebpe, "REMEMBERED", 10)
    texts = [f"word{i} other{i * 7}" for i in range(200)]
    for k in range(0, 200, 20):
        for text, ids in zip(texts[k : k + 20], codec.encode(texts[k : k + 20])):
            assert ids.tolist() == library.encode_ordinary(text)


def test_tokens_that_no_merge_reaches():
    """A token is met whole even if its parts are no tokens; ranks need no merge path."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abcd": 256, b"xy": 257}
    ours = Codec(serialise(ranks), PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcd xy", "abcde", "xabcd", "xyxy abcd"):
        assert ours.encode([text])[0].tolist() == theirs.encode_ordinary(text), text


def test_ranks_are_checked():
    with pytest.raises(ValueError):
        serialise({bytes([b]): b + 1 for b in range(256)})
    with pytest.raises(ValueError):
        serialise({bytes([b]): b for b in range(255)})


def test_query_equals_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op12_bytebpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, library):
    encoded = encode_texts(odd_documents(spark), RANKS, PATTERN, keep=("doc_id", "text", "name"))
    rows = decode_ids(encoded, RANKS, keep=("doc_id", "text", "ids")).withColumn("n", token_count("ids")).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert (r.n, bytes(r.decoded)) == (len(r.ids) // 4, (r.text or "").encode())
    assert any(r.text == LONG for r in rows)
    assert encode_texts(no_documents(spark), RANKS, PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert [bytes(r.decoded) for r in decode_ids(nothing, RANKS).collect()] == [b""]
    same = documents(spark, ["twice", "twice"])
    assert encode_texts(same, RANKS, PATTERN).select("ids").distinct().count() == 1
