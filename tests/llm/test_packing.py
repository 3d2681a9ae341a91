import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blocktide.llm.packing import Limits, pack, place
from blocktide.llm.queries import gpt_ids
from tests.llm.cases import ODD_ROWS, SMALL, documents, no_documents, odd_documents


def whole(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_round_trip_with_the_tokeniser(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tokeniser = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {i: [*tokeniser.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack(docs.repartition(3), gpt_ids, with_ids=True).collect():
        assert r.ids_crc32 == whole(r.ids) and r.length == len(r.ids) and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, ids in want.items():
        assert sum((p for _, p in sorted(pieces[i])), []) == ids
    padded = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
        padded += 1024 - at
    assert padded < 0.02 * sum(map(len, want.values())) + 3 * 1024


@pytest.mark.parametrize("cut_below", [0, 8])
def test_limits_hold_together(cut_below):
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 101, 500)
    loss = (tokens * rng.random(500)).astype(int)
    limits = Limits(tokens=100, segments=4, loss=60)
    demands = np.stack((tokens, np.minimum(loss, 60)), 1)
    placed = place(demands, limits, cut_below)
    used = np.zeros(500, int)
    for sequence in placed:
        assert 0 < len(sequence) <= 4
        total = bearing = 0
        for item, length in sequence:
            at = used[item]
            end = at + length
            bearing += max(0, end - max(at, tokens[item] - demands[item, 1]))
            used[item] = end
            total += length
        assert total <= 100 and bearing <= 60
    assert (used == tokens).all()
    if not cut_below:
        assert sorted(i for s in placed for i, _ in s) == list(range(500))
    assert len(placed) <= 1.15 * max(tokens.sum() / 100, demands[:, 1].sum() / 60, 500 / 4)


def test_odd_rows(spark):
    rows = pack(odd_documents(spark), gpt_ids, Limits()).collect()
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.doc_id] += r.length
    assert set(tokens) == {r[0] for r in ODD_ROWS}
    assert tokens[3] == tokens[4] == 1
    assert tokens[2] == 2 * tokens[1]
    assert pack(no_documents(spark), gpt_ids).count() == 0


def test_small_blocks_and_masked_fronts(spark):
    docs = odd_documents(spark)
    limits = Limits(tokens=64, segments=3, loss=32)
    rows = pack(docs, gpt_ids, limits, loss_share=0.5, block=4).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    assert all(len(s) <= 3 and sum(r.length for r in s) <= 64 for s in sequences.values())
    total = sum(r.length for r in rows)
    assert total == sum(r.length for r in pack(docs, gpt_ids).collect())


def test_added_tokens_keep_their_ids(spark):
    end = "<|endoftext|>"
    texts = [
        end, end * 3, f"a {end} b", f"glued{end}to{end}letters", f"  {end} \n\n{end}\n ", f"<|endof{end}text|>",
        "<|endoftext|", "no such token",
    ]
    tokeniser = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tokeniser.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert want[0] == [50256, 0]
    rows = pack(documents(spark, texts), gpt_ids, with_ids=True, cut_below=0).collect()
    assert {r.doc_id: r.ids for r in rows} == want
    assert all(r.ids_crc32 == whole(r.ids) and r.doc_tokens == len(r.ids) for r in rows)
