"""Vector bin packing of tokenised examples into sequences.

A sequence has three limits: tokens, segments and loss-bearing tokens. Examples
too long for one sequence are cut; what is left of each is placed by the
dot-product heuristic: into the open sequence goes the piece whose demand has
the largest dot product with the capacity that remains. Each task packs what it
reads, in blocks of bounded size, so nothing is shuffled.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocktide.llm.common import batches_of, sliced

#: A text becomes its token ids (uint32) and how many of them bear loss, from the end.
Tokenise = Callable[[list[str]], list[np.ndarray]]


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 512
    loss: int = 1024


@dataclass
class Piece:
    row: int  # number of the example among those read by the task
    start: int
    ids: np.ndarray
    loss: int


def place(demands: np.ndarray, limits: Limits, cut_below: int = 0) -> list[list[tuple[int, int]]]:
    """Sequences as lists of (item, tokens used) for ``demands`` (tokens, loss) of items.

    Equal demands are one kind with a stock, so a step looks at the kinds only.
    Where no item fits and at least ``cut_below`` tokens are free (0: never), the
    item of the largest product is cut to fill them; its rest stays in stock.
    """
    stock: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for i in range(len(demands) - 1, -1, -1):
        stock[tuple(int(x) for x in demands[i])].append((i, 0))
    kinds = sorted(stock, reverse=True)
    table = np.array(kinds, np.int64).reshape(-1, 2)
    alive = np.array([len(stock[k]) for k in kinds], np.int64)
    scale = np.array([limits.tokens, limits.loss], float)
    index = {k: n for n, k in enumerate(kinds)}
    sequences = []
    left = len(demands)
    while left:
        free = np.array([limits.tokens, limits.loss], np.int64)
        segments = limits.segments
        sequence: list[tuple[int, int]] = []
        while segments and left and free[0]:
            room = free / scale
            worth = (table / scale) @ room + segments / limits.segments**2
            fits = (alive > 0) & (table <= free).all(axis=1)
            if fits.any():
                k = int(np.where(fits, worth, -1.0).argmax())
                item, _ = stock[kinds[k]].pop()
                alive[k] -= 1
                left -= 1
                sequence.append((item, kinds[k][0]))
                free -= table[k]
                segments -= 1
                continue
            room_now = int(min(free))
            if not cut_below or room_now < cut_below:
                break
            k = int(np.where(alive > 0, worth, -1.0).argmax())
            item, _ = stock[kinds[k]].pop()
            alive[k] -= 1
            sequence.append((item, room_now))
            length = kinds[k][0] - room_now
            rest = (length, min(length, kinds[k][1]))  # the end of an example bears the loss
            if rest not in index:
                index[rest] = len(kinds)
                kinds.append(rest)
                table = np.vstack((table, [rest]))
                alive = np.append(alive, 0)
            stock[rest].append((item, 0))
            alive[index[rest]] += 1
            break
        sequences.append(sequence)
    return sequences


def added_tokens(vocabulary: str) -> dict[str, int]:
    """Strings that a vocabulary's JSON file gives an id of their own, wherever they stand."""
    with open(vocabulary, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token with conditions on its surroundings: {token}")
    return {token["content"]: token["id"] for token in added}


def byte_bpe(ranks: str, vocabulary: str, end_id: int = 0) -> Tokenise:
    """Ids of a byte-level BPE vocabulary given as a rank file, then ``end_id``.

    The ids are those of the same vocabulary's JSON file, ``vocabulary``, whose
    added tokens keep their own ids inside a text too.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as file:
        pairs = (line.split() for line in file)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    encoding = tiktoken.Encoding(
        "byte_bpe",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=table,
        special_tokens=added_tokens(vocabulary),
    )

    def tokenise(texts: list[str]) -> list[np.ndarray]:
        end = np.array([end_id], np.uint32)
        out = []
        for text in texts:
            ids = encoding.encode_to_numpy(text, allowed_special="all")
            out.append(np.concatenate((ids.astype(np.uint32, copy=False), end)))
        return out

    return tokenise


PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def pack(
    docs: DataFrame,
    tokeniser: Callable[[], Tokenise],
    limits: Limits = Limits(),
    id_column: str = "doc_id",
    text_column: str = "text",
    loss_share: float = 1.0,
    cut_below: int = 16,
    block: int = 8192,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all rows of ``docs`` and their places in sequences.

    ``tokeniser()`` is called once in each task. The last ``loss_share`` of an
    example's tokens bears loss. Full sequences are cut from the front of a long
    example; the remainder is packed with others, ``block`` at a time, and the
    last, unfilled sequence of a block is opened again in the next one. With
    ``with_ids`` the token ids follow as a column ``ids``.

    A null text is empty and gives the end token only. Repeated rows are packed
    each for itself; an empty table gives no rows; other columns are ignored.
    ``sequence_id`` is unique but has gaps.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = PIECES.format(id=kind) + (", ids array<int>" if with_ids else "")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenise = tokeniser()
        next_id = TaskContext.get().partitionId() << 40
        names: dict[int, tuple[object, int]] = {}
        waiting: list[Piece] = []
        out: dict[str, list] = defaultdict(list)
        row = 0

        def emit(piece: Piece, sequence: int, offset: int) -> None:
            name, total = names[piece.row]
            values = (
                name, piece.start, len(piece.ids), zlib.crc32(piece.ids.astype("<u4").tobytes()),
                total, sequence, offset,
            )
            for column, value in zip(columns, values):
                out[column].append(value)
            if with_ids:
                out["ids"].append(piece.ids.astype(np.int32))

        def flush() -> pa.RecordBatch:
            types = [arrow_id, *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]
            arrays = [pa.array(out[c], t) for c, t in zip(all_columns, types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=all_columns)

        def pack_block(last: bool) -> None:
            nonlocal next_id, waiting
            demands = np.array([(len(p.ids), p.loss) for p in waiting], np.int64).reshape(-1, 2)
            placed = place(demands, limits, cut_below)
            used = np.zeros(len(waiting), np.int64)
            again: list[Piece] = []
            for n, sequence in enumerate(placed):
                full = last or n < len(placed) - 1
                offset = 0
                for item, length in sequence:
                    piece, at = waiting[item], int(used[item])
                    part = Piece(
                        piece.row, piece.start + at, piece.ids[at : at + length],
                        max(0, min(length, piece.loss - (len(piece.ids) - at - length))),
                    )
                    used[item] += length
                    if full:
                        emit(part, next_id, offset)
                        offset += length
                    else:
                        again.append(part)
                next_id += full
            waiting = again
            kept = {p.row for p in waiting}
            for r in [r for r in names if r not in kept]:
                del names[r]

        arrow_id = None
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        all_columns = [*columns, *["ids"] * with_ids]
        step = max(1, min(limits.tokens, limits.loss))
        for part in sliced(parts):
            arrow_id = part.schema.field(0).type
            ids_of, texts = part.column(0).to_pylist(), part.column(1)
            texts = [t or "" for t in texts.to_pylist()]
            for some in batches_of(texts, 2_000_000):
                for name, ids in zip(ids_of[some], tokenise(texts[some])):
                    names[row] = (name, len(ids))
                    bearing = len(ids) - int(round(loss_share * len(ids)))
                    at = 0
                    while len(ids) - at >= step:
                        loss = max(0, min(step, at + step - bearing))
                        emit(Piece(row, at, ids[at : at + step], loss), next_id, 0)
                        next_id += 1
                        at += step
                    if at < len(ids):
                        loss = min(len(ids) - at, len(ids) - bearing)
                        waiting.append(Piece(row, at, ids[at:].copy(), loss))
                    row += 1
                    if len(waiting) >= block:
                        pack_block(last=False)
                if len(out["doc_id"]) >= 4096:
                    yield flush()
        if waiting:
            pack_block(last=True)
        if out["doc_id"]:
            yield flush()

    return rows.mapInArrow(run, schema)
