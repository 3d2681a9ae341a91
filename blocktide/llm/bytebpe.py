"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is serialised from the rank file alone: each token becomes a piece in
which every byte is one printable character, scored by its negative rank, under
identity normalisation. Merging the pair of the best score is then merging the
pair of the lowest rank. Texts are split by the vocabulary's pattern first and
every pre-token is encoded by itself; ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocktide.llm.common import batches_of, sliced, text_or_empty

#: Pre-tokens remembered by a task, at most; a full memory is emptied.
REMEMBERED = 500_000
#: Characters of longer pre-tokens are not remembered.
LONGEST_REMEMBERED = 64
#: Characters that are cut into pre-tokens at a time; a longer text is a slice of its own.
SLICE_CHARS = 1_000_000


def byte_characters() -> list[str]:
    """A character that is neither space nor control for each byte.

    Bytes that are printable in Latin-1 stand for themselves, the others follow
    from 256 on, in order.
    """
    out, following = [], 256
    for byte in range(256):
        char = chr(byte)
        if char.isprintable() and not char.isspace():
            out.append(char)
        else:
            out.append(chr(following))
            following += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64, a space, and the rank in each line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def serialise(ranks: Mapping[bytes, int]) -> bytes:
    """A sentencepiece BPE model with the given tokens; the ids of pieces are the ranks.

    Ranks must be 0, 1, ... without a gap and every single byte a token. The
    piece for the unknown, which the format asks for, comes last and is never met.
    """
    from sentencepiece import sentencepiece_model_pb2 as format_of

    ordered = sorted(ranks, key=ranks.__getitem__)
    if [ranks[token] for token in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0, 1, ... without gaps")
    if not all(bytes([byte]) in ranks for byte in range(256)):
        raise ValueError("every single byte must be a token")
    characters = byte_characters()
    model = format_of.ModelProto()
    for rank, token in enumerate(ordered):
        model.pieces.add(piece="".join(characters[b] for b in token), score=-float(rank))
    unknown = format_of.ModelProto.SentencePiece.UNKNOWN
    model.pieces.add(piece="<unk>", score=0.0, type=unknown)
    trainer = model.trainer_spec
    trainer.model_type = format_of.TrainerSpec.BPE
    trainer.vocab_size = len(ordered) + 1
    trainer.unk_id = len(ordered)
    trainer.bos_id = trainer.eos_id = trainer.pad_id = -1
    normaliser = model.normalizer_spec
    normaliser.name = "identity"
    normaliser.add_dummy_prefix = False
    normaliser.remove_extra_whitespaces = False
    normaliser.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes with a serialised model; made once in each task."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        characters = byte_characters()
        self.to_piece = str.maketrans({chr(b): c for b, c in enumerate(characters)})
        from_piece = {c: b for b, c in enumerate(characters)}
        size = self.processor.vocab_size() - 1
        pieces = self.processor.id_to_piece(list(range(size)))
        self.tokens = [bytes(map(from_piece.__getitem__, piece)) for piece in pieces]
        # A pre-token that is a token is that token, even where no merges lead to it.
        merged = self.processor.encode(pieces, out_type=int, num_threads=1)
        self.unmerged = {p: [i] for i, (p, ids) in enumerate(zip(pieces, merged)) if ids != [i]}
        self.known: dict[str, list[int]] = {}

    def _learn(self, fresh: list[str]) -> dict[str, list[int]]:
        pieces = [f.encode("utf-8").decode("latin-1").translate(self.to_piece) for f in fresh]
        found = self.processor.encode(pieces, out_type=int, num_threads=1)
        if self.unmerged:
            found = [self.unmerged.get(p, ids) for p, ids in zip(pieces, found)]
        return dict(zip(fresh, found))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        fresh = self._learn(list({t for tokens in split for t in tokens if t not in known}))
        known.update((t, ids) for t, ids in fresh.items() if len(t) <= LONGEST_REMEMBERED)
        ids_of = known.get  # no pre-token is empty, so neither are its ids
        return [np.array([i for t in tokens for i in ids_of(t) or fresh[t]], "<u4") for tokens in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _with_column(part: pa.RecordBatch, values: list[bytes], name: str) -> pa.RecordBatch:
    kept = [part.column(k) for k in range(part.num_columns - 1)]
    names = part.schema.names[: len(kept)]
    return pa.RecordBatch.from_arrays([*kept, pa.array(values, pa.binary())], names=[*names, name])


def _mapped(rows: DataFrame, name: str, model: bytes, pattern: str, work) -> DataFrame:
    """``rows`` with the last column replaced by the binary column ``name``."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model, pattern)
        for part in sliced(parts):
            yield _with_column(part, work(codec, part.column(part.num_columns - 1)), name)

    return rows.mapInArrow(run, ", ".join([*fields, f"{name} binary"]))


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    keep: tuple[str, ...] = ("doc_id",),
    text_column: str = "text",
) -> DataFrame:
    """Token ids of every row: the columns ``keep`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers in a row, the form in which
    token shards are stored (``token_count`` counts them). The rank file is read by the driver; tasks get the serialised model, whose size is that
    of the vocabulary. Nothing is shuffled.

    A null text is empty and has no ids. Repeated rows are encoded each for
    itself, there are no ties; an empty table gives no rows; other columns than
    ``keep`` are ignored, whatever their names. Special tokens are ordinary text.
    """
    model = serialise(read_ranks(ranks_path))
    rows = docs.select(*[F.col(c) for c in keep], text_or_empty(text_column).alias("_in"))

    def work(codec: Codec, column: pa.Array) -> list[bytes]:
        texts = column.to_pylist()
        out: list[bytes] = []
        for some in batches_of(texts, SLICE_CHARS):
            out.extend(ids.tobytes() for ids in codec.encode(texts[some]))
        return out

    return _mapped(rows, "ids", model, pattern, work)


def decode_ids(
    encoded: DataFrame,
    ranks_path: str,
    keep: tuple[str, ...] = ("doc_id", "ids"),
    ids_column: str = "ids",
) -> DataFrame:
    """The bytes that ids stand for: the columns ``keep`` and ``decoded``.

    Null ids give empty bytes; an id outside the vocabulary is an error.
    """
    model = serialise(read_ranks(ranks_path))
    ids = F.coalesce(F.col(ids_column), F.lit(b""))
    rows = encoded.select(*[F.col(c) for c in keep], ids.alias("_in"))

    def work(codec: Codec, column: pa.Array) -> list[bytes]:
        return [codec.decode(np.frombuffer(v.as_buffer(), "<u4")) for v in column]

    return _mapped(rows, "decoded", model, "", work)


def token_count(ids: str = "ids"):
    """How many ids a binary column of ``encode_texts`` holds."""
    return F.shiftright(F.octet_length(F.col(ids)), 2).cast("long")
