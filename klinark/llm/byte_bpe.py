"""Byte-level BPE: a rank file becomes a sentencepiece model; encoding and decoding as Spark columns."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klinark.llm.shared import slices

REMEMBERED = 150_000  # pre-tokens whose ids a worker keeps

# Fixed values of the sentencepiece model format: field numbers, piece types, model type.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
BPE = 2


def byte_letters() -> list[str]:
    """One printable letter per byte: printable Latin-1 bytes stand for themselves, others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of `base64 rank` lines; ranks have no gap."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[k] for k in range(len(ranks))]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer: a number, a 32-bit float or bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose ids are the ranks.

    The piece of a token is its bytes as letters, its score the negative rank, so the best
    merge is the one of lowest rank. Text is not normalised. The unknown piece comes last and
    never occurs, since each single byte is a token.
    """
    letters = byte_letters()
    pieces = b"".join(
        _field(PIECES, _field(1, "".join(letters[b] for b in token).encode()) + _field(2, -float(rank))
               + _field(3, NORMAL)) for rank, token in enumerate(tokens))
    unknown = _field(PIECES, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))
    trainer = _field(3, BPE) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    plain = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + unknown + _field(TRAINER, trainer) + _field(NORMALIZER, plain)


class Codec:
    """Encoder and decoder of one worker, made from the tokens and the pre-token pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.split = regex.compile(pattern).findall
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.whole = {token: rank for rank, token in enumerate(tokens)}
        self.known: dict[str, tuple[int, ...]] = {}
        self.model = None
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.length, self.place = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _learn(self, pieces: set[str]) -> None:
        """Ids of new pre-tokens: a pre-token that is a token has its rank, others are merged."""
        if self.model is None:
            self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        rest = []
        for piece in pieces:
            rank = self.whole.get(piece.encode())
            if rank is None:
                rest.append(piece)
            else:
                self.known[piece] = (rank,)
        as_letters = [piece.encode().decode("latin-1").translate(self.letters) for piece in rest]
        for piece, ids in zip(rest, self.model.encode(as_letters, num_threads=1)):
            self.known[piece] = tuple(ids)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        for text in texts:
            pieces = self.split(text or "")
            new = set(pieces).difference(self.known)
            if new:
                if len(self.known) + len(new) > REMEMBERED:
                    self.known = {}
                    new = set(pieces)
                self._learn(new)
            out.append(np.fromiter(chain.from_iterable(map(self.known.__getitem__, pieces)), np.int32))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: each one's bytes are copied from the table of all tokens."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.place[ids] - ends + lengths, lengths) + np.arange(total)].tobytes()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _shared(df: DataFrame, tokens: list[bytes], pattern: str):
    return df.sparkSession.sparkContext.broadcast((tokens, pattern))


def _free(df: DataFrame, name: str) -> list[str]:
    return [c for c in df.columns if c.lower() != name.lower()]


def encode(df: DataFrame, tokens: list[bytes], pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the token ids of each whole text (array of int, empty for a null or empty text).

    A column already called `name` is replaced. The vocabulary is broadcast: its size does not
    depend on the data.
    """
    shared, kept = _shared(df, tokens, pattern), _free(df, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            rows = batch.select(kept)
            ids = _lists(codec.encode(batch["_text"].to_pylist()))
            yield pa.record_batch([*rows.columns, ids], names=[*kept, name])

    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [f"`{name}` array<int>"])
    return df.withColumn("_text", F.col(text).cast("string")).mapInArrow(run, kind)


def decode(df: DataFrame, tokens: list[bytes], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that the token ids stand for; null ids give empty bytes."""
    shared, kept = _shared(df, tokens, ""), _free(df, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            rows = batch.select(kept)
            lists = batch[ids]
            out = [codec.decode(x.values.to_numpy(zero_copy_only=False).astype(np.int64)) if x.is_valid else b""
                   for x in lists]
            yield pa.record_batch([*rows.columns, pa.array(out, pa.binary())], names=[*kept, name])

    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [f"`{name}` binary"])
    return df.mapInArrow(run, kind)


def round_trip(docs: DataFrame, tokens: list[bytes], pattern: str, doc_id: str = "doc_id",
               text: str = "text", copies: str | None = None) -> DataFrame:
    """Encode every document, decode the ids, and give digests of both.

    Returns (doc_id, n_tokens, ids_sha256, decoded_sha256), as often as the column `copies` says, once without it. A null text counts as empty: no
    token, the digests of nothing. Repeated rows and null ids each give their row; other
    columns are ignored.
    """
    often = F.lit(1) if copies is None else F.col(copies)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       often.cast("long").alias("copies"))
    shared = _shared(docs, tokens, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in slices(batches, 500):
            ids = codec.encode(batch["text"].to_pylist())
            decoded = [codec.decode(own) for own in ids]
            yield pa.record_batch([batch["doc_id"], batch["copies"], _lists(ids), pa.array(decoded, pa.binary())],
                                  names=["doc_id", "copies", "ids", "decoded"])

    # one Python worker per task does both ways
    both = rows.mapInArrow(run, "doc_id long, copies long, ids array<int>, decoded binary")
    digests = both.select(
        "doc_id", "copies", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
    if copies is None:
        return digests.drop("copies")
    return digests.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
