"""Byte-level BPE through a sentencepiece model that is serialised straight from a rank file.

`model_bytes` writes the protocol buffer of a BPE model by hand: one piece per token, its bytes mapped one to one to
the characters U+0100 to U+01FF, its score the negative rank, so that the best merge is the lowest rank; identity
normalisation, no dummy prefix, no white-space handling. Texts are cut into pre-tokens by the vocabulary's pattern, each
pre-token is encoded by itself (distinct ones once per worker while they fit the cache), and a pre-token that is itself in
the vocabulary is its token. Decoding maps the pieces' characters back to bytes.

Work runs in Arrow batches where the rows are; nothing is shuffled. Memory is bounded by the batch, the longest text
and the cache.

Null texts count as empty: no ids. Ids of documents may be null or repeat; each row has its result.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crivo.llm.base import col, held, ship

#: Pre-tokens that a worker remembers, and how many are encoded at a time.
REMEMBERED, AT_ONCE = 300_000, 200_000
#: First of the 256 characters that stand for bytes.
BASE = 0x100
# Fixed values of the sentencepiece model format.
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def ranks_of(lines: Iterable[bytes]) -> list[bytes]:
    """Tokens by rank, from lines of a base64 token and its rank. Ranks run from 0 without gaps."""
    tokens: dict[int, bytes] = {}
    for line in lines:
        if line.strip():
            token, rank = line.split()
            tokens[int(rank)] = base64.b64decode(token)
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[i] for i in range(len(tokens))]


def read_ranks(path: str) -> list[bytes]:
    with open(path, "rb") as lines:
        return ranks_of(lines)


def as_characters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHARACTERS)


def as_bytes(characters: str) -> bytes:
    return bytes(ord(c) - BASE for c in characters)


_TO_CHARACTERS = {b: BASE + b for b in range(256)}


def _varint(number: int) -> bytes:
    number &= (1 << 64) - 1
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    out.append(number)
    return bytes(out)


def _whole(field: int, number: int) -> bytes:
    return _varint(field << 3) + _varint(number)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def _piece(text: str, score: float, kind: int) -> bytes:
    body = _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _block(1, body + _whole(3, kind))


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose ids are the ranks; the id after the last is its unknown piece."""
    pieces = [_piece(as_characters(t), float(-rank), _NORMAL) for rank, t in enumerate(tokens)]
    pieces.append(_piece("<unknown>", 0.0, _UNKNOWN))
    trainer = _whole(3, _BPE) + _whole(4, len(pieces)) + _whole(40, len(tokens)) + _whole(41, -1) + _whole(42, -1)
    trainer += _whole(43, -1) + _block(45, b"<unknown>")
    normaliser = _block(1, b"identity") + _whole(3, 0) + _whole(4, 0) + _whole(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normaliser)


class Codec:
    """Encodes and decodes whole texts with one model and one pattern."""

    def __init__(self, model: bytes, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.unknown = self.pieces.unk_id()
        self.bytes_of = [as_bytes(self.pieces.id_to_piece(i)) for i in range(self.unknown)]
        self.ids_of = {raw: struct.pack("<I", i) for i, raw in enumerate(self.bytes_of)}
        self.known: dict[str, bytes] = {}

    def _learn(self, pretokens: Iterable[str]) -> None:
        new = list(set(pretokens).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(set(pretokens))
        raws = [p.encode() for p in new]
        hard = [(p, raw) for p, raw in zip(new, raws, strict=True) if raw not in self.ids_of]
        self.known.update((p, self.ids_of[raw]) for p, raw in zip(new, raws, strict=True) if raw in self.ids_of)
        encoded = self.pieces.encode([as_characters(raw) for _, raw in hard], num_threads=1) if hard else []
        for (pretoken, _), ids in zip(hard, encoded, strict=True):
            self.known[pretoken] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit integers."""
        if len(text) <= AT_ONCE:
            return self._joined(self.pattern.findall(text))
        found = (m.group() for m in self.pattern.finditer(text))
        return b"".join(map(self._joined, iter(lambda: list(itertools.islice(found, AT_ONCE)), [])))

    def _joined(self, pretokens: list[str]) -> bytes:
        self._learn(pretokens)
        return b"".join(map(self.known.__getitem__, pretokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(model: bytes, pattern: str) -> Codec:
    """The worker's codec for this model; workers outlive tasks."""
    key = hashlib.sha256(model + pattern.encode()).digest()
    return held(("bpe", key), lambda: Codec(model, pattern))


def _over_texts(docs: DataFrame, columns: list[str], text: str, fields: list, per_text, tokens: list[bytes], pattern: str):
    """`columns` of docs and what `per_text(codec, text)` says of each whole text, a value per field."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(model_bytes(tokens))  # as large as the vocabulary
    kept = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)], col(text).alias("text"))
    shape = T.StructType(
        [T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(kept.schema.fields[:-1])]
        + [T.StructField(n, t, True) for n, t, _ in fields]
    )
    names = [f.name for f in shape.fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = codec(model.value, pattern)
        for batch in batches:
            done = [per_text(using, t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
            values = [pa.array([row[i] for row in done], kind) for i, (_, _, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], names)

    out = kept.mapInArrow(read, shape)
    return out.select(*[col(f"c{i}").alias(c) for i, c in enumerate(columns)], *[n for n, _, _ in fields])


def _ids(using: Codec, text: str) -> tuple:
    return (np.frombuffer(using.encode(text), "<u4"),)


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, columns: list[str], text: str = "text") -> DataFrame:
    """`columns` of docs and the `ids` array of each whole text."""
    fields = [("ids", T.ArrayType(T.LongType()), pa.list_(pa.int64()))]
    return _over_texts(docs, columns, text, fields, _ids, tokens, pattern)


def _digests(using: Codec, text: str) -> tuple:
    ids = using.encode(text)
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(using.decode(ids)).hexdigest()


def round_trip(docs: DataFrame, tokens: list[bytes], pattern: str, columns: list[str], text: str = "text") -> DataFrame:
    """`columns` of docs and n_tokens, ids_sha256 and decoded_sha256: texts are encoded, then their ids decoded."""
    fields = [
        ("n_tokens", T.LongType(), pa.int64()),
        ("ids_sha256", T.StringType(), pa.string()),
        ("decoded_sha256", T.StringType(), pa.string()),
    ]
    return _over_texts(docs, columns, text, fields, _digests, tokens, pattern)
