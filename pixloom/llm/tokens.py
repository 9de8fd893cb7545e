"""Encoding of the whole corpus with a public byte-level BPE vocabulary (problem 7).

A sentencepiece BPE model is serialised straight from the vocabulary: every token becomes a
piece of byte-mapped characters (one printable character per byte) scored by its negative rank,
with identity normalisation and no dummy prefix. Merging the best-scored pair first is then
exactly rank order. Texts are cut into pre-tokens by the vocabulary's pattern, each pre-token is
byte-mapped and encoded as one piece sequence; decoding maps pieces back to bytes.

Plan. One scalar Arrow pass, no shuffle. A worker builds the model once and keeps a bounded memo
of pre-tokens, so the cost per word is a dictionary lookup.

Defined results: null and empty texts have the empty list of ids; strings of special tokens are
ordinary text; lone surrogates cannot occur in Spark strings; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import os
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixloom.session import spread, table

#: Folder of the public vocabularies.
TOKENIZERS = os.environ.get("PIXLOOM_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"
#: Pre-token pattern of the byte-level vocabularies (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Most pre-tokens a worker remembers.
MEMO = 400_000


def byte_alphabet() -> list[str]:
    """One printable character for each byte: itself where printable, else the next free one from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto: piece i is the token of rank i, the last piece is the unknown one."""
    alphabet = byte_alphabet()
    pieces = []
    for rank, token in enumerate(sorted(ranks, key=ranks.__getitem__)):
        if ranks[token] != rank:
            raise ValueError("ranks must be 0 .. n-1")
        text = "".join(alphabet[b] for b in token).encode()
        pieces.append(_field(1, _field(1, text) + _field(2, float(-rank)) + _field(3, 1)))
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    n = len(pieces)
    # trainer_spec: model_type BPE, vocabulary size, unk id, no bos, eos or pad
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, n) + _field(40, n - 1) + b"".join(_field(k, none) for k in (41, 42, 43))
    # normalizer_spec: identity, no dummy prefix, white space neither removed nor escaped
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*pieces, _field(2, trainer), _field(3, normalizer)])


class ByteBpe:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, path: str):
        import regex
        import sentencepiece

        ranks = load_ranks(path)
        self.alphabet = byte_alphabet()
        self.back = {ch: b for b, ch in enumerate(self.alphabet)}
        self.whole = {"".join(self.alphabet[b] for b in t): r for t, r in ranks.items()}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialize_model(ranks))
        self.split = regex.compile(PATTERN).findall
        self.memo: dict[str, list[int]] = {}

    def pre_token(self, text: str) -> list[int]:
        mapped = "".join(map(self.alphabet.__getitem__, text.encode()))
        rank = self.whole.get(mapped)
        return [rank] if rank is not None else self.model.encode(mapped)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        memo = self.memo
        for t in self.split(text):
            found = memo.get(t)
            if found is None:
                found = self.pre_token(t)
                if len(t) < 64 and len(memo) < MEMO:
                    memo[t] = found
            ids += found
        return ids

    def decode(self, ids) -> str:
        mapped = "".join(self.model.id_to_piece(int(i)) for i in ids)
        return bytes(self.back[ch] for ch in mapped).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(col: Column | str, vocabulary: str = BYTE_BPE_50K, folder: str = TOKENIZERS) -> Column:
    """Token ids of a text column as array<int>."""
    path = os.path.join(folder, vocabulary)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for s in batches:
            yield s.map(bpe.encode)

    return ids(col)


def decode(ids: Column | str, vocabulary: str = BYTE_BPE_50K, folder: str = TOKENIZERS) -> Column:
    """The text of a list of ids."""
    path = os.path.join(folder, vocabulary)

    @F.pandas_udf(T.StringType())
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for s in batches:
            yield s.map(bpe.decode)

    return text(ids)


def count_tokens(col: Column | str, vocabulary: str = BYTE_BPE_50K, folder: str = TOKENIZERS) -> Column:
    """Number of tokens of a text column, 0 for null; the ids never leave the worker."""
    path = os.path.join(folder, vocabulary)

    @F.pandas_udf(T.IntegerType())
    def n(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for s in batches:
            yield s.map(lambda t: len(bpe.encode(t))).astype("int32")

    return n(col)


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", encode("text").alias("ids"))


def p7_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every text encoded and decoded again (as a digest); a null text comes back empty."""
    ids = p7_ids(spark, sf)
    return ids.select("doc_id", F.md5(decode("ids")).alias("text"))


QUERIES = {"p7_ids": p7_ids, "p7_roundtrip": p7_roundtrip}
ORACLES = {"p7_roundtrip": "SELECT doc_id, md5(coalesce(text, '')) AS text FROM documents"}
