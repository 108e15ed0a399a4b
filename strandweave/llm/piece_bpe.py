"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank vocabulary."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from strandweave.llm.chunks import ChunkEncoder, byte_letters


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int) -> bytes:
    """A protobuf field: length-delimited bytes or a varint."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model: piece i is the token of rank i in byte letters with score -i; identity normalisation.

    The unknown piece that the format asks for follows the vocabulary and is never produced, since every byte has a
    piece of its own.
    """
    letters = byte_letters()
    by_rank = {rank: token for token, rank in ranks.items()}
    size = max(by_rank) + 1 if by_rank else 0
    normal, unknown, unused, bpe = 1, 2, 5, 2
    out = bytearray()
    for rank in range(size):
        token = by_rank.get(rank)
        name = "".join(letters[b] for b in token) if token is not None else f"<unused {rank}>"
        piece = _field(1, name.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -rank)
        out += _field(1, piece + _field(3, normal if token is not None else unused))
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0) + _field(3, unknown))
    out += _field(2, _field(3, bpe) + _field(4, size + 1) + _field(40, size))
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class PieceCodec:
    """Encoder and decoder of one vocabulary file; ``pattern`` cuts a text into pre-tokens."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.whole = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        tokens = {rank: token for token, rank in ranks.items()}
        self.inverse = pa.array([tokens.get(rank) for rank in range(max(tokens) + 1)], pa.large_binary())
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(ranks))
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.split = regex.compile(pattern).findall
        # shorter runs and memories than by default: a worker keeps what it met through all its tasks
        self.encoder = ChunkEncoder(self._whole, self._pieces, self.split, limit=400_000, at_once=4_000_000)

    def _pieces(self, pres: list[str]) -> list[bytes]:
        """Each pre-token separately, as bytes in Latin-1; one that is a token is not merged again."""
        raw = [pre.encode().decode("latin-1") for pre in pres]
        unseen = [pre for pre in raw if pre not in self.whole]
        merged = iter(self.model.encode([pre.translate(self.letters) for pre in unseen], num_threads=1)) if unseen else iter(())
        return [np.array((self.whole[pre],) if pre in self.whole else next(merged), dtype="<u4").tobytes() for pre in raw]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = [self.split(text) for text in texts]
        pres = list({pre for own in found for pre in own})
        ids = dict(zip(pres, self._pieces(pres), strict=True))
        return [b"".join([ids[pre] for pre in own]) for own in found]

    def encode(self, texts: pa.Array) -> Iterator[memoryview]:
        """Little-endian unsigned 32-bit ids of each text."""
        return self.encoder.ids(texts)

    def decode(self, ids: bytes | memoryview) -> bytes:
        tokens = self.inverse.take(pa.array(np.frombuffer(ids, "<u4")))
        end, data = int(np.frombuffer(tokens.buffers()[1], np.int64)[len(tokens)]) if len(ids) else 0, tokens.buffers()[2]
        return data[:end].to_pybytes() if end else b""


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> PieceCodec:
    """One for each Python worker."""
    return PieceCodec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, ids binary, decoded binary)``: ids as little-endian unsigned 32-bit integers and the bytes they decode to.

    A null text counts as empty and gives no ids; every other text is encoded whole. Repeated rows give repeated rows;
    other columns are not read. One map over the rows, no shuffle; ``path`` must exist on every machine.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                ids = [bytes(x) for x in own.encode(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([own.decode(x) for x in ids], pa.binary())], [id_col, "ids", "decoded"])

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(work, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, ids binary, decoded binary")


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document ``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of what ``encode_documents`` gives for it.

    The digests are taken in the same Python pass, so that ids need not travel back to the JVM.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            n, first, second = [], [], []
            for ids in own.encode(batch.column(1)):
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
