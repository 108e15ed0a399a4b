"""Token ids in wavelet-matrix shard files: succinct bit-planes that answer access, counting and occurrence lookup."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandweave.llm.chunks import ChunkEncoder, byte_letters
from strandweave.session import Cut, fresh_path

MAGIC = b"WMX2"
BLOCK = 512
#: Bytes of a bit-plane that are compressed together.
PAGE = 4096
MANIFEST = "path string, first_doc long, last_doc long, n_docs long, n_ids long"


class WaveletMatrix:
    """A sequence of n ids below 2**bits as one bit-plane per bit, the highest first, each stably parted by its bits.

    ``planes[level]`` holds little-endian packed bits, ``ranks[level]`` the ones before every block of 512 bits: arrays,
    or the compressed pages of a file. Everything below works on whole arrays of positions.
    """

    def __init__(self, n: int, bits: int, planes, ranks, zeros: np.ndarray):
        self.n, self.bits, self.planes, self.ranks, self.zeros = n, bits, planes, ranks, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        bits = max(1, int(ids.max()).bit_length()) if n else 1
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        width = -(-n // BLOCK) * BLOCK // 8
        planes = np.zeros((bits, width), np.uint8)
        zeros = np.zeros(bits, np.int64)
        for level in range(bits):
            one = (now & now.dtype.type(1 << (bits - 1 - level))) != 0
            packed = np.packbits(one, bitorder="little")
            planes[level, : len(packed)] = packed
            low, high = np.flatnonzero(~one), np.flatnonzero(one)
            zeros[level] = len(low)
            now = np.concatenate([now.take(low), now.take(high)])
        return cls(n, bits, planes, cls._ranks(planes), zeros)

    @staticmethod
    def _ranks(planes: np.ndarray) -> np.ndarray:
        bits, width = planes.shape
        ones = np.bitwise_count(planes).reshape(bits, width * 8 // BLOCK, BLOCK // 8).sum(axis=2, dtype=np.uint32)
        return np.concatenate([np.zeros((bits, 1), np.uint32), np.cumsum(ones, axis=1, dtype=np.uint32)], axis=1)

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position of a plane."""
        block = at // BLOCK
        out = self.ranks[level].take(block).astype(np.int64)
        plane, byte = self.planes[level], block * (BLOCK // 8)
        if not self.n:
            return out
        for _ in range(BLOCK // 8):
            left = at - byte * 8
            inside = left > 0
            if not inside.any():
                break
            value = plane.take(np.minimum(byte, (self.n - 1) // 8)) & ((1 << np.clip(left, 0, 8)) - 1).astype(np.uint8)
            out += np.where(inside, np.bitwise_count(value), 0)
            byte = byte + 1
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some positions."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            one = (self.planes[level].take(at // 8) >> (at % 8).astype(np.uint8)) & 1 == 1
            ones = self._rank1(level, at)
            out = out << 1 | one
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return out

    def _span(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among the first ``end`` ids stand after the last plane."""
        lo, hi = 0, end
        for level in range(self.bits):
            a, b = (int(x) for x in self._rank1(level, np.array([lo, hi], np.int64)))
            if token >> (self.bits - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` among the first ``end`` ids, all by default."""
        if not 0 <= token < 1 << self.bits:
            return 0
        lo, hi = self._span(token, self.n if end is None else min(end, self.n))
        return hi - lo

    def _select(self, level: int, one: bool, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) ones or zeros of a plane: search over blocks, then inside the block."""
        counts = self.ranks[level].astype(np.int64)
        if not one:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = np.searchsorted(counts, k, side="right") - 1
        span = self.planes[level].take(block[:, None] * (BLOCK // 8) + np.arange(BLOCK // 8))
        bits = np.unpackbits(span, axis=1, bitorder="little")
        inside = np.cumsum(bits if one else 1 - bits, axis=1)
        return block * BLOCK + (inside > (k - counts[block])[:, None]).argmax(axis=1)

    def occurrences(self, token: int, first: int = 0, most: int | None = None) -> np.ndarray:
        """Positions of ``token``, from its ``first``-th occurrence on, ``most`` of them."""
        if not 0 <= token < 1 << self.bits:
            return np.zeros(0, np.int64)
        lo, hi = self._span(token, self.n)
        at = np.arange(lo + first, hi if most is None else min(hi, lo + first + most), dtype=np.int64)
        for level in reversed(range(self.bits)):
            one = bool(token >> (self.bits - 1 - level) & 1)
            at = self._select(level, one, at - (int(self.zeros[level]) if one else 0))
        return at

    def all(self) -> np.ndarray:
        """The whole sequence, plane by plane from the lowest."""
        dtype = np.uint16 if self.bits <= 16 else np.uint32
        out = np.zeros(self.n, dtype)
        for level in reversed(range(self.bits)):
            one = np.unpackbits(np.asarray(self.planes[level]), count=self.n, bitorder="little").view(np.bool_)
            before, zeros = np.empty_like(out), int(self.zeros[level])
            before[np.flatnonzero(~one)] = out[:zeros]
            before[np.flatnonzero(one)] = out[zeros:] | dtype(1 << (self.bits - 1 - level))
            out = before
        return out


class Pages:
    """A bit-plane in a file: fixed pages, each compressed on its own, of which only those asked for are read."""

    def __init__(self, read, ends: np.ndarray, size: int):
        self.read, self.ends, self.size = read, ends, size
        self.held: dict[int, np.ndarray] = {}

    def page(self, k: int) -> np.ndarray:
        if k not in self.held:
            if len(self.held) >= 64:
                self.held.clear()
            start = int(self.ends[k])
            raw = zstandard.ZstdDecompressor().decompress(self.read(start, int(self.ends[k + 1]) - start))
            self.held[k] = np.frombuffer(raw, np.uint8)
        return self.held[k]

    def take(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at)
        out = np.empty(at.shape, np.uint8)
        own = at // PAGE
        for k in np.unique(own).tolist():
            mine = own == k
            out[mine] = self.page(k)[at[mine] - k * PAGE]
        return out

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        start = int(self.ends[0])
        blob, inflate = memoryview(self.read(start, int(self.ends[-1]) - start)), zstandard.ZstdDecompressor().decompress
        return np.frombuffer(b"".join([inflate(blob[a - start : b - start]) for a, b in zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True)]), np.uint8)


def pack(doc_ids: np.ndarray, sizes: np.ndarray, matrix: WaveletMatrix) -> bytes:
    """A shard file: magic, length and JSON of the header, index, rank table, then the planes in compressed pages.

    The index holds document ids, sizes, zeros and where each page ends. Ranks are stored per level as the ones in each
    block, compressed; a page of a plane is read and inflated alone, so a position costs one page a level.
    """
    deflate = zstandard.ZstdCompressor(level=1).compress
    width = matrix.planes.shape[1]
    pages = [deflate(plane[at : at + PAGE].tobytes()) for plane in matrix.planes for at in range(0, width, PAGE)]
    ranks = [deflate(np.diff(r).astype("<u2").tobytes()) for r in matrix.ranks]
    ends = np.cumsum([len(b) for b in [*ranks, *pages]], dtype="<i8")
    index = [doc_ids.astype("<i8"), sizes.astype("<i8"), matrix.zeros.astype("<i8"), ends]
    head = json.dumps({"n": matrix.n, "bits": matrix.bits, "docs": len(doc_ids), "width": width, "parts": [p.nbytes for p in index]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *(p.tobytes() for p in index), *ranks, *pages])


def unpack(read) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """(document ids, sizes, matrix) of a shard file; ``read(start, size)`` gives bytes of it, and only the index, the ranks and the pages that answers need are read."""
    if bytes(read(0, 4)) != MAGIC:
        raise ValueError("not a wavelet-matrix shard")
    at = 8 + int.from_bytes(read(4, 4), "little")
    head = json.loads(bytes(read(8, at - 8)))
    parts = []
    for size in head["parts"]:
        parts.append(np.frombuffer(read(at, size), "<i8"))
        at += size
    doc_ids, sizes, zeros, ends = parts
    ends = at + np.concatenate([[0], ends])
    bits, each = head["bits"], -(-head["width"] // PAGE)
    inflate = zstandard.ZstdDecompressor().decompress
    counts = [np.frombuffer(inflate(read(int(a), int(b - a))), "<u2") for a, b in zip(ends[:bits], ends[1 : bits + 1], strict=True)]
    ranks = [np.concatenate([[0], np.cumsum(c, dtype=np.int64)]) for c in counts]
    planes = [Pages(read, ends[bits + level * each : bits + (level + 1) * each + 1], head["width"]) for level in range(bits)]
    return doc_ids, sizes, WaveletMatrix(head["n"], bits, planes, ranks, zeros)


def in_memory(blob: bytes | pa.Buffer):
    view = memoryview(blob)
    return lambda start, size: view[start : start + size]


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow knows; a plain path is a path of the shared file system."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def write_file(uri: str, data: bytes) -> None:
    """Written beside its place and then renamed, so that a task that dies leaves nothing that looks whole."""
    store, path = open_store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(part := f"{path}.{uuid.uuid4().hex}.part") as out:
        out.write(data)
    store.move(part, path)


def read_file(uri: str) -> pa.Buffer:
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        return file.read_buffer()


@contextmanager
def shard(uri: str):
    """The shard at ``uri``, of which only the parts that are used are read."""
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        yield unpack(lambda start, size: file.read_at(size, start))


#: Pre-tokens of letters, digits and signs below this character are cut here, others by the library alone.
FAMILIAR = "\u0530"


@lru_cache(maxsize=2)
def chunk_tokenizer(path: str, end: bytes = b"") -> ChunkEncoder:
    """One for each Python worker: chunks are cut to pre-tokens, which the library's model encodes one by one.

    A chunk that may hold an added token of the file (such as ``<|endoftext|>``), or unfamiliar characters, is encoded
    by the library whole, as are texts that are not cut.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own = Tokenizer.from_file(path)
    own.no_padding()
    own.no_truncation()
    added = tuple(t.content for t in own.get_added_tokens_decoder().values())
    letters = dict(enumerate(byte_letters()))
    find, tokenize = regex.compile(public_tokenizers.PATTERN).findall, own.model.tokenize

    def split(text: str) -> list[str] | None:
        return None if max(text) >= FAMILIAR or any(t in text for t in added) else find(text)

    def pieces(pres: list[str]) -> list[bytes]:
        mapped = (p.replace(" ", letters[32]) if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters) for p in pres)
        return [array("I", [t.id for t in tokens]).tobytes() for tokens in map(tokenize, mapped)]

    def whole(texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in own.encode_batch_fast(texts, add_special_tokens=False)]

    return ChunkEncoder(whole, pieces, split, end)


#: The document id of a row without one: the least long, before all others.
NO_ID = -(1 << 63)


def write_shards(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 2, shard_ids: int = 4_000_000, part_bytes: int = 16_000_000, most_parts: int = 20_000) -> DataFrame:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes shards in ascending ``doc_id`` order.

    Documents are dealt out by ranges of doc_id and sorted inside, so shards follow one another without a global pass.
    A range has about ``part_bytes`` of text; of very large tables there are ``most_parts`` ranges, each with many
    shards. A shard closes after ``shard_ids`` ids at the latest with the document that reaches it; memory is bounded by
    that, the encoder's run of texts and the longest document. Returns the manifest, one row per shard, for
    ``read_shards``: (path, first_doc, last_doc, n_docs, n_ids). A repeated doc_id is written as often as it comes, its
    rows in the order of a hash of their texts; a null doc_id comes first and is NO_ID in the files and the manifest. An
    empty table has an empty manifest.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(most_parts, max(1, -(-int(total) // part_bytes)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = chunk_tokenizer(tokenizer_path, np.array([end_id], "<u4").tobytes()), 0
        names: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        codes: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            ids, docs_, ns = (np.concatenate(x) for x in (codes, names, sizes))
            uri = f"{out_dir}/shard-{TaskContext.get().partitionId():06d}-{number:04d}-{uuid.uuid4().hex[:8]}.wmx"
            write_file(uri, pack(docs_, ns, WaveletMatrix.build(ids)))
            row = {"path": uri, "first_doc": int(docs_[0]), "last_doc": int(docs_[-1]), "n_docs": len(docs_), "n_ids": len(ids)}
            names.clear(), sizes.clear(), codes.clear()
            number, held = number + 1, 0
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("first_doc", "last_doc", "n_docs", "n_ids"))]))

        for batch in batches:
            docs_, at = batch.column(0).fill_null(NO_ID).to_numpy(), 0
            for ids, ends in own.runs(batch.column(1)):
                mine, starts, base = docs_[at : at + len(ends)], np.concatenate([[0], ends[:-1]]), 0
                at += len(ends)
                while base < len(ends):
                    # the first document with which the shard is full, or the last of the run
                    stop = min(len(ends), int(np.searchsorted(ends, starts[base] + shard_ids - held)) + 1)
                    names.append(mine[base:stop]), codes.append(ids[starts[base] : ends[stop - 1]])
                    sizes.append(ends[base:stop] - starts[base:stop])
                    held += int(ends[stop - 1] - starts[base])
                    base = stop
                    if held >= shard_ids:
                        yield flush()
        if names:
            yield flush()

    dealt = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return Cut(dealt.mapInArrow(work, MANIFEST), "wavelet-manifest").df


def with_starts(manifest: DataFrame) -> DataFrame:
    """``base``: ids in all shards before each one. The window runs over one small row per shard, never over documents."""
    from pyspark.sql import Window

    order = Window.orderBy("first_doc", "last_doc", "path").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))


def read_shards(manifest: DataFrame, spark: SparkSession) -> DataFrame:
    """Per document, from the files alone: (doc_id, start, n_tokens, ids_crc32); NO_ID is null again."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids, sizes, matrix = unpack(in_memory(read_file(path)))
                ids = matrix.all().astype("<u4").view(np.uint8)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(starts + base), pa.array(sizes), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = with_starts(manifest).select("path", "base")
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
    return placed.repartition(parts, "path").mapInArrow(work, schema)


def lookup(manifest: DataFrame, token: int, most: int | None = None) -> DataFrame:
    """Global positions of a token, (position), by rank and select inside each shard; ``most`` per shard if given."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with shard(path) as (_, _, matrix):
                    yield pa.RecordBatch.from_arrays([pa.array(matrix.occurrences(token, 0, most) + base)], ["position"])

    return with_starts(manifest).select("path", "base").mapInArrow(work, "position long")


def count(manifest: DataFrame, token: int) -> DataFrame:
    """One row (n): how often a token occurs, by rank alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with shard(path) as (_, _, matrix):
                    yield pa.RecordBatch.from_arrays([pa.array([matrix.count(token)], pa.int64())], ["n"])

    return manifest.select("path").mapInArrow(work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def documents_to_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes ``docs`` to fresh shards in the shared folder and reads them back."""
    spark = docs.sparkSession
    manifest = write_shards(docs, fresh_path(spark, "wavelet"), tokenizer_path, end_id)
    return read_shards(manifest, spark)
