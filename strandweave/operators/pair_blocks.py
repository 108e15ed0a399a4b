"""All pairs of sequences inside each alignment, made block by block with arrays of letters and of bits."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.session import Cut

#: Sequences of a block: at least and at most, by how many there are; letters of a block, and of the units of a part; pairs made at once.
LEAST, MOST, BLOCKS, LETTERS, PART_LETTERS, AT_ONCE = 256, 1 << 16, 32, 1 << 22, 1 << 26, 1 << 14
GAP = ord("-")


class Block:
    """Sequences as a matrix of letters, 0 behind the end of each; a null is empty and marked in ``null``."""

    def __init__(self, rows: pa.StructArray):
        self.rows = rows
        self.texts = rows.field("seq").to_pylist()
        self.null = np.array([t is None for t in self.texts], bool)
        self.texts = [t or "" for t in self.texts]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.letters = _letters(self.texts, int(self.size.max(initial=1)))
        self.inside = np.arange(self.letters.shape[1]) < self.size[:, None]
        self.residue = self.inside & (self.letters != GAP)
        self.residues = self.residue.sum(axis=1)
        self.cache: dict[str, list[np.ndarray]] = {}

    def column(self, name: str) -> np.ndarray:
        return self.rows.field(name).to_numpy(zero_copy_only=False)

    def kept(self, name: str, make: Callable[[], list[np.ndarray]]) -> list[np.ndarray]:
        if name not in self.cache:
            self.cache[name] = make()
        return self.cache[name]

    def null_pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.null[a] | self.null[b]


def _letters(texts: list[str], width: int) -> np.ndarray:
    codes = np.array(texts, f"<U{max(1, width)}").view(np.uint32).reshape(len(texts), -1)
    return codes.astype(np.uint8) if codes.max(initial=0) < 128 else codes


def _bits(mask: np.ndarray) -> np.ndarray:
    """Rows of truth values as 64-bit words."""
    packed = np.packbits(mask, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def _planes(letters: np.ndarray) -> list[np.ndarray]:
    """One array of bits for each digit of the letters' codes."""
    return [_bits((letters >> k) & 1 == 1) for k in range(max(1, int(letters.max(initial=0)).bit_length()))]


def _count(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


def _differ(planes: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = planes[0][a] ^ planes[0][b]
    for plane in planes[1:]:
        out |= plane[a] ^ plane[b]
    return out


def _residues(block: Block) -> np.ndarray:
    return block.kept("residues", lambda: [_bits(block.residue)])[0]


def _same(block: Block, a: np.ndarray, b: np.ndarray, classes: bool) -> np.ndarray:
    """Columns in which both have one residue, or residues of one class."""
    table = str.maketrans(*S.CLASSES) if classes else {}
    planes = block.kept(f"planes-{classes}", lambda: _planes(_letters([t.translate(table) for t in block.texts], block.letters.shape[1])))
    return _count(~_differ(planes, a, b) & _residues(block)[a] & _residues(block)[b])


def _common(block: Block, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _count(_residues(block)[a] & _residues(block)[b])


def _share(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A share, 0 of nothing."""
    return np.where(of > 0, n / np.maximum(of, 1), 0.0)


def identity(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Columns with the same residue over all columns of the first."""
    return [pa.array(_share(_same(block, a, b, False), block.size[a]), mask=block.null_pair(a, b) | (block.size[a] == 0))]


def similarity(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Columns with residues of one class over those in which both have one."""
    c = _common(block, a, b)
    return [pa.array(_share(_same(block, a, b, True), c), mask=block.null_pair(a, b) | (c == 0))]


def tanimoto(heuristics: bool) -> Callable[[Block, np.ndarray, np.ndarray], list[pa.Array]]:
    """As ``sequence.tanimoto``."""

    def kernel(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
        s, c, m, n = (x.astype(float) for x in (_same(block, a, b, True), _common(block, a, b), block.residues[a], block.residues[b]))
        none = (m == 0) | (n == 0) | (c == 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.sqrt(s * s / (m * n))
            if heuristics:
                out = np.select([s > 0.9 * m, s > 0.9 * n, (s >= 0.66 * c) & (0.66 * c > 4)], [s / m, s / n, s / c], out)
        # an empty sequence is like nothing, not even a null
        empty = (~block.null[a] & (m == 0)) | (~block.null[b] & (n == 0))
        return [pa.array(np.where(none, 0.0, out), mask=block.null_pair(a, b) & ~empty)]

    return kernel


def matched_shares(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Columns in which both have a residue over those in which any has, and over the shorter sequence; 0 for unequal lengths."""
    c = np.where((block.size[a] == block.size[b]) & ~block.null_pair(a, b), _common(block, a, b), 0)
    every = _count(_residues(block)[a] | _residues(block)[b])
    return [pa.array(_share(c, every)), pa.array(_share(c, np.minimum(block.residues[a], block.residues[b])))]


def close_enough(block: Block, a: np.ndarray, b: np.ndarray, lengths: int = 3, mismatches: int = 2) -> list[pa.Array]:
    """As ``sequence.close_enough``."""

    def stripped() -> list[np.ndarray]:
        texts = [t.lstrip("X") for t in block.texts]
        letters, size = _letters(texts, block.letters.shape[1]), np.array([len(t) for t in texts], np.int64)
        return [size, _bits(np.arange(letters.shape[1]) < size[:, None]), *_planes(letters)]

    size, inside, *planes = block.kept("stripped", stripped)
    off = _count(_differ(planes, a, b) & inside[a] & inside[b])
    return [pa.array((np.abs(size[a] - size[b]) <= lengths) & (off <= mismatches), mask=block.null_pair(a, b))]


def _texts(letters: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive texts of the given sizes."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    if letters.dtype == np.uint8:
        return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(letters.tobytes()))
    whole = letters.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([whole[p:q] for p, q in zip(ends[:-1], ends[1:])], pa.string())


def _joined(values: pa.Array, counts: np.ndarray, between: str) -> pa.Array:
    """Consecutive groups of texts, each joined."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), values), between)


def cigars(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """As ``sequence.cigar``."""
    width = block.letters.shape[1]
    state = block.residue[a].view(np.uint8) + 2 * block.residue[b].view(np.uint8)
    state[(block.size[a] != block.size[b]) | block.null_pair(a, b)] = 0
    at = np.flatnonzero(state)
    kind, row = state.ravel()[at], (at // width).astype(np.int32)
    new = np.r_[True, (kind[1:] != kind[:-1]) | (row[1:] != row[:-1])][: len(at)]
    starts = np.flatnonzero(new)
    length = np.diff(np.r_[starts, len(at)])
    names = pa.array([f"{n}{letter}" for letter in "BAM" for n in range(width + 1)])
    runs = names.take(pa.array((kind[starts].astype(np.int64) - 1) * (width + 1) + length))
    return [_joined(runs, np.bincount(row[starts], minlength=len(a)), "")]


def _without_double_gaps(first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    keep = ((first != GAP) & (first != 0)) | ((second != GAP) & (second != 0))
    # letters behind the end of the other sequence have no column
    keep &= (first != 0) & (second != 0)
    sizes = keep.sum(axis=1)
    return [_texts(first[keep], sizes), _texts(second[keep], sizes)]


def rows_of_pairs(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Both sequences without columns in which both have a gap; empty for unequal lengths."""
    first, second = block.letters[a], block.letters[b]
    first[(block.size[a] != block.size[b]) | block.null_pair(a, b)] = 0
    return _without_double_gaps(first, second)


def framed_rows(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Both sequences in the frame of their starts ``a_start`` and ``b_start``, without columns in which both have a gap."""
    s, t = block.column("a_start")[a], block.column("b_start")[b]
    least = np.minimum(s, t)
    width = np.maximum(s + block.size[a], t + block.size[b]) - least
    columns = np.arange(int(width.max(initial=1)))

    def laid(own: np.ndarray, start: np.ndarray) -> np.ndarray:
        at = columns - (start - least)[:, None]
        held = (at >= 0) & (at < block.size[own][:, None])
        out = np.where(held, block.letters[own[:, None], np.where(held, at, 0)], np.asarray(GAP, block.letters.dtype))
        out[columns >= width[:, None]] = 0
        return out

    first, second = laid(a, s), laid(b, t)
    null = pa.array(block.null_pair(a, b))
    return [pc.if_else(null, None, text) for text in _without_double_gaps(first, second)]


def patched(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """As ``sequence.patched``, the filled codons joined by commas."""
    n = -(-block.letters.shape[1] // 3)
    cut = lambda own: np.pad(block.letters[own], ((0, 0), (0, 3 * n - block.letters.shape[1]))).reshape(len(own), n, 3)
    target, template = cut(a), cut(b)
    gap = target == GAP
    one = (gap.sum(axis=2) == 1) & (target != 0).all(axis=2)
    filler = np.where(gap, template, 0).max(axis=2)
    new = np.where(gap, filler[:, :, None], target)
    big = np.where((new >= ord("a")) & (new <= ord("z")), new - 32, new)
    stop = np.zeros(one.shape, bool)
    for codon in (i for i, c in enumerate(S.STANDARD) if c == "*"):
        stop |= (big == [ord(S.BASES[codon // 4**k % 4]) for k in (2, 1, 0)]).all(axis=2)
    fill = one & (filler != 0) & (filler != GAP) & ~stop
    done = np.where(fill[:, :, None], new, target).reshape(len(a), -1)
    row, codon = np.nonzero(fill)
    numbers = pa.array([str(i) for i in range(n)]).take(pa.array(codon))
    null = pa.array(block.null_pair(a, b))
    out = [_texts(done[done != 0], block.size[a]), _joined(numbers, np.bincount(row, minlength=len(a)), ",")]
    return [pc.if_else(null, None, text) for text in out]


def fused(block: Block, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """The letters of the first, those of the second where it has a gap; behind the shorter's end no gap is filled."""
    first, second = block.letters[a], block.letters[b]
    out = np.where(first == GAP, second, first)
    null = pa.array(block.null_pair(a, b))
    return [pc.if_else(null, None, _texts(out[out != 0], (out != 0).sum(axis=1)))]


def block_numbers(rows: DataFrame, key: list[str]) -> DataFrame:
    """(*key, n_blocks, letters): in how many blocks the sequences of each key go, and the letters of them all.

    Blocks grow with their key up to ``LETTERS`` letters, each a matrix as wide as the key's longest sequence, so that up
    to about two million sequences of 60 letters a sequence travels to about ``BLOCKS`` units, however many there are.
    """
    size = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.ceil(F.count("*") / BLOCKS)))
    letters = F.count("*") * F.coalesce(F.max(F.length("seq")), F.lit(0))
    number = F.greatest(F.ceil(F.count("*") / size), F.ceil(letters / LETTERS), F.lit(1))
    return rows.groupBy(*key).agg(number.cast("int").alias("n_blocks"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("letters"))


def all_pairs(rows: DataFrame, key: list[str], kernel: Callable, result: str, extra: list[str] | None = None, wanted: Callable | None = None) -> DataFrame:
    """(*key, a_id, b_id, ...): what ``kernel`` makes of every two sequences of a key, a the one of lesser id.

    ``rows`` is (*key, seq_id, seq) and ``extra`` columns for the kernel; ``wanted(block, a, b)`` may leave pairs out.
    The sequences of a key are dealt to blocks by hash, and every two blocks are one unit of work, placed by its own
    hash: a key of any size is spread over all tasks, and a task holds two blocks and some thousand pairs. Units are
    dealt to as many parts as their letters ask for.
    """
    extra = extra or []
    # written once, as it is read for the numbers and again for the blocks
    rows = Cut(rows.select(*key, "seq_id", "seq", *extra).where("seq_id is not null"), "pair-rows").df
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    numbers = block_numbers(rows, key)
    moved = numbers.agg(F.sum(F.col("letters").cast("double") * F.col("n_blocks"))).first()[0] or 0
    dealt = rows.join(numbers.drop("letters"), key)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("seq_id", "seq"), F.col("n_blocks")).cast("int"))
    blocks = dealt.groupBy(*key, "n_blocks", "block").agg(F.collect_list(F.struct("seq_id", "seq", *extra)).alias("rows"))
    met = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    met = met.select(*key, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), F.struct("block", "rows").alias("own"))
    spark = rows.sparkSession
    # a number of parts of its own, as few bytes make many pairs
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(moved / PART_LETTERS))
    units = met.repartition(parts, *key, "lo", "hi").groupBy(*key, "lo", "hi").agg(F.array_sort(F.collect_list("own"), lambda p, q: p["block"] - q["block"]).alias("both"))
    names = [*key, "a_id", "b_id", *(c.split()[0] for c in result.split(","))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                parts = [x.values for x in batch["both"][r].values.field("rows")]
                block = Block(pa.concat_arrays(parts) if len(parts) > 1 else parts[0])
                ids, own = block.column("seq_id"), len(parts[0])
                # a block of its own meets itself, two meet each other; blocks without rows make no unit
                others = np.arange(own, len(ids)) if len(parts) > 1 else np.arange(own) if batch["lo"][r].as_py() == batch["hi"][r].as_py() else np.arange(0)
                step = max(1, AT_ONCE // max(1, len(others)))
                for at in range(0, own, step):
                    p = np.arange(at, min(own, at + step))
                    p, q = np.repeat(p, len(others)), np.tile(others, len(p))
                    less = ids[p] < ids[q]
                    keep = less if len(parts) == 1 else less | (ids[q] < ids[p])
                    a, b = np.where(less, p, q)[keep], np.where(less, q, p)[keep]
                    if wanted is not None:
                        keep = wanted(block, a, b)
                        a, b = a[keep], b[keep]
                    if len(a):
                        id_column = block.rows.field("seq_id")
                        yield pa.record_batch([*(pa.repeat(batch[c][r], len(a)) for c in key), id_column.take(pa.array(a)), id_column.take(pa.array(b)), *kernel(block, a, b)], names)

    return units.mapInArrow(work, ", ".join([*(f"{c} {kinds[c]}" for c in key), f"a_id {kinds['seq_id']}, b_id {kinds['seq_id']}", result]))
