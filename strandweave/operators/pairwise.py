"""Exon-aware alignment of candidate pairs and the exon maps read from it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandweave.functions import sequence as S
from strandweave.operators.joins import overlap

GAP = "#"
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
#: The public BLOSUM62 scores, lower triangle in the order of RESIDUES.
BLOSUM62 = """
4
-1 5
-2 0 6
-2 -2 1 6
0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""


def scores() -> np.ndarray:
    """Score of every two characters: residues by BLOSUM62; marks and digits against each other and against residues."""
    out = np.zeros((128, 128), dtype=np.int32)
    for i, line in enumerate(BLOSUM62.split("\n")[1:-1]):
        for j, value in enumerate(line.split()):
            out[ord(RESIDUES[i]), ord(RESIDUES[j])] = out[ord(RESIDUES[j]), ord(RESIDUES[i])] = int(value)
    digits, letters, marks = ([ord(c) for c in s] for s in ("0123456789", RESIDUES + "X", "BZ"))
    for one, other, value in ((digits, digits, 5), (digits, letters, -2), (digits, marks, -15)):
        out[np.ix_(one, other)] = value
        out[np.ix_(other, one)] = value
    out[ord("B"), ord("B")] = out[ord("Z"), ord("Z")] = 5
    out[ord("B"), ord("Z")] = out[ord("Z"), ord("B")] = -10
    return out


def _between(codes: np.ndarray) -> np.ndarray:
    """For each prefix length whether it ends outside an exon; before the first mark it does."""
    state, out = True, [True]
    for c in codes:
        state = False if c == ord("B") else True if c == ord("Z") else state
        out.append(state)
    return np.array(out)


@dataclass(frozen=True)
class Gaps:
    opening: int
    extending: int


def _fill(profile: np.ndarray, b: np.ndarray, free: tuple[np.ndarray, np.ndarray], rows: tuple[int, int], top: tuple[np.ndarray, np.ndarray], gaps: Gaps, keep: bool):
    """Cells of the rows after ``rows[0]`` up to ``rows[1]`` below a known row ``top`` (scores, ways), by anti-diagonals.

    Returns (last row, best score, its cell, ways of the rows if they are kept). Ways are 0 match, 1 along the first,
    2 along the second.
    """
    (lo, hi), n = rows, len(b)
    k = hi - lo
    older, old, turned = np.zeros(k + 1, np.int64), np.zeros(k + 1, np.int64), np.zeros(k + 1, np.int8)
    old[0], turned[0] = top[0][0], top[1][0]
    last, last_way = np.zeros(n + 1, np.int64), np.ones(n + 1, np.int8)
    ways = np.zeros((k + 1, n + 1), np.int8) if keep else None
    best, best_at = 0, (0, 0)
    free_a, free_b = free
    for d in range(1, k + n + 1):
        low, high = max(1, d - n), min(k, d)
        i = np.arange(low, high + 1)
        j = d - i
        above, beside = slice(low - 1, high), slice(low, high + 1)
        up = old[above] + np.where(free_b[j], 0, np.where(turned[above] == 1, gaps.extending, gaps.opening))
        left = old[beside] + np.where(free_a[lo + i], 0, np.where(turned[beside] == 2, gaps.extending, gaps.opening))
        value = older[above] + profile[lo + i - 1, b[j - 1]]
        turn = np.zeros(len(i), np.int8)
        for other, mark in ((up, 1), (left, 2)):
            better = other > value
            value[better], turn[better] = other[better], mark
        np.maximum(value, 0, out=value)
        if high == d:  # the cell before the second text begins
            value[-1], turn[-1] = 0, 1
        at = int(np.argmax(value))
        if value[at] > best or (value[at] == best > 0 and lo + int(i[at]) < best_at[0]):
            best, best_at = int(value[at]), (lo + int(i[at]), int(j[at]))
        if keep:
            ways[i, j] = turn
        if high == k:
            last[d - k], last_way[d - k] = value[-1], turn[-1]
        older, old, turned = old, np.zeros(k + 1, np.int64), np.zeros(k + 1, np.int8)
        old[beside], turned[beside] = value, turn
        if d <= n:
            old[0], turned[0] = top[0][d], top[1][d]
    return (last, last_way), best, best_at, ways


def best_path(profile: np.ndarray, b: np.ndarray, free: tuple[np.ndarray, np.ndarray], gaps: Gaps, cells: int = 1 << 25) -> list[tuple[int, int]]:
    """Matched places (i, j) of the best alignment of rows with scores ``profile[i, letter]`` with the letters ``b``.

    ``free`` says for prefixes of both sides whether gaps cost nothing behind them. Rows are filled in blocks of about
    ``cells`` cells, of which only the last row is kept; on the way back a block is filled again with its ways. So
    memory is that of one block and one row a block, whatever the lengths.
    """
    m, n = len(profile), len(b)
    if not m or not n:
        return []
    size = max(16, cells // (n + 1))
    blocks = [(lo, min(m, lo + size)) for lo in range(0, m, size)]
    tops = [(np.zeros(n + 1, np.int64), np.r_[np.int8(0), np.full(n, 2, np.int8)])]
    best, best_at, ways = 0, (0, 0), None
    for rows in blocks:
        below, high, at, ways = _fill(profile, b, free, rows, tops[-1], gaps, len(blocks) == 1)
        tops.append(below)
        if high > best:
            best, best_at = high, at
    i, j = best_at
    matches = []
    while i > 0 and j > 0:
        block = (i - 1) // size
        if len(blocks) > 1:
            ways = _fill(profile, b, free, blocks[block], tops[block], gaps, True)[3]
        lo = blocks[block][0]
        while i > lo and j > 0:
            way = ways[i - lo, j]
            i, j = i - (way != 2), j - (way != 1)
            if way == 0:
                matches.append((i, j))
    return matches[::-1]


def _laid(first: str, second: str, matches: list[tuple[int, int]]) -> tuple[str, str]:
    left_text, right_text, p, q, start = [], [], 0, 0, 0
    for k, (i, j) in enumerate([*matches, (len(first), len(second))]):
        if i == p and j == q and k < len(matches):  # goes on a stretch of matches
            p, q = i + 1, j + 1
            continue
        left_text += [first[start:p], first[p:i], GAP * (j - q)]
        right_text += [second[q - (p - start) : q], GAP * (i - p), second[q:j]]
        start, p, q = i, i + 1, j + 1
    return "".join(left_text), "".join(right_text)


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8) & 127


def align_pair(first: str, second: str, gap_open: int, gap_extend: int, table: np.ndarray, cells: int = 1 << 25) -> tuple[str, str]:
    """The best alignment from the two origins, the rest of both behind it.

    On equal scores a match goes before a gap in the second and that before a gap in the first; of equal best cells the
    first in row order counts. Two texts of any length take the memory that ``best_path`` states.
    """
    a, b = _letters(first), _letters(second)
    return _laid(first, second, best_path(table[a], b, (_between(a), _between(b)), Gaps(gap_open, gap_extend), cells))


def _side_by_side(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, free, lengths) of texts as columns, 0 behind their ends."""
    letters, free = np.zeros((width, len(texts)), np.int32), np.zeros((width + 1, len(texts)), bool)
    for p, text in enumerate(texts):
        letters[: len(text), p] = own = _letters(text)
        free[: len(text) + 1, p] = _between(own)
    return letters, free, np.array([len(x) for x in texts], np.int32)


def best_paths(firsts: list[str], seconds: list[str], gaps: Gaps, table: np.ndarray) -> list[list[tuple[int, int]]]:
    """What ``best_path`` gives for each of several pairs, their anti-diagonals filled side by side; texts are under 4096 letters.

    A cell depends on cells before it only, so the cells behind the end of a shorter text change none of its own.
    """
    k, n, size = max(map(len, firsts)), max(map(len, seconds)), len(firsts)
    (a, free_a, ends_a), (b, free_b, ends_b) = _side_by_side(firsts, k), _side_by_side(seconds, n)
    # what a gap adds: nothing where it is free, and by the way of the cell before
    open_a, more_a = (np.where(free_a, 0, x).astype(np.int32) for x in (gaps.opening, gaps.extending))
    open_b, more_b = (np.where(free_b, 0, x).astype(np.int32) for x in (gaps.opening, gaps.extending))
    flat, rows = table.astype(np.int32).ravel(), a * 128
    turned_b, open_b, more_b = b[::-1], open_b[::-1], more_b[::-1]
    older, old, new = (np.zeros((k + 1, size), np.int32) for _ in range(3))
    ways = np.zeros((k + n + 1, k + 1, size), np.int8)
    ways[1 : n + 1, 0] = 2
    for d in range(1, k + 1):
        ways[d, d] = 1
    best, best_j = np.zeros(size, np.int32), np.zeros(size, np.int32)
    numbers = np.arange(k + 1, dtype=np.int32)[:, None]
    for d in range(1, k + n + 1):
        low, high = max(1, d - n), min(k, d - 1)  # the cell before the second text begins stays 0
        if low <= high:
            above, beside, back = slice(low - 1, high), slice(low, high + 1), slice(n - d + low, n - d + high + 1)
            before = ways[d - 1]
            up = old[above] + np.where(before[above] == 1, more_b[back], open_b[back])
            left = old[beside] + np.where(before[beside] == 2, more_a[beside], open_a[beside])
            value = older[above] + flat[rows[above] + turned_b[back]]
            turn = (up > value).view(np.int8)
            np.maximum(value, up, out=value)
            turn[left > value] = 2
            np.maximum(value, left, out=value)
            ways[d, beside] = turn
            np.maximum(value, 0, out=new[beside])
            # the greatest, then the first by row; a later one of its row has a greater d
            inside = (numbers[beside] <= ends_a) & (d - numbers[beside] <= ends_b)
            most = np.where(inside, new[beside] * 4096 - numbers[beside], 0).max(axis=0)
            more = most > best
            best[more], best_j[more] = most[more], d
        new[0] = 0
        if d <= k:
            new[d] = 0
        older, old, new = old, new, older
    i = np.where(best > 0, -best % 4096, 0)
    j = np.where(best > 0, best_j - i, 0)
    out: list[list[tuple[int, int]]] = [[] for _ in range(size)]
    live = np.flatnonzero((i > 0) & (j > 0))
    met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(live):
        way = ways[i[live] + j[live], i[live], live]
        i[live] -= way != 2
        j[live] -= way != 1
        hit = live[way == 0]
        met.append((hit, i[hit], j[hit]))
        live = live[(i[live] > 0) & (j[live] > 0)]
    for hit, x, y in reversed(met):
        for p, u, v in zip(hit.tolist(), x.tolist(), y.tolist()):
            out[p].append((u, v))
    return out


def align_pairs(firsts: list[str], seconds: list[str], gap_open: int, gap_extend: int, table: np.ndarray, cells: int = 1 << 24) -> list[tuple[str, str]]:
    """What ``align_pair`` gives for each pair; short ones are aligned many at a time, by their lengths, as far as ``cells`` cells go."""
    out: list[tuple[str, str]] = [("", "")] * len(firsts)
    sizes = [(len(x), len(y)) for x, y in zip(firsts, seconds, strict=True)]
    fits = lambda m, n: 0 < m < 4096 and 0 < n < 4096 and 16 * (m + n + 1) * (m + 1) <= cells
    for p in (p for p, s in enumerate(sizes) if not fits(*s)):
        out[p] = align_pair(firsts[p], seconds[p], gap_open, gap_extend, table)
    short = sorted((p for p, s in enumerate(sizes) if fits(*s)), key=lambda p: (sizes[p][0] // 16, sizes[p][1]))
    while short:
        taken, width, height = 0, 0, 0
        for p in short[:256]:
            width, height = max(width, sizes[p][0]), max(height, sizes[p][1])
            if taken and (taken + 1) * (width + height + 1) * (width + 1) > cells:
                break
            taken += 1
        own, short = short[:taken], short[taken:]
        paths = best_paths([firsts[p] for p in own], [seconds[p] for p in own], Gaps(gap_open, gap_extend), table)
        for p, matches in zip(own, paths):
            out[p] = _laid(firsts[p], seconds[p], matches)
    return out


def align(pairs: DataFrame, gap_open: int = -5, gap_extend: int = -3) -> DataFrame:
    """Pairs with ``first`` and ``second`` aligned to each other; null texts count as empty.

    Each pair is one row of a distributed table; a task holds one block of one long pair, or some short pairs, at a time.
    """
    names = [f.name for f in pairs.schema]
    schema = StructType([StructField(f.name, StringType()) if f.name in ("first", "second") else f for f in pairs.schema])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = scores()
        for batch in batches:
            done = align_pairs([x or "" for x in batch["first"]], [y or "" for y in batch["second"]], gap_open, gap_extend, table)
            yield batch.assign(first=[x for x, _ in done], second=[y for _, y in done])[names]

    # a number of parts of its own, as few bytes are much work here and would be put together to few parts at run time
    spark = pairs.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return pairs.repartition(parts, "a_id", "b_id").mapInPandas(work, schema)


def exon_pairs(aligned: DataFrame) -> DataFrame:
    """(a_id, b_id, a_label, b_label, x, y): exons that overlap in an alignment, in one frame and without double gaps."""
    tidy = lambda c: F.regexp_replace(F.replace(c, F.lit(GAP), F.lit("-")), "B(-+)", "$1B")
    base = aligned.select("a_id", "b_id", tidy("first").alias("first"), tidy("second").alias("second"))
    rows = base.withColumn("s", F.explode(S.exon_spans(F.col("first")))).withColumn("t", F.explode(S.exon_spans(F.col("second"))))
    rows = rows.where(overlap(F.col("s.first"), F.col("s.last"), F.col("t.first"), F.col("t.last"))).where(F.col("s.label").rlike("^[0-9]{3}$") & F.col("t.label").rlike("^[0-9]{3}$"))
    piece = lambda text, span: F.substring(F.col(text), F.col(f"{span}.first") + 1, F.col(f"{span}.last") - F.col(f"{span}.first"))
    rows = rows.withColumns({"u": piece("first", "s"), "v": piece("second", "t")})
    rows = rows.withColumns({"x": S.padded(F.col("u"), F.col("s.first"), F.col("v"), F.col("t.first")), "y": S.padded(F.col("v"), F.col("t.first"), F.col("u"), F.col("s.first"))})
    return rows.select("a_id", "b_id", F.col("s.label").cast("int").alias("a_label"), F.col("t.label").cast("int").alias("b_label"), *(S.without_double_gaps(F.col("x"), F.col("y"), F.col(c)).alias(c) for c in ("x", "y")))


def exon_maps(aligned: DataFrame, least: float = 0.8) -> DataFrame:
    """(a_id, b_id, a_label, b_label, similarity, cigar) of exon pairs that are alike enough."""
    scored = exon_pairs(aligned).withColumn("similarity", S.tanimoto(F.col("x"), F.col("y")))
    return scored.where(F.col("similarity") >= least).select("a_id", "b_id", "a_label", "b_label", "similarity", S.cigar(F.col("x"), F.col("y")).alias("cigar"))


def paralogue_maps(aligned: DataFrame) -> DataFrame:
    """As ``exon_maps`` without a threshold, the similarity being the matched share of the shorter exon."""
    lined = exon_pairs(aligned).withColumn("cigar", S.cigar(F.col("x"), F.col("y")))
    return lined.select("a_id", "b_id", "a_label", "b_label", S.matched_of_shorter(F.col("cigar"), F.col("x"), F.col("y")).alias("similarity"), "cigar")
