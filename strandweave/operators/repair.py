"""Repair of aligned exon rows: boundaries put in line, and exons that map to several reference exons aligned anew."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.operators.pairwise import GAP, Gaps, _between, align, best_path, scores

BLANK, BOUND = ord("-"), ord("Z")
#: Gap penalties of the re-alignment.
REPAIR_GAPS = Gaps(-3, 0)


# An alignment is a matrix of letters, one row a sequence, in the order in which the sequences count as anchors.


def _matrix(rows: list[str]) -> np.ndarray:
    return np.frombuffer("".join(rows).encode("ascii", "replace"), np.uint8).reshape(len(rows), -1)


def _rows(matrix: np.ndarray) -> list[str]:
    n, width = matrix.shape
    text = matrix.tobytes().decode("ascii")
    return [text[k * width : (k + 1) * width] for k in range(n)]


def _marks(row: np.ndarray) -> list[int]:
    """Starts of the marks -Z- in a row, none overlapping the one before."""
    text, out, at = row.tobytes(), [], 0
    while (at := text.find(b"-Z-", at)) >= 0:
        out.append(at)
        at += 3
    return out


def _with_gaps_at_marks(m: np.ndarray) -> np.ndarray:
    """A column of gaps before and behind each Z that has a residue there; the ends of the alignment need none."""
    r = -1
    while True:
        bound, filled = m == BOUND, m != BLANK
        tight = (bound[:, 1:] & filled[:, :-1]).any(axis=1) | (bound[:, :-1] & filled[:, 1:]).any(axis=1)
        open_rows = np.flatnonzero(tight[r + 1 :])
        if not len(open_rows):
            return m
        r += 1 + int(open_rows[0])
        z = np.flatnonzero(m[r] == BOUND)
        before = z[(z > 0) & (m[r, np.maximum(z - 1, 0)] != BLANK)]
        behind = z[z + 1 < m.shape[1]] + 1
        behind = behind[m[r, behind] != BLANK]
        m = np.insert(m, np.sort(np.r_[before, behind]), BLANK, axis=1)


def _moved(row: np.ndarray, bounds: list[int]) -> bool:
    """Whether marks of a row that stood on no boundary went to the first boundary from which only gaps part them; in place."""
    moved = False
    for at in _marks(row):
        if at in bounds:
            continue
        for to in bounds:
            between = row[at + 3 : to + 3] if at < to else row[to:at]
            if len(between) == abs(at - to) and (between == BLANK).all():
                row[min(at, to) : max(at, to) + 3] = BLANK
                row[to + 1] = BOUND
                moved = True
                break
    return moved


def _restless(m: np.ndarray, bounds: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with a mark on no boundary that can go to one, rows that have residues and no Z on one, and all rows with a mark on none.

    A mark can go where only gaps part it from the boundary next to it on either side; others need not be tried.
    """
    stray = (m[:, 1:-1] == BOUND) & (m[:, :-2] == BLANK) & (m[:, 2:] == BLANK)
    stray[:, [b for b in bounds if b < stray.shape[1]]] = False
    off, free = stray.any(axis=1), np.zeros(len(m), bool)
    for at in np.flatnonzero(stray.any(axis=0)).tolist():
        rows, k = np.flatnonzero(stray[:, at]), bisect_left(bounds, at)
        if k:
            free[rows[(m[rows, bounds[k - 1] : at] == BLANK).all(axis=1)]] = True
        if k < len(bounds) and bounds[k] + 3 <= m.shape[1]:
            free[rows[(m[rows, at + 3 : bounds[k] + 3] == BLANK).all(axis=1)]] = True
    crossed = np.zeros(len(m), bool)
    for b in bounds:
        cells = m[:, b : b + 3]
        crossed |= ~(cells == BOUND).any(axis=1) & (cells != BLANK).any(axis=1)
    return free, crossed, off


def _make_room(m: np.ndarray, bounds: list[int], r: int, k: int) -> np.ndarray:
    """Gaps beside the residues that row r has on boundary k; boundaries behind them shift, in place.

    Gaps go in before the residues, and behind the marks of the rows that have one, if the boundary begins with a gap, or
    is full of residues behind a gap; else behind them, and before those marks, if it ends with a gap or is full, and then
    the boundary itself shifts. Two residues around one gap stay.
    """
    at, width = bounds[k], m.shape[1]
    if at + 3 >= width:
        return m
    cell = m[r, at : at + 3] != BLANK
    full = bool(cell.all())
    left = not cell[0] or (full and (at == 0 or m[r, at - 1] == BLANK))
    right = not left and (not cell[2] or full)
    if not (left or right):
        return m
    gaps = 0 if full else int(np.argmax(cell if left else cell[::-1]))
    size = 3 - gaps
    inside = at + gaps if left else at + size
    marked = (m[:, at] == BLANK) & (m[:, at + 1] == BOUND) & (m[:, at + 2] == BLANK)
    out = np.full((len(m), width + size), BLANK, np.uint8)
    for rows, place in ((marked, at + 3 if left else at), (~marked, inside)):
        out[rows, :place], out[rows, place + size :] = m[rows, :place], m[rows, place:]
    bounds[:] = [b + size if b > at or (right and b == at) else b for b in bounds]
    return out


def cleaned(rows: list[str]) -> list[str]:
    """The rows with their boundaries in line: an ordered fold over anchors, each adding its boundaries to those before.

    First every Z gets gaps on both sides. Then per anchor marks of other rows move to a boundary over gaps, rows with
    residues on a boundary get gaps beside them, and marks move once more. Empty alignments and rows of different
    lengths stay as they are. A row that a visit left as it was is visited again only after it, the columns or the
    boundaries have changed, and anchors that add no boundary are passed over where no row is left to visit.
    """
    return _rows(_cleaned(_matrix(rows))) if rows and rows[0] and len({len(r) for r in rows}) == 1 else rows


def _cleaned(m: np.ndarray) -> np.ndarray:
    m = _with_gaps_at_marks(m.copy())
    bounds: list[int] = []
    stray, crossed, off = np.zeros(len(m), bool), np.zeros(len(m), bool), np.ones(len(m), bool)

    def move(anchor: int) -> None:
        for r in np.flatnonzero(stray):
            if r != anchor:
                stray[r] = _moved(m[r], bounds)
                crossed[r] |= stray[r]

    anchor = -1
    while True:
        anchor += 1
        if not (stray.any() or crossed.any()):
            anchor += int(np.argmax(off[anchor:])) if off[anchor:].any() else len(m)
        if anchor >= len(m):
            return m
        own = sorted({*bounds, *_marks(m[anchor])})
        if own != bounds:
            bounds = own
            stray, crossed, off = _restless(m, bounds)
        move(anchor)
        r = -1
        while len(left := np.flatnonzero(crossed[r + 1 :])):
            r += 1 + int(left[0])
            if r == anchor:
                continue
            before = m
            for k in range(len(bounds)):
                cells = m[r, bounds[k] : bounds[k] + 3]
                if not (cells == BOUND).any() and (cells != BLANK).any():
                    m = _make_room(m, bounds, r, k)
            if m is not before:
                stray, crossed, off = _restless(m, bounds)
            else:
                crossed[r] = False
        move(anchor)


def _apart(rows: DataFrame) -> DataFrame:
    """Alignments in a number of parts of its own, as few bytes are much work and would be put together to few parts at run time."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "aln_id")


def clean_boundaries(aln: DataFrame) -> DataFrame:
    """(aln_id, seq_id, seq): each alignment (aln_id, seq_id, seq, rank) cleaned, its sequences being anchors by rank.

    One alignment is one group, as each anchor builds on the ones before; null rows are left out, equal ranks go by seq_id.
    """

    def work(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["seq"].notna()].sort_values(["rank", "seq_id"], kind="stable")
        return own[["aln_id", "seq_id"]].assign(seq=pd.Series(cleaned(own["seq"].tolist()), own.index, object))

    kinds = {f.name: f.dataType.simpleString() for f in aln.schema}
    return _apart(aln).groupBy("aln_id").applyInPandas(work, f"aln_id {kinds['aln_id']}, seq_id {kinds['seq_id']}, seq string")


def alike_pieces(pieces: DataFrame, templates: DataFrame, least: float = 0.33333) -> DataFrame:
    """Pieces (aln_id, seq_id, group_no, piece_no, seq) without those that overlap and are unlike their template once aligned alone.

    ``templates`` is (aln_id, group_no, template). Where pieces of a sequence have residues in one column, all of them,
    joined in order by marks, are aligned with the template; a piece stays if it is like the template's part beside it.
    Sequences without an overlap stay whole, those with a piece of another length than the template lose all.
    """
    key = ["aln_id", "seq_id", "group_no"]
    filled = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: (x != "-").cast("int"))
    rows = pieces.join(templates, ["aln_id", "group_no"])
    items = F.array_sort(F.collect_list(F.struct("piece_no", "seq")))
    own = rows.groupBy(*key).agg(F.first("template").alias("template"), F.bool_and(F.length("seq") == F.length("template")).alias("whole"), items.alias("items")).where("whole")
    added = F.aggregate("items", F.array_repeat(F.lit(0), F.length("template")), lambda s, x: F.zip_with(s, filled(x["seq"]), lambda p, q: p + q))
    own = own.withColumn("hit", F.exists(added, lambda n: n > 1))
    bare = lambda c: F.replace(c, F.lit("-"), F.lit(""))
    joined = F.array_join(F.transform("items", lambda x: bare(x["seq"])), "Z")
    pairs = own.where("hit").select(*key, "items", F.struct(*key).alias("a_id"), F.lit(0).alias("b_id"), bare(F.col("template")).alias("first"), joined.alias("second"))
    lined = align(pairs, REPAIR_GAPS.opening, REPAIR_GAPS.extending)
    parts = F.split("second", "Z")
    start = lambda i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda s, p: s + F.length(p) + 1)
    beside = F.transform("items", lambda x, i: F.struct(x["piece_no"].alias("piece_no"), F.get(parts, i).alias("b"), F.substring(F.col("first"), start(i) + 1, F.length(F.get(parts, i))).alias("a")))
    tidy = lambda c: F.replace(c, F.lit(GAP), F.lit("-"))
    scored = lined.select(*key, F.inline(beside)).select(*key, "piece_no", tidy("a").alias("a"), tidy("b").alias("b"))
    alike = scored.where(S.tanimoto(F.col("a"), F.col("b")) >= least).select(*key, "piece_no")
    alone = own.where("not hit").select(*key, F.explode("items.piece_no").alias("piece_no"))
    return pieces.join(alike.unionByName(alone), [*key, "piece_no"], "left_semi")


def _decorated(slices: np.ndarray, reference: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, columns, profile) of a slice's reference row with its exons decorated.

    A residue or gap keeps its column; the marks of a decoration and the last Z have column -1. The profile's scores are
    the sums over all rows, so they grow with the rows as the gap penalties do.
    """
    letters, columns, number = [], [], 0

    def decorate() -> None:
        nonlocal number
        number += 1
        letters.extend(f"B{number:03d}".encode())
        columns.extend([-1] * 4)

    decorate()
    for at, letter in enumerate(slices[reference]):
        letters.append(letter)
        columns.append(at)
        if letter == BOUND:
            decorate()
    letters, columns = np.array([*letters, BOUND], np.uint8), np.array([*columns, -1])
    profile = len(slices) * table[letters].astype(np.int64)
    real = columns >= 0
    # letters are counted by column, so no table of rows, columns and scores arises
    shown = slices[:, columns[real]]
    counts = np.bincount((np.arange(shown.shape[1]) * 128 + shown).ravel(), minlength=128 * shown.shape[1]).reshape(-1, 128)
    profile[real] = counts @ table.astype(np.int64)
    return letters, columns, profile


def realigned(slices: np.ndarray, reference: int, pieces: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, row): a slice of an alignment with room for the pieces, and the row of the pieces in it.

    The pieces, decorated as exons, are aligned with all columns of the slice at once. What is a mark of a decoration on
    one side alone leaves no column; the boundaries between pieces stay as Z.
    """
    letters, columns, profile = _decorated(slices, reference, table)
    second = np.frombuffer("".join(f"B{k:03d}{piece}Z" for k, piece in enumerate(pieces, 1)).encode("ascii", "replace"), np.uint8) & 127
    gaps = Gaps(REPAIR_GAPS.opening * len(slices), REPAIR_GAPS.extending * len(slices))
    matches = best_path(profile, second, (_between(letters), _between(second)), gaps)
    shown = np.isin(second, np.frombuffer(b"B0123456789", np.uint8), invert=True)
    shown[-1] = False
    source, row, p, q = [], [], 0, 0
    for i, j in [*matches, (len(letters), len(second))]:
        kept, new = [c for c in columns[p:i] if c >= 0], [c for c, s in zip(second[q:j], shown[q:j]) if s]
        source += kept + [-1] * len(new)
        row += [BLANK] * len(kept) + new
        if i < len(letters) and (columns[i] >= 0 or shown[j]):
            source.append(columns[i])
            row.append(second[j] if shown[j] else BLANK)
        p, q = i + 1, j + 1
    source = np.array(source, np.int64)
    out = np.where(source >= 0, slices[:, source], BLANK).astype(np.uint8)
    return out, np.array(row, np.uint8)


def _slice_of(row: np.ndarray, first: int, last: int) -> tuple[int, int] | None:
    """Columns from the start of a row's exon ``first`` to the end of its exon ``last``, counted by its marks."""
    z = np.flatnonzero(row == BOUND)
    if last > len(z):
        return None
    return int(z[first - 1]) + 1 if first else 0, int(z[last]) if last < len(z) else len(row)


def repair(rows: list[str], reference: int, target: int, groups: list[tuple[int, int, list[str]]], n_exons: int, clean_slice: bool, table: np.ndarray) -> list[str] | None:
    """The alignment after a sequence's groups (first and last reference exon, pieces) are aligned anew; None if it fails.

    It fails where a group lies behind the reference's last exon, where rows differ in length, and where the number of
    exons with residues in the row is not ``n_exons`` at the end. Boundaries are cleaned after every group, columns of
    gaps only go; with ``clean_slice`` the slice's boundaries are cleaned by itself before that.
    """
    if len({len(r) for r in rows}) != 1:
        return rows if not groups and _whole(rows[target], n_exons) else None
    after = _repaired(_matrix(rows), reference, target, groups, n_exons, clean_slice, table)
    return None if after is None else _rows(after)


def _whole(row: str, n_exons: int) -> bool:
    return sum(bool(piece.strip("-")) for piece in row.split("Z")) == n_exons


def _repaired(m: np.ndarray, reference: int, target: int, groups: list[tuple[int, int, list[str]]], n_exons: int, clean_slice: bool, table: np.ndarray) -> np.ndarray | None:
    keep = np.arange(len(m)) != target
    for first, last, pieces in groups:
        span = _slice_of(m[reference], first, last)
        if span is None or not pieces:
            return None
        others, row = realigned(m[keep, span[0] : span[1]], reference - (target < reference), pieces, table)
        part = np.insert(others, target, row, axis=0)
        if clean_slice and part.shape[1]:
            part = _cleaned(part)
        m = np.concatenate([m[:, : span[0]], part, m[:, span[1] :]], axis=1)
        m = _cleaned(m) if m.shape[1] else m
        # a mark keeps its gaps where a column of gaps beside it has gone
        m = _with_gaps_at_marks(m[:, (m != BLANK).any(axis=0)])
    return m if _whole(m[target].tobytes().decode("ascii"), n_exons) else None


def repaired(aln: DataFrame, references: DataFrame, exons: DataFrame, clean_slice: bool = False) -> DataFrame:
    """(aln_id, seq_id, seq, repaired): alignments in which exons that share reference exons are aligned anew, group by group.

    ``aln`` is (aln_id, seq_id, seq, rank), ``references`` (aln_id, target_id), ``exons`` the settled exons of the
    sequences to repair: (aln_id, seq_id, piece_no, group_no, first_ref, last_ref, pep); exons in no group (null) only
    count. Sequences are repaired by rank, groups by their first reference exon, each on what the one before left; a
    sequence whose repair fails keeps its row and all others theirs. One alignment and its exons are one group of work.
    """
    kinds = {f.name: f.dataType.simpleString() for f in aln.schema}
    schema = f"aln_id {kinds['aln_id']}, seq_id {kinds['seq_id']}, seq string, repaired boolean"

    def work(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        group = group[group["seq"].notna()].sort_values(["rank", "seq_id"], kind="stable")
        names, rows = group["seq_id"].tolist(), group["seq"].tolist()
        m = _matrix(rows) if rows and len({len(r) for r in rows}) == 1 else None
        place = {name: i for i, name in reversed(list(enumerate(names)))}
        done = set()
        target = place.get(own["target_id"].iloc[0]) if len(own) else None
        table = scores()
        by_name = dict(list(own.groupby("seq_id"))) if len(own) else {}
        for name in [n for n in sorted(place, key=place.get) if n in by_name and target is not None and place[n] != target]:
            mine = by_name[name].sort_values(["piece_no"], kind="stable")
            groups = [(int(g["first_ref"].min()), int(g["last_ref"].max()), g["pep"].tolist()) for _, g in mine[mine["group_no"].notna()].groupby("group_no")]
            after = _repaired(m, target, place[name], sorted(groups, key=lambda g: g[:2]), len(mine), clean_slice, table) if groups and m is not None else None
            if after is not None:
                m = after
                done.add(place[name])
        rows = _rows(m) if done else rows
        return group[["aln_id", "seq_id"]].assign(seq=pd.Series(rows, group.index, object), repaired=pd.Series([i in done for i in range(len(names))], group.index, bool))

    known = exons.join(references, "aln_id")
    known = known.select(*(F.col(c).alias(c) for c in known.columns))  # columns of its own, where both come from one table
    return _apart(aln).groupBy("aln_id").cogroup(_apart(known).groupBy("aln_id")).applyInPandas(work, schema)
