"""Boundaries and repaired exons against versions that work on one text and one cell at a time."""

import random
import re

from pyspark.sql import functions as F

from strandweave.adapters import Inputs
from strandweave.functions import sequence as S
from strandweave.operators import pairwise as W
from strandweave.operators import repair
from strandweave.plans import registry, tracks

SF = "/root/testdata/sf0.001"


def put(rows, at, gaps, marked_at=None, mark=None):
    """Gaps into every text at one place, at another in those that have a mark there."""
    return [r[:p] + "-" * gaps + r[p:] for r in rows for p in [marked_at if mark is not None and r[mark : mark + 3] == "-Z-" else at]]


def slide(row, bounds):
    for m in [m.start() for m in re.finditer("-Z-", row)]:
        if m in bounds:
            continue
        for to in bounds:
            if m < to and row[m + 3 : to + 3] == "-" * (to - m):
                row = row[:m] + "-" * (to - m) + "-Z-" + row[to + 3 :]
                break
            if m > to and row[to:m] == "-" * (m - to):
                row = row[:to] + "-Z-" + "-" * (m - to) + row[m + 3 :]
                break
    return row


def plain_cleaned(rows):
    rows = list(rows)
    for r in range(len(rows)):
        at = 0
        while at < len(rows[r]):
            if rows[r][at] == "Z" and at and rows[r][at - 1] != "-":
                rows = put(rows, at, 1)
                at += 1
            if rows[r][at] == "Z" and at + 1 < len(rows[r]) and rows[r][at + 1] != "-":
                # a Z behind this one is parted from it by a gap of its own, too
                rows = put(rows, at + 1, 2 if rows[r][at + 1] == "Z" else 1)
            at += 1
    bounds = []
    for a in range(len(rows)):
        bounds = sorted({*bounds, *(m.start() for m in re.finditer("-Z-", rows[a]))})
        rows = [row if r == a else slide(row, bounds) for r, row in enumerate(rows)]
        for r in range(len(rows)):
            for k in range(len(bounds)):
                p = bounds[k]
                cell = rows[r][p : p + 3]
                if r == a or "Z" in cell or set(cell) <= {"-"} or p + 3 >= len(rows[r]):
                    continue
                if cell[0] == "-" or ("-" not in cell and (p == 0 or rows[r][p - 1] == "-")):
                    lead = len(cell) - len(cell.lstrip("-"))
                    rows = put(rows, p + lead, 3 - lead, p + 3, p)
                    bounds = [b + 3 - lead if b > p else b for b in bounds]
                elif cell[2] == "-" or "-" not in cell:
                    tail = len(cell) - len(cell.rstrip("-"))
                    rows = put(rows, p + 3 - tail, 3 - tail, p, p)
                    bounds = [b + 3 - tail if b >= p else b for b in bounds]
        rows = [row if r == a else slide(row, bounds) for r, row in enumerate(rows)]
    return rows


def test_boundaries_against_one_text_at_a_time():
    rnd = random.Random(11)
    for n in range(300):
        width = rnd.randrange(1, 30)
        rows = ["".join(rnd.choice("AC----Z" if n % 2 else "ACDE--") for _ in range(width)) for _ in range(rnd.randrange(1, 6))]
        if n % 2 == 0:
            rows = [r[:k] + "-Z-" + r[k:] for r in rows for k in [rnd.randrange(width + 1)]]
        got = repair.cleaned(rows)
        assert got == plain_cleaned(rows), rows
        assert [r.replace("-", "") for r in got] == [r.replace("-", "") for r in rows] and len({len(r) for r in got}) == 1


def test_boundaries_at_ends_double_gaps_and_nested():
    assert repair.cleaned([]) == [] and repair.cleaned([""]) == [""] and repair.cleaned(["AB", "A"]) == ["AB", "A"]
    assert repair.cleaned(["ZAB", "---"]) == ["Z-AB", "----"]
    assert repair.cleaned(["ABZ", "---"]) == ["AB-Z", "----"]
    assert repair.cleaned(["A--Z--B", "A-Z---B"]) == ["A--Z--B", "A--Z--B"]
    assert repair.cleaned(["AA-Z-CC", "AAACCCC"])[0].replace("-", "") == "AAZCC"
    nested = repair.cleaned(["AA-Z-CC-Z-DD", "AACCCCC-Z-DD", "AA-Z-CCDDDDD"])
    z = [[m.start() for m in re.finditer("Z", r)] for r in nested]
    assert set(z[1]) <= set(z[0]) and set(z[2]) <= set(z[0])


def test_registered_boundaries(spark):
    x = Inputs(spark, SF)
    alns = {}
    for r in tracks.ranked_rows(x).orderBy("rank").collect():
        if r.aln_id is not None:
            alns.setdefault(r.aln_id, []).append((r.seq_id, r.seq))
    got = {(r.aln_id, r.seq_id): r.seq for r in registry.queries()["ALN-10"](spark, SF).collect() if r.aln_id is not None}
    want = {(a, s): t for a, rows in alns.items() for (s, _), t in zip(rows, plain_cleaned([t for _, t in rows]))}
    assert got == want and want


def cell_by_cell(columns, second, n):
    """Profile alignment of decorated columns [(letter, texts)] with a text, every cell by itself; matched places."""
    table = W.scores()
    a = "".join(c for c, _ in columns)
    score = lambda i, c: sum(int(table[ord(x), ord(c)]) for x in columns[i][1])
    inside = lambda s, k: max(s.rfind("B", 0, k), -1) > s.rfind("Z", 0, k)
    f, way, best = {(0, 0): 0}, {}, (0, 0, 0)
    for i in range(len(a) + 1):
        for j in range(len(second) + 1):
            if i == j == 0:
                continue
            if not i or not j:
                f[i, j], way[i, j] = 0, "i" if i else "j"
                continue
            options = [(f[i - 1, j - 1] + score(i - 1, second[j - 1]), "d")]
            options.append((f[i - 1, j] + (-3 * n if inside(second, j) and way[i - 1, j] != "i" else 0), "i"))
            options.append((f[i, j - 1] + (-3 * n if inside(a, i) and way[i, j - 1] != "j" else 0), "j"))
            top = max(options, key=lambda o: o[0])
            f[i, j], way[i, j] = max(0, top[0]), top[1]
            if f[i, j] > best[0]:
                best = (f[i, j], i, j)
    _, i, j = best
    out = []
    while i and j:
        w = way[i, j]
        i, j = i - (w != "j"), j - (w != "i")
        if w == "d":
            out.append((i, j))
    return out[::-1]


def plain_repair(rows, ref, target, groups, n_exons, clean_slice):
    for first, last, pieces in groups:
        z = [-1] + [m.start() for m in re.finditer("Z", rows[ref])] + [len(rows[ref])]
        if last + 1 >= len(z):
            return None
        lo, hi = z[first] + 1, z[last + 1]
        others = [r[lo:hi] for i, r in enumerate(rows) if i != target]
        me = ref - (target < ref)
        columns, k = [], 1
        mark = lambda text: [(c, c * len(others)) for c in text]
        columns += mark(f"B{k:03d}")
        for p in range(hi - lo):
            columns.append((others[me][p], [o[p] for o in others], p))
            if others[me][p] == "Z":
                k += 1
                columns += mark(f"B{k:03d}")
        columns += mark("Z")
        second = "".join(f"B{i + 1:03d}{p}Z" for i, p in enumerate(pieces))
        cells, p, q = [], 0, 0
        for i, j in [*cell_by_cell([c[:2] for c in columns], second, len(others)), (len(columns), len(second))]:
            cells += [([o[c[2]] for o in others], "-") for c in columns[p:i] if len(c) == 3]
            cells += [(["-"] * len(others), c) for at, c in enumerate(second[q:j], q) if c not in "B0123456789" and at < len(second) - 1]
            if i < len(columns):
                c = second[j] if second[j] not in "B0123456789" and j < len(second) - 1 else "-"
                if len(columns[i]) == 3:
                    cells.append(([o[columns[i][2]] for o in others], c))
                elif c != "-":
                    cells.append((["-"] * len(others), c))
            p, q = i + 1, j + 1
        part = ["".join(c[0][o] for c in cells) for o in range(len(others))]
        part.insert(target, "".join(c[1] for c in cells))
        part = plain_cleaned(part) if clean_slice else part
        rows = plain_cleaned([r[:lo] + s + r[hi:] for r, s in zip(rows, part)])
        keep = [p for p in range(len(rows[0])) if any(r[p] != "-" for r in rows)]
        rows = ["".join(r[p] for p in keep) for r in rows]
        for r in range(len(rows)):
            at = 0
            while at < len(rows[r]):
                if rows[r][at] == "Z" and at and rows[r][at - 1] != "-":
                    rows = put(rows, at, 1)
                    at += 1
                if rows[r][at] == "Z" and at + 1 < len(rows[r]) and rows[r][at + 1] != "-":
                    rows = put(rows, at + 1, 2 if rows[r][at + 1] == "Z" else 1)
                at += 1
    return rows if sum(bool(p.strip("-")) for p in rows[target].split("Z")) == n_exons else None


def test_repair_against_cell_by_cell():
    rnd = random.Random(7)
    done = 0
    for n in range(60):
        exons = ["".join(rnd.choice("ARNDCQEGHILKMFPSTWYV") for _ in range(rnd.randrange(4, 12))) for _ in range(3)]
        change = lambda e: "".join(c if rnd.random() < 0.8 else rnd.choice("ARND-") for c in e)
        rows = ["-Z-".join(change(e) for e in exons) for _ in range(rnd.randrange(2, 5))]
        target = rnd.randrange(len(rows))
        ref = (target + 1) % len(rows)
        cut = rnd.randrange(1, len(exons[0]))
        groups = [(0, 1, [exons[0][:cut], exons[0][cut:] + exons[1]])] if n % 2 else [(0, 0, [exons[0]]), (1, 2, [exons[1], exons[2]])]
        count = 3
        got = repair.repair(rows, ref, target, groups, count, n % 3 == 0, W.scores())
        want = plain_repair(rows, ref, target, groups, count, n % 3 == 0)
        assert got == want
        if got:
            done += 1
            pieces = [p for g in groups for p in g[2]]
            if n % 2 == 0:
                assert got[target].replace("-", "") == "Z".join(pieces)
            assert [r.replace("-", "") for i, r in enumerate(got) if i != target] == [r.replace("-", "") for i, r in enumerate(rows) if i != target]
    assert done > 30
    assert repair.repair(["AA-Z-CC", "AA-Z-CC"], 0, 1, [(0, 5, ["AA"])], 1, False, W.scores()) is None
    assert repair.repair(["AA", "AAA"], 0, 1, [(0, 0, ["AA"])], 1, False, W.scores()) is None
    # an exon too many: the alignment stays
    assert repair.repair(["AA-Z-CC", "AA-Z-CC"], 0, 1, [(0, 1, ["AA", "CC"])], 3, False, W.scores()) is None


def test_registered_repairs(spark):
    x = Inputs(spark, SF)
    alns, exons = {}, {}
    for r in tracks.ranked_rows(x).orderBy("rank").collect():
        alns.setdefault(r.aln_id, []).append((r.seq_id, r.seq))
    for r in tracks.exons_to_repair(x).orderBy("piece_no").collect():
        exons.setdefault((r.aln_id, r.seq_id), []).append(r)
    for name, clean in (("ALN-12", False), ("ALN-12-paralogue", True)):
        got = {}
        for r in registry.queries()[name](spark, SF).collect():
            got.setdefault(r.aln_id, {})[r.seq_id] = (r.seq, r.repaired)
        assert sum(v[1] for a in got.values() for v in a.values()) > 20
        for aln_id in [a for a in alns if a is not None][:12]:
            names, rows, fixed = [s for s, _ in alns[aln_id]], [t for _, t in alns[aln_id]], set()
            for i, s in enumerate(names):
                own = exons.get((aln_id, s), [])
                if i and own:
                    grouped = [e.pep for e in own if e.group_no is not None]
                    after = plain_repair(rows, 0, i, [(0, 1, grouped)], len(own), clean) if grouped else None
                    rows, fixed = (after, fixed | {i}) if after else (rows, fixed)
            assert got[aln_id] == {s: (t, i in fixed) for i, (s, t) in enumerate(zip(names, rows))}


def test_repair_of_odd_tables(spark):
    aln = spark.createDataFrame([("a", 1, "AA-Z-CC", 1), ("a", 2, None, 2), ("a", 3, "AA-Z-CC", 2), ("b", 1, "", 1), (None, 1, "A", 1)], "aln_id string, seq_id long, seq string, rank int")
    refs = spark.createDataFrame([("a", 1), ("b", 1)], "aln_id string, target_id long")
    exons = spark.createDataFrame([("a", 3, 0, 0, 0, 1, "AA"), ("a", 3, 1, 0, 0, 1, "CC"), ("c", 1, 0, 0, 0, 0, "A")], "aln_id string, seq_id long, piece_no int, group_no int, first_ref int, last_ref int, pep string")
    got = {(r.aln_id, r.seq_id): (r.seq, r.repaired) for r in repair.repaired(aln, refs, exons).collect()}
    assert got == {("a", 1): ("AA-Z-CC", False), ("a", 3): ("AA-Z-CC", True), ("b", 1): ("", False), (None, 1): ("A", False)}
    assert repair.repaired(aln.limit(0), refs, exons).count() == 0 and repair.clean_boundaries(aln.limit(0)).count() == 0
    assert repair.repaired(aln, refs, exons.limit(0)).where("repaired").count() == 0


def tanimoto(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    from pyspark.sql import functions as F

    return [r.t for r in rows.select("i", S.tanimoto(F.col("a"), F.col("b")).alias("t")).orderBy("i").collect()]


def test_alike_pieces_against_one_sequence_at_a_time(spark):
    x = Inputs(spark, SF)
    own, templates = {}, {r.aln_id: r.template for r in tracks.piece_templates(x).collect()}
    for r in tracks.several_pieces(x).orderBy("piece_no").collect():
        if r.aln_id in templates:
            own.setdefault((r.aln_id, r.seq_id), []).append((r.piece_no, r.seq))
    want, asked = set(), []
    for (aln, seq), pieces in own.items():
        hit = any(sum(p[1][c] != "-" for p in pieces) > 1 for c in range(len(templates[aln])))
        if not hit:
            want |= {(aln, seq, k) for k, _ in pieces}
            continue
        bare = [p.replace("-", "") for _, p in pieces]
        a, b = W.align_pair(templates[aln].replace("-", ""), "Z".join(bare), -3, 0, W.scores())
        at = 0
        for (k, _), part in zip(pieces, b.split("Z")):
            asked.append(((aln, seq, k), a[at : at + len(part)].replace("#", "-"), part.replace("#", "-")))
            at += len(part) + 1
    want |= {key for (key, *_), t in zip(asked, tanimoto(spark, [x[1:] for x in asked])) if t is not None and t >= 0.33333}
    got = {tuple(r) for r in registry.queries()["ALN-11-alike"](spark, SF).collect()}
    assert got == want and len(want) > 20


def test_rows_without_news_are_not_visited_again(monkeypatch):
    """With two kinds of marks the visits grow with the rows, not with their square."""
    visits = []
    moved, room = repair._moved, repair._make_room
    monkeypatch.setattr(repair, "_moved", lambda *args: (visits.append(1), moved(*args))[1])
    monkeypatch.setattr(repair, "_make_room", lambda *args: (visits.append(1), room(*args))[1])
    rows = ["ACDE-Z-AC-Z-DE" if i % 2 else "AC-Z-DEACDEACD" for i in range(300)]
    out = repair.cleaned(rows)
    assert [r.replace("-", "").replace("Z", "") for r in out] == [r.replace("-", "").replace("Z", "") for r in rows]
    assert len(visits) < 10 * len(rows)


def test_small_alignments_are_spread_over_tasks(spark):
    """Few bytes are not put together to one task."""
    rows = spark.createDataFrame([(f"a{k}", i, "AC-Z-DE", i) for k in range(40) for i in range(3)], "aln_id string, seq_id long, seq string, rank long")
    refs = rows.select("aln_id", F.lit(0).cast("long").alias("target_id")).distinct()
    exons = rows.where("seq_id = 1").select("aln_id", "seq_id", F.lit(0).alias("piece_no"), F.lit(0).alias("group_no"), F.lit(0).alias("first_ref"), F.lit(1).alias("last_ref"), F.lit("AC").alias("pep"))
    for made in (repair.clean_boundaries(rows), repair.repaired(rows, refs, exons)):
        assert made.groupBy(F.spark_partition_id()).count().count() >= 8


def test_marks_that_cannot_move_are_not_tried(monkeypatch):
    """A row whose marks have residues on both sides is visited for no anchor; rows that can move still do."""
    rows = ["AC-Z-GTACGTAC"] + ["ACGTAC-Z-GTAC"] * 50 + ["AC---GT-Z-TAC", "ACG-Z---GTACG"]
    tried = []
    moved = repair._moved
    monkeypatch.setattr(repair, "_moved", lambda row, bounds: tried.append(1) or moved(row, bounds))
    got = repair.cleaned(rows)
    assert len(tried) < 50 and len({len(r) for r in got}) == 1
    assert [r.replace("-", "") for r in got] == [r.replace("-", "") for r in rows]
