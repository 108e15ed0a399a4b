"""Novel exons cleaned up one at a time."""

from math import log2

from strandweave.adapters import Inputs
from strandweave.functions import sequence as S
from strandweave.operators import splicing as Y
from strandweave.plans import mapping, registry

SF = "/root/testdata/sf0.001"


def peptide(dna, mitochondrial=False):
    table = S.MITOCHONDRIAL if mitochondrial else S.STANDARD
    place = lambda c: 16 * S.BASES.index(c[0]) + 4 * S.BASES.index(c[1]) + S.BASES.index(c[2])
    return "".join(table[place(dna[i : i + 3])] if set(dna[i : i + 3]) <= set(S.BASES) else "X" for i in range(0, len(dna) - 2, 3))


def consensus(site, at, shares):
    return sum(log2(s[c] / Y.BACKGROUND[c]) for s, c in zip(shares, site[at : at + 2])) if set(site[at : at + 2]) <= set("ACGT") else None


def acceptor(site, tables):
    rest = site[:18] + site[20:]
    words = [tables.get((k, rest[a : a + n])) for k, (a, n) in enumerate(Y.PARTS)]
    base = consensus(site, 18, Y.ACCEPTOR)
    return None if base is None or None in words else base + sum((1 if k < 5 else -1) * log2(v) for k, v in enumerate(words))


def donor(site, table):
    value, base = table.get(site[:3] + site[5:9]), consensus(site, 3, Y.DONOR)
    return None if base is None or value is None else base + log2(value)


def best(text, zero, low, high, before, behind, score, least):
    tried = [s for s in range(low, high) if zero + s - before >= 0 and zero + s + behind <= len(text) and "N" not in text[zero + s - before : zero + s + behind]]
    scored = [(round(v, 9), -s) for s in tried if (v := score(text[zero + s - before : zero + s + behind])) is not None]
    if not scored or max(scored)[0] < least or -max(scored)[1] == tried[0]:
        return None, None
    return -max(scored)[1], max(scored)[0]


def clean(e, acceptors, donors):
    left, dna, right, pep = (x or "" for x in (e.left_flank, e.dna, e.right_flank, e.pep))
    template, cut_left, cut_right = e.template_dna or "", 0, 0
    if e.transl_end - e.transl_start != len(dna):
        cut_left, cut_right = e.transl_start, len(dna) - e.transl_end
        left, right, dna = left + dna[: e.transl_start], dna[e.transl_end :] + right, dna[e.transl_start : e.transl_end]
    if k := len(dna) % 3:
        if peptide(dna[k:]) == pep:
            left, dna, cut_left = left + dna[:k], dna[k:], cut_left + k
        elif peptide(dna[:-k]) == pep:
            right, dna, cut_right = dna[-k:] + right, dna[:-k], cut_right + k
        else:
            return None
    apart, shorter = abs(len(dna) - len(template)), len(dna) < len(template)
    out, in_ = (10 + apart, 10) if shorter else (10, 10 + apart)
    l, ls = None, None
    if e.is_first:
        if (e.template_pep or "").startswith("M"):
            whole, joint = left + dna, len(left)
            up, down = (12 + (apart if shorter else 0)) // 3, (12 + (0 if shorter else apart)) // 3
            places = [joint] if dna.startswith("ATG") else [joint - 3 * i for i in range(1, up + 1)] + [joint + 3 * i for i in range(down + 1)]
            l = next((p - joint for p in places if p >= 0 and whole[p : p + 3] == "ATG"), None)
    else:
        l, ls = best(left + dna, len(left), -out, in_, 20, 3, lambda s: acceptor(s, acceptors), 3.0)
        l, ls = (l, ls) if ls is not None and ls >= 6.0 else (None, None)
    r, rs = best(dna + right, len(dna), -in_, out, 3, 9, lambda s: donor(s[:9], donors), 3.0)
    r = None if r is None else r + 1
    whole, a, z = left + dna + right, len(left) + (l or 0), len(left) + len(dna) + (r or 0)
    if not 0 <= a < z <= len(whole):
        return None
    phase = (l or 0) % 3 if l is not None and not e.is_first else 0
    end_phase = (r or 0) % 3 if r is not None else 0
    first, last = (3 - phase) % 3 if l is not None else 0, z - a - end_phase
    over = (last - first) % 3
    if l is not None and r is None:
        end_phase, last = over, last - over
    if r is not None and l is None:
        phase, first = over, first + over
    if last < first or (last - first) % 3:
        return None
    new = peptide(whole[a:z][first:last], e.is_mitochondrial)
    if "*" in new and "*" not in pep:
        return None
    return whole[:a], whole[a:z], whole[z:], new, first, last, phase, end_phase, ls, rs, (l or 0) + cut_left, (r or 0) - cut_right


def plain(r):
    return (r.left_flank, r.dna, r.right_flank, r.pep, r.transl_start, r.transl_end, r.phase, r.end_phase, r.left_score, r.right_score, r.start_shift, r.end_shift)


def test_cleanup_of_novel_exons(spark):
    x = Inputs(spark, SF)
    acceptors = {(r.part, r.word): r.value for r in mapping.whole_acceptor_tables(x).collect()}
    donors = {r.word: r.value for r in mapping._donor_table(x).collect()}
    exons = mapping.novel_exons(x)
    want = {e.exon_id: clean(e, acceptors, donors) for e in exons.collect()}
    got = {r.exon_id: plain(r) for r in registry.queries()["SEQ-25"](spark, SF).collect()}
    assert got == {k: v for k, v in want.items() if v is not None}
    assert sum(v is None for v in want.values()) > 0 and sum(v[10] != 0 for v in got.values()) > 5 and sum(v[11] != 0 for v in got.values()) > 5


def test_cleanup_of_odd_exons(spark):
    site, late = "CT" * 9 + "AG" + "ATG", "ATG" + "GTAAGT" + "AAA"
    tables = {(k, (site[:18] + site[20:])[a : a + n]): 8.0 if k < 5 else 1.0 for k, (a, n) in enumerate(Y.PARTS)}
    donors = {"ATG" + "AAGT": 8.0}
    rows = [
        (1, "C" * 10 + site[:20], "ATGAAACATG", "GTAAGTAAAC", "MKH", 0, 10, "ATGAAACATG", "MKH", False, False),
        (2, "", "", "", "", 0, 0, "", "", False, False), (3, None, None, None, None, 0, 0, None, None, True, False),
        (4, "CCCCCCATG", "CCCATGAAA", "CC", "PMK", 0, 9, "ATGCCCATGAAA", "MPMK", True, False), (5, "A", "TTATGAAATAAC", "A", "MK*", 2, 11, "ATG", "M", False, True),
        (6, "N" * 40, "ATGNNNATG", "N" * 20, "MXM", 0, 9, "ATGATGATG", "MMM", False, False), (7, "A", "ATGA", "A", "Q", 0, 4, "ATG", "M", False, False),
    ]
    exons = spark.createDataFrame([(*r, "z") for r in rows], "exon_id long, left_flank string, dna string, right_flank string, pep string, transl_start int, transl_end int, template_dna string, template_pep string, is_first boolean, is_mitochondrial boolean, whole string")
    run = lambda e: {r.exon_id: plain(r) for r in Y.cleaned_exons(e, spark.createDataFrame([(k, w, v) for (k, w), v in tables.items()], "part int, word string, value double"), spark.createDataFrame([*donors.items()], "word string, value double")).collect()}
    want = {e.exon_id: clean(e, tables, donors) for e in exons.collect()}
    assert run(exons) == {k: v for k, v in want.items() if v is not None} and 7 not in run(exons)
    assert run(exons.limit(0)) == {}


def test_equal_donor_scores_go_to_the_first_site(spark):
    """Odds that are equal but for the last bit of their sums: the least shift counts."""
    first, second = "AAAAGAAAA", "AAAGAACCC"
    gap = consensus(second, 3, Y.DONOR) - consensus(first, 3, Y.DONOR)
    table = spark.createDataFrame([("AAAAAAA", 2.0**gap * (1 + 1e-12)), ("AAAACCC", 1.0 + 3e-12)], "word string, value double")
    windows = spark.createDataFrame([(1, "NN" + first + "N" + second), (2, "N" + second + "N" + first)], "window_id long, text string")
    got = {r["window_id"]: r["shift"] for r in Y.best_donor(windows, table, -100.0).collect()}
    assert got == {1: 2, 2: 1}


def test_slices_are_written_once_a_query(spark):
    x = Inputs(spark, SF)
    texts = [mapping.novel_exons(x), mapping.whole_acceptor_tables(x), mapping._donor_table(x), mapping.hits(x)]
    files = {f for df in texts for f in df.inputFiles()}
    assert files and not any("documents.parquet" in f for f in files) and len({f.rsplit("/", 1)[0] for f in files}) == 1
