"""Tracks of transcripts against a layout letter by letter."""

import random

from test_splicing import peptide

from strandweave.adapters import Inputs
from strandweave.operators import tracks as T
from strandweave.plans import registry, tracks

SF = "/root/testdata/sf0.001"


def plain_tracks(seq, transcripts, inside, flank=10):
    """{transcript: (dna, pep)} of one gene; transcripts: {id: [(start, end)]}, inside: {id: (first, last)}."""
    n, dna, pep, ends = len(seq), {}, {}, {}
    for t, exons in transcripts.items():
        exons = [(s, min(e, n)) for s, e in exons if 0 <= s < e and s < n]
        if not exons:
            continue
        row, line, ends[t] = ["-"] * n, ["-"] * n, set()
        for s, e in exons:
            for p in range(max(0, s - flank), min(n, e + flank)):
                row[p] = row[p] if row[p].isupper() else seq[p].upper() if s <= p < e else seq[p].lower()
            ends[t] |= ({s - flank} if s >= flank else set()) | ({e + flank} if e + flank <= n else set())
        first, last = inside.get(t, (0, 0))
        coding = [p for p in range(max(0, first), min(n, last)) if row[p].isupper()]
        for k, aa in enumerate(peptide("".join(seq[p].upper() for p in coding))):
            line[coding[3 * k + 1]] = aa
        dna[t], pep[t] = row, line
    marks = set().union(*ends.values()) if ends else set()
    shown = [p for p in range(n) if any(r[p] != "-" for r in dna.values())]
    out = {}
    for t in dna:
        texts = []
        for row in (dna[t], pep[t]):
            at = {p: row[p] for p in shown}
            texts.append("".join((("-Z-" if p in ends[t] else "---") if p in marks else "") + at.get(p, "") for p in range(n + 1)))
        out[t] = tuple(texts)
    return out


def run(spark, rows, inside, genes):
    got = T.transcript_tracks(spark.createDataFrame(rows, "gene_id long, transcript_id long, start long, end long"), spark.createDataFrame(inside, "transcript_id long, first long, last long"), spark.createDataFrame(genes, "gene_id long, seq string"))
    return {(r.gene_id, r.transcript_id): (r.dna, r.pep) for r in got.collect()}


def test_tracks_against_letters(spark):
    rnd = random.Random(21)
    genes = {g: "".join(rnd.choice("ACGT") for _ in range(rnd.randrange(30, 220))) for g in range(25)}
    transcripts = {g: {10 * g + t: [(s, s + rnd.randrange(1, 40)) for s in (rnd.randrange(0, 200) for _ in range(rnd.randrange(1, 5)))] for t in range(3)} for g in genes}
    inside = {t: tuple(sorted(rnd.sample(range(0, 230), 2))) for own in transcripts.values() for t in own if rnd.random() < 0.8}
    got = run(spark, [(g, t, s, e) for g, own in transcripts.items() for t, exons in own.items() for s, e in exons], [(t, *x) for t, x in inside.items()], list(genes.items()))
    assert got == {(g, t): x for g, own in transcripts.items() for t, x in plain_tracks(genes[g], own, inside).items()}


def test_tracks_of_a_known_gene_and_odd_tables(spark):
    seq = "C" * 20 + "ATGAAA" + "G" * 30 + "TTTTAA" + "C" * 20
    rows = [(1, 1, 20, 26), (1, 1, 56, 62), (1, 2, 20, 26), (1, 2, 20, 26), (2, 3, 0, 5), (1, 4, 500, 600), (1, 5, 9, 9)]
    got = run(spark, rows, [(1, 20, 62), (2, 20, 26), (9, 1, 2)], [(1, seq), (3, "A")])
    assert got[1, 1][0] == "-Z-ccccccccccATGAAAgggggggggg-Z--Z-ggggggggggTTTTAAcccccccccc-Z-" and got[1, 1][1].replace("Z", "").replace("-", "") == "MKF*"
    assert got[1, 2][1].replace("-", "").replace("Z", "") == "MK" and set(got) == {(1, 1), (1, 2)}
    assert run(spark, [], [], []) == {}


def test_registered_tracks(spark):
    x = Inputs(spark, SF)
    genes = {r.seq_id: r.dna for r in x.x_seq.select("seq_id", "dna").collect()}
    transcripts, inside = {}, {r.transcript_id: (r.first, r.last) for r in tracks.transcript_translations(x).collect()}
    for r in tracks.transcript_exons(x).collect():
        if r.gene_id in genes:
            transcripts.setdefault(r.gene_id, {}).setdefault(r.transcript_id, []).append((r.start, r.end))
    got = {(r.gene_id, r.transcript_id): (r.dna, r.pep) for r in registry.queries()["SEQ-28"](spark, SF).collect()}
    assert got and got == {(g, t): v for g, own in transcripts.items() for t, v in plain_tracks(genes[g], own, inside).items()}


def test_exons_of_transcripts_are_written_once_and_have_a_sequence(spark):
    x = Inputs(spark, SF)
    files = {f for df in (tracks.transcript_exons(x), tracks.transcript_translations(x)) for f in df.inputFiles()}
    assert files and not any("lineitem.parquet" in f for f in files) and len({f.rsplit("/", 1)[0] for f in files}) == 1
    own = x.x_seq.selectExpr("seq_id AS gene_id")
    assert tracks.transcript_exons(x).join(own, "gene_id", "left_anti").isEmpty()
    assert tracks.transcript_exons(x).count() == x.x_exon.join(own, "gene_id", "left_semi").count() > 0
