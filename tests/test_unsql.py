"""Queries without SQL against brute force on the smallest tables."""

import itertools
import random
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F

from strandweave.adapters import Inputs
from strandweave.functions import sequence as S
from strandweave.operators import audits as C
from strandweave.operators import pairwise as W
from strandweave.operators import splicing
from strandweave.plans import mapping, registry, tracks

SF = "/root/testdata/sf0.001"


def plain_alignment(a, b, opening, extending):
    """Cell by cell, with the whole table of scores."""
    table = W.scores()
    m, n = len(a), len(b)
    score, way = [[0] * (n + 1) for _ in range(m + 1)], [["d"] * (n + 1) for _ in range(m + 1)]

    def outside(s, k):
        last = max((s.rfind(c, 0, k), c) for c in "BZ")
        return last[0] < 0 or last[1] == "Z"

    best = (0, 0, 0)
    for i in range(m + 1):
        for j in range(n + 1):
            if not i and not j:
                continue
            options = []
            if i and j:
                options.append((score[i - 1][j - 1] + int(table[ord(a[i - 1]), ord(b[j - 1])]), "d"))
            if i:
                free = outside(b, j) if j else outside(a, i)
                options.append((score[i - 1][j] + (0 if free else extending if way[i - 1][j] == "i" else opening), "i"))
            if j:
                free = outside(a, i) if i else outside(b, j)
                options.append((score[i][j - 1] + (0 if free else extending if way[i][j - 1] == "j" else opening), "j"))
            top = max(options, key=lambda o: o[0])
            score[i][j], way[i][j] = max(top[0], 0), top[1]
            if score[i][j] > best[0]:
                best = (score[i][j], i, j)
    _, i, j = best
    links = []
    while i or j:
        if way[i][j] == "d":
            i, j = i - 1, j - 1
            links.append((i, j))
        elif way[i][j] == "i":
            i -= 1
        else:
            j -= 1
    x = y = ""
    p = q = 0
    for i, j in [*links[::-1], (m, n)]:
        x += a[p:i] + W.GAP * (j - q) + a[i : i + 1]
        y += W.GAP * (i - p) + b[q:j] + b[j : j + 1]
        p, q = i + 1, j + 1
    return x, y


def test_alignment_against_cell_by_cell():
    rnd = random.Random(3)
    table = W.scores()

    def gene():
        return "".join(f"B{k:03d}" + "".join(rnd.choice("ARNDKLMX") for _ in range(rnd.randrange(0, 9))) + "Z" for k in range(1, rnd.randrange(1, 4)))

    for gaps in ((-5, -3), (-3, 0)):
        for _ in range(60):
            a, b = gene(), gene()
            got = W.align_pair(a, b, *gaps, table)
            assert got == plain_alignment(a, b, *gaps)
            assert got[0].replace(W.GAP, "") == a and got[1].replace(W.GAP, "") == b and len(got[0]) == len(got[1])


def test_alignment_and_maps_of_genes(spark):
    rows = W.align(spark.createDataFrame([(1, 2, "B001MKLAWWYZB002RNDCQEZ", "B001MKLAWWYZB002RNDCQEZ"), (3, 4, "", "B001MZ"), (5, 6, None, None)], "a_id long, b_id long, first string, second string"))
    got = {(r.a_label, r.b_label): (round(r.similarity, 6), r.cigar) for r in W.exon_maps(rows).collect()}
    assert got == {(1, 1): (1.0, "7M"), (2, 2): (1.0, "6M")}
    assert {r.cigar for r in W.paralogue_maps(rows).collect()} == {"7M", "6M"}


def test_registered_alignments(spark):
    x = Inputs(spark, SF)
    inputs = {(r.a_id, r.b_id): (r.first, r.second) for r in mapping.orthologue_strings(x).collect()}
    got = {(r.a_id, r.b_id): (r.first, r.second) for r in registry.queries()["SIM-01"](spark, SF).collect()}
    assert got.keys() == inputs.keys()
    for key in sorted(inputs)[:25]:
        assert got[key] == plain_alignment(*inputs[key], -5, -3)


def read_exons(exons, mitochondrial, frame):
    """One pass over the exons, codon by codon."""
    table = S.MITOCHONDRIAL if mitochondrial else S.STANDARD
    code = {p + q + r: table[16 * i + 4 * j + k] for i, p in enumerate(S.BASES) for j, q in enumerate(S.BASES) for k, r in enumerate(S.BASES)}
    carry, pep = "", ""
    for n, (dna, phase) in enumerate(exons):
        if n == 0:
            dna = dna[frame + (3 - phase) % 3 :]
        elif len(carry) == phase:
            dna = carry + dna
        else:
            dna = dna[(3 - phase) % 3 :]
        whole = len(dna) // 3 * 3
        pep += "".join(code[dna[i : i + 3]] for i in range(0, whole, 3))
        carry = dna[whole:]
    return pep.removesuffix("*")


def test_reading_of_genes(spark):
    x = Inputs(spark, SF)
    exons = {r.gene_id: [(e.dna, e.phase) for e in r.exons] for r in tracks.reading_inputs(x).collect()}
    got = {r.gene_id: r.pep for r in registry.queries()["SEQ-33"](spark, SF).collect()}
    assert got.keys() == exons.keys() and got
    for gene, items in exons.items():
        tries = [read_exons(items, False, 0), read_exons(items, True, 0), read_exons(items, False, 1), read_exons(items, False, 2)]
        want = next((t for t in tries if "*" not in t), tries[0])
        place = gene % 50
        assert got[gene] == (want[:place] + "U" + want[place + 1 :] if place < len(want) else want)


def test_sample_does_not_depend_on_the_split(spark):
    rows = spark.range(500).toDF("gene_id")
    one, two = (sorted(r.gene_id for r in C.random_rows(df, 20, 5, "gene_id").collect()) for df in (rows, rows.repartition(7)))
    assert one == two and len(set(one)) == 20
    assert sorted(r.gene_id for r in C.random_rows(rows, 20, 6, "gene_id").collect()) != one
    assert registry.queries()["TOP-05"](spark, SF).where(F.col("gene_id").isNull()).count() == 0


def mutated(rnd, text, share):
    return "".join(rnd.choice([b for b in "ACGT" if b != c]) if rnd.random() < share else c for c in text)


def turned(text):
    return text[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_planted_exons_are_found_on_both_strands(spark):
    rnd = random.Random(9)
    bases = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    for share, least in ((0.05, 1.0), (0.15, 1.0), (0.2, 0.9)):
        templates, regions, places = [], [], {}
        for k in range(60):
            exon = bases(120)
            copy = mutated(rnd, exon, share)
            if k % 3 == 2:
                copy = copy[:60] + copy[63:]  # a codon is missing
            before = bases(300 + 53 * k)
            templates.append((k, exon))
            regions.append((100 + k, before + (turned(copy) if k % 2 else copy) + bases(1500)))
            places[k] = (100 + k, -1 if k % 2 else 1, len(before))
        got = splicing.missing_exons(spark.createDataFrame(templates, "query_id long, seq string"), spark.createDataFrame(regions, "target_id long, seq string"), spark.createDataFrame([(k, 100 + k) for k in range(60)], "query_id long, target_id long"), piece=600)
        found = {r.query_id for r in got.collect() if (r.target_id, r.strand) == places[r.query_id][:2] and abs(r["first"] - places[r.query_id][2]) <= 8 and r.match_length >= 100}
        assert len(found) >= least * 60, (share, len(found))


def test_search_of_odd_templates(spark):
    rnd = random.Random(2)
    bases = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    short, tiny, long = bases(20), bases(9), bases(3000)
    region = bases(2500) + short + bases(700) + turned(tiny) + bases(40) + mutated(rnd, long, 0.1) + bases(3000) + "A" * 3000
    templates = [(1, short), (2, tiny), (3, long), (4, ""), (5, None), (6, "A" * 60), (7, bases(60)), (8, "N" * 50), (1, short)][:8]
    regions = [(10, region), (11, None), (12, "")]
    asked = [(k, t) for k in range(1, 9) for t in (10, 11, 12)] * 2
    frame_ = lambda rows, names: spark.createDataFrame(rows, names)
    run = lambda t, r, s: {x.query_id: (x.target_id, x.strand, x["first"], x.match_length) for x in splicing.missing_exons(frame_(t, "query_id long, seq string"), frame_(r, "target_id long, seq string"), frame_(s, "query_id long, target_id long"), piece=1000).collect()}
    got = run(templates, regions, asked)
    assert got[1] == (10, 1, 2500, 20) and got[2][0] == 10 and got[3][:2] == (10, 1) and abs(got[3][2] - region.index(region[2500 + 20 + 700 + 9 + 40 :])) <= 3
    assert got[6][1] == 1 and got[6][3] == 60 and 4 not in got and 5 not in got
    assert run([], regions, asked) == run(templates, [], asked) == run(templates, regions, []) == {}


def test_registered_search_finds_each_exon_in_its_own_gene(spark):
    x = Inputs(spark, SF)
    exons = {r.query_id: r.seq for r in mapping.exon_templates(x).collect()}
    texts = {r.seq_id: r.dna for r in x.x_seq.select("seq_id", "dna").collect()}
    own = [r for r in registry.queries()["SIM-06"](spark, SF).collect() if r.query_id // 100 == r.target_id]
    exact = [r for r in own if exons[r.query_id] in texts[r.target_id] or turned(exons[r.query_id]) in texts[r.target_id]]
    assert {r.query_id for r in own} == {k for k, v in exons.items() if v} and len(exact) == len(own) > 0
    assert sum(r.identity >= 99.9 and r.match_length == len(exons[r.query_id]) for r in exact) >= 0.98 * len(exact)


def frame(template, seq, start, end):
    """One hit at a time, by trying all shifts."""
    template, seq = template or "", seq or ""
    code = {"".join(c): S.STANDARD[i] for i, c in enumerate(itertools.product(S.BASES, repeat=3))}
    read = lambda a, b: "".join(code.get(seq[i : i + 3], "X") for i in range(a, min(b, len(seq)) - 2, 3))
    like = lambda p: SequenceMatcher(None, p, template).ratio()
    own = read(start, end)
    if end >= len(seq):
        return "", start, end
    if own == template or (like(own) > 0.5 and "*" not in own):
        return own, start, end
    tries = [(start + b, end + e) for b in range(-2, 3) for e in range(-2, 3) if 0 <= start + b <= len(seq) and 0 <= end + e <= len(seq)]
    first, last = max(tries, key=lambda t: like(read(*t)))
    pep = read(first, last)
    if like(pep) < 0.5:
        return "", start, end
    if "*" in pep and len(pep) > len(template):
        blocks = [m for m in SequenceMatcher(None, pep, template).get_matching_blocks() if m.size]
        size = blocks[-1].a + blocks[-1].size - blocks[0].a
        if size == len(template):
            pep, first = pep[blocks[0].a : blocks[0].a + size], first + 3 * blocks[0].a
            last = first + 3 * size
    return ("" if "*" in pep else pep), first, last


def test_best_frames(spark):
    x = Inputs(spark, SF)
    odd = [(-1, None, None, 0, 0), (-2, "MK", "ATGAAATAAGG", 0, 9), (-3, "MK", "CATGAAATAAGG", 0, 9), (-4, "MK", "ATGAAA", 0, 6), (-5, "WWWW", "ATGAAATAAGG", 1, 8), (-6, "MK", "ATGAAATAAGG", 4, 2)]
    hits = mapping.hits(x).unionByName(spark.createDataFrame(odd, "hit_id long, template string, seq string, match_start int, match_end int"))
    want = {r.hit_id: frame(r.template, r.seq, r.match_start, r.match_end) for r in hits.collect()}
    got = {r.hit_id: (r.pep, r.match_start, r.match_end) for r in splicing.best_frames(hits).collect()}
    assert len(got) > len(odd) and got == want
    assert registry.queries()["SEQ-21"](spark, SF).count() == len(want) - len(odd)


def test_frames_are_compared_in_their_own_row(spark):
    got = splicing.best_frames(mapping.hits(Inputs(spark, SF)))
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    tried = ["MKV", "AAA", "MKVL", "MKVL", "", "MKLV"]
    own, ratio, place, at, size = splicing.likeness.func(*(pd.Series(v) for v in (["VVV"], [tried], ["MKVL"], [0.5]))).iloc[0]
    assert (ratio, place, at, size) == (1.0, 2, 0, 4) and own == SequenceMatcher(None, "VVV", "MKVL").ratio()


def test_the_search_of_exons_broadcasts_no_table(spark):
    text = "ACGTTGCAAGCTTAGCCATGGATCCGTTAACGGCATCTAGACTTGCAGT"
    frame_ = spark.createDataFrame
    got = splicing.missing_exons(frame_([(1, text)], "query_id long, seq string"), frame_([(2, "TTGA" + text + "CCAG")], "target_id long, seq string"), frame_([(1, 2)], "query_id long, target_id long"))
    assert [(r.query_id, r.target_id, r.strand, r["first"], r.match_length) for r in got.collect()] == [(1, 2, 1, 4, len(text))]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
