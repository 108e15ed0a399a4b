"""Missing exons beside mapped ones, walked one gene at a time, and the spans between their bounds."""

import random

from strandweave.operators import aggregates as A
from strandweave.operators import joins as J


def walk(flags):
    """(class, left, right) of the unmapped exons of one gene; exon numbers are their places."""
    out, n = {}, len(flags)
    ok = lambda k: 0 <= k < n and flags[k][0] == 1
    for k in range(n):
        if not flags[k][0]:
            out[k] = ("both", k - 1, k + 1) if ok(k - 1) and ok(k + 1) else ("no_right", k - 1, None) if ok(k - 1) else ("no_left", None, None)
    bound = None
    for k in reversed(range(n)):
        if k in out and out[k][0] == "no_left":
            out[k] = ("no_left", None, bound)
        if flags[k][0] or flags[k][1]:
            bound = k
    return out


def test_neighbourhoods_against_a_walk(spark):
    rnd = random.Random(1)
    genes = {g: [(int(rnd.random() < 0.5), int(rnd.random() < 0.3)) for _ in range(rnd.randrange(1, 12))] for g in range(80)}
    rows = [(g, 100 * g + k, k, m, 0 if m else f) for g, flags in genes.items() for k, (m, f) in enumerate(flags)]
    exons = spark.createDataFrame(rows, "gene_id long, exon_id long, start_in_gene long, mapped int, found int")
    got = {r.exon_id: (r.neighbourhood, r.left_bound, r.right_bound) for r in A.missing_class(exons).collect()}
    at = lambda g, k: None if k is None else 100 * g + k
    assert got == {100 * g + k: (c, at(g, a), at(g, b)) for g, flags in genes.items() for k, (c, a, b) in walk([(m, 0 if m else f) for m, f in flags]).items()}


def test_spans_beside_and_between_bounds(spark):
    regions = [(1, "c1", "f", 1, 100, 200), (2, "c1", "f", 1, 900, 950), (3, "c1", "f", -1, 900, 950), (4, "c1", "f", -1, 100, 200), (5, "c2", "f", 1, 900, 950), (6, "c1", "g", 1, 900, 950)]
    bounds = [(10, 1, 2), (11, 3, 4), (12, None, 2), (13, 1, None), (14, None, 4), (15, 3, None), (16, 1, 5), (17, 1, 6), (18, 1, 3), (19, None, None), (20, 99, None), (21, None, 1)]
    run = J.neighbour_spans(spark.createDataFrame(bounds, "exon_id long, left_bound long, right_bound long"), spark.createDataFrame(regions, "exon_id long, name string, file string, strand int, start long, end long"), 300)
    got = {r.exon_id: (r.strand, r.span_start, r.span_end) for r in run.collect()}
    assert got == {10: (1, 200, 900), 11: (-1, 200, 900), 12: (1, 600, 900), 13: (1, 200, 500), 14: (-1, 200, 500), 15: (-1, 600, 900), 21: (1, 1, 100)}
