"""Ranks and meeting intervals of large and odd groups against one process."""

import random

from pyspark.sql import functions as F

from strandweave.operators import audits as C
from strandweave.operators import graph as G
from strandweave.operators import joins as J
from strandweave.operators import ranks


def test_ranks_of_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [(None if g == 7 else g, k, rnd.random()) for g, n in ((0, 5000), (1, 1), (2, 40), (7, 300)) for k in range(n)]
    got = ranks.ranked(spark.createDataFrame(rows, "g long, k long, v double").repartition(9), ["g"], ["v"], "n").collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.v, r.n))
    assert len(got) == len(rows) and all([n for _, n in sorted(x)] == list(range(1, len(x) + 1)) for x in by.values())
    assert ranks.ranked(spark.createDataFrame([], "g long, v double"), ["g"], ["v"], "n").count() == 0


def test_ranks_of_one_group_of_all_rows(spark):
    out = ranks.ranked(spark.range(200_000).select(F.lit(1).alias("g"), F.col("id").alias("v")), ["g"], ["v"], "n")
    assert out.where("n <> v + 1").count() == 0 and out.count() == 200_000


def test_choices_with_replacement_do_not_depend_on_the_split(spark):
    rows = spark.range(40).select((F.col("id") * 3).alias("gene_id"))
    one, two = (sorted((r.draw, r.gene_id) for r in C.random_choices(df, 200, 5, "gene_id").collect()) for df in (rows, rows.repartition(7)))
    assert one == two and [d for d, _ in one] == list(range(200)) and {g for _, g in one} <= {3 * k for k in range(40)}
    assert len({g for _, g in one}) > 25 and one != sorted((r.draw, r.gene_id) for r in C.random_choices(rows, 200, 6, "gene_id").collect())
    assert C.random_choices(rows.limit(0), 5, 1, "gene_id").count() == 0


def test_cycles_of_covering_exons_are_told(spark):
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 2), (2, 10, 11), (2, 11, 12), (2, 12, 10), (2, 12, 13), (3, 20, 20)], "gene_id long, master long, covered long")
    assert sorted(map(tuple, G.unrooted(edges).collect())) == [(2, 10), (2, 11), (2, 12), (2, 13), (3, 20)]


def plain_pairs(rows):
    out = set()
    for g, k, s, e in rows:
        for h, m, t, f in rows:
            if g == h and k < m and s is not None and t is not None and s <= e and t <= f and s <= f and t <= e:
                out.add((g, k, m))
    return out


def test_meeting_pairs_against_all_pairs(spark):
    rnd = random.Random(5)
    for width in (3, 40, 400):
        rows = [(k % 3, k, s, s + rnd.randrange(0, width)) for k in range(240) for s in [rnd.randrange(0, 300)]]
        rows += [(0, 900, 0, 1000), (0, 901, None, 5), (1, 902, 9, 3), (4, 903, 1, 1)]
        got = ranks.meeting_pairs(spark.createDataFrame(rows, "g long, k long, s long, e long"), "g", "k", "s", "e", bin_rows=8).collect()
        pairs = [(r.g, *sorted((r.a, r.b))) for r in got]
        assert len(pairs) == len(set(pairs)) and set(pairs) == plain_pairs(rows)


def test_large_genes_take_the_same_pairs(spark):
    rnd = random.Random(8)
    rows = [(k % 2, k, s, s + rnd.randrange(1, 60), k % 3 == 0, "havana" if k % 5 else "ensembl") for k in range(150) for s in [rnd.randrange(0, 500)]]
    exons = spark.createDataFrame([(*r[:4], int(r[4]), r[5]) for r in rows], "gene_id long, exon_id long, start_in_gene long, end_in_gene long, is_canonical int, logic_name string")
    some = [sorted(map(tuple, J.covering_pairs(exons, most).collect())) for most in (1000, 10)]
    assert some[0] == some[1] and some[0]


def test_a_gene_of_100000_exons(spark):
    exons = spark.range(100_000).select(F.lit(1).cast("long").alias("g"), F.col("id").alias("k"), (F.col("id") * 10).alias("s"), (F.col("id") * 10 + 14).alias("e"))
    assert ranks.meeting_pairs(exons, "g", "k", "s", "e").count() == 99_999
