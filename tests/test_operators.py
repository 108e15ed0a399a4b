"""Hand-made rows: components against union-find, sequence functions, round trips."""

import random

from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.operators import joins as J
from strandweave.operators.components import connected_components
from strandweave.sources import files as R


def test_components_of_chains_hubs_and_loops(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)] + [(3, 3)] + [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(150)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = dict(connected_components(spark.createDataFrame(edges + [(None, 5)], "a long, b long"), "a", "b").collect())
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert got == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_sequence_functions(spark):
    r = one(
        spark, S.reverse_complement(S.reverse_complement(F.lit("ACGTNacgt"))).alias("twice"), S.translate(F.lit("ATGGCCTAAAC")).alias("p"), S.translate(F.lit("ATANNN"), 0, True).alias("m"),
        S.translate(F.lit("AT")).alias("short"), S.cigar(F.lit("AC--GT"), F.lit("A-TT-T")).alias("c"), S.cigar(F.lit(""), F.lit("")).alias("c0"), S.thread_codons(F.lit("M-A"), F.lit("ATGGCC")).alias("t"),
        S.bitmap(F.lit("A-CC-----A")).alias("b"), S.close_enough(F.lit("XXMKL"), F.lit("MKI")).alias("ok"), S.retry_translation(F.lit("TTAATGA"), F.lit(0)).alias("r"),
    )
    assert (r.twice, r.p, r.m, r.short, r.c, r.c0, r.t, r.b.lower(), r.ok) == ("ACGTNacgt", "MA*", "MX", "", "1M1B2A1B1M", "", "ATG---GCC", "b040", True)
    assert r.r == "LM"


def test_fasta_and_dump_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("g1", "ACGT" * 40), ("g2", "TT")], "name string, seq string")
    R.write_fasta(rows, F.col("name"), F.col("seq"), str(tmp_path / "f"))
    assert sorted(R.fasta_records(spark, str(tmp_path / "f")).collect()) == sorted(rows.collect())
    dump = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    R.write_dump(dump, str(tmp_path / "d"))
    assert sorted(R.read_dump(spark, str(tmp_path / "d"), dump.schema).collect(), key=str) == sorted(dump.collect(), key=str)


def test_start_codon_makes_its_text_once(spark):
    rows = spark.createDataFrame([("xxATGCATGAAAATG", 8), ("xxCCC", 2), (None, 0), ("", 3)], "t string, j int")
    got = rows.select(S.start_codon(F.regexp_replace("t", "x", "G"), F.col("j"), 2, 3).alias("p"))
    assert [r.p for r in got.collect()] == [2, None, None, None]
    # a text that is made inside the filter is made again for each place
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(regexp_replace" not in plan and plan.count("regexp_replace(") == 1


def test_orthologues_meet_in_parts_that_are_not_put_together(spark):
    members = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 10), (2, 11), (3, 12), (3, None), (None, 10)], "homology_id long, gene_member_id long")
    genes = spark.createDataFrame([(10, 3), (11, 4), (12, 3)], "gene_id long, species_id int")
    types = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "homology_id long, description string")
    got = J.orthologues(members, types, genes, 3)
    assert sorted(got.collect()) == [(10, 11, 4, "a"), (10, 12, 3, "a"), (12, 10, 3, "a"), (12, 11, 4, "a")]
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
