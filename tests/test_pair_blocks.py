"""Pairs by blocks against the column functions, one pair at a time."""

import random

import pytest
from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.operators import audits as C
from strandweave.operators import pair_blocks as B
from strandweave.operators import tracks as T

BARE = lambda c: F.replace(c, F.lit("-"), F.lit(""))
COLUMNS = {
    "identity": (B.identity, "v double", lambda a, b: [F.when(F.length(a) > 0, S.identity(a, b))]),
    "similarity": (B.similarity, "v double", lambda a, b: [S.similar(a, b) / F.nullif(S.common(a, b), F.lit(0))]),
    "tanimoto": (B.tanimoto(False), "v double", lambda a, b: [S.tanimoto(a, b, heuristics=False)]),
    "heuristics": (B.tanimoto(True), "v double", lambda a, b: [S.tanimoto(a, b)]),
    "shares": (B.matched_shares, "v double, w double", lambda a, b: [S.cigar_identity(S.cigar(a, b)), S.matched_of_shorter(S.cigar(a, b), a, b)]),
    "close": (B.close_enough, "v boolean", lambda a, b: [S.close_enough(a, b)]),
    "cigar": (B.cigars, "v string", lambda a, b: [S.cigar(a, b)]),
    "rows": (B.rows_of_pairs, "v string, w string", lambda a, b: [S.unfolded(BARE(a), S.cigar(a, b), "A"), S.unfolded(BARE(b), S.cigar(a, b), "B")]),
    "patched": (B.patched, "v string, w string", lambda a, b: [S.patched(a, b)["text"], F.array_join(F.transform(S.patched(a, b)["codons"], lambda i: i.cast("string")), ",")]),
    "fused": (B.fused, "v string", lambda a, b: [F.array_join(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == "-", y).otherwise(x)), "")]),
}


def odd_rows(spark, letters):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = [("p", i, text(70)) for i in range(30)] + [("p", 30 + i, text(rng.choice([1, 2, 5, 64, 65, 130]))) for i in range(12)]
    rows += [("p", 50, None), ("e", 51, ""), ("e", 54, ""), ("e", 55, None), ("p", 52, "---"), ("p", 53, "XX" + rows[0][2]), ("p", 7, text(70)), ("q", 1, "ACG"), ("q", 2, "A-G"), (None, 3, "ACG"), ("q", None, "ACG")]
    return spark.createDataFrame(rows, "aln_id string, seq_id long, seq string").cache()


@pytest.mark.parametrize("letters, most", [("ACDEX--", 4), ("ACGT-ta", 256), ("ACé-", 4)])
def test_pairs_equal_column_functions(spark, monkeypatch, letters, most):
    monkeypatch.setattr(B, "LEAST", most)
    monkeypatch.setattr(B, "MOST", most)
    aln = odd_rows(spark, letters)
    side = lambda t: aln.select("aln_id", F.col("seq_id").alias(f"{t}_id"), F.col("seq").alias(t))
    pairs = side("a").join(side("b"), "aln_id").where("a_id < b_id")
    tidy = lambda rows: sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    for name, (kernel, result, make) in COLUMNS.items():
        own = B.all_pairs(aln, ["aln_id"], kernel, result).collect()
        want = pairs.select("aln_id", "a_id", "b_id", *make(F.col("a"), F.col("b"))).collect()
        if name == "patched":  # the column function fills a gap beside the template's end with nothing
            own, want = ([r for r in rows if r["b_id"] < 30] for rows in (own, want))
        assert len(own) > 400 and tidy(own) == tidy(want), name


def test_framed_rows_and_spread(spark, monkeypatch):
    monkeypatch.setattr(B, "LEAST", 4)
    monkeypatch.setattr(B, "MOST", 4)
    aln = odd_rows(spark, "ACD-").withColumns({"a_start": (F.col("seq_id") % 5).cast("int"), "b_start": (F.col("seq_id") % 4).cast("int")})
    side = lambda t: aln.select("aln_id", F.col("seq_id").alias(f"{t}_id"), F.col("seq").alias(t), F.col(f"{t}_start").alias(f"{t}s"))
    pairs = side("a").join(side("b"), "aln_id").where("a_id < b_id")
    a, b, s, t = (F.col(c) for c in ("a", "b", "as", "bs"))
    x, y = S.padded(a, s, b, t), S.padded(b, t, a, s)
    want = pairs.where("a is not null and b is not null").select("a_id", "b_id", S.without_double_gaps(x, y, x), S.without_double_gaps(x, y, y)).collect()
    made = B.all_pairs(aln, ["aln_id"], B.framed_rows, "first string, second string", ["a_start", "b_start"]).drop("aln_id")
    own = made.collect()
    assert sorted(map(tuple, want)) == sorted(tuple(r) for r in own if r["first"] is not None)
    assert len(own) == pairs.count()
    # one alignment is the work of many tasks
    assert made.groupBy(F.spark_partition_id()).count().count() >= 8


def test_settled_pieces_make_no_pairs(spark):
    """Many pieces of one alignment, against all pairs of them; repeated ids are never rivals."""
    rng = random.Random(5)
    rows = [("p", i if i < 55 else i - 50, "-" * rng.randrange(20) + "".join(rng.choice("AC-") for _ in range(rng.randrange(5)))) for i in range(60)]
    rows = [(a, i, s.ljust(24, "-")) for a, i, s in rows] + [("p", 99, None), ("q", 1, "-" * 24), ("q", 2, "A" + "-" * 23), ("r", 5, "AA"), ("r", 6, "AA")]
    aln = spark.createDataFrame(rows, "aln_id string, seq_id long, seq string")
    targets = spark.createDataFrame([("p", 3), ("q", 1), ("r", 5)], "aln_id string, target_id long")
    for_target = {a: s for a, i, s in reversed(rows) if (a, i) in {("p", 3), ("q", 1), ("r", 5)}}
    held = [(a, i, s, sum(x == y != "-" for x, y in zip(s, for_target[a])) / len(s)) for a, i, s in rows if s is not None]
    lost = {(a, i if u < v else j) for a, i, s, u in held for b, j, t, v in held if a == b and i < j and any(x != "-" != y for x, y in zip(s, t))}
    got = {(r["aln_id"], r["seq_id"]) for r in T.settled_pieces(aln, targets).collect()}
    assert lost and got == {(a, i) for a, i, _ in rows} - lost
    plan = T.settled_pieces(aln, targets)._jdf.queryExecution().optimizedPlan().toString()
    assert "a_score" not in plan


def test_fused_pairs(spark):
    rng = random.Random(7)
    rows = [("p", i, "".join(rng.choice("AC--") for _ in range(9)), rng.randrange(2), rng.choice([0, 1, None]), rng.choice([[1, 2], [2, 3], [4], [5, 6], [], [1, None]])) for i in range(60)]
    both = spark.createDataFrame(rows, "aln_id string, seq_id long, seq string, species int, scaffold int, exons array<int>")
    got = sorted(map(tuple, T.fused(both.select("aln_id", "seq_id", "seq"), both.select("aln_id", "seq_id", "species", "scaffold", "exons")).collect()))
    fit = [r for r in rows if r[4] is not None and r[5] and None not in r[5]]
    want = [("p", a[1], b[1], "".join(y if x == "-" else x for x, y in zip(a[2], b[2]))) for a in fit for b in fit
            if a[1] < b[1] and a[3] == b[3] and a[4] != b[4] and (max(a[5]) < min(b[5]) or max(b[5]) < min(a[5]))]
    assert want and got == sorted(want)


def test_mutations_of_one_row_are_rows_by_kind(spark):
    """What leaves the first step is a row a kind, whatever the length."""
    dna = "".join(random.Random(1).choice("ACGT") for _ in range(3001))
    rows = [(1, dna), (1, "ACG"), (2, "CGNCGA"), (3, None), (4, "AC")]
    got = {(r["gene_id"], r["category"], r["effect"]): r["n"] for r in C.mutation_background(spark.createDataFrame(rows, "gene_id long, dna string")).collect()}
    want = {}
    residue = {a + b + c: S.STANDARD[16 * i + 4 * j + k] for i, a in enumerate(S.BASES) for j, b in enumerate(S.BASES) for k, c in enumerate(S.BASES)}
    for gene, text in rows:
        for i in range(3 * (len(text or "") // 3)):
            codon, base = text[i // 3 * 3 : i // 3 * 3 + 3], text[i]
            if codon in residue:
                near = text[i : i + 2] == "CG" or text[max(i - 1, 0) : i + 1] == "CG"
                for to in "ACGT".replace(base, ""):
                    new = residue[codon[: i % 3] + to + codon[i % 3 + 1 :]]
                    kind = ("CpG" if near else "AT" if base in "AT" else "CG") + ("_transition" if {base, to} in ({"A", "G"}, {"C", "T"}) else "_transversion")
                    name = (gene, kind, "silent" if new == residue[codon] else "nonsense" if new == "*" else "missense")
                    want[name] = want.get(name, 0) + 1
    assert got == want
    assert "Generate" not in C.mutation_background(spark.createDataFrame(rows, "gene_id long, dna string"))._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_grow_with_their_key(spark):
    # 700,000 sequences were 342 blocks of 2,048, and each sequence went to as many units
    rows = spark.range(700_000).select(F.lit("p").alias("aln_id"), F.repeat(F.lit("A"), 60).alias("seq"))
    assert B.block_numbers(rows, ["aln_id"]).first().n_blocks == 32
    # a block is as wide as its longest sequence
    rows = spark.range(5_000).select(F.lit("p").alias("aln_id"), F.when(F.col("id") == 0, F.repeat(F.lit("A"), 100_000)).otherwise("A").alias("seq"))
    assert B.block_numbers(rows, ["aln_id"]).first().n_blocks * B.LETTERS >= 5_000 * 100_000
