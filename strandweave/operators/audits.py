"""Checks and reports over annotation tables, and the choice of regions, templates and hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.operators.ranks import ranked

#: Classes of a base by its pair, transition and transversion, and CpG context; A and T have no CpG class.
MUTATION_CLASSES = ("AT_transition", "AT_transversion", "CG_transition", "CG_transversion", "CpG_transition", "CpG_transversion")


def ccds_support(transcripts: DataFrame, links: DataFrame, features: DataFrame, mark: str = "CCDS") -> DataFrame:
    """(transcript_id, hit_name): the last alignment feature of a transcript whose hit name has a mark."""
    hits = features.where((F.col("feature_type") == "dna_align_feature") & F.contains("hit_name", F.lit(mark))).select("feature_id", "hit_name")
    return transcripts.join(links, "transcript_id").join(hits, "feature_id").groupBy("transcript_id").agg(F.max_by("hit_name", "feature_id").alias("hit_name"))


def acceptable_template(length: Column, reference: Column, left: Column, right: Column, pep: Column, warning: Column, least: float = 0.3) -> Column:
    """Whether a template is neither too short nor too long, has both flanks, no XX, and a map without warning."""
    ratio = length / reference
    return ratio.between(least, 1 / least) & (F.length(left) > 0) & (F.length(right) > 0) & ~F.contains(pep, F.lit("XX")) & warning.isNull()


def first_template(candidates: DataFrame, ok: Column) -> DataFrame:
    """The acceptable candidate nearest in the tree for each exon."""
    w = Window.partitionBy("exon_id").orderBy("distance", "cognate_exon_id", "part")
    return candidates.where(ok).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def best_hits(hits: DataFrame, least_share: float = 0.4, least_identity: float = 10.0) -> DataFrame:
    """(query_id, target_id, match_length, first): the longest match long enough for the shorter sequence; first counts from the whole target."""
    good = hits.where((F.col("match_length") >= least_share * F.least("query_length", "target_length")) & (F.col("identity") >= least_identity))
    top = F.max(F.struct("match_length", (-F.col("target_id")).alias("k"), (-F.col("first")).alias("f"), "offset")).alias("t")
    return good.groupBy("query_id").agg(top).select("query_id", (-F.col("t.k")).alias("target_id"), "t.match_length", (F.col("t.offset") - F.col("t.f")).alias("first"))


def random_rows(rows: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows without replacement, in the order of a hash of key and seed: the same rows however the table is split."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def random_choices(rows: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``draw`` from 0 on and one row for each of n choices with replacement, the same however the table is split.

    Rows are numbered by ``key`` in parallel, a choice is the hash of its number and the seed, and the two meet in a join.
    An empty table gives no choices.
    """
    numbered = ranked(rows, [], [key], "number")
    total = rows.count()
    draws = rows.sparkSession.range(n if total else 0).select(F.col("id").alias("draw"), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1))) + 1).alias("of"))
    return draws.join(numbered, F.col("of") == F.col("number")).select("draw", *rows.columns)


def patch_regions(genes: DataFrame, exceptions: DataFrame, regions: DataFrame, only: str | None = "PATCH_%") -> DataFrame:
    """(gene_id, exc_type, region_name, exc_start, exc_end) of assembly exceptions on the genes' regions."""
    wanted = exceptions.where(F.col("exc_type").like(only)) if only else exceptions
    return genes.select("gene_id", "region_id").join(wanted, "region_id").join(regions, "exc_region_id").select("gene_id", "exc_type", "region_name", "exc_start", "exc_end")


def region_choice(candidates: DataFrame) -> DataFrame:
    """(gene_id, source): the primary region if its translation agrees with the stored one, else the first patch that does.

    ``candidates`` is (gene_id, source, priority, built, stored); genes of which none agrees are left out.
    """
    w = Window.partitionBy("gene_id").orderBy("priority", "source")
    return candidates.where(S.close_enough(F.col("built"), F.col("stored"))).withColumn("rn", F.row_number().over(w)).where("rn = 1").select("gene_id", "source")


def genes_of_exons(wanted: DataFrame, exons: DataFrame) -> DataFrame:
    """Gene of each exon id of one provenance."""
    return wanted.join(exons.select("exon_id", "provenance", "gene_id"), ["exon_id", "provenance"])


def map_holes(exons: DataFrame, maps: DataFrame, least: float = 0.2) -> DataFrame:
    """(species_id, n_exons, n_holes, n_novel) per species with a map, over all exons of genes that have a map.

    A hole is an exon whose best map in the species is absent or weak; the number without a map is a difference, so no
    grid of species and exons is made.
    """
    inside = exons.join(exons.join(maps.select("exon_id"), "exon_id", "left_semi").select("gene_id").distinct(), "gene_id", "left_semi")
    best = maps.join(inside.select("exon_id"), "exon_id", "left_semi").groupBy("species_id", "exon_id").agg(F.max("similarity").alias("s"), F.max("novel").alias("novel"))
    per = best.groupBy("species_id").agg(F.count_if(F.col("s") >= least).alias("good"), F.count_if(F.col("novel") == 1).alias("n_novel"))
    total = inside.agg(F.count("*").alias("n_exons")).withColumn("k", F.lit(1))
    return per.withColumn("k", F.lit(1)).join(F.broadcast(total), "k").select("species_id", "n_exons", (F.col("n_exons") - F.col("good")).alias("n_holes"), "n_novel")


def translation_audit(rows: DataFrame) -> DataFrame:
    """(status, n) of (exon_id, dna, pep): no_sequence, too_short, failed, mismatch or ok."""
    status = F.when(F.col("dna").isNull(), "no_sequence").when(F.length("dna") < 3, "too_short").when(F.col("pep") == "-10", "failed").when(S.translate(F.col("dna")) != F.col("pep"), "mismatch").otherwise("ok")
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def length_agreement(lengths: DataFrame, peptides: DataFrame, most: int = 3) -> DataFrame:
    """(gene_id, coding_length, pep_length, agrees): a third of the coding length against the stored peptide."""
    n = F.floor(F.col("coding_length") / 3)
    return lengths.join(peptides, "gene_id").select("gene_id", "coding_length", F.length("pep").alias("pep_length"), (F.abs(n - F.length("pep")) <= most).alias("agrees"))


def reading_length(exons: DataFrame) -> DataFrame:
    """(gene_id, reading_length): length of the exons between those marked as first and as last, both included."""
    w = Window.partitionBy("gene_id").orderBy("start_in_gene", "exon_id")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    begun = F.max(F.col("is_first")).over(so_far)
    lagged = exons.withColumn("ended", F.coalesce(F.lag("is_last").over(w), F.lit(0)))
    inside = (begun == 1) & (F.max("ended").over(so_far) == 0)
    size = F.col("end_in_gene") - F.col("start_in_gene") + 1
    return lagged.withColumn("inside", inside).groupBy("gene_id").agg(F.sum(F.when(F.col("inside"), size).otherwise(0)).cast("long").alias("reading_length"))


def splice_audit(exons: DataFrame, sequences: DataFrame, cover: DataFrame) -> DataFrame:
    """(status, n) of the exons of supported transcripts (gene_id, exon_id): sequence missing, or how their cover stands.

    ``sequences`` is (exon_id, pep, dna), ``cover`` (exon_id, master); a covering exon may itself be of a supported
    transcript or not.
    """
    own = exons.select(F.col("exon_id").alias("master"), F.lit(1).alias("supported")).distinct()
    first = cover.groupBy("exon_id").agg(F.min("master").alias("master"))
    rows = exons.distinct().join(sequences.withColumn("has", F.lit(1)), "exon_id", "left").join(first, "exon_id", "left").join(own, "master", "left")
    status = F.when(F.col("has").isNull(), "no_sequence").when(F.coalesce(F.length("pep"), F.lit(0)) == 0, "no_protein").when(F.coalesce(F.length("dna"), F.lit(0)) == 0, "no_dna")
    status = status.when(F.col("master").isNull(), "uncovered").when(F.col("supported") == 1, "cover_present").otherwise("cover_not_supported")
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def missing_exon_counts(candidates: DataFrame) -> DataFrame:
    """(species_id, sought, found, unsequenced) of (species_id, found, region)."""
    return candidates.groupBy("species_id").agg(F.count("*").alias("sought"), F.count_if(F.col("found") == 1).alias("found"), F.count_if(F.contains("region", F.lit("NNN"))).alias("unsequenced"))


def _substitutions() -> tuple[list[tuple[str, str]], np.ndarray]:
    """Kinds (category, effect), and how many single substitutions of each a codon has: row 4 codon + 2 (C before) + (G behind)."""
    codons = [a + b + c for a in S.BASES for b in S.BASES for c in S.BASES]
    residue = dict(zip(codons, S.STANDARD, strict=True))
    found: dict[tuple[str, str], np.ndarray] = {}
    for row, (codon, before, behind) in enumerate((c, x, y) for c in codons for x in "NC" for y in "NG"):
        text = before + codon + behind
        for place, base in enumerate(codon):
            cpg = text[place + 1 : place + 3] == "CG" or text[place : place + 2] == "CG"
            for to in "ACGT".replace(base, ""):
                kind = "_transition" if {base, to} in ({"A", "G"}, {"C", "T"}) else "_transversion"
                new = residue[codon[:place] + to + codon[place + 1 :]]
                effect = "silent" if new == residue[codon] else "nonsense" if new == "*" else "missense"
                name = (("CpG" if cpg else "AT" if base in "AT" else "CG") + kind, effect)
                found.setdefault(name, np.zeros(4 * len(codons), np.int64))[row] += 1
    return list(found), np.stack(list(found.values()), axis=1)


def mutation_background(cdna: DataFrame) -> DataFrame:
    """(gene_id, category, effect, n): all single substitutions in whole codons of (gene_id, dna).

    Each sequence's codons are counted by the bases beside them in one pass over its letters; what a codon can become is
    a fixed table. So a row of the input makes one row a kind, however long it is.
    """
    gene = cdna.schema["gene_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, table = _substitutions()
        code = np.full(256, 4, np.int64)
        code[np.frombuffer(S.BASES.encode(), np.uint8)] = range(4)
        category, effect = (pa.array(names) for names in zip(*kinds))
        for batch in batches:
            counts = np.zeros((len(batch), len(kinds)), np.int64)
            for r, dna in enumerate(batch["dna"]):
                letters = code[np.frombuffer((dna.as_py() or "").encode("ascii", "replace"), np.uint8)]
                end = len(letters) // 3 * 3
                codon = letters[:end].reshape(-1, 3)
                before, behind = np.r_[4, letters][:end:3], np.r_[letters, 4][3 : end + 1 : 3]
                word = codon @ [64, 16, 4] + 2 * (before == S.BASES.index("C")) + (behind == S.BASES.index("G"))
                counts[r] = np.bincount(word[(codon < 4).all(axis=1)], minlength=len(table)) @ table
            row, kind = np.nonzero(counts)
            yield pa.record_batch([batch["gene_id"].take(pa.array(row)), category.take(pa.array(kind)), effect.take(pa.array(kind)), pa.array(counts[row, kind])], ["gene_id", "category", "effect", "n"])

    counted = cdna.select("gene_id", "dna").mapInArrow(work, f"gene_id {gene}, category string, effect string, n long")
    return counted.groupBy("gene_id", "category", "effect").agg(F.sum("n").alias("n"))


def unseen_paralogues(pairs: DataFrame) -> DataFrame:
    """Pairs (first, second) whose first member was not the second member of a pair with a lesser first."""
    seen = pairs.groupBy(F.col("second").alias("first")).agg(F.min("first").alias("by"))
    return pairs.join(seen, "first", "left").where(F.col("by").isNull() | (F.col("by") >= F.col("first"))).select("first", "second")


def renumbered(rows: DataFrame) -> DataFrame:
    """``new_name`` of (base, name, similarity): base, base_2, ... by falling similarity."""
    n = F.row_number().over(Window.partitionBy("base").orderBy(F.desc("similarity"), "name"))
    return rows.withColumn("n", n).withColumn("new_name", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("n").cast("string")))).drop("n")


def input_set(wanted: DataFrame, symbols: DataFrame, pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    """(gene_id, member_id, position): the gene of each symbol and its one-to-one orthologues, by species rank; the gene is at 0."""
    own = wanted.join(symbols, "symbol").select("gene_id")
    w = Window.partitionBy("gene_id").orderBy("rank", "member_id")
    others = own.join(pairs, "gene_id").join(ranks, "species_id").select("gene_id", "member_id", F.row_number().over(w).alias("position"))
    return own.select("gene_id", F.col("gene_id").alias("member_id"), F.lit(0).alias("position")).unionByName(others)
