"""Set-oriented joins over annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.operators.ranks import large_groups, meeting_pairs
from strandweave.session import Cut, spread


def orthologues(members: DataFrame, types: DataFrame, genes: DataFrame, reference_species: int) -> DataFrame:
    """(gene_id, cognate_gene_id, cognate_species, description): partners of reference genes in the same homology."""
    own = genes.select("gene_id", "species_id")
    placed = spread(members.join(own, members.gene_member_id == own.gene_id).select("homology_id", "gene_id", "species_id"), "homology_id")
    partner = placed.select("homology_id", F.col("gene_id").alias("cognate_gene_id"), F.col("species_id").alias("cognate_species"))
    return (
        placed.where(F.col("species_id") == reference_species)
        .join(partner, "homology_id").where("gene_id <> cognate_gene_id")
        .join(types, "homology_id").select("gene_id", "cognate_gene_id", "cognate_species", "description").distinct()
    )


def homology_subset(members: DataFrame, reference: DataFrame) -> DataFrame:
    """All members of every homology that holds a reference member."""
    ids = members.join(reference, "gene_member_id", "left_semi").select("homology_id")
    return members.join(ids, "homology_id", "left_semi")


def homology_descriptions(homologies: DataFrame, subset: DataFrame) -> DataFrame:
    """One row per member row; a homology without a description keeps a null."""
    return homologies.join(subset, "homology_id", "right").select("homology_id", "gene_member_id", "description")


def one_hop(orthos: DataFrame, representative: int, group: list[int]) -> DataFrame:
    """Genes of the representative species beside those of its group that share the reference gene; one per species."""
    a = orthos.where(F.col("cognate_species") == representative).select("gene_id", F.col("cognate_gene_id").alias("rep_gene_id"))
    b = orthos.where(F.col("cognate_species").isin(group)).groupBy("gene_id", "cognate_species").agg(F.max("cognate_gene_id").alias("cognate_gene_id"))
    return a.join(b, "gene_id", "left")


def exons_of_genes(exons: DataFrame, exon_transcript: DataFrame) -> DataFrame:
    """Distinct exons over all transcripts of each gene."""
    return exon_transcript.select("gene_id", "exon_id").distinct().join(exons, ["gene_id", "exon_id"])


def mark_canonical(exons: DataFrame, exon_transcript: DataFrame, translations: DataFrame) -> DataFrame:
    """``in_canonical``, ``canon_transl_start`` and ``canon_transl_end`` (-1 elsewhere) from the canonical transcript.

    Bounds are positions in the gene: counted from the exon's start on the plus strand, from its end on the minus one.
    """
    canon = exon_transcript.where("is_canonical_transcript = 1").select("gene_id", "exon_id", "transcript_id").distinct()
    ends = canon.select("transcript_id", "gene_id").distinct().join(translations, "transcript_id")
    ends = ends.select("gene_id", "start_exon_id", "seq_start", "end_exon_id", "seq_end")
    marked = exons.join(canon.select("gene_id", "exon_id", F.lit(1).alias("hit")), ["gene_id", "exon_id"], "left").join(ends, "gene_id", "left")
    place = lambda at: F.when(F.col("strand") > 0, F.col("start_in_gene") + F.col(at) - 1).otherwise(F.col("end_in_gene") - F.col(at) + 1)
    is_first, is_last = F.col("exon_id") == F.col("start_exon_id"), F.col("exon_id") == F.col("end_exon_id")
    forward = F.col("strand") > 0
    start = F.when(forward & is_first, place("seq_start")).when(~forward & is_last, place("seq_end")).otherwise(-1)
    end = F.when(forward & is_last, place("seq_end")).when(~forward & is_first, place("seq_start")).otherwise(-1)
    return marked.withColumns({"in_canonical": F.coalesce("hit", F.lit(0)), "canon_transl_start": start, "canon_transl_end": end}).drop("hit", "start_exon_id", "seq_start", "end_exon_id", "seq_end")


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether two closed intervals meet; touching bounds count."""
    return ~(b_end < a_start) & ~(a_end < b_start)


def coding_exons(exons: DataFrame, regions: DataFrame, exon_transcript: DataFrame) -> DataFrame:
    """``coding``: 1 where the exon meets its gene's translated region and stands in some transcript."""
    known = exon_transcript.select("gene_id", "exon_id").distinct().withColumn("hit", F.lit(True))
    joined = exons.join(regions, "gene_id", "left").join(known, ["gene_id", "exon_id"], "left")
    meets = overlap(F.col("start_in_gene"), F.col("end_in_gene"), F.col("tr_start"), F.col("tr_end"))
    return joined.withColumn("coding", F.when(F.col("hit") & meets, 1).otherwise(0)).drop("hit", "tr_start", "tr_end")


def overlapping_exons(exons: DataFrame, columns: list[str], most: int = 1_000) -> DataFrame:
    """(gene_id, a_*, b_*): pairs of exons of a gene that overlap, a the one of lesser id, with some of their columns.

    The equi key is the gene, the interval test runs inside it. Genes of more than ``most`` exons take ``meeting_pairs``,
    which gives the same pairs without comparing all.
    """
    side = lambda df, t: df.select("gene_id", *(F.col(c).alias(f"{t}_{c}") for c in dict.fromkeys(["exon_id", "start_in_gene", "end_in_gene", *columns])))
    large = Cut(large_groups(exons, "gene_id", most), "large-genes")
    if large.df.isEmpty():
        large.drop()
        few, many = exons, None
    else:
        few, many = exons.join(large.df, "gene_id", "left_anti"), exons.join(large.df, "gene_id", "left_semi")
    pairs = side(few, "a").join(side(few, "b"), "gene_id").where(F.col("a_exon_id") < F.col("b_exon_id"))
    pairs = pairs.where(overlap(*(F.col(f"{t}_{c}") for t in "ab" for c in ("start_in_gene", "end_in_gene"))))
    if many is not None:
        met = meeting_pairs(many, "gene_id", "exon_id", "start_in_gene", "end_in_gene").select("gene_id", F.least("a", "b").alias("a_exon_id"), F.greatest("a", "b").alias("b_exon_id"))
        pairs = pairs.unionByName(met.join(side(many, "a"), ["gene_id", "a_exon_id"]).join(side(many, "b"), ["gene_id", "b_exon_id"]))
    return pairs


def covering_pairs(exons: DataFrame, most: int = 1_000) -> DataFrame:
    """(gene_id, master, covered) of overlapping exons of a gene, by the first rule that tells them apart.

    Canonical before not, then the two annotation sources in order, then the one that holds the other; else no row.
    """
    pairs = overlapping_exons(exons, ["is_canonical", "logic_name"], most)
    rules = [(F.col("a_is_canonical") == 1, F.col("b_is_canonical") == 1)]
    rules += [(F.col("a_logic_name") == x, F.col("b_logic_name") == x) for x in ("havana", "ensembl")]
    holds = lambda t, o: (F.col(f"{t}_start_in_gene") <= F.col(f"{o}_start_in_gene")) & (F.col(f"{t}_end_in_gene") >= F.col(f"{o}_end_in_gene"))
    rules.append((holds("a", "b"), holds("b", "a")))
    master = F.coalesce(*(F.when(p & ~q, F.col("a_exon_id")).when(q & ~p, F.col("b_exon_id")) for p, q in rules))
    out = pairs.withColumn("master", master).where("master is not null")
    return out.select("gene_id", "master", F.when(F.col("master") == F.col("a_exon_id"), F.col("b_exon_id")).otherwise(F.col("a_exon_id")).alias("covered"))


def contained_in_genes(features: DataFrame, genes: DataFrame, bin_size: int) -> DataFrame:
    """Features that lie within a gene's span on the same region; regions are cut in bins to have an equi key."""
    spans = genes.withColumn("bin", F.explode(F.sequence(F.floor(F.col("region_start") / bin_size), F.floor(F.col("region_end") / bin_size))))
    return features.withColumn("bin", F.floor(F.col("start") / bin_size)).join(spans, ["region_id", "bin"]).where("start >= region_start and `end` <= region_end").drop("bin")


def reliable_orthologues(orthos: DataFrame, genes: DataFrame) -> DataFrame:
    """One-to-one rows, unresolved rows for species without one, all with protein-coding partners."""
    one = orthos.where("target = 'orthologue'")
    rest = orthos.where("target = 'unresolved_ortho'").join(one, ["gene_id", "cognate_species"], "left_anti")
    coding = genes.where("biotype = 'protein_coding'").select(F.col("gene_id").alias("cognate_gene_id"))
    return one.unionByName(rest).join(coding, "cognate_gene_id", "left_semi")


def paralogue_pairs(members: DataFrame, types: DataFrame, genes: DataFrame) -> DataFrame:
    """(species_id, first, second): homologies of the paralogue type with exactly two coding members in one species."""
    coding = genes.where("biotype = 'protein_coding'").select(F.col("gene_id").alias("gene_member_id"), "species_id")
    own = members.join(types.where("description = 'within_species_paralog'"), "homology_id", "left_semi").join(coding, "gene_member_id")
    two = own.groupBy("homology_id", "species_id").agg(F.count("*").alias("n"), F.min("gene_member_id").alias("first"), F.max("gene_member_id").alias("second"))
    return two.where("n = 2").select("species_id", "first", "second").distinct()


def first_source(exons: DataFrame, exon_transcript: DataFrame) -> DataFrame:
    """``source_transcript``: the least transcript that holds the exon, 0 if none does."""
    first = exon_transcript.groupBy("exon_id").agg(F.min("transcript_id").alias("source_transcript"))
    return exons.join(first, "exon_id", "left").withColumn("source_transcript", F.coalesce("source_transcript", F.lit(0)))


def neighbour_spans(bounds: DataFrame, regions: DataFrame, extension: int) -> DataFrame:
    """(exon_id, name, file, strand, span_start, span_end): where to search for an exon between its bounds (left_bound, right_bound).

    ``regions`` is (exon_id, name, file, strand, start, end) of the bounds. Two bounds must agree in name, file and strand,
    else the exon is left out, as it is without a bound; the span lies between them, in whichever order they stand on the
    sequence. Beside one bound it is ``extension`` bases long, on the side that the strand tells. Spans start from 1 on.
    """
    side = lambda t: regions.select(F.col("exon_id").alias(f"{t}_bound"), F.struct("name", "file", "strand", F.col("start").alias("start"), F.col("end").alias("end")).alias(t))
    rows = bounds.select("exon_id", "left_bound", "right_bound").join(side("left"), "left_bound", "left").join(side("right"), "right_bound", "left")
    one, other = F.col("left"), F.col("right")
    agree = (one["name"] == other["name"]) & (one["file"] == other["file"]) & (one["strand"] == other["strand"])
    rows = rows.where((one.isNotNull() | other.isNotNull()) & F.coalesce(agree, one.isNull() | other.isNull()))
    before = lambda r, on_left: (r["strand"] == 1) == F.lit(on_left)
    single = lambda r, on_left: (F.when(before(r, on_left), r["start"] - extension).otherwise(r["end"]), F.when(before(r, on_left), r["start"]).otherwise(r["end"] + extension))
    (left_start, left_end), (right_start, right_end) = single(other, True), single(one, False)
    crossed = one["end"] > other["start"]
    start = F.when(one.isNull(), left_start).when(other.isNull(), right_start).when(crossed, other["end"]).otherwise(one["end"])
    end = F.when(one.isNull(), left_end).when(other.isNull(), right_end).when(crossed, one["start"]).otherwise(other["start"])
    same = lambda c: F.coalesce(one[c], other[c]).alias(c)
    return rows.select("exon_id", same("name"), same("file"), same("strand"), F.greatest(start, F.lit(1)).alias("span_start"), end.alias("span_end"))
