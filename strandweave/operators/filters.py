"""Projections, filters and predicates over annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def genes_by_biotype(genes: DataFrame, biotype: str, excluded_regions: DataFrame | None = None) -> DataFrame:
    """Genes of one biotype, without those on regions that carry the non-reference attribute."""
    kept = genes.where(F.col("biotype") == biotype)
    return kept if excluded_regions is None else kept.join(excluded_regions, "region_id", "left_anti")


def admissible_names(names: DataFrame, column: str, excluded: list[str], prefixes: list[str], family: str | None = None, only: str | None = None) -> DataFrame:
    """Rows whose name is not excluded and has no excluded prefix; of a prefix family a single name is admitted."""
    name = F.col(column)
    ok = ~name.isin(excluded)
    for prefix in prefixes:
        ok = ok & ~name.startswith(prefix)
    if family:
        ok = ok & F.when(name.startswith(family), name == only).otherwise(True)
    return names.where(ok)


def with_clean_peptides(exons: DataFrame, peptides: DataFrame) -> DataFrame:
    """Exons with their peptide, every X removed; those without one or left empty are dropped."""
    clean = F.regexp_replace("pep", "X", "")
    return exons.join(peptides, "exon_id").withColumn("pep", clean).where(F.length("pep") > 0)


def relevant_exons(exons: DataFrame) -> DataFrame:
    """All but the exons that are canonical and not coding."""
    return exons.where(~((F.col("is_canonical") == 1) & (F.col("is_coding") == 0)))


def usable_exons(exons: DataFrame, sequences: DataFrame) -> DataFrame:
    """Canonical coding exons that have a sequence."""
    return exons.where("is_canonical = 1 and is_coding = 1").join(sequences, "exon_id", "left_semi")


HOMOLOGY_ROUTES = {  # fixed values: homology type -> target table
    "ortholog_one2one": "orthologue", "apparent_ortholog_one2one": "orthologue",
    "possible_ortholog": "unresolved_ortho", "ortholog_one2many": "unresolved_ortho", "ortholog_many2many": "unresolved_ortho",
}


def route_homologies(homologies: DataFrame) -> DataFrame:
    """``target`` table of each homology by its type; other types are left out."""
    route = F.lit(None).cast("string")
    for kind, target in HOMOLOGY_ROUTES.items():
        route = F.when(F.col("description") == kind, target).otherwise(route)
    return homologies.withColumn("target", route).where("target is not null")


def effective_bounds(exons: DataFrame) -> DataFrame:
    """``eff_start`` and ``eff_end``: the translated bound where there is one (>= 0), else the exon's own."""
    pick = lambda coded, own: F.when(F.col(coded) < 0, F.col(own)).otherwise(F.col(coded))
    return exons.withColumns({"eff_start": pick("canon_transl_start", "start_in_gene"), "eff_end": pick("canon_transl_end", "end_in_gene")})


def defaulted(column: Column, default: Column) -> Column:
    """The value, or the default where it is null or empty."""
    return F.coalesce(F.nullif(column, F.lit("")), default)


def inner_stop(peptide: Column) -> Column:
    """Whether a stop stands before the last residue."""
    return F.instr(F.substring(peptide, F.lit(1), F.greatest(F.length(peptide) - 1, F.lit(0))), "*") > 0


def acceptable_templates(pairs: DataFrame, ratio: float = 0.3) -> DataFrame:
    """Templates whose length is within ``ratio`` and its inverse of the reference, with both flanks and no XX."""
    share = F.length("template_pep") / F.length("reference_pep")
    return pairs.where(share.between(ratio, 1 / ratio) & (F.length("left_flank") > 0) & (F.length("right_flank") > 0) & ~F.contains("template_pep", F.lit("XX")))


def mismatching_ids(left: DataFrame, right: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Rows in which two sources differ."""
    return left.join(right, key).where(F.col(first) != F.col(second))


def with_integer_suffix(names: DataFrame, column: str) -> DataFrame:
    """``base`` and ``copy_no`` of names that end in ``_<integer>``, both null for others."""
    hit = F.col(column).rlike(r"_\d+$")
    return names.withColumns({
        "base": F.when(hit, F.regexp_replace(column, r"_\d+$", "")),
        "copy_no": F.when(hit, F.regexp_extract(column, r"_(\d+)$", 1).cast("long")),
    })
