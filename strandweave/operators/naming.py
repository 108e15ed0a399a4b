"""Names, accessions, synonyms and annotations of genes and species."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandweave.operators.ranks import ranked


def underscored(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[ '\"]", "_")


def renamed(name: Column, fixed: dict[str, str]) -> Column:
    """Fixed renames, other names as they are."""
    out = name
    for old, new in fixed.items():
        out = F.when(name == old, new).otherwise(out)
    return out


def trivial_name(species: Column, common: Column, fixed: dict[str, str]) -> Column:
    """The fixed name of a species, else its common name without the word common, else the species."""
    own = underscored(F.regexp_replace(F.lower(common), "common ", ""))
    given = F.lit(None).cast("string")
    for key, value in fixed.items():
        given = F.when(species == key, value).otherwise(given)
    return F.coalesce(given, own, species)


def shorthand(code: Column, fixed: dict[str, str]) -> Column:
    return renamed(F.upper(F.regexp_replace(F.regexp_replace(code, "ENS", ""), "EiJ_", "")), fixed)


def genome_names(species: DataFrame, genomes: DataFrame, fixed: dict[str, str]) -> DataFrame:
    """(species, genome_id, matched) by the renamed species; a species without a genome is reported with matched false."""
    wanted = species.select("species", renamed(F.col("species"), fixed).alias("known_as"))
    return wanted.join(genomes, F.col("known_as") == F.col("genome_name"), "left").select("species", "genome_id", F.col("genome_id").isNotNull().alias("matched"))


def with_common_names(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    return rows.join(names, key, "left")


def protein_symbols(translations: DataFrame, transcripts: DataFrame, symbols: DataFrame) -> DataFrame:
    """(protein_id, symbol): symbol of the protein's gene, the protein's own id where there is none."""
    of = transcripts.select("transcript_id", "gene_id").distinct()
    return translations.join(of, "transcript_id").join(symbols, "gene_id", "left").select("protein_id", F.coalesce("symbol", "protein_id").alias("symbol"))


def primary_accessions(lists: DataFrame, known: DataFrame, sep: str = ";") -> DataFrame:
    """(primary, secondaries): ids of each list under those of them that are known; an unknown id alone is accepted.

    Lists of several ids of which none is known are left out. ``lists`` is (list_id, ids), ``known`` is (id).
    """
    items = lists.select("list_id", F.explode(F.array_distinct(F.split("ids", sep))).alias("id")).join(known.select("id", F.lit(1).alias("is_known")), "id", "left")
    size = items.groupBy("list_id").agg(F.count("*").alias("n"))
    primary = items.where("is_known = 1").select("list_id", F.col("id").alias("primary"))
    single = items.where("is_known is null").join(size.where("n = 1"), "list_id", "left_semi").select(F.col("id").alias("primary"), F.lit(None).cast("string").alias("id"))
    second = primary.join(items.where("is_known is null").select("list_id", "id"), "list_id", "left").select("primary", "id")
    ids = F.array_join(F.array_sort(F.collect_set("id")), sep)
    return second.unionByName(single).groupBy("primary").agg(ids.alias("secondaries"))


def synonyms(lines: DataFrame, genes: DataFrame, mark: str) -> DataFrame:
    """(synonym, stable_id): all fields of a line before its last, if the last holds a mark and is a known gene."""
    p = F.split("value", "\t")
    rows = lines.select(F.element_at(p, -1).alias("stable_id"), F.explode(F.slice(p, 1, F.size(p) - 1)).alias("field"))
    out = rows.where(F.contains("stable_id", F.lit(mark))).select(F.upper(F.regexp_replace("field", "[\"']", "")).alias("synonym"), "stable_id").distinct()
    return out.join(genes.select("stable_id"), "stable_id", "left_semi").select("synonym", "stable_id")


def transferred_annotation(candidates: DataFrame, ignorance: list[str]) -> DataFrame:
    """(gene_id, species_rank, annotation) from candidates (gene_id, species_rank, type_rank, description).

    Of each species the first homology type with rows counts; its descriptions without a word of ignorance, in either
    case, are joined; the first species with any wins.
    """
    first = candidates.groupBy("gene_id", "species_rank").agg(F.min("type_rank").alias("type_rank"))
    clear = F.lit(True)
    for word in ignorance:
        clear = clear & ~F.contains(F.lower("description"), F.lit(word.lower()))
    told = candidates.join(first, ["gene_id", "species_rank", "type_rank"], "left_semi").where(clear & F.col("description").isNotNull())
    text = told.groupBy("gene_id", "species_rank").agg(F.array_join(F.array_sort(F.collect_list("description")), "; ").alias("annotation"))
    return text.withColumn("rn", F.row_number().over(Window.partitionBy("gene_id").orderBy("species_rank"))).where("rn = 1").drop("rn")


def annotated_header(name: Column, annotation: Column, source: Column, own: Column) -> Column:
    """``>id annotation``, with the source in brackets where the annotation is another's."""
    said = F.coalesce(annotation, F.lit("none"))
    return F.when(own | (said == "none"), F.concat(F.lit(">"), name, F.lit(" "), said)).otherwise(F.concat(F.lit(">"), name, F.lit(" "), said, F.lit(" [by sim to "), source, F.lit("]")))


def by_rank(names: DataFrame, ranks: DataFrame) -> DataFrame:
    """(group_id, position, name) in the order of species ranks, names of unknown species left out; positions from 1."""
    own = names.join(ranks, "species_id").select("group_id", "rank", "name")
    return ranked(own, ["group_id"], ["rank", "name"], "position").select("group_id", F.col("position").cast("int").alias("position"), "name")


def output_order(hits: DataFrame) -> DataFrame:
    """(bait, position, name): the bait itself at 0, then its hits (bait, hits joined by commas) as found."""
    p = hits.select("bait", F.posexplode(F.concat(F.array("bait"), F.split("hits", ","))).alias("position", "name"))
    return p.where("position = 0 or name <> bait")


def level_difference(levels: DataFrame) -> DataFrame:
    """(level_no, own): members of each level that the level before lacks; ``levels`` is (level_no, members)."""
    before = F.lag("members").over(Window.partitionBy("group_id").orderBy("level_no"))
    return levels.withColumn("own", F.array_except("members", F.coalesce(before, F.array().cast(levels.schema["members"].dataType))))


def new_ids(ids: DataFrame, earlier: DataFrame) -> DataFrame:
    """(id): ids without their isoform suffix, once each, that no earlier list has."""
    bare = F.regexp_replace("id", r"-\d+$", "").alias("id")
    return ids.select(bare).distinct().join(earlier.select(bare), "id", "left_anti")
