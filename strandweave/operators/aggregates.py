"""Aggregations over annotation tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandweave.operators.ranks import ranked
from strandweave.session import Cut

#: Pairs that one task counts, and members of one list of a value.
PAIRS_A_PART, LIST = 1_000_000, 4_096


def group_representatives(genes: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, representative, members): species by gene count, the first stands for its group, members after it."""
    counts = genes.groupBy("species_id").agg(F.count("*").alias("n")).join(groups, "species_id")
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "species_id")))
    ranked = counts.groupBy("group_id").agg(order.alias("o"))
    return ranked.select("group_id", F.col("o")[0]["species_id"].alias("representative"), F.array_join(F.transform(F.slice("o", 2, 100000), lambda x: x["species_id"].cast("string")), ",").alias("members"))


def translated_region(genes: DataFrame, exons: DataFrame, exon_transcript: DataFrame, translations: DataFrame) -> DataFrame:
    """(gene_id, tr_start, tr_end): extent of all translations; a gene without one has its span inverted."""
    place = exons.select("exon_id", "start_in_gene", "end_in_gene")
    first = place.select(F.col("exon_id").alias("start_exon_id"), F.col("start_in_gene").alias("fs"), F.col("end_in_gene").alias("fe"))
    last = place.select(F.col("exon_id").alias("end_exon_id"), F.col("start_in_gene").alias("ls"), F.col("end_in_gene").alias("le"))
    of = exon_transcript.select("gene_id", "transcript_id").distinct()
    ends = translations.join(of, "transcript_id").join(genes.select("gene_id", "strand"), "gene_id").join(first, "start_exon_id").join(last, "end_exon_id")
    forward = F.col("strand") > 0
    start = F.when(forward, F.col("fs") + F.col("seq_start") - 1).otherwise(F.col("le") - F.col("seq_end") + 1)
    end = F.when(forward, F.col("ls") + F.col("seq_end") - 1).otherwise(F.col("fe") - F.col("seq_start") + 1)
    found = ends.groupBy("gene_id").agg(F.min(start).alias("tr_start"), F.max(end).alias("tr_end"))
    size = F.col("region_end") - F.col("region_start")
    return genes.join(found, "gene_id", "left").select("gene_id", F.coalesce("tr_start", size).alias("tr_start"), F.coalesce("tr_end", F.lit(0).cast("long")).alias("tr_end"))


def reading_frames(bounded: DataFrame) -> DataFrame:
    """(gene_id, coding_length, remainder): effective length of a gene's canonical coding exons and its rest by 3."""
    size = F.when(F.col("is_coding") == 1, F.col("eff_end") - F.col("eff_start") + 1).otherwise(0)
    out = bounded.where("in_canonical = 1").groupBy("gene_id").agg(F.sum(size).cast("long").alias("coding_length"))
    return out.withColumn("remainder", F.pmod("coding_length", F.lit(3)))


def exon_counts(genes: DataFrame, exons: DataFrame) -> DataFrame:
    """(gene_id, n_exons, n_canonical) with zeros for genes without exons."""
    own = exons.groupBy("gene_id").agg(F.count("*").alias("n"), F.count_if(F.col("is_canonical") == 1).alias("c"))
    return genes.select("gene_id").join(own, "gene_id", "left").select("gene_id", F.coalesce("n", F.lit(0)).alias("n_exons"), F.coalesce("c", F.lit(0)).alias("n_canonical"))


def sequence_coverage(exons: DataFrame, sequences: DataFrame) -> DataFrame:
    """(gene_id, n_canonical, n_with_seq) over canonical exons."""
    have = sequences.select("exon_id", F.lit(1).alias("has"))
    return exons.where("is_canonical = 1").join(have, "exon_id", "left").groupBy("gene_id").agg(F.count("*").alias("n_canonical"), F.count("has").alias("n_with_seq"))


def totals_with_all(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n): rows of two tables per key, and in all with a null key."""
    return left.select(key).unionByName(right.select(key)).rollup(key).agg(F.count("*").alias("n"))


def histogram(rows: DataFrame, key: str) -> DataFrame:
    """(n_per_key, n_keys): how many keys have how many rows."""
    return rows.groupBy(key).agg(F.count("*").alias("n_per_key")).groupBy("n_per_key").agg(F.count("*").alias("n_keys"))


def map_coverage(exons: DataFrame, maps: DataFrame) -> DataFrame:
    """(gene_id, n_exons, n_mapped, percent) over canonical coding exons."""
    mapped = maps.select("exon_id").distinct().withColumn("hit", F.lit(1))
    own = exons.where("is_canonical = 1 and is_coding = 1").join(mapped, "exon_id", "left").groupBy("gene_id").agg(F.count("*").alias("n_exons"), F.count("hit").alias("n_mapped"))
    return own.withColumn("percent", F.col("n_mapped") * 100.0 / F.col("n_exons"))


def merged_problems(problems: DataFrame) -> DataFrame:
    """(gene_id, description): the distinct problems of a gene in one text."""
    return problems.groupBy("gene_id").agg(F.array_join(F.array_sort(F.collect_set("description")), " | ").alias("description"))


def joined_list(rows: DataFrame, key: str, value: str, sep: str, name: str) -> DataFrame:
    """Distinct values of a key in order, joined."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_set(value)), lambda x: x.cast("string")), sep).alias(name))


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


# windows

def running_ids(rows: DataFrame, partition: str, order: list[str]) -> DataFrame:
    """``id``: 1, 2, ... in each partition, which may be of any size."""
    return ranked(rows, [partition], order, "id")


def decorated(exons: DataFrame) -> DataFrame:
    """(gene_id, decorated): per gene B, three-digit ordinal, peptide and Z of each exon, reversed on the minus strand."""
    order = F.when(F.col("strand") < 0, -F.col("start_in_gene")).otherwise(F.col("start_in_gene"))
    items = F.array_sort(F.collect_list(F.struct(order.alias("k"), "exon_id", "pep")))
    grouped = exons.groupBy("gene_id").agg(items.alias("o"))
    n = F.size("o")
    piece = lambda x, i: F.concat(F.lit("B"), F.lpad((i + 1).cast("string"), 3, "0"), F.when(i == n - 1, F.regexp_replace(x["pep"], r"\*$", "")).otherwise(x["pep"]), F.lit("Z"))
    return grouped.select("gene_id", F.array_join(F.transform("o", piece), "").alias("decorated"))


def neighbours(exons: DataFrame) -> DataFrame:
    w = Window.partitionBy("gene_id").orderBy("start_in_gene", "exon_id")
    return exons.withColumns({"prev_exon": F.lag("exon_id").over(w), "next_exon": F.lead("exon_id").over(w)})


def cdna_positions(exons: DataFrame) -> DataFrame:
    """``cdna_start`` and ``cdna_end`` of each coding exon, 1-based in reading order."""
    order = F.when(F.col("strand") < 0, -F.col("start_in_gene")).otherwise(F.col("start_in_gene"))
    w = Window.partitionBy("gene_id").orderBy(order, "exon_id").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("end_in_gene") - F.col("start_in_gene") + 1
    before = F.coalesce(F.sum(size).over(w), F.lit(0))
    return exons.withColumns({"cdna_start": (before + 1).cast("long"), "cdna_end": (before + size).cast("long")})


def overlaps_previous(exons: DataFrame) -> DataFrame:
    """(gene_id, overlapping): whether any exon starts before the one ahead of it ends."""
    w = Window.partitionBy("gene_id").orderBy("start_in_gene", "exon_id")
    hit = (F.lag("end_in_gene").over(w) > F.col("start_in_gene")).cast("int")
    return exons.withColumn("hit", hit).groupBy("gene_id").agg(F.coalesce(F.max("hit"), F.lit(0)).alias("overlapping"))


def species_names(rows: DataFrame) -> DataFrame:
    """``name``: the species for its first gene, the species with _2, _3, ... for the ones after."""
    base = F.concat(F.lit("s"), F.col("species_id").cast("string"))
    return ranked(rows, ["species_id"], ["gene_id"], "n").withColumn("name", F.when(F.col("n") == 1, base).otherwise(F.concat(base, F.lit("_"), F.col("n").cast("string")))).drop("n")


def missing_class(exons: DataFrame) -> DataFrame:
    """(exon_id, neighbourhood, left_bound, right_bound) of each exon without a map: both, no_left or no_right.

    ``exons`` is (gene_id, exon_id, start_in_gene, mapped, found), the last two 0 or 1: whether the exon has a map, and
    whether a search has found it since. Classes ask the immediate neighbours, left before right; a first exon has no
    left, a last one no right. A bound is the mapped neighbour's id; on the right of a ``no_left`` exon it is the nearest
    exon that is mapped or was found, as the search goes on from what it found. Exons of which nothing is known on either
    side have no bound.
    """
    w = Window.partitionBy("gene_id").orderBy("start_in_gene", "exon_id")
    left, right = (F.coalesce(f("mapped").over(w), F.lit(0)) == 1 for f in (F.lag, F.lead))
    known = F.first(F.when((F.col("mapped") == 1) | (F.col("found") == 1), F.col("exon_id")), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    kind = F.when(left & right, "both").when(~left, "no_left").otherwise("no_right")
    out = exons.withColumns({"neighbourhood": kind, "left_bound": F.when(left, F.lag("exon_id").over(w)), "right_bound": F.when(left & right, F.lead("exon_id").over(w)).when(~left, known)})
    return out.where("mapped = 0").select("exon_id", "neighbourhood", "left_bound", "right_bound")


# top-k and sets

def best_maps(maps: DataFrame, least: float) -> DataFrame:
    """The map of highest similarity per species and exon, the later cognate exon on a tie."""
    w = Window.partitionBy("species_id", "exon_id").orderBy(F.desc("similarity"), F.desc("cognate_exon_id"), F.desc("part"))
    return maps.where(F.col("similarity") >= least).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def ranked_names(names: DataFrame, ranks: DataFrame) -> DataFrame:
    """Names with the rank of their species, those of unknown species left out."""
    return names.join(ranks, "species_id").withColumn("position", F.row_number().over(Window.partitionBy("group_id").orderBy("rank", "name")))


def complement(genes: DataFrame, themes: list[DataFrame]) -> DataFrame:
    out = genes.select("gene_id").distinct()
    for theme in themes:
        out = out.join(theme, "gene_id", "left_anti")
    return out


def shared_sets(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, other_key, n_shared): pairs of keys that share values, by an equi join on the value."""
    own = Cut(rows.select(key, value).distinct(), "shared-values").df
    return pair_counts(own.select(F.col(key).alias("a"), value), own.select(F.col(key).alias("b"), value), value, "n_shared").select("a", "b", "n_shared")


def pair_counts(a: DataFrame, b: DataFrame, value: str, name: str) -> DataFrame:
    """(a, b, ..., name): how often each a of ``a`` meets a greater b of ``b`` on a value; other columns must follow from a or b.

    An a travels once a value with the list of all it meets, not once a pair. Lists are counted in parts of a number of
    their own, told by how many meet, so a task's memory does not grow with the input; long lists are cut, and what an a
    of very many pairs meets is dealt out by b.
    """
    a, b = (x.where(F.col(value).isNotNull()) for x in (a, b))
    sizes = a.groupBy(value).agg(F.count("*").alias("n_"))
    pairs, most = sizes.agg(F.sum(F.col("n_").cast("double") * (F.col("n_") - 1) / 2), F.max("n_")).first()
    held = a.groupBy("a").count().agg(F.max("count")).first()[0]
    parts = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((pairs or 0) / PAIRS_A_PART))
    own, other = ([c for c in x.columns if c != value] for x in (a, b))
    if (most or 0) * (held or 0) > PAIRS_A_PART:
        hubs = a.join(sizes, value).groupBy("a").agg(F.ceil(F.sum("n_") / PAIRS_A_PART).cast("int").alias("salts_")).where("salts_ > 1")
        a = a.join(hubs, "a", "left").withColumn("salts_", F.coalesce("salts_", F.lit(1)))
    else:
        a = a.withColumn("salts_", F.lit(1))
    # few bytes are many pairs, so values are dealt to as many parts as pairs are
    a, b = (x.repartition(parts, value) for x in (a, b))
    cut = F.pmod(F.xxhash64("b"), F.ceil(F.count("*").over(Window.partitionBy(value)) / LIST))
    lists = b.withColumn("cut_", cut).groupBy(value, "cut_").agg(F.collect_list(F.struct(*other)).alias("met_"))
    rows = a.join(lists, value).withColumn("salt_", F.explode(F.sequence(F.lit(0), F.col("salts_") - 1)))
    mine = F.filter("met_", lambda x: (x["b"] > F.col("a")) & ((F.col("salts_") == 1) | (F.pmod(F.xxhash64(x["b"]), F.col("salts_")) == F.col("salt_"))))
    rows = rows.select("salt_", *own, mine.alias("met_")).where("size(met_) > 0").select("salt_", *own, *(F.col("met_")[c].alias(c) for c in other))
    each = rows.repartition(parts, "a", "salt_").select("salt_", *own, F.inline(F.arrays_zip(*other)))
    return each.groupBy("salt_", *own, *other).agg(F.count("*").alias(name)).drop("salt_")
