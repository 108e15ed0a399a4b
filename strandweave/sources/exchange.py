"""Dumps that are written, audited and loaded again, and scans of FASTA folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.sources.files import upsert

NO_DATE, FIRST_DATE = "0000-00-00", "1000-01-01"  # fixed values: the dump's empty date and what stands for it


def fasta_headers(spark: SparkSession, path: str) -> DataFrame:
    """(name, files): first token of every header line below a folder, with the files that have it."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    named = lines.where(F.startswith("value", F.lit(">"))).select(F.regexp_extract("value", r"^>\s*(\S*)", 1).alias("name"), "file")
    return named.groupBy("name").agg(F.array_sort(F.collect_set("file")).alias("files"))


def without_version(name: Column) -> Column:
    return F.regexp_replace(name, r"\.\d+$", "")


def subset_records(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records whose name without its version is in ``ids`` (id); the names keep their versions."""
    return records.join(ids.select(F.col("id").alias("wanted_")), without_version(F.col("name")) == F.col("wanted_"), "left_semi")


def versions_per_id(names: DataFrame, order: str) -> DataFrame:
    """(id, versions): versions of each id of (name, ``order``) in file order."""
    ranked = names.select(F.regexp_extract("name", r"^([^.]+)", 1).alias("id"), F.regexp_extract("name", r"\.(\d+)$", 1).alias("v"), F.col(order).alias("at"))
    return ranked.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("versions"))


def repaired_date(text: Column) -> Column:
    return F.when(text == NO_DATE, FIRST_DATE).otherwise(text).cast("date")


def reload(spark: SparkSession, source: DataFrame, path: str, table: str) -> DataFrame:
    """Loads a table unless it has as many rows as its source; one audit row (table_name, rows_before, rows_source, action)."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
    before, now = (spark.read.parquet(path).count() if there else 0), source.count()
    action = "skip" if there and before == now else "load"
    if action == "load":
        source.write.mode("overwrite").parquet(path)
    return spark.range(1).select(F.lit(table).alias("table_name"), F.lit(before).cast("long").alias("rows_before"), F.lit(now).cast("long").alias("rows_source"), F.lit(action).alias("action"))


def non_empty(rows: DataFrame, what: str) -> DataFrame:
    """The rows; raises where there are none."""
    if rows.isEmpty():
        raise ValueError(f"no rows in {what}")
    return rows


def tsv_lines(rows: DataFrame, fields: list[str], partition: str, order: list[str]) -> DataFrame:
    """(value): tab-joined fields in their order behind an id that runs within a partition; null is the dump's marker."""
    number = F.row_number().over(Window.partitionBy(partition).orderBy(*order)).cast("string")
    return rows.withColumn("id_", number).select(F.concat_ws("\t", "id_", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in fields)).alias("value"))


def flat_rows(lines: DataFrame, least: int, key_fields: int, extra: str = "payload") -> DataFrame:
    """(key, payload) of tab-separated lines with enough fields; the key joins the first fields."""
    parts = F.split("value", "\t")
    return lines.where(F.size(parts) >= least).select(F.array_join(F.slice(parts, 1, key_fields), "_").alias("key"), F.get(parts, F.lit(key_fields)).alias(extra))


def store(base: DataFrame, lines: DataFrame, least: int, key_fields: int) -> DataFrame:
    """A table (key, payload) after the upsert of flat lines."""
    return upsert(base, flat_rows(lines, least, key_fields), ["key"], ["payload"])


def unfinished(partitions: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    return partitions.select(key).distinct().join(manifest.select(key).distinct(), key, "left_anti")


def exon_dump(genes: DataFrame, exons: DataFrame, sequences: DataFrame, covered: DataFrame) -> DataFrame:
    """One row per uncovered exon of protein-coding genes with a sequence; ids of found exons are made from their code."""
    own = genes.where("biotype = 'protein_coding'").select("gene_id", F.col("stable_id").alias("gene_stable_id"), "species_id", "strand")
    name = F.when(F.col("provenance") == 1, F.concat(F.lit("E"), F.col("exon_id").cast("string"))).when(F.col("provenance") == 2, F.concat(F.lit("sw_sharp_"), F.col("exon_id").cast("string"))).when(F.col("provenance") == 3, F.concat(F.lit("usearch_"), F.col("exon_id").cast("string"))).otherwise("anon")
    return exons.join(covered.select("exon_id").distinct(), "exon_id", "left_anti").join(own, "gene_id").join(sequences, "exon_id").select(
        "exon_id", "gene_stable_id", "species_id", "strand", "start_in_gene", "end_in_gene", "is_coding", "is_canonical", name.alias("stable_id"), F.col("logic_name").alias("analysis"), "pep"
    )


def pair_lines(pairs: DataFrame, fields: list[str]) -> DataFrame:
    return pairs.select(F.concat_ws("\t", *(F.col(c).cast("string") for c in fields)).alias("value"))


def read_orthologues(lines: DataFrame, least: int = 4) -> DataFrame:
    """(gene, species, cognate, common_name) of lines with enough fields; of a gene and species the greatest cognate stays."""
    p = F.split("value", "\t")
    rows = lines.where(F.size(p) >= least).select(p[0].alias("gene"), p[1].alias("cognate"), p[2].alias("species"), p[3].alias("common_name"))
    return rows.groupBy("gene", "species").agg(F.max(F.struct("cognate", "common_name")).alias("top")).select("gene", "species", "top.cognate", "top.common_name")


def read_paralogues(lines: DataFrame, mark: str) -> DataFrame:
    """(first, second) of lines of two tokens that contain a mark."""
    p = F.split(F.trim("value"), r"\s+")
    return lines.where((F.size(p) == 2) & F.contains("value", F.lit(mark))).select(p[0].alias("first"), p[1].alias("second"))
