"""File sources and sinks of annotation pipelines, as distributed reads and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandweave.session import Cut


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq) of all records below a path; blanks leave the header, line breaks the sequence; of equal names the longest path wins."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^>", "").alias("record"))
    parts = F.split("record", "\n", 2)
    rows = raw.where("trim(record) <> ''").select("file", F.replace(parts[0], F.lit(" "), F.lit("")).alias("name"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("seq"))
    last = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("file")))
    return rows.withColumn("rn", last).where("rn = 1").select("name", "seq")


def fasta_text(rows: DataFrame, name: Column, seq: Column, width: int = 50) -> DataFrame:
    """(value): one record per row, the sequence wrapped."""
    from strandweave.functions.sequence import wrapped

    return rows.select(F.concat(F.lit(">"), name, F.lit("\n"), wrapped(seq, width)).alias("value"))


def write_fasta(rows: DataFrame, name: Column, seq: Column, path: str, width: int = 50) -> None:
    fasta_text(rows, name, seq, width).write.text(path)


def read_dump(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tab-separated table dump with the null marker of the dump tool."""
    return spark.read.schema(schema).csv(path, sep="\t", nullValue="\\N", escape="\\")


def write_dump(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", nullValue="\\N", escape="\\")


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Rows of the base with ``update`` fields from matching rows of the delta, then the delta's rows that match none.

    Null keys never match. A delta without update fields changes nothing but adds its new rows.
    """
    new = delta.select(*keys, *(F.col(c).alias(f"new_{c}") for c in update), F.lit(True).alias("hit_"))
    kept = base.join(new, keys, "left").select(*(F.when(F.col("hit_"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in base.columns))
    added = delta.join(base.select(*keys), keys, "left_anti")
    return kept.unionByName(added, allowMissingColumns=True)


def insert_ignore(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return base.unionByName(new.join(base.select(*keys), keys, "left_anti"))


def delete_keys(base: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return base.join(keys, on, "left_anti")


def sharded(rows: DataFrame, order: list[str], shards: int) -> DataFrame:
    """``shard``: rows dealt out in turn, in the given order.

    Rows are sorted by ranges in parallel and written once with their place in their range; the rows in the ranges
    before, one small number for each range, make the place a global one.
    """
    whole = F.monotonically_increasing_id()  # range and place in it
    placed = Cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"range_": F.shiftright(whole, 33), "place_": whole.bitwiseAND((1 << 33) - 1)}), "shards").df
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("range_").count().select("range_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start_"))
    dealt = placed.join(F.broadcast(starts), "range_")  # as many rows as there are shuffle partitions
    return dealt.withColumn("shard", ((F.col("start_") + F.col("place_")) % shards).cast("int")).select(*rows.columns, "shard")


def file_mapping(regions: DataFrame, files: DataFrame) -> DataFrame:
    """(region_id, file_ids): comma-joined file ids of each region, or ``not found``."""
    own = files.groupBy("region_id").agg(F.array_join(F.transform(F.array_sort(F.collect_set("file_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return regions.join(own, "region_id", "left").select("region_id", F.coalesce("ids", F.lit("not found")).alias("file_ids"))


def theme_genes(theme: DataFrame, genes: DataFrame) -> DataFrame:
    """Gene ids of a list of stable ids; unknown ones are dropped."""
    return genes.join(theme, "stable_id").select("gene_id", "stable_id")


def extract_range(chunks: DataFrame, ranges: DataFrame, chunk: int) -> DataFrame:
    """(range_id, seq): closed 1-based ranges of sequences stored as (seq_id, chunk_no, seq), by the chunks they touch."""
    touched = ranges.withColumn("chunk_no", F.explode(F.sequence(F.floor((F.col("first") - 1) / chunk).cast("int"), F.floor((F.col("last") - 1) / chunk).cast("int"))))
    part = touched.join(chunks, ["seq_id", "chunk_no"])
    cut = F.substring(F.col("seq"), F.greatest(F.col("first") - F.col("chunk_no") * chunk, F.lit(1)).cast("int"), (F.least(F.col("last") - F.col("chunk_no") * chunk, F.lit(chunk)) - F.greatest(F.col("first") - F.col("chunk_no") * chunk, F.lit(1)) + 1).cast("int"))
    pieces = part.select("range_id", "chunk_no", cut.alias("piece"))
    return pieces.groupBy("range_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "piece"))), lambda x: x["piece"]), "").alias("seq"))
