"""Alignment tables: rows (aln_id, seq_id, seq), or one row per column in ``columns``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def columns(aln: DataFrame) -> DataFrame:
    """(aln_id, seq_id, pos, ch), pos from 1."""
    letters = F.filter(F.split("seq", ""), lambda x: x != "")
    return aln.select("aln_id", "seq_id", F.posexplode(letters).alias("p", "ch")).select("aln_id", "seq_id", (F.col("p") + 1).alias("pos"), "ch")


def rebuilt(long: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("pos", "ch")))
    return long.groupBy("aln_id", "seq_id").agg(ordered.alias("o")).select("aln_id", "seq_id", F.array_join(F.transform("o", lambda x: x["ch"]), "").alias("seq"))


def without_common_gaps(aln: DataFrame) -> DataFrame:
    """Columns that are a gap in every sequence are dropped; masks meet per alignment, sequences are not taken apart."""
    mask = columns(aln).groupBy("aln_id", "pos").agg(F.bool_or(F.col("ch") != "-").alias("keep")).where("keep")
    kept = mask.groupBy("aln_id").agg(F.array_sort(F.collect_list("pos")).alias("kept"))
    return aln.join(kept, "aln_id").select("aln_id", "seq_id", F.array_join(F.transform("kept", lambda p: F.substring(F.col("seq"), p, F.lit(1))), "").alias("seq"))


def restricted_to(aln: DataFrame, targets: DataFrame, gaps: str = "-.") -> DataFrame:
    """Only the columns in which the alignment's target (aln_id, target_id) has a residue."""
    target = aln.join(targets, "aln_id").where("seq_id = target_id")
    places = F.filter(F.sequence(F.lit(1), F.length("seq")), lambda p: ~F.contains(F.lit(gaps), F.substring(F.col("seq"), p, F.lit(1))))
    return aln.join(target.select("aln_id", places.alias("kept")), "aln_id").select("aln_id", "seq_id", F.array_join(F.transform("kept", lambda p: F.substring(F.col("seq"), p, F.lit(1))), "").alias("seq"))


def without_gappy(aln: DataFrame, most: float = 0.33) -> DataFrame:
    """Sequences of which at most a share is X, point or gap."""
    return aln.where(F.length(F.regexp_replace("seq", "[^X.-]", "")) / F.length("seq") <= most)


def without_long(aln: DataFrame, references: DataFrame, most: float = 1.3) -> DataFrame:
    """Sequences at most ``most`` times as long as their alignment's reference (aln_id, target_id), gaps apart."""
    size = F.length(F.regexp_replace("seq", "-", ""))
    own = aln.withColumn("n", size)
    ref = own.join(references, "aln_id").where("seq_id = target_id").select("aln_id", F.col("n").alias("ref_n"))
    return own.join(ref, "aln_id").where(F.col("n") <= most * F.col("ref_n")).select("aln_id", "seq_id", "seq")


def majority(aln: DataFrame, least: float = 0.9) -> DataFrame:
    """(aln_id, pos, ch): the top letter of a column where it is alone at the top and frequent enough."""
    counts = columns(aln).groupBy("aln_id", "pos", "ch").agg(F.count("*").alias("n"))
    top = counts.groupBy("aln_id", "pos").agg(F.sum("n").alias("total"), F.max(F.struct("n", "ch")).alias("top"), F.max("n").alias("best"))
    ties = counts.join(top, ["aln_id", "pos"]).where("n = best").groupBy("aln_id", "pos").agg(F.count("*").alias("k"))
    return top.join(ties, ["aln_id", "pos"]).where((F.col("k") == 1) & (F.col("best") / F.col("total") >= least)).select("aln_id", "pos", F.col("top")["ch"].alias("ch"))


def pruned(aln: DataFrame, most: float = 0.6) -> DataFrame:
    """Sequences of which less than a share deviates from the columns' most frequent letters, all ties being such."""
    long = columns(aln)
    counts = long.groupBy("aln_id", "pos", "ch").agg(F.count("*").alias("n"))
    modes = counts.withColumn("r", F.rank().over(Window.partitionBy("aln_id", "pos").orderBy(F.desc("n")))).where("r = 1").select("aln_id", "pos", "ch", F.lit(1).alias("mode"))
    off = long.join(modes, ["aln_id", "pos", "ch"], "left").groupBy("aln_id", "seq_id").agg(F.count_if(F.col("mode").isNull()).alias("off"), F.count("*").alias("n"))
    return aln.join(off.where(F.col("off") / F.col("n") < most).select("aln_id", "seq_id"), ["aln_id", "seq_id"], "left_semi")


def length_check(aln: DataFrame) -> DataFrame:
    """(aln_id, equal_lengths): whether all sequences are of one length above 0."""
    n = F.length("seq")
    return aln.groupBy("aln_id").agg(((F.min(n) == F.max(n)) & (F.max(n) > 0)).alias("equal_lengths"))


def first_residues(aln: DataFrame) -> DataFrame:
    """(aln_id, seq_id, first_pos, piece_no): first residue of each sequence, 0 if none, and their order by it."""
    first = F.length("seq") - F.length(F.regexp_replace("seq", "^-+", "")) + 1
    out = aln.select("aln_id", "seq_id", F.when(first > F.length("seq"), 0).otherwise(first).alias("first_pos"))
    return out.withColumn("piece_no", F.row_number().over(Window.partitionBy("aln_id").orderBy("first_pos", "seq_id")))
