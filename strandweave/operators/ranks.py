"""Ranks inside groups of any size, and pairs of intervals that meet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandweave.session import Cut


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``name``: 1, 2, ... (long) for the rows of each group in the given order, ties in any order.

    Rows are sorted by ranges of group and order in parallel and written once with their place in their range, so a group
    of any size is spread over tasks. A group's rows are neighbours in a range: its first place there and the rows it has
    in the ranges before, one small row a group and range, make a place a rank. Nulls in ``group`` are one group.
    """
    taken = ["range_", "place_", "lead_", "before_", "of_range_"]
    if clash := set(taken) & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are used here")
    whole = F.monotonically_increasing_id()
    keys = [*group, *order]
    placed = Cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"range_": F.shiftright(whole, 33), "place_": whole.bitwiseAND((1 << 33) - 1)}), "ranked").df
    of = {c: f"of_{i}_" for i, c in enumerate(group)}
    starts = placed.groupBy(*group, "range_").agg(F.min("place_").alias("lead_"), F.count("*").alias("n_"))
    # a group's ranges are as many as there are tasks at most
    before = Window.partitionBy(*group).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_").withColumnsRenamed({**of, "range_": "of_range_"})
    same = F.col("range_") == F.col("of_range_")
    for c, renamed in of.items():
        same = same & F.col(c).eqNullSafe(F.col(renamed))
    return placed.join(starts, same).withColumn(name, F.col("before_") + F.col("place_") - F.col("lead_") + 1).select(*rows.columns, name)


def meeting_pairs(rows: DataFrame, group: str, key: str, start: str, end: str, bin_rows: int = 64) -> DataFrame:
    """(group, a, b): keys of two closed intervals of a group that meet, each pair once, a the one that starts first.

    A group's intervals, ranked by start, are cut to bins of ``bin_rows`` starts. An interval is in all bins from its
    own to the last one that begins before it ends, and is compared with those that start there after it: all in between
    are hits, so work grows with the hits and with the rows, not with the square of a group. Of equal starts the lesser
    key is first. Intervals with a null bound or an end before their start meet none.
    """
    kept = rows.where(F.col(start) <= F.col(end)).select(group, F.col(key).alias("key"), F.col(start).alias("s"), F.col(end).alias("e"))
    placed = Cut(ranked(kept, [group], ["s", "key"], "rank").withColumn("bin", F.floor((F.col("rank") - 1) / bin_rows)), "interval-bins").df
    edges = placed.groupBy(group, "bin").agg(F.min("s").alias("from"))
    # the last bin that begins at or before an interval's end: bounds and ends sorted together, by ranges where a group is large
    marks = edges.select(group, F.col("from").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast(rows.schema[key].dataType).alias("key"), "bin")
    asked = placed.select(group, F.col("e").alias("at"), F.lit(1).alias("kind"), "key", F.lit(None).cast("long").alias("bin"))
    reach = Cut(_last_known(marks.unionByName(asked), group).where("kind = 1").select(group, F.col("key").alias("of"), "last"), "interval-reach").df
    spans = placed.join(reach.withColumnRenamed(group, "of_group"), (F.col(group) == F.col("of_group")) & (F.col("key") == F.col("of"))).select(group, "key", "s", "e", "rank", F.explode(F.sequence("bin", "last")).alias("bin"))
    later = placed.select(group, "bin", F.col("key").alias("b"), F.col("s").alias("b_s"), F.col("rank").alias("b_rank"))
    return spans.join(later, [group, "bin"]).where((F.col("rank") < F.col("b_rank")) & (F.col("b_s") <= F.col("e"))).select(group, F.col("key").alias("a"), "b")


def _last_known(rows: DataFrame, group: str) -> DataFrame:
    """``last``: the greatest bin among the rows of a group at or before each row, in the order of (at, kind).

    Ranks cut a group to runs; a run's greatest bin goes to the runs behind it, so no task holds a group.
    """
    placed = Cut(ranked(rows, [group], ["at", "kind", "key"], "rank").withColumn("run", F.floor((F.col("rank") - 1) / 65_536)), "interval-marks").df
    ahead = Window.partitionBy(group).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(group, "run").agg(F.max("bin").alias("most")).withColumn("earlier", F.max("most").over(ahead)).select(F.col(group).alias("of_group"), F.col("run").alias("of_run"), "earlier")
    inside = Window.partitionBy(group, "run").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    own = placed.join(runs, (F.col(group) == F.col("of_group")) & (F.col("run") == F.col("of_run")))
    return own.withColumn("last", F.greatest(F.max("bin").over(inside), "earlier"))


def large_groups(rows: DataFrame, group: str, most: int) -> DataFrame:
    """Groups of more than ``most`` rows, for which a plan of their own pays."""
    return rows.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") > most).select(group)
