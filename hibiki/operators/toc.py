"""The table of contents: positions, overrides, volumes and neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def flattened(entries: DataFrame, nest: list[str], key: str) -> DataFrame:
    """key, position (from 0): nested lists in reading order."""
    return entries.select(*nest, key).withColumn("position", F.row_number().over(Window.orderBy(*nest, key)) - 1).select(key, "position")


def mapped(parts: DataFrame, episodes: DataFrame) -> DataFrame:
    """id, part_number, episode, confidence: part n is the n-th episode; out of range needs review."""
    out = parts.select("id", "part_number").join(episodes.select(F.col("episode"), (F.col("position") + 1).alias("part_number")), "part_number", "left")
    return out.select("id", "part_number", "episode", F.when(F.col("episode").isNull(), "needs_review").otherwise("high").alias("confidence"))


def overridden(mapping: DataFrame, overrides: DataFrame, known: DataFrame) -> DataFrame:
    """mapping with manual bindings: null episode = not on the site, a known one = bound, else unknown."""
    o = overrides.select(F.col("id").alias("_id"), F.col("episode").alias("_to"))
    k = known.select(F.col("episode").alias("_known")).distinct()
    j = mapping.join(o, F.col("id") == F.col("_id"), "left").join(k, F.col("_to") == F.col("_known"), "left")
    outcome = F.when(F.col("_id").isNull(), "kept").when(F.col("_to").isNull(), "not_on_site").when(F.col("_known").isNull(), "unknown_episode").otherwise("bound")
    return j.select("id", "part_number", F.when(outcome == "bound", F.col("_to")).when(outcome == "not_on_site", F.lit(None)).otherwise(F.col("episode")).alias("episode"), outcome.alias("outcome"))


def source_only(episodes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Episodes that no part is bound to."""
    return episodes.join(mapping.where(F.col("episode").isNotNull()).select("episode"), "episode", "left_anti")


def volumes(blocks: DataFrame, order: list[str], is_break: Column) -> DataFrame:
    """blocks + volume: one more than the breaks strictly before the block, counted by partition sums.

    The running count over all rows would be one task; it is taken in ranges of
    the order's first column instead, each started at the sum of those before it.
    """
    b = blocks.withColumn("_break", is_break.cast("int")).withColumn("_range", F.floor(F.col(order[0]) / 10_000))
    starts = b.groupBy("_range").agg(F.sum("_break").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return b.join(starts, "_range").withColumn("volume", 1 + F.col("_before") + F.coalesce(F.sum("_break").over(inside), F.lit(0))).drop("_break", "_range", "_before")


def neighbours(parts: DataFrame, marked: DataFrame, reach: int = 3) -> DataFrame:
    """id, other, distance: for marked parts the others within `reach` numbers, by equi-joins on the number."""
    want = marked.select("id", "part_number", F.explode(F.sequence(F.col("part_number") - reach, F.col("part_number") + reach)).alias("n"))
    return want.join(parts.select(F.col("id").alias("other"), F.col("part_number").alias("n")), "n").select("id", "other", (F.col("n") - F.col("part_number")).alias("distance"))


def first_gaps(used: DataFrame, group: str, number: str) -> DataFrame:
    """group, next_free: the first unused number from 1 on.

    It is the least of 1 and the successors of used numbers that isn't used.
    """
    u = used.select(F.col(group).alias("g"), F.col(number).alias("n")).where("g is not null and n >= 1").distinct()
    succ = u.select("g", (F.col("n") + 1).alias("n")).unionByName(u.select("g", F.lit(1).alias("n")).distinct())
    free = succ.join(u, ["g", "n"], "left_anti").groupBy("g").agg(F.min("n").alias("next_free"))
    return free.withColumnRenamed("g", group)


def sequence_ids(new: DataFrame, used: DataFrame, group: str, order: list[str], number: str) -> DataFrame:
    """new + number: counted on from the greatest used number of the group.

    Rows are counted in ranges of the first order column, each started at the sum of those before it, so a group that
    holds many rows is spread over tasks; an order that starts with no number is one range.
    """
    top = used.groupBy(F.col(group).alias("_g")).agg(F.max(number).alias("_top"))
    numeric = isinstance(new.schema[order[0]].dataType, NumericType)
    rows = new.withColumn("_range", F.floor(F.col(order[0]) / 10_000) if numeric else F.lit(0))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(group, "_range").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    w = Window.partitionBy(group, "_range").orderBy(*order)
    j = rows.join(starts, [group, "_range"]).join(top, F.col(group) == F.col("_g"), "left")
    return j.withColumn(number, F.coalesce("_top", F.lit(0)) + F.col("_start") + F.row_number().over(w)).select(*new.columns, number)
