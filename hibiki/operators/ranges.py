"""Windows over groups of any size: rows are looked at in ranges of a numeric order column, and what passes from
one range to the next is a row a range.

Defined results: rows without the order column's value come first, in a range of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 10_000


def _ranged(df: DataFrame, column: str, size: int) -> DataFrame:
    return df.withColumn("_range", F.coalesce(F.floor(F.col(column) / size), F.lit(-(1 << 62))))


def _joined(rows: DataFrame, per: DataFrame, group: list[str]) -> DataFrame:
    """rows with what is known of their range; nulls in a group's key are one key."""
    names = {g: f"_{g}_of" for g in [*group, "_range"]}
    on = [F.col(g).eqNullSafe(F.col(n)) if g != "_range" else F.col(g) == F.col(n) for g, n in names.items()]
    return rows.join(per.withColumnsRenamed(names), on).drop(*names.values())


def with_previous(df: DataFrame, group: list[str], order: list[str], value: Column, name: str, size: int = RANGE) -> DataFrame:
    """df + name: the value of the row before in the group's order, null for the first."""
    rows = _ranged(df.withColumn("_v", value), order[0], size)
    last = rows.groupBy(*group, "_range").agg(F.max_by(F.struct("_v"), F.struct(*order)).alias("_last"))
    before = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(*group).orderBy("_range"))).drop("_last")
    w = Window.partitionBy(*group, "_range").orderBy(*order)
    own = rows.withColumn("_own", F.lag(F.struct("_v")).over(w))
    return _joined(own, before, group).withColumn(name, F.coalesce("_own", "_before").getField("_v")).select(*df.columns, name)


def with_running_count(df: DataFrame, group: list[str], order: list[str], flag: Column, name: str, size: int = RANGE) -> DataFrame:
    """df + name: how many rows of the group up to this one have the flag."""
    rows = _ranged(df.withColumn("_f", F.coalesce(flag, F.lit(False)).cast("int")), order[0], size)
    sums = rows.groupBy(*group, "_range").agg(F.sum("_f").alias("_n"))
    upto = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("_start", F.coalesce(F.sum("_n").over(upto), F.lit(0))).drop("_n")
    w = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("_own", F.sum("_f").over(w))
    return _joined(own, before, group).withColumn(name, F.col("_start") + F.col("_own")).select(*df.columns, name)


def with_sum_before(df: DataFrame, group: list[str], order: list[str], value: Column, name: str, size: int = RANGE) -> DataFrame:
    """df + name: the sum of a value over the group's rows before this one."""
    rows = _ranged(df.withColumn("_s", value), order[0], size)
    sums = rows.groupBy(*group, "_range").agg(F.sum("_s").alias("_n"))
    w = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    w = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_own", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    return _joined(own, before, group).withColumn(name, F.col("_start") + F.col("_own")).select(*df.columns, name)
