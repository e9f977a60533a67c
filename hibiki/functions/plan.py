"""Small helpers that shape a logical plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once a row, however often they are used.

    Catalyst inlines a column's expression into every place above it that reads
    it, filters included; with costly regexes this multiplies the work. A
    generator of one struct is a border which inlining doesn't cross.
    """
    keep = [c for c in df.columns if c not in exprs]
    made = F.explode(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))).alias("_once")
    return df.select(*keep, made).select(*keep, *[F.col("_once").getField(n).alias(n) for n in exprs])


def guarded(df: DataFrame, facts: DataFrame, ok: Column, message: str) -> DataFrame:
    """df, whose reading fails with `message` where `ok` doesn't hold on the one row of facts.

    The check is a branch of its own without rows, so that no optimizer drops it with an unused column.
    """
    fails = F.when(F.coalesce(ok, F.lit(False)), F.lit(False)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return df.unionByName(facts.where(fails).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]))
