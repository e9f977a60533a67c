"""Deterministic stratified holdouts and leak-free reference windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET, SEED, WINDOW = 30, 7, 10


def bucket(number: str = "part_number", top: str = "top") -> Column:
    """early, middle or late third of the story, by position over the greatest eligible number."""
    share = F.col(number) / F.greatest(F.col(top), F.lit(1))
    return F.when(share < 1 / 3, "early").when(share < 2 / 3, "middle").otherwise("late")


def quotas(target: int, strata: list[str]) -> dict[tuple[str, str], int]:
    """Equal thirds, what is left to the late one; inside a bucket the odd slots go to the last strata."""
    each = target // 3
    out = {}
    for name, n in (("early", each), ("middle", each), ("late", target - 2 * each)):
        base, odd = divmod(n, len(strata))
        for i, s in enumerate(strata):
            out[name, s] = base + (1 if i >= len(strata) - odd else 0)
    return out


def bucketed(eligible: DataFrame) -> DataFrame:
    """eligible + bucket; the greatest number is one small aggregate, joined back."""
    top = eligible.agg(F.max("part_number").alias("top"))
    return eligible.join(top, F.lit(True)).withColumn("bucket", bucket()).drop("top")


def picked(eligible: DataFrame, strata: list[str], target: int = TARGET, seed: int = SEED) -> DataFrame:
    """id, part_number, pov, bucket of the held-out parts: in each cell the first of a seeded hash order."""
    q = quotas(target, strata)
    cells = F.create_map(*[F.lit(x) for (b, s), n in q.items() for x in (f"{b}|{s}", n)])
    w = Window.partitionBy("bucket", "pov").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "id").cast("binary")), "id")
    rows = bucketed(eligible.where(F.col("pov").isin(strata))).withColumn("_rn", F.row_number().over(w))
    return rows.where(F.col("_rn") <= F.coalesce(F.try_element_at(cells, F.concat_ws("|", "bucket", "pov")), F.lit(0))).select("id", "part_number", "pov", "bucket")


def cell_counts(holdout: DataFrame) -> DataFrame:
    """bucket, pov, n."""
    return holdout.groupBy("bucket", "pov").agg(F.count("*").alias("n"))


def style_corpus(parts: DataFrame, held: DataFrame, through: int) -> DataFrame:
    """parts up to a number, with `held`: whether the part is held out (to be left out, and counted). held: id."""
    h = held.select("id").where("id is not null").distinct().withColumn("_h", F.lit(True))
    return parts.where(F.col("part_number") <= through).join(h, "id", "left").withColumn("held", F.col("_h").isNotNull()).drop("_h")


def reference_windows(parts: DataFrame, size: int = WINDOW) -> DataFrame:
    """id, part_number, ref_id, ref_number, place: the last `size` eligible parts before each part, oldest first.

    parts: id, part_number, eligible. Both sides are ranked and joined on equal
    blocks of the rank, so the as-of join is an equi-join that grows with the
    output, not a range join. Nothing at or after a part is ever its reference.
    """
    order = Window.orderBy("part_number", "id")
    ranked = parts.withColumn("rk", F.sum(F.col("eligible").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    ranked = ranked.withColumn("rk", F.coalesce("rk", F.lit(0)))
    refs = parts.where("eligible").select(F.col("id").alias("ref_id"), F.col("part_number").alias("ref_number"), F.row_number().over(order).alias("erk"))
    wanted = ranked.where("rk > 0").select("id", "part_number", "rk", F.explode(F.sequence(F.greatest(F.col("rk") - (size - 1), F.lit(1)), F.col("rk"))).alias("erk"))
    return wanted.join(refs, "erk").select("id", "part_number", "ref_id", "ref_number", (F.col("erk") - F.greatest(F.col("rk") - (size - 1), F.lit(1)) + 1).cast("long").alias("place"))


def underfilled(parts: DataFrame, size: int = WINDOW) -> DataFrame:
    """id, have, lacking: parts whose window isn't full."""
    got = reference_windows(parts, size).groupBy("id").agg(F.count("*").alias("have"))
    return parts.select("id").join(got, "id", "left").select("id", F.coalesce("have", F.lit(0)).alias("have")).withColumn("lacking", F.lit(size) - F.col("have")).where("lacking > 0")


def window_prompt(windows: DataFrame, titles: DataFrame) -> DataFrame:
    """id, prompt: each window's titles, oldest first, a line each."""
    return (
        windows.join(titles.select(F.col("id").alias("ref_id"), "title"), "ref_id", "left")
        .withColumn("line", F.concat(F.col("ref_id"), F.lit(": "), F.coalesce("title", F.lit(""))))
        .groupBy("id")
        .agg(F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY place)").alias("prompt"))
    )


def merged_references(explicit: DataFrame, recent: DataFrame, limit: int) -> DataFrame:
    """target, ref_id, ref_number: the explicit references and the newest others, at most `limit` in all.

    An explicit reference wins over a recent one with the same id.
    """
    both = explicit.withColumn("rank", F.lit(0)).unionByName(recent.withColumn("rank", F.lit(1)))
    one = Window.partitionBy("target", "ref_id").orderBy("rank")
    both = both.withColumn("_rn", F.row_number().over(one)).where("_rn = 1")
    w = Window.partitionBy("target").orderBy("rank", F.desc("ref_number"), "ref_id")
    return both.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).select("target", "ref_id", "ref_number")
