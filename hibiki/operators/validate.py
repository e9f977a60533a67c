"""Checks of a translation against its source, and what a corpus says of their bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T

# Default bands.
RATIO_MIN, RATIO_MAX, WARN_BELOW, WARN_ABOVE = 1.85, 2.94, 0.85, 1.15
DIALOGUE_SKEW, NAME_WARN, NAME_FAIL, MARGIN = 0.107, 0.65, 0.90, 0.10
ORDER = {"pass": 0, "warn": 1, "fail": 2}
#: Which names are followed: (source form, target forms) of each.
Names = list[tuple[str, list[str]]]


def measures(paras: DataFrame, names: Names) -> DataFrame:
    """One row a part: visible characters, dialogue marks and name counts of both sides.

    Every measure is a sum over paragraphs, so nothing is put together into whole
    texts and a part that holds a tenth of all rows is summed map-side.
    """
    t = F.coalesce("text", F.lit(""))
    jp, en = F.col("side") == "jp", F.col("side") == "en"

    def total(cond: Column, value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long").alias(name)

    marks = {"open": "「", "close": "」", "lq": "“", "rq": "”", "dq": '"'}
    per_name = [total(jp, T.count_of(t, a), f"jp_name{i}") for i, (a, _) in enumerate(names)] + [total(en, T.count_any(t, b), f"en_name{i}") for i, (_, b) in enumerate(names)]
    sums = paras.where("part_id is not null").groupBy("part_id").agg(
        F.count_if(jp).alias("jp_rows"),
        F.count_if(en).alias("en_rows"),
        total(jp, T.visible_chars(t), "jp_chars"),
        total(en, T.visible_chars(t), "en_chars"),
        *[total(jp, T.count_of(t, marks[m]), f"jp_{m}") for m in ("open", "close")],
        *[total(en, T.count_of(t, c), f"en_{m}") for m, c in marks.items()],
        *per_name,
    )
    corner = F.least("en_open", "en_close")
    target = F.when(corner > 0, corner).when(F.col("en_lq") + F.col("en_rq") > 0, F.least("en_lq", "en_rq")).otherwise(F.floor(F.col("en_dq") / 2))
    return sums.where("jp_rows > 0 and en_rows > 0").select(
        "part_id", "jp_chars", "en_chars", F.least("jp_open", "jp_close").alias("jp_blocks"), target.alias("en_blocks"), *[f"{s}_name{i}" for s in ("jp", "en") for i in range(len(names))]
    )


def length_ratio() -> Column:
    return F.try_divide(F.col("en_chars").cast("double"), F.nullif(F.col("jp_chars"), F.lit(0)))


def ratio_status(low: float = RATIO_MIN, high: float = RATIO_MAX) -> Column:
    """pass inside the band, warn a little outside or without source, else fail."""
    r = length_ratio()
    return F.when(F.col("jp_chars") == 0, "warn").when(r.between(low, high), "pass").when(r.between(low * WARN_BELOW, high * WARN_ABOVE), "warn").otherwise("fail")


def dialogue_skew() -> Column:
    """Null where neither side has dialogue."""
    apart = F.abs(F.col("jp_blocks") - F.col("en_blocks")) / F.greatest("jp_blocks", "en_blocks", F.lit(1))
    return F.when((F.col("jp_blocks") > 0) | (F.col("en_blocks") > 0), apart)


def dialogue_status(most: float = DIALOGUE_SKEW) -> Column:
    return F.when(F.coalesce(dialogue_skew(), F.lit(0.0)) <= most, "pass").otherwise("fail")


def name_skews(measured: DataFrame, names: Names) -> DataFrame:
    """part_id, name, jp_n, en_n, skew; a name that neither side has is left out."""
    each = F.array(*[F.struct(F.lit(a).alias("name"), F.col(f"jp_name{i}").alias("jp_n"), F.col(f"en_name{i}").alias("en_n")) for i, (a, _) in enumerate(names)])
    rows = measured.select("part_id", F.explode(each).alias("r")).select("part_id", "r.*").where("jp_n > 0 or en_n > 0")
    return rows.withColumn("skew", F.abs(F.col("jp_n") - F.col("en_n")) / F.greatest("jp_n", "en_n", F.lit(1)))


def worst_name_skew(names: Names) -> Column:
    one = [F.when((F.col(f"jp_name{i}") > 0) | (F.col(f"en_name{i}") > 0), F.abs(F.col(f"jp_name{i}") - F.col(f"en_name{i}")) / F.greatest(f"jp_name{i}", f"en_name{i}", F.lit(1))) for i in range(len(names))]
    return F.greatest(*one) if len(one) > 1 else one[0]


def name_status(names: Names) -> Column:
    s = F.coalesce(worst_name_skew(names), F.lit(0.0))
    return F.when(s > NAME_FAIL, "fail").when(s > NAME_WARN, "warn").otherwise("pass")


def worst(*statuses: Column) -> Column:
    rank = F.create_map(*[F.lit(x) for kv in ORDER.items() for x in kv])
    back = F.create_map(*[F.lit(x) for k, v in ORDER.items() for x in (v, k)])
    return back[F.greatest(*[rank[s] for s in statuses])]


def validated(measured: DataFrame, names: Names) -> DataFrame:
    """part_id, the three statuses and the worst of them."""
    out = measured.select("part_id", ratio_status().alias("length"), dialogue_status().alias("dialogue"), name_status(names).alias("names"))
    return out.withColumn("overall", worst(F.col("length"), F.col("dialogue"), F.col("names")))


def metrics(measured: DataFrame, names: Names) -> DataFrame:
    """metric, value: the measures unpivoted; those that a part lacks are left out."""
    each = F.array(
        F.struct(F.lit("length_ratio").alias("metric"), length_ratio().alias("value")),
        F.struct(F.lit("dialogue_skew").alias("metric"), dialogue_skew().alias("value")),
        *[
            F.struct(F.lit(f"name_skew_{i}").alias("metric"), F.when((F.col(f"jp_name{i}") > 0) | (F.col(f"en_name{i}") > 0), F.abs(F.col(f"jp_name{i}") - F.col(f"en_name{i}")) / F.greatest(f"jp_name{i}", f"en_name{i}", F.lit(1))).alias("value"))
            for i in range(len(names))
        ],
    )
    return measured.select(F.explode(each).alias("m")).select("m.*").where("value is not null")


def distribution(values: DataFrame) -> DataFrame:
    """metric, n, mean, stdev (population), min, p05 ... p95, max: exact quantiles, one aggregate for all metrics."""
    q = F.percentile("value", F.array(*[F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)]))
    out = values.groupBy("metric").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("stdev"), F.min("value").alias("min"), q.alias("q"), F.max("value").alias("max"))
    names = ["p05", "p25", "p50", "p75", "p95"]
    return out.select("metric", "n", *[F.round(c, 6).alias(c) for c in ("mean", "stdev", "min")], *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(names)], F.round("max", 6).alias("max"))


def recommendations(dist: DataFrame, margin: float = MARGIN) -> DataFrame:
    """length_min, length_max, dialogue_max: one row; fixed defaults stand in for what nothing was measured of."""
    of = lambda metric, q: F.max(F.when(F.col("metric") == metric, F.col(q)))
    return dist.agg(
        F.coalesce(F.round(of("length_ratio", "p05") * (1 - margin), 2), F.lit(1.0)).alias("length_min"), F.coalesce(F.round(of("length_ratio", "p95") * (1 + margin), 2), F.lit(3.0)).alias("length_max"),
        F.coalesce(F.round(of("dialogue_skew", "p95"), 3), F.lit(0.1)).alias("dialogue_max"),
    )


def recommended(dist: DataFrame, margin: float = MARGIN) -> DataFrame:
    """metric, low, high: the quantile band widened by the margin."""
    return dist.select("metric", F.round(F.col("p05") * (1 - margin), 6).alias("low"), F.round(F.col("p95") * (1 + margin), 6).alias("high"))


def narrator(paras: DataFrame, a: str, b: str, least: int = 3) -> DataFrame:
    """part_id, a_n, b_n, narrator, confident: who tells a part, by who is named less in its narration.

    A narrator rarely names themself. Ties and parts with fewer than `least` mentions have none.
    """
    t = F.coalesce("text", F.lit(""))
    told = paras.where("side = 'jp' and part_id is not null").where(T.paragraph_kind("text") == "narration")
    n = told.groupBy("part_id").agg(F.sum(T.count_of(t, a)).alias("a_n"), F.sum(T.count_of(t, b)).alias("b_n"))
    known = (F.col("a_n") + F.col("b_n") >= least) & (F.col("a_n") != F.col("b_n"))
    low, high = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return n.select("part_id", "a_n", "b_n", F.when(known, F.when(F.col("a_n") < F.col("b_n"), a).otherwise(b)).alias("narrator"), (known & ((high > 2 * low) | (high - low >= 3))).alias("confident"))
