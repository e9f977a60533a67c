"""Audits of an index against its sources, and quality gates of model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.session import cut

from . import ranges, spans

# Gates of an extraction.
MAX_PAIR_JP, MAX_PAIR_EN, MIN_COVERAGE, SPARSE_COVERAGE, LONG_PART, FEW = 600, 1800, 0.70, 0.50, 2000, 5


def holds(source: Column | str, span: Column | str) -> Column:
    """The span stands in the source, white space and case aside; null spans and empty ones don't."""
    key = T.verbatim_key(span)
    return F.coalesce((F.length(key) > 0) & F.contains(T.verbatim_key(source), key), F.lit(False))


def coverage(index: DataFrame, source: DataFrame) -> DataFrame:
    """part_id, source_chars, indexed_chars, coverage: visible characters that the index holds.

    index and source: part_id, text. Both are summed before they are joined.
    """
    a = source.where("part_id is not null").groupBy("part_id").agg(F.coalesce(F.sum(T.visible_chars("text")), F.lit(0)).alias("source_chars"))
    b = index.where("part_id is not null").groupBy(F.col("part_id").alias("_p")).agg(F.coalesce(F.sum(T.visible_chars("text")), F.lit(0)).alias("indexed_chars"))
    out = a.join(b, F.col("part_id") == F.col("_p"), "left")
    n = F.coalesce("indexed_chars", F.lit(0))
    return out.select("part_id", "source_chars", n.alias("indexed_chars"), F.round(n / F.greatest("source_chars", F.lit(1)), 6).alias("coverage"))


def count_outliers(index: DataFrame, key: str, z: float = -2.0) -> DataFrame:
    """key, n, z: parts with far fewer rows than others (sample deviation)."""
    per = index.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    stats = per.agg(F.avg("n").alias("mean"), F.stddev_samp("n").alias("sd"))
    out = per.join(stats, F.lit(True)).withColumn("z", F.round(F.try_divide(F.col("n") - F.col("mean"), F.nullif(F.col("sd"), F.lit(0.0))), 6))
    return out.where(F.col("z") < z).select(key, "n", "z")


def rate(df: DataFrame, group: str, flag: Column) -> DataFrame:
    """group, n, hits, rate of a flag."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.count_if(flag).alias("hits")).withColumn("rate", F.round(F.col("hits") / F.col("n"), 6))


def trivial(a: str, b: str, longest: int = 30) -> Column:
    """Equal, or one inside the other, both short."""
    x, y = T.verbatim_key(a), T.verbatim_key(b)
    return F.coalesce((F.length(x) <= longest) & (F.length(y) <= longest) & ((x == y) | F.contains(x, y) | F.contains(y, x)), F.lit(False))


def inversions(df: DataFrame, group: list[str], order: list[str], position: str) -> DataFrame:
    """group, n, inversions: neighbours in one order that stand the other way round in another. The order starts with a number."""
    rows = df.where(F.col(position).isNotNull()).select(*dict.fromkeys([*group, *order, position]))
    rows = ranges.with_previous(rows, group, order, F.col(position), "_before")
    return rows.groupBy(*group).agg(F.count("*").alias("n"), F.count_if(F.col(position) < F.col("_before")).alias("inversions"))


def _key(x: str) -> Column:
    """T.verbatim_key() of much text: the white space of T.WS, in a pattern that takes fewer tests a character."""
    return F.lower(F.regexp_replace(F.col(x), r"(?U)[\s\x1c-\x1f]+", ""))


def spans_in_sources(phrases: DataFrame, paras: DataFrame) -> DataFrame:
    """ph_id, part_id, at, jp_ok, en_ok, source_chars: where a phrase's source span stands in its part (from 1; 0: nowhere), and whether both spans do.

    White space and case count for nothing; spans may run over paragraphs. An empty span stands everywhere, a null one
    nowhere. phrases: ph_id, part_id, jp_span, en_span. paras: part_id, side, para_index, para_id, text and any others; rows
    alike in every column count once.
    """
    j = cut(phrases.select(F.monotonically_increasing_id().alias("_id"), "ph_id", "part_id", _key("jp_span").alias("_js"), _key("en_span").alias("_es")))
    sides = F.explode(F.array(F.struct(F.lit("jp").alias("side"), F.col("_js").alias("span")), F.struct(F.lit("en").alias("side"), F.col("_es").alias("span")))).alias("_x")
    j = j.select("_id", "ph_id", "part_id", sides).select("_id", "ph_id", "part_id", "_x.side", "_x.span")
    texts = paras.where("part_id is not null and text is not null and side in ('jp', 'en')")
    found, sizes = spans.first_places(texts, j.where("part_id is not null and span <> ''"), _key)
    j = j.join(found, ["part_id", "side", "span"], "left")
    ok = lambda side: F.coalesce(F.bool_or((F.col("side") == side) & ((F.col("span") == "") | F.col("at").isNotNull())), F.lit(False))
    j = j.groupBy("_id", "ph_id", "part_id").agg(F.min(F.when(F.col("side") == "jp", F.col("at"))).alias("at"), ok("jp").alias("jp_ok"), ok("en").alias("en_ok"))
    j = j.join(sizes.where("side = 'jp'").select("part_id", "size"), "part_id", "left")
    return j.select("ph_id", "part_id", F.coalesce("at", F.lit(0)).alias("at"), "jp_ok", "en_ok", F.coalesce("size", F.lit(0)).alias("source_chars"))


def phrase_yield(spans: DataFrame) -> DataFrame:
    """part_id, phrases, survivors, dropped, source_chars, too_few: fewer than FEW verbatim phrases on a long part."""
    kept = F.col("jp_ok") & F.col("en_ok")
    per = spans.where("part_id is not null").groupBy("part_id").agg(F.count("*").alias("phrases"), F.count_if(kept).alias("survivors"), F.count_if(~kept).alias("dropped"), F.max("source_chars").cast("long").alias("source_chars"))
    return per.withColumn("too_few", (F.col("source_chars") > LONG_PART) & (F.col("survivors") < FEW))


def span_misses(spans: DataFrame, worst: int) -> tuple[DataFrame, DataFrame]:
    """(n, misses, rate over all), (part_id, n, misses, rate of the `worst` parts): target spans that don't stand in their sources.

    spans: what spans_in_sources() gives; an empty span is no miss.
    """
    hit = ~F.col("en_ok")
    rates = [F.count("*").alias("n"), F.count_if(hit).alias("misses")]
    add = lambda df: df.withColumn("rate", F.round(F.col("misses") / F.greatest(F.col("n"), F.lit(1)), 6))
    per = add(spans.where("part_id is not null").groupBy("part_id").agg(*rates)).where("misses > 0")
    return add(spans.agg(*rates)), per.orderBy(F.desc("misses"), "part_id").limit(worst)


def gates(pairs: DataFrame, sources: DataFrame) -> DataFrame:
    """part_id, pairs, longest_jp, longest_en, coverage, verdict: the first gate that fails, else ok.

    pairs: part_id, jp, en; sources: part_id, source_chars.
    """
    per = pairs.groupBy(F.col("part_id").alias("_p")).agg(F.count("*").alias("pairs"), F.max(F.length("jp")).alias("longest_jp"), F.max(F.length("en")).alias("longest_en"), F.sum(T.visible_chars("jp")).alias("chars"))
    j = sources.join(per, F.col("part_id") == F.col("_p"), "left").select("part_id", "source_chars", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("pairs", "longest_jp", "longest_en", "chars")])
    cov = F.try_divide(F.col("chars").cast("double"), F.nullif(F.col("source_chars"), F.lit(0)))
    verdict = (
        F.when((F.col("source_chars") > LONG_PART) & (F.col("pairs") < FEW), "too_few")
        .when((F.col("longest_jp") > MAX_PAIR_JP) | (F.col("longest_en") > MAX_PAIR_EN), "too_large")
        .when(F.coalesce(cov < MIN_COVERAGE, F.lit(False)), "low_coverage")
        .otherwise("ok")
    )
    return j.select("part_id", "pairs", "longest_jp", "longest_en", F.round(cov, 6).alias("coverage"), verdict.alias("verdict"))


def battery(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """name, passed, overall: each check is a one-row frame with a boolean `passed`; overall is their conjunction."""
    out = None
    for name, df in checks:
        row = df.select(F.lit(name).alias("name"), F.coalesce("passed", F.lit(False)).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("overall", F.bool_and("passed").over(Window.partitionBy()))
