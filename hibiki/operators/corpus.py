"""The corpus tables in their clean form, and the filters and joins over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.functions.plan import guarded


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the one that comes last in `order`."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def entries(toc: DataFrame) -> DataFrame:
    """The table of contents, a repeated id taken from its last place in the file."""
    return latest(toc, "id", "file_pos")


def is_target(povs: list[str]) -> Column:
    """A numbered part with a supported point of view."""
    return (F.col("kind") == "part") & F.col("part_number").isNotNull() & F.col("pov").isin(povs)


def story_key() -> Column:
    """Sort key of the canonical order; entries without a number come last."""
    return F.coalesce(F.nullif(F.col("part_number"), F.lit(0)), F.lit(1_000_000))


def paragraphs(raw: DataFrame) -> DataFrame:
    """Deliveries that are alike in every column once."""
    return raw.select("para_id", "part_id", "side", "para_index", "kind", "text").distinct()


def side_counts(paras: DataFrame) -> DataFrame:
    """part_id, side, paragraphs that aren't blank, visible characters: partial sums before the shuffle."""
    return paras.where("part_id is not null").groupBy("part_id", "side").agg(
        F.count_if(T.paragraph_kind("text") != "blank").alias("n_paragraphs"),
        F.coalesce(F.sum(T.visible_chars("text")), F.lit(0)).alias("chars"),
    )


def selected(entries: DataFrame, scope: Column, only: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """The entries named in `only`, whatever the scope; else those of the scope, the first `limit` in story order if one is given."""
    if only:
        return entries.where(F.col("id").isin(only))
    rows = entries.where(scope)
    return rows.orderBy(story_key(), "id").limit(limit) if limit else rows


def found_part(entries: DataFrame, part_id: str) -> DataFrame:
    """The entry of one id; an id that isn't there is an error."""
    rows = entries.where(F.col("id") == part_id)
    return guarded(rows, rows.agg(F.count("*").alias("n")), F.col("n") > 0, f"unknown part: {part_id}")


def with_texts(entries: DataFrame, sides: DataFrame) -> DataFrame:
    """Entries that have a source text, with both texts, in story order; the target's may be null. sides: part_id, side, text."""
    jp = sides.where("side = 'jp'").select(F.col("part_id").alias("id"), F.col("text").alias("jp_text"))
    en = sides.where("side = 'en'").select(F.col("part_id").alias("id"), F.col("text").alias("en_text"))
    return entries.join(jp, "id").join(en, "id", "left").orderBy(story_key(), "id")


def verify_pairs(parts: DataFrame, counts: DataFrame, skew: float = 0.25) -> DataFrame:
    """id, jp, en (paragraphs that aren't blank; null where the side is missing), jp_status, en_status, complete, skewed.

    A missing side is 'print_only' (source) or 'source_only' (target) where the entry has no address for it, else
    'missing'. Pairs are skewed where both sides have paragraphs and their counts are apart by more than `skew`.
    parts: id, kakuyomu_episode_id, url_en.
    """
    jp = counts.where("side = 'jp'").select(F.col("part_id").alias("_j"), F.col("n_paragraphs").alias("jp"))
    en = counts.where("side = 'en'").select(F.col("part_id").alias("_e"), F.col("n_paragraphs").alias("en"))
    joined = parts.select("id", "kakuyomu_episode_id", "url_en").join(jp, F.col("id") == F.col("_j"), "left").join(en, F.col("id") == F.col("_e"), "left")
    apart = F.abs(F.col("jp") - F.col("en")) / F.greatest("jp", "en")
    gone = lambda side, url, name: F.when(F.col(side).isNotNull(), "present").when(F.coalesce(F.col(url), F.lit("")) == "", name).otherwise("missing")
    return joined.select(
        "id", "jp", "en", gone("jp", "kakuyomu_episode_id", "print_only").alias("jp_status"), gone("en", "url_en", "source_only").alias("en_status"),
        (F.col("jp").isNotNull() & F.col("en").isNotNull()).alias("complete"), F.coalesce((F.col("jp") > 0) & (F.col("en") > 0) & (apart > skew), F.lit(False)).alias("skewed"),
    )


def verify_report(verified: DataFrame, all_entries: DataFrame) -> DataFrame:
    """One row: entries in and out of scope, sides present, complete pairs, each kind of miss, skewed pairs."""
    miss = lambda c, v: F.count_if(F.col(c) == v)
    out = verified.agg(
        F.count("*").alias("in_scope"), miss("jp_status", "present").alias("jp_present"), miss("en_status", "present").alias("en_present"), F.count_if("complete").alias("complete_pairs"), miss("jp_status", "missing").alias("missing_jp"),
        miss("jp_status", "print_only").alias("missing_jp_print_only"), miss("en_status", "missing").alias("missing_en"), miss("en_status", "source_only").alias("missing_en_source_only"), F.count_if("skewed").alias("skewed"),
    )
    return out.join(all_entries.agg(F.count("*").alias("_all")), F.lit(True)).withColumn("out_of_scope", F.col("_all") - F.col("in_scope")).drop("_all")


def set_gaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, gap: keys of one side that the other lacks."""
    a, b = left.select(key).where(F.col(key).isNotNull()).distinct(), right.select(key).where(F.col(key).isNotNull()).distinct()
    return a.join(b, key, "left_anti").withColumn("gap", F.lit("only_left")).unionByName(b.join(a, key, "left_anti").withColumn("gap", F.lit("only_right")))


def split_paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, idx, paragraph: the lines that aren't blank, trimmed, numbered from 0."""
    kept = F.filter(F.transform(T.lines(text), lambda x: T.trimmed(x)), lambda x: x != "")
    return docs.select(key, F.posexplode(kept).alias("idx", "paragraph"))


def equal_count_parts(counts: DataFrame) -> DataFrame:
    """Parts with as many paragraphs on both sides, and some: the calibration set."""
    wide = counts.groupBy("part_id").agg(*[F.max(F.when(F.col("side") == s, F.col("n_paragraphs"))).alias(s) for s in ("jp", "en")])
    return wide.where("jp = en and jp > 0").select("part_id", F.col("jp").alias("n_paragraphs"))
