"""Entries of a contents page: what each link is, from its label and the block of text it stands in.

A page is a list of blocks (its paragraphs and headings, numbered from 0) and
of links (block, place in the page, label, href). Everything is a column
expression; volumes and counters are windows over one page.

Defined results: a null label or block reads as an empty one. A page without
breaks is one volume. Repeated links are repeated entries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T

from . import sections, toc

# Patterns of the page.
TAG = r"(?i)\((Miyagi|Sendai|Maika|Both)\s*PoVs?\)"
CHAPTER, VOLUME, READ_AFTER = r"(?i)Chapter\s+([A-Za-z\-]+)", r"(?i)Volume\s+([A-Za-z]+)", r"(?i)read after part\s+(\d+)"
PART_LABEL, SIDE_VOLUME = r"(?i)^part\s+(\d+)", r"(?i)vol\.\s*(\d+)"
BREAK = r"(?i)This is where volume (\w+) of the light novel ends"
# Kinds that only the printed volumes have; who tells an entry without a tag.
PRINT_ONLY = ("interlude", "extra", "side_story_maika", "bookwalker", "special")
PRINT_NOTE = "LN-exclusive (no web-novel source on Kakuyomu)"
TELLERS, BY_KIND, DEFAULT_TELLER = ("miyagi", "sendai", "maika"), {"interlude": "sendai"}, "miyagi"


def _text(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def _has(x: Column, *words: str) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in words])


def link_kind(label: Column | str, block: Column | str) -> Column:
    """The kind of an entry; the first rule that holds."""
    a, b = F.lower(_text(label)), F.lower(_text(block))
    return (
        F.when(_has(b, "april fool", "special chapter"), "special")
        .when(_has(b, "bookwalker") | _has(a, "bookwalker"), "bookwalker")
        .when(_has(b, "maika side story", "maika ss"), "side_story_maika")
        .when(_has(b, "interlude"), "interlude")
        .when(_has(b, "extra") & _has(a, "extra"), "extra")
        .when(a.startswith("part"), "part")
        .when(_has(b, "side story"), "side_story_maika")
        .otherwise("part")
    )


def entry_id(kind: Column, part_number: Column, volume: Column, index: Column) -> Column:
    """part_007, interlude_v2, special_02 ...; what has no form of its own is numbered within its volume."""
    v = volume.cast("string")
    return (
        F.when((kind == "part") & part_number.isNotNull(), F.format_string("part_%03d", part_number))
        .when(kind.isin("interlude", "extra", "bookwalker"), F.concat(kind, F.lit("_v"), v))
        .when(kind == "side_story_maika", F.concat(F.lit("maika_ss_v"), v))
        .when(kind == "special", F.format_string("special_%02d", volume))
        .otherwise(F.format_string("unknown_v%d_%02d", volume, index))
    )


def number_after(pattern: str, x: Column | str) -> Column:
    """The number, in words or digits, that a pattern's group names; null without one."""
    return T.word_to_number(F.regexp_extract(_text(x), pattern, 1))


def chapter_title(block: Column | str) -> Column:
    """The block without its chapter number, tags and the labels behind; null if nothing is left."""
    t = F.regexp_replace(_text(block), r"(?i)^Chapter\s+[A-Za-z\-]+\s*[–\-]\s*", "")
    t = T.trimmed(F.regexp_replace(t, TAG, ""))
    t = T.trimmed(F.regexp_replace(t, r"\[(?:Part|Interlude|Extra|Side Story).*", ""))
    t = T.trimmed(F.regexp_replace(t, r"[–\-]+$", ""))
    return F.nullif(t, F.lit(""))


def teller(kind: Column, block: Column | str, label: Column | str) -> Column:
    """Whose point of view: the last tag before the label's last place, else the first tag, else the kind's own."""
    tag = sections.tag_of_label(_text(block), _text(label), TAG)
    default = reduce(lambda out, kv: out.when(kind == kv[0], kv[1]), BY_KIND.items(), F.when(F.lit(False), F.lit(""))).otherwise(DEFAULT_TELLER)
    return F.when(kind == "side_story_maika", "maika").when(tag.isNull(), default).when(tag.isin(*TELLERS), tag).otherwise("both")


def with_volumes(links: DataFrame, breaks: DataFrame, page: str) -> DataFrame:
    """links + volume: one more than the breaks in blocks before the link's.

    Links and breaks of a page are put in one order and breaks are counted up;
    links: page, block_index, pos. breaks: page, block_index.
    """
    both = links.withColumn("_break", F.lit(0)).unionByName(breaks.select(page, "block_index").withColumn("_break", F.lit(1)), allowMissingColumns=True)
    # breaks strictly before a block: a range frame that ends one below it
    before = Window.partitionBy(page).orderBy("block_index").rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn("volume", (1 + F.coalesce(F.sum("_break").over(before), F.lit(0))).cast("int")).where("_break = 0").drop("_break")


def contents(links: DataFrame, breaks: DataFrame, page: str = "page") -> DataFrame:
    """page, pos, id, kind, part_number, chapter_number, chapter_subnumber, volume_number, pov, title_en, url_en,
    chapter_title_en, read_after_part, mapping_confidence, notes: the typed entry of every link.

    links: page, block_index, pos, label, href, block. breaks: page, block_index.
    """
    rows = with_volumes(links, breaks, page).withColumn("kind", link_kind("label", "block"))
    kind, label, block = F.col("kind"), F.col("label"), F.col("block")
    number = F.regexp_extract(_text(label), PART_LABEL, 1).try_cast("int")
    side = F.regexp_extract(_text(block), SIDE_VOLUME, 1).try_cast("int")
    rows = rows.withColumn("part_number", F.when(kind != "special", number)).withColumn("volume", F.when(kind == "side_story_maika", F.coalesce(side, F.col("volume"))).otherwise(F.col("volume")))
    index = F.row_number().over(Window.partitionBy(page, "volume").orderBy("pos"))
    rows = rows.withColumn("_index", index).withColumn("chapter_number", number_after(CHAPTER, "block"))
    only = kind.isin(*PRINT_ONLY)
    return rows.select(
        page, "pos", entry_id(kind, F.col("part_number"), F.col("volume"), F.col("_index")).alias("id"), "kind", "part_number", "chapter_number",
        F.when(kind == "interlude", F.col("chapter_number") + F.lit(0.5)).alias("chapter_subnumber"), F.col("volume").alias("volume_number"), teller(kind, "block", "label").alias("pov"),
        F.col("label").alias("title_en"), F.col("href").alias("url_en"), chapter_title("block").alias("chapter_title_en"), F.regexp_extract(_text(block), READ_AFTER, 1).try_cast("int").alias("read_after_part"),
        F.when(only, "manual").otherwise("auto").alias("mapping_confidence"), F.when(only, PRINT_NOTE).alias("notes"),
    )


def build_contents(links: DataFrame, breaks: DataFrame, episodes: DataFrame, overrides: DataFrame | None = None, page: str = "page") -> DataFrame:
    """The whole table of contents: typed entries, parts bound to episodes by position, overrides, then the episodes that no part is bound to.

    episodes: episode, position. overrides: id, episode. Returns id, kind, part_number, episode, outcome ('kept',
    'bound', 'not_on_site', 'unknown_episode' or 'source_only').
    """
    entries = contents(links, breaks, page)
    mapping = toc.mapped(entries.where("kind = 'part' and part_number is not null"), episodes)
    if overrides is None:
        overrides = entries.sparkSession.createDataFrame([], "id string, episode string")
    bound = toc.overridden(mapping, overrides, episodes)
    of_parts = bound.select("id", F.lit("part").alias("kind"), "part_number", "episode", "outcome")
    rest = entries.where("kind != 'part' or part_number is null").select("id", "kind", "part_number", F.lit(None).cast("string").alias("episode"), F.lit("kept").alias("outcome"))
    tail = toc.source_only(episodes.select("episode"), bound).select(F.concat(F.lit("source_"), "episode").alias("id"), F.lit("source_only").alias("kind"), F.lit(None).cast("int").alias("part_number"), "episode", F.lit("source_only").alias("outcome"))
    return of_parts.unionByName(rest).unionByName(tail)
