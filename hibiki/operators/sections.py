"""Documents cut at headings, tags that belong to labels, and other reading of marked-up text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.functions.plan import guarded

from . import notes, ranges


def numbered_sections(docs: DataFrame, key: str, text: str, heading: str = r"(?m)^#{1,6}\s*(\d{1,2})[.):]?\s+([^\n]+)$", lowest: int = 1, highest: int = 16) -> DataFrame:
    """key, number, name, body: the parts between numbered headings; of a number that comes twice the later counts."""
    cuts = F.split(F.col(text), r"(?m)(?=^#{1,6}\s*\d{1,2}[.):]?\s+\S)")
    rows = docs.select(key, F.posexplode(cuts).alias("pos", "piece"))
    rows = rows.withColumn("number", F.regexp_extract("piece", heading, 1).try_cast("int")).withColumn("name", T.trimmed(F.regexp_extract("piece", heading, 2)))
    rows = rows.where(F.col("number").between(lowest, highest)).withColumn("body", T.trimmed(F.regexp_replace("piece", r"^[^\n]*\n?", "")))
    w = Window.partitionBy(key, "number").orderBy(F.desc("pos"))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(key, "number", "name", "body")


def style_sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, number, name, file, body: the numbered sections under their canonical names, each with a heading of one form.

    A document without any numbered section of the range is an error, so that it never replaces a profile.
    """
    rows = numbered_sections(docs, key, text)
    name = notes.canonical_dimension(F.col("number"), F.col("name"))
    body = T.trimmed(F.concat(F.format_string("## %d. ", F.col("number")), name, F.lit("\n\n"), F.col("body")))
    out = rows.select(key, "number", name.alias("name"), notes.dimension_file(F.col("number"), name).alias("file"), body.alias("body"))
    lacking = docs.select(key).join(rows.select(key), key, "left_anti").agg(F.count("*").alias("n"))
    return guarded(out, lacking, F.col("n") == 0, "no numbered sections: the profile isn't replaced")


def missing_numbers(sections: DataFrame, key: str, lowest: int = 1, highest: int = 16) -> DataFrame:
    """key, missing: the numbers of the range that a document lacks."""
    return sections.groupBy(key).agg(F.array_except(F.sequence(F.lit(lowest), F.lit(highest)), F.collect_set("number")).alias("missing"))


def tag_of_label(block: Column | str, label: Column | str, tag: str) -> Column:
    """The last tag that stands before the last place of the label in the block, else the first tag, else null.

    `tag` is a pattern whose first group names the tag.
    """
    b, x = (F.col(block) if isinstance(block, str) else block), (F.col(label) if isinstance(label, str) else label)
    after = F.call_function("substring_index", b, x, F.lit(-1))
    head = F.left(b, F.length(b) - F.length(after))
    in_head, everywhere = F.regexp_extract_all(head, F.lit(tag), F.lit(1)), F.regexp_extract_all(b, F.lit(tag), F.lit(1))
    return F.lower(F.coalesce(F.try_element_at(in_head, F.lit(-1)), F.try_element_at(everywhere, F.lit(1))))


def by_prefix(x: Column | str, prefixes: dict[str, str], default: str) -> Column:
    """The value of the first prefix that the text starts with."""
    c, out = F.lower(F.col(x) if isinstance(x, str) else x), F
    for p, v in prefixes.items():
        out = out.when(c.startswith(p), v)
    return out.otherwise(default)


def token_prefix(docs: DataFrame, key: str, text: str, encode: Callable[[str], list[int]], decode: Callable[[list[int]], str], most: int = 7000) -> DataFrame:
    """key, text, tokens, shortened: what a model with a limit can be given; the operator's feature is the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = [encode(t) if t else [] for t in pdf["t"]]
            yield pd.DataFrame({"k": pdf["k"], "text": [decode(i[:most]) if len(i) > most else t for i, t in zip(ids, pdf["t"])], "tokens": [min(len(i), most) for i in ids], "shortened": [len(i) > most for i in ids]})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, text string, tokens long, shortened boolean").withColumnRenamed("k", key)


def dialogue_turns(paras: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """group, run, first, lines: runs of neighbouring dialogue paragraphs. The order starts with a number."""
    d = paras.select(*group, *order, (T.paragraph_kind("text") == "dialogue").alias("_d"))
    d = ranges.with_previous(d, group, order, F.col("_d"), "_p")
    runs = ranges.with_running_count(d, group, order, F.col("_d") & ~F.coalesce("_p", F.lit(False)), "run").where("_d")
    return runs.groupBy(*group, "run").agg(F.min(order[0]).alias("first"), F.count("*").alias("lines"))
