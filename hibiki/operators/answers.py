"""Model answers as tables: fences and prose stripped, JSON parsed, defaults filled in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T

# The categories of a phrase pair and the levels of a risk.
CATEGORIES = ("set_phrase", "onomatopoeia", "facial_idiom", "register", "restructured", "other")
LEVELS = ("low", "medium", "high")

ANSWER = (
    "struct<phrase_pairs: array<struct<jp_span: string, en_span: string, category: string, literal_alternative: string, context_jp: string, notes: string>>,"
    " paragraph_pairs: array<struct<jp: string, en: string, shape: string>>,"
    " risks: array<struct<jp_span: string, category: string, risk_level: string, literal_trap: string, reason: string, context_jp: string>>>"
)


def coerced(value: Column | str, known: tuple[str, ...], default: str) -> Column:
    """A known value, written in lower case, or the default."""
    v = F.lower(F.trim(F.col(value) if isinstance(value, str) else value))
    return F.when(v.isin(*known), v).otherwise(default)


def registered(rows: DataFrame, column: str, registry: DataFrame, fallback: str = "other") -> DataFrame:
    """rows + label, description of the category that the registry (key, label, description) has, or of the fallback's."""
    r = registry.select(F.col("key").alias("_key"), "label", "description")
    known = rows.join(r.select("_key"), F.lower(F.trim(F.col(column))) == F.col("_key"), "left")
    named = known.withColumn(column, F.coalesce("_key", F.lit(fallback))).drop("_key")
    return named.join(r, F.col(column) == F.col("_key"), "left").drop("_key")


def described(registry: DataFrame) -> DataFrame:
    """text: the registry as lines of a prompt, by key."""
    return registry.withColumn("_line", F.concat(F.lit("- "), "key", F.lit(": "), "description")).agg(F.expr("listagg(_line, '\n') WITHIN GROUP (ORDER BY key)").alias("text"))


def parsed(answers: DataFrame, text: str) -> DataFrame:
    """answers + json (the payload, null where there is none that parses) and body (its records)."""
    body = T.unfenced(text)
    # broken JSON gives a struct of nulls, so it is told apart by a parse of its own
    ok = F.try_parse_json(body).isNotNull() & (body != "")
    return answers.withColumn("json", F.when(ok, body)).withColumn("body", F.from_json("json", ANSWER))


def phrases(answers: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, idx, jp_span, en_span, category, notes: phrase pairs with both spans, categories coerced."""
    rows = parsed(answers, text).select(*keys, F.posexplode("body.phrase_pairs").alias("idx", "p"))
    return rows.where("trim(p.jp_span) <> '' and trim(p.en_span) <> ''").select(
        *keys, F.col("idx").cast("long").alias("idx"), "p.jp_span", "p.en_span", coerced("p.category", CATEGORIES, "other").alias("category"), F.coalesce("p.notes", F.lit("")).alias("notes")
    )


def paragraph_pairs(answers: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, idx, jp, en, shape."""
    rows = parsed(answers, text).select(*keys, F.posexplode("body.paragraph_pairs").alias("idx", "p"))
    return rows.select(*keys, F.col("idx").cast("long").alias("idx"), "p.jp", "p.en", F.coalesce("p.shape", F.lit("1:1")).alias("shape"))


def risks(answers: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, idx, jp_span, category, risk_level; unknown levels are medium."""
    rows = parsed(answers, text).select(*keys, F.posexplode("body.risks").alias("idx", "p"))
    return rows.where("trim(p.jp_span) <> ''").select(*keys, F.col("idx").cast("long").alias("idx"), "p.jp_span", coerced("p.category", CATEGORIES, "other").alias("category"), coerced("p.risk_level", LEVELS, "medium").alias("risk_level"))
