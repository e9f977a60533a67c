"""Comments mined from chats: references to lines of an output, what is said of them, and the answer that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T

# The form of a reference, and where a comment ends.
FIELDS = r"^@(data/output/((part_\d+)[^/\s]*)/translation\.en\.txt):(\d+(?:-\d+)?)\s*([\s\S]*)$"
START = r"(?=@data/output|@knowledge-vault|@src/|@/)"
ENDS = ("</user_query>", "</attached_files>", "\nPlease analyze", "\nPlease look", "\nPlease suggest", "\nPlease begin")
# Keywords of a category, the first that holds; and of a major comment.
HINTS = [
    ("formatting", ("quote", "stars", "asterisk", "line break", "spacing", "no line")),
    ("tense", ("tense", "past tense", "should be was", 'should be "was"', "present tense")),
    ("untranslated_term", ("glossary", "what is", "what's", "isn't this", "is this ramen", "nabe", "mizuna", "edamame", "napa")),
    ("terminology", ("order", "request", "name", "right name", "naming")),
    ("coordination_and", ("and structure", "using and", "and all the time", "becomes two sentences", "two sentences")),
    ("preferred_variant", ("liked", "previous version", "before in the previous")),
    ("metaphor", ("metaphor", "analogy", "caterpillar", "simile")),
]
OTHER, MAJOR = "translationese", ("really bad", "fundamental", "error", "wrong", "must", "violat")
SHORTEST = 4


def category(comment: Column | str) -> Column:
    return T.first_match(comment, HINTS, OTHER)


def severity(comment: Column | str) -> Column:
    return T.first_match(comment, [("major", MAJOR)], "minor")


def references(turns: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, pos, path, part_id, suffix, lines, comment of every reference in a text, in order.

    The text is cut where any reference starts, so that each piece holds one and
    its comment, up to the next. Comments shorter than SHORTEST are no comments.
    """
    rows = turns.select(*keys, F.posexplode(F.split(F.col(text), START)).alias("pos", "_piece"))
    group = lambda i: F.regexp_extract("_piece", FIELDS, i)
    rows = rows.where(F.col("_piece").rlike(FIELDS)).select(
        *keys, "pos", group(1).alias("path"), group(3).alias("part_id"), F.regexp_replace(F.regexp_replace(group(2), r"^part_\d+", ""), "^-", "").alias("suffix"), group(4).alias("lines"), T.clean_comment(group(5), ENDS).alias("comment")
    )
    return rows.where(F.length("comment") >= SHORTEST)


def replies(turns: DataFrame, chat: str, order: str, cap: int = 2500) -> DataFrame:
    """chat, order (of the user's turn), reply: what the assistant says until the user's next turn, trimmed texts a blank line apart, capped.

    turns: chat, order, role, text. Other roles and blank texts are left out.
    """
    w = Window.partitionBy(chat).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    t = turns.withColumn("_asked", F.max(F.when(F.col("role") == "user", F.col(order))).over(w)).withColumn("_text", T.trimmed("text"))
    said = t.where("role = 'assistant' and _asked is not null and _text <> ''")
    return said.groupBy(chat, F.col("_asked").alias(order)).agg(T.trimmed(F.substring(T.trimmed(F.expr(f"listagg(_text, '\n\n') WITHIN GROUP (ORDER BY {order})")), 1, cap)).alias("reply"))


def mined(turns: DataFrame, chat: str, order: str) -> DataFrame:
    """chat, order, pos, path, part_id, suffix, lines, comment, category, severity, reply: each comment once.

    Of comments on the same lines of a part that read alike the first counts, by chat, turn and place.
    """
    asked = turns.where("role = 'user'").select(chat, order, "text")
    found = references(asked, [chat, order], "text")
    first = Window.partitionBy("part_id", "lines", F.lower("comment")).orderBy(chat, order, "pos")
    found = found.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    out = found.withColumn("category", category("comment")).withColumn("severity", severity("comment"))
    return out.join(replies(turns, chat, order), [chat, order], "left").withColumn("reply", F.coalesce("reply", F.lit("")))


def part_number(part_id: Column) -> Column:
    """The number of a part id; anything else is an error of the row."""
    n = F.regexp_extract(part_id, r"^part_(\d+)$", 1)
    return F.when(n != "", n.cast("int")).otherwise(F.raise_error(F.concat(F.lit("invalid part id: "), F.coalesce(part_id, F.lit("null")))).cast("int"))
