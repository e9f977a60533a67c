"""Problem 1: texts that were cut off by a field limit or in transfer.

Two kinds of evidence, all of it in SQL expressions:

* length histograms. For each source and column (the whole answer and every
  named value inside it), in characters and in bytes, a length at which far
  more values pile up than at its neighbours is a limit; a value of that length
  (or a little less, cut back to a word or clause) without an end is cut;
* the shape of the end. An answer that is a JSON object is cut where the text
  stops inside a string or with brackets open; prose is cut where it stops
  without an end mark, or at a mark that says so ("…", "[truncated]").

Defined results: null, empty and blank texts are never cut. A text that is only
badly formed (stray commas, an odd quote in a text whose brackets close) is not
cut. A null source is a source of its own. Repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions.plan import once
from hibiki.session import cut, spread

#: A limit is not looked for below this length: short values are words of a list.
MIN_LIMIT = 32
#: A limit holds at least so many distinct values, and so many times a neighbouring length's.
MIN_AT_LIMIT, TIMES_NEIGHBOUR, REACH = 5, 6.0, 10
#: Some writers cut back to a word or clause: open values down to this share of a limit are cut too.
CUT_BACK = 0.9
#: Prose shorter than this is a remark, not a cut text.
MIN_PROSE = 25

# Stand-ins of escapes, by the bytes of what they stand for; an escaped quote may close a sentence.
QUOTE = "\x02"
ESCAPES = [
    (r'\\"', QUOTE), (r"\\[^u]", "\x01"), (r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}", "\U000f0000"),
    (r"\\u00[0-7][0-9a-fA-F]", "\x01"), (r"\\u0[0-7][0-9a-fA-F]{2}", "\x80"), (r"\\u[0-9a-fA-F]{4}", "\ue000"),
]

SPACE = r"[\s\p{Z}\x{FEFF}]"
# The same as characters, for trims, which look at the end only.
WHITE = "".join(map(chr, [*range(9, 14), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
CLOSERS = "\"”’')]」』）" + QUOTE
# What ends a sentence, and what says that a text goes on.
ENDS = (".", "!", "?", "。", "！", "？", "؟", "।")
GOES_ON = ("[truncated]", "[cut off]", "[continued]", "[...]", "[…]", "\ufffd")


def _ends(c: Column) -> tuple[Column, Column]:
    """(ended, marked): the text ends like a sentence; it ends with a mark that says that it was cut. Any number of closers may follow."""
    core = F.rtrim(c, F.lit(CLOSERS))
    cut_mark = (c.endswith("…") & ~c.endswith("……")) | (c.endswith("...") & ~c.endswith("...."))
    for m in GOES_ON:
        cut_mark = cut_mark | c.endswith(m)
    done = core.endswith("……")
    for m in ENDS:
        done = done | core.endswith(m)
    return done & ~cut_mark, cut_mark


def _prepared(text: Column) -> dict[str, Column]:
    """The columns a judgement needs; each is one pass over the text."""
    tail = F.rtrim(text, F.lit(WHITE))
    # an escape becomes one character of the size of what it stands for, so that a quote is a quote and bytes are bytes
    plain = tail
    for escape, stand_in in ESCAPES:
        plain = F.regexp_replace(plain, escape, stand_in)
    # texts without escapes need no pass
    return {"_tail": tail, "_plain": F.when(F.contains(tail, F.lit("\\")), plain).otherwise(tail)}


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def with_shape(df: DataFrame, text: str) -> DataFrame:
    """Adds _tail, _plain, _json, _cut_end (the text stops before its end) and _complete."""
    df = once(df, _prepared(F.col(text)))
    ended, marked = _ends(F.col("_tail"))
    df = once(
        df,
        {
            "_json": F.col("_tail").rlike(rf"^{SPACE}*+(?:```[A-Za-z]*+{SPACE}*+)?[\{{\[]"),
            "_bare": F.regexp_replace("_plain", r'"[^"]*+"', "S"),
            "_marked": marked,
            "_ended": ended,
            "_closes": F.regexp_replace(F.rtrim(F.col("_tail"), F.lit("` \t\r\n")), r"\s+([\]}])$", "$1").rlike(r"(?:[\]}][\]}]|\{\})$") | F.col("_tail").endswith("```"),
        },
    )
    df = once(df, {"_open_string": F.col("_bare").contains('"'), "_bare": F.regexp_replace("_bare", r'"[^"]*+$', "")})
    df = once(
        df,
        {
            "_depth": _count(F.col("_bare"), "{[") - _count(F.col("_bare"), "}]"),
            "_after": F.length(F.regexp_extract("_bare", r"[}\]](?:\s*```)?\s*([^{}\[\]`]*)$", 1)),
            # a list whose lines have no end marks shows nothing by lacking the last one
            "_listed": ~F.col("_json") & F.col("_tail").contains("\n") & ~F.col("_tail").rlike(r"[.!?。！？][\s”’」』\"]"),
        },
    )
    depth, string, closes, ended = F.col("_depth"), F.col("_open_string"), F.col("_closes"), F.col("_ended")
    json_cut = (depth > 0) & ~(string & closes) | (string & ~closes)
    rest_cut = (depth <= 0) & ~string & (F.col("_after") >= MIN_PROSE) & ~ended
    prose_cut = (F.length("_tail") >= MIN_PROSE) & ~ended & (~F.col("_listed") | F.col("_marked"))
    blank = F.col("_tail").isNull() | (F.col("_tail") == "")
    return once(
        df,
        {
            "_cut_end": F.when(blank, False).otherwise(F.when(F.col("_json"), json_cut | rest_cut).otherwise(prose_cut)),
            "_complete": F.coalesce(F.when(F.col("_json"), (depth <= 0) & ~string).otherwise(ended), F.lit(True)),
        },
    ).drop("_bare", "_open_string", "_closes", "_ended", "_depth", "_after", "_listed", "_marked")


def measured(shaped: DataFrame) -> DataFrame:
    """_id, _src, field, chars, bytes, h, complete, cut_end of the whole texts (field '') and the named string values inside JSON.

    Only lengths and a hash go on; the texts are read and parsed once and left
    behind. Escape pairs count as the one character that they stand for.
    """
    pair = r'"([^"]*+)"\s*+:\s*+"([^"]*+)"'
    item = "array<struct<f: string, v: string>>"
    pairs = F.arrays_zip(
        F.regexp_extract_all("_plain", F.lit(pair), F.lit(1)).alias("f"), F.regexp_extract_all("_plain", F.lit(pair), F.lit(2)).alias("v")
    ).cast(item)
    whole = F.array(F.struct(F.lit("").alias("f"), F.col("_text").alias("v"))).cast(item)
    items = F.when(F.col("_json"), F.concat(whole, pairs)).otherwise(whole)
    out = shaped.where(F.col("_tail") != "").select("_id", "_src", "_complete", "_cut_end", F.posexplode(items).alias("k", "p"))
    out = once(out, {"_end": F.when(F.col("k") > 0, F.rtrim(F.col("p.v"), F.lit(WHITE)))})
    inside, _ = _ends(F.col("_end"))
    return out.select(
        "_id", "_src", F.when(F.col("k") == 0, "").otherwise(F.concat(F.lit("."), "p.f")).alias("field"), F.length("p.v").alias("chars"), F.octet_length("p.v").alias("bytes"),
        F.xxhash64("p.v").alias("h"), F.when(F.col("k") == 0, F.col("_complete")).otherwise(inside).alias("complete"), ((F.col("k") == 0) & F.col("_cut_end")).alias("cut_end"),
    )


def limits(values: DataFrame) -> DataFrame:
    """The lengths at which the values of a source and field pile up without an end.

    values: what measured() gives. Partial counts come before every shuffle, and
    what is shuffled is one row per distinct value hash, then one per length; a
    hot source is spread by field, length and hash.
    """
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("len")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("len"))))
    # copies neither make a limit nor hide one: each value counts once
    by_value = values.select("_src", "field", "complete", "h", units.alias("u")).select("_src", "field", "u.unit", "u.len", "h", "complete").distinct()
    by_len = by_value.groupBy("_src", "field", "unit", "len").agg(F.count("*").alias("n"), F.count_if(~F.col("complete")).alias("n_open"))
    around = Window.partitionBy("_src", "field", "unit").orderBy("len").rangeBetween(-REACH, REACH)
    beside = (F.sum("n").over(around) - F.col("n")) / (2.0 * REACH)
    return (
        by_len.withColumn("beside", beside)
        .where(
            (F.col("len") >= MIN_LIMIT)
            & (F.col("n_open") >= MIN_AT_LIMIT)
            & (F.col("n") >= TIMES_NEIGHBOUR * F.greatest(F.col("beside"), F.lit(0.25)))
            & (F.col("n_open") >= 0.5 * F.col("n"))
        )
        .select("_src", "field", "unit", F.col("len").alias("limit"), "n", "n_open")
    )


def truncated(df: DataFrame, row_id: str, source: str, text: str) -> DataFrame:
    """row_id, reason ('end', 'limit', 'value limit'), field, of every cut text.

    A row may be named for several reasons. Extra columns of df are ignored.
    """
    base = spread(df.select(F.col(row_id).alias("_id"), F.col(source).alias("_src"), F.col(text).alias("_text")))
    values = cut(measured(with_shape(base, "_text")))
    found = limits(values).select(F.col("_src").alias("s"), F.col("field").alias("f"), "unit", "limit")
    size = F.when(F.col("unit") == "chars", F.col("chars")).otherwise(F.col("bytes"))
    # the open values only, joined with the few limits; the optimizer sees their size
    at_limit = (
        values.where(~F.col("complete"))
        .join(found, F.col("_src").eqNullSafe(F.col("s")) & (F.col("field") == F.col("f")))
        .where(size.between(CUT_BACK * F.col("limit"), F.col("limit")))
        .select("_id", F.when(F.col("field") == "", "limit").otherwise("value limit").alias("reason"), "field")
    )
    ends = values.where("cut_end").select("_id", F.lit("end").alias("reason"), "field")
    return ends.unionByName(at_limit).distinct().withColumnRenamed("_id", row_id)


def truncation_report(df: DataFrame, row_id: str, source: str, text: str, kind: Column) -> DataFrame:
    """model, kind, answers, cut, cut_share: how often each source truncates each kind; and how many of the cut
    answers each way found: by the end of the text, at a limit of whole answers, at a limit of values inside."""
    by = [F.max(F.col("reason") == r).alias(n) for n, r in (("_end", "end"), ("_limit", "limit"), ("_value", "value limit"))]
    found = truncated(df, row_id, source, text).groupBy(F.col(row_id).alias("_cut_id")).agg(*by)
    base = df.select(F.col(row_id).alias("_id"), F.col(source).alias("model"), kind.alias("kind"))
    return (
        base.join(found, F.col("_id") == F.col("_cut_id"), "left")
        .groupBy("model", "kind")
        .agg(
            F.count("*").alias("answers"), F.count("_cut_id").alias("cut"), F.count_if("_end").alias("by_end"), F.count_if("_limit").alias("by_limit"), F.count_if("_value").alias("by_value_limit"),
            F.count_if(F.col("_end") & ~F.col("_limit") & ~F.col("_value")).alias("by_end_only"),
        )
        .withColumn("cut_share", F.round(F.col("cut") / F.col("answers"), 6))
    )
