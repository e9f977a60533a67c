"""Column functions for text, with Python's notion of white space and lines.

All are built-in expressions: they stay inside whole-stage codegen and can be
pushed to the scan side of a plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and line ends as Python's str methods see them.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squeezed(x: Column | str) -> Column:
    """Without any white space."""
    return F.regexp_replace(_c(x), f"{WS}+", "")


def visible_chars(x: Column | str) -> Column:
    """Number of characters that aren't white space (code points)."""
    return F.length(squeezed(x))


def trimmed(x: Column | str) -> Column:
    """Unicode trim of both ends."""
    return F.regexp_replace(_c(x), f"^{WS}+|{WS}+$", "")


def collapsed(x: Column | str) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(_c(x), f"{WS}+", " "))


def lines(x: Column | str) -> Column:
    """Array of lines, at every line end that Python's splitlines knows."""
    return F.split(_c(x), LINE_END)


def count_of(x: Column | str, needle: str) -> Column:
    """Occurrences of a literal that don't overlap."""
    c = _c(x)
    return ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def count_any(x: Column | str, needles: list[str]) -> Column:
    """Sum of the counts of each form; a form inside another counts for both."""
    return reduce(lambda a, b: a + b, [count_of(x, n) for n in needles])


def verbatim_key(x: Column | str) -> Column:
    """The form in which spans are looked for: lower case, no white space."""
    return F.lower(squeezed(x))


def paired(x: Column | str, opening: str, closing: str) -> Column:
    return F.least(count_of(x, opening), count_of(x, closing))


def dialogue_blocks_source(x: Column | str) -> Column:
    """Corner-bracket pairs."""
    return paired(x, "「", "」")


def dialogue_blocks_target(x: Column | str) -> Column:
    """Corner brackets; without them curly quotes; without these half the straight quotes."""
    corner, c = paired(x, "「", "」"), _c(x)
    curly = (count_of(c, "“") + count_of(c, "”")) > 0
    return F.when(corner > 0, corner).when(curly, paired(c, "“", "”")).otherwise(F.floor(count_of(c, '"') / 2))


#: Openers of dialogue by side.
OPENERS = {"jp": ("「", "『"), "en": ("「", "『", "“", '"')}


def side_kind(x: Column | str, side: Column | str) -> Column:
    """paragraph_kind() by the rule of the paragraph's side; in the source a straight or curly quote opens no dialogue."""
    return F.when(_c(side) == "jp", paragraph_kind(x, OPENERS["jp"])).otherwise(paragraph_kind(x, OPENERS["en"]))


def paragraph_kind(x: Column | str, openers: tuple[str, ...] = ("「", "『", "“", '"')) -> Column:
    """blank, dialogue (starts with an opener behind the indent) or narration."""
    t = trimmed(x)
    starts = reduce(lambda a, b: a | b, [t.startswith(o) for o in openers])
    return F.when(F.coalesce(t, F.lit("")) == "", "blank").when(starts, "dialogue").otherwise("narration")


def safe_name(url: Column | str, longest: int = 180, kept: int = 170) -> Column:
    """A file name for a URL without its scheme; long ones are cut and told apart by ten digits of their hash."""
    c = _c(url)
    clean = F.regexp_replace(F.regexp_replace(c, "^https?://", ""), r"[^A-Za-z0-9._-]", "_")
    short = F.when(F.length(clean) > longest, F.concat(F.left(clean, F.lit(kept)), F.lit("_"), F.left(F.sha1(c.cast("binary")), F.lit(10)))).otherwise(clean)
    return F.concat(short, F.lit(".html"))


# English number words.
UNITS = {w: i + 1 for i, w in enumerate("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * (i + 2) for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split())}


def word_to_number(x: Column | str) -> Column:
    """12, twelve, Thirty-eight: the number, else null."""
    w = F.regexp_replace(F.lower(_c(x)), r"[\s-]", "")
    pairs = lambda d: F.create_map(*[F.lit(v) for kv in d.items() for v in kv])
    tens = F.regexp_extract(w, f"^({'|'.join(TENS)})", 1)
    rest = F.regexp_replace(w, f"^({'|'.join(TENS)})", "")
    value = F.try_element_at(pairs(TENS), tens) + F.when(rest == "", 0).otherwise(F.try_element_at(pairs({k: v for k, v in UNITS.items() if v < 10}), rest))
    return F.coalesce(w.try_cast("int"), F.try_element_at(pairs(UNITS), w), value)


def part_id_of(x: Column | str) -> Column:
    """4 or '4' as part_004; any other text as it is."""
    n = F.trim(_c(x).cast("string")).try_cast("int")
    return F.when(n.isNotNull(), F.format_string("part_%03d", n)).otherwise(_c(x).cast("string"))


def substituted(template: Column | str, values: dict[str, Column]) -> Column:
    """$name placeholders replaced in one pass; unknown ones stay as they are.

    The template is cut before each $ and behind each word, so that a placeholder
    of any length is a piece of its own, and each piece is replaced by itself: a
    value that holds a placeholder isn't replaced again.
    """
    pieces = F.split(_c(template), r"(?=\$[A-Za-z_])|(?<=\w)(?=\W)")
    table = F.create_map(*[v for k, c in values.items() for v in (F.lit("$" + k), c.cast("string"))])
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")


def first_match(x: Column | str, rules: list[tuple[str, tuple[str, ...]]], default: str) -> Column:
    """The name of the first rule of which a keyword stands in the text."""
    low = F.lower(_c(x))
    out = F
    for name, words in rules:
        out = out.when(reduce(lambda a, b: a | b, [low.contains(w) for w in words]), name)
    return out.otherwise(default)


def clean_comment(x: Column | str, markers: tuple[str, ...]) -> Column:
    """Cut at the first of any marker, white space collapsed."""
    c = _c(x)
    for m in markers:
        c = F.substring_index(c, m, 1)
    return collapsed(c)


def unfenced(x: Column | str) -> Column:
    """The inside of a code fence, or the text from its first to its last brace."""
    t = trimmed(x)
    inner = F.regexp_extract(t, r"(?s)^```[A-Za-z]*\s*(.*?)\s*```", 1)
    t = F.when(inner != "", inner).otherwise(t)
    return F.regexp_extract(t, r"(?s)(\{.*\})", 1)
