"""Problem 2: sentence units of texts in any script, with their positions.

Everything is a SQL expression. A copy of the text, equal in length, is made:
full-width letters and look-alike marks folded to plain ones, and every
terminator that ends nothing (in decimals, URLs, initials, abbreviations,
quotations, brackets) masked by a private-use character. Border marks are then
put into the copy by regexes of the scripts' terminators; the pieces between
borders give positions, and the units are cut from the original text, so
nothing has to be undone in it. A step is taken only by texts that hold a
character which it is about; steps that follow each other are told apart by a
border which Catalyst doesn't inline across.

Defined results: a null, empty or blank text has no units, nor has a line
without a letter or digit. Repeated rows give repeated units. An unpaired quote
or bracket protects nothing. Positions count code points.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hibiki.functions.plan import once

# Private-use characters: a masked mark, a masked line break or space, a border.
MASK, GAP, BORDER = "", "", ""

# Abbreviations after which a full stop ends nothing.
TITLES = "Mr|Mrs|Ms|Messrs|Dr|Prof|Rev|Hon|St|Mt|Lt|Col|Gen|Sgt|Capt|Gov|Sen|Rep|vs|cf|viz|approx|ca"
NUMBERED = "No|Nos|Vol|Vols|Ch|Chap|Fig|Figs|Sec|Art|Eq|Ed|Pt|p|pp|vol|vols|no|nos|ch|chap|fig|figs|sec|pt|ed|eq"
# Nouns whose single letter is a label ("Room B."), not an initial.
LABELS = "Note|Room|Plan|Type|Class|Group|Block|Section|Part|Exhibit|Appendix|Platform|Gate|Grade|Exit|Vitamin|Team|Hall|Building|Model|Track|Side|Point|Option"
# English verbs of reporting clauses.
REPORTING = (
    "said|says|say|asked|asks|answered|replied|whispered|murmured|muttered|shouted|yelled|screamed|cried|called|exclaimed|"
    "added|remarked|told|sighed|laughed|snapped|growled|declared|announced|insisted|admitted|agreed|continued|repeated|demanded|thought|wondered"
)
# English words after which a line break never ends a clause.
FUNCTION_WORDS = (
    "a|an|the|of|at|by|in|on|to|for|from|with|and|or|but|nor|so|yet|as|if|that|than|then|when|while|because|since|was|were|is|are|be|been|has|had|have|"
    "not|no|into|onto|over|under|about|next|who|which|whose|his|her|its|their|our|your|my|this|these|those|Mr|Mrs|Ms|Dr"
)

CLOSE = "”’»」』）\\])】》〉｣}\"'"
OPEN = "“‘«「『（\\[(【《〈｢{\"'"
# A pair of quotes or brackets with one level of the same kind inside.
_PAIRS = [("「", "」"), ("『", "』"), ("“", "”"), ("（", "）"), ("\\(", "\\)"), ("\\[", "\\]"), ("【", "】"), ("《", "》"), ("〈", "〉"), ("«", "»"), ("｢", "｣")]
PROTECTED = "|".join([f"{a}[^{a}{b}]*+(?:{a}[^{a}{b}]*+{b}[^{a}{b}]*+)*+{b}" for a, b in _PAIRS] + ['"[^"]*+"', r"(?<![\p{L}\p{N}])‘(?:[^‘’]|(?<=\p{L})’(?=\p{L}))*+’"])
_FIRSTS = "「『“（(\\[【《〈«｢\"‘"
# What a protected piece, or the longest run that starts none, looks like.
SEGMENT = f"(?:{PROTECTED})|[^{_FIRSTS}]++|[\\s\\S]"

_MARKS = ".!?。！？．｡…؟।॥‥⁈⁉‼"
_SPACES = " \t\n\r　\xa0      "

# Fixed value: white space at the ends of a unit.
WHITE = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _folded(text: Column) -> Column:
    """Full-width ASCII to ASCII, Greek and Cyrillic twins to Latin letters, odd spaces to the space, character by character."""
    wide = "".join(map(chr, [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]))
    plain = "".join(chr(ord(c) - 0xFEE0) for c in wide)
    twins, latin = "аеорсхуіѕјΑΒΕΖΗΙΚΜΝΟΡΤΥΧАВЕКМНОРСТХІЅЈοανικρυ", "aeopcxyisjABEZHIKMNOPTYXABEKMHOPCTXISJoavikpu"
    spaces = "".join(map(chr, [0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))
    return F.translate(text, wide + twins + spaces, plain + latin + " " * len(spaces))


Step = tuple[Callable[[Column], Column], Callable[[Column], Column]]  # does it concern the text; what it makes of it


def _holds(*chars: str) -> Callable[[Column], Column]:
    return lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(c)) for c in chars])


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda t: t.rlike(pattern)


def _each(*rules: tuple[str, str]) -> Callable[[Column], Column]:
    return lambda t: reduce(lambda x, r: F.regexp_replace(x, *r), rules, t)


def _url_marks(t: Column) -> Column:
    """Every inner mark of an address masked; the address may be of any length."""
    inner = lambda x: F.concat(F.translate(F.left(x, F.length(x) - 1), ".!?", MASK * 3), F.right(x, F.lit(1)))
    pieces = F.regexp_extract_all(t, F.lit(r"(?:https?://|www\.)[\x21-\x7e]++|[\s\S](?:(?!https?://|www\.)[\s\S])*+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.when(x.rlike(r"^(?:https?://|www\.)"), inner(x)).otherwise(x)), "")


MASKING: list[Step] = [
    # numbers, times, versions: a mark between digits; the Japanese full-width one as well
    (_holds(".", "．"), _each((r"(?<=\p{N})[.．](?=\p{N})", MASK))),
    (_holds("://", "www."), _url_marks),
    # e.g., i.e., a.m.: letter, stop, letter, stop
    (_matches(r"[eiap]\.\s?[gem]\."), _each((r"(?<![\p{L}])(e|i|a|p)\.\s?(g|e|m)\.", f"$1{MASK}$2."), (rf"(?<=(?<![\p{{L}}])[ei]{MASK}[ge])\.", MASK))),
    # a time that opens a clause ("At 6:30 a.m. Irie ..."), or whose clause goes on, ends nothing
    (
        _holds(f"{MASK}m."),
        _each(
            (
                rf"((?:^|[.!?…;:,”\"\n]|\b(?:[Aa]nd|[Bb]ut|[Ss]o|[Tt]hen|[Yy]et|[Bb]ecause))\s*+(?:[Aa]t|[Bb]y|[Aa]round|[Bb]efore|[Aa]fter|[Uu]ntil|[Ff]rom|[Aa]bout)\s+\d{{1,2}}(?:[:{MASK}]\d\d)?\s+[ap]{MASK}m)\.",
                f"$1{MASK}",
            )
        ),
    ),
    (
        _holds("."),
        _each(
            (rf"(?<![\p{{L}}])({TITLES})\.", f"$1{MASK}"),
            (rf"(?<![\p{{L}}])({NUMBERED})\.(?=\s*\p{{N}})", f"$1{MASK}"),
            # initials, unless the letter is the label of a noun
            (rf"(?<![\p{{L}}\p{{N}}])(?<!\b(?:{LABELS})\s{{1,2}})(\p{{Lu}})\.(?=\s+\p{{Lu}})", f"$1{MASK}"),
        ),
    ),
]


def _sheltered(text: Column) -> Column:
    """Marks and spaces inside quotes and brackets masked. The closing sign stays, and a
    quotation's last mark is kept, for what follows a quotation depends on it."""
    marks, gaps = MASK * len(_MARKS), GAP * len(_SPACES)

    def one(seg: Column) -> Column:
        inner = F.translate(seg, _MARKS + _SPACES, marks + gaps)
        ended = seg.rlike(f"[{_MARKS}]+[”\"’»]$")
        return F.when(seg.rlike(f"^[{_FIRSTS}][\\s\\S]*[{CLOSE}]$"), F.when(ended, F.regexp_replace(inner, f"{MASK}(?=.$)", "!")).otherwise(inner)).otherwise(seg)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(0)), one), "")


_UNLESS_REPORTED = rf"(?!\s+(?:(?:Mr|Mrs|Ms|Dr|Prof){MASK}?\s+)?\p{{Lu}}[\p{{L}}'’-]*(?:\s+\p{{Lu}}[\p{{L}}'’-]*)?\s+(?:{REPORTING})\b)"
BORDERS: list[Step] = [
    # 1. scripts whose marks need no space behind them
    (_matches("[。！？｡।॥؟‼⁈⁉]"), _each((rf"([。！？｡।॥؟‼⁈⁉]+[。！？｡!?…]*[{CLOSE}]*)(?=[^。！？｡!?…।॥؟{CLOSE}])(?!、|，)", f"$1{BORDER}"))),
    (_matches("[぀-ヿ㐀-鿿][.．!?]"), _each((rf"(?<=[぀-ヿ㐀-鿿])([.．!?]+[{CLOSE}]*)(?=[぀-ヿ㐀-鿿「『])", f"$1{BORDER}"))),
    # 2. Japanese ellipses: an end after a predicate, none after a particle
    (
        _holds("…", "‥"),
        _each(
            (rf"(?<=[ただるいうくすつぬむぐぶよねかぞわん])([…‥]+[{CLOSE}]*)(?=[^。！？｡!?….…、，{CLOSE}])", f"$1{BORDER}"),
            (r"(?<=[぀-ヿ㐀-鿿])([…‥]+)(?=[\s\p{Z}])", f"$1{BORDER}"),
        ),
    ),
    # 3. marks followed by a space: an end unless a small letter goes on
    (
        _matches(r"[.!?…]"),
        _each(
            (r"([.!?…]+)(?=[\s\p{Z}]+[^\p{Ll}\s\p{Z}])", f"$1{BORDER}"),
            (rf"([.!?…]+[{CLOSE}]+)(?=[\s\p{{Z}}]+[^\p{{Ll}}\s\p{{Z}}]){_UNLESS_REPORTED}", f"$1{BORDER}"),
        ),
    ),
    # 4. scripts without marks: a space between their letters
    (_matches("[฀-๿຀-໿က-႟ក-៿]"), _each((r"(?<=[฀-๿຀-໿က-႟ក-៿])(?=[ 　\xa0]+[฀-๿຀-໿က-႟ក-៿])", BORDER))),
    # 5. line breaks: around a line without letters, and after a complete clause
    (
        _holds("\n", "\r"),
        _each(
            (r"(?<=[\n\r])(?=[^\p{L}\p{N}\n\r]+(?:[\n\r]|$))", BORDER),
            (r"(?<=^|[\n\r])([^\p{L}\p{N}\n\r]+)(?=[\n\r])", f"$1{BORDER}"),
            (r"(?=[\n\r]\s*[\n\r])", BORDER),
            (r"(?<=[ただるいうくすつぬむぐぶよねかぞわん」』）。！？!?…])(?=[ \t　]*+[\n\r])", BORDER),
            (rf"(?<![,;:\p{{Pd}}\s])(?<!\b(?:{FUNCTION_WORDS}))(?=[ \t]*+[\n\r]\s*+[\p{{Lu}}“\"‘(])(?<=[\x21-ʯ”’…])", BORDER),
        ),
    ),
]


def _stepped(df: DataFrame, name: str, steps: list[Step]) -> DataFrame:
    """df with the column taken through the steps that concern it."""
    for concerns, make in steps:
        df = once(df, {name: F.when(concerns(F.col(name)), make(F.col(name))).otherwise(F.col(name))})
    return df


#: Pieces whose starts are summed up at once.
RUN = 64


def _starts(parts: Column) -> Column:
    """Where each piece starts: runs of pieces are summed, then starts within runs, so that time isn't the square of their number."""
    size = F.transform(parts, F.length)
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / RUN).cast("int")), lambda r: F.slice(size, r * RUN + 1, RUN))

    def summed(xs: Column, first: Column) -> Column:
        return F.aggregate(xs, F.array(first), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    firsts = summed(F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda a, x: a + x)), F.lit(0))
    return F.flatten(F.zip_with(runs, F.slice(firsts, 1, F.size(runs)), lambda r, first: F.slice(summed(r, first), 1, F.size(r))))


def units(df: DataFrame, text: str, keys: list[str], start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    """keys + start_pos, end_pos (exclusive), unit: one row per sentence unit of every text."""
    base = df.select(*keys, F.col(text).alias("_text")).where(F.col("_text").isNotNull() & (F.col("_text") != ""))
    base = once(base, {"_t": _folded(F.translate("_text", MASK + GAP + BORDER, "�" * 3))})
    base = _stepped(base, "_t", [*MASKING, (_matches(f"[{_FIRSTS}]"), _sheltered), *BORDERS])
    base = once(base, {"_parts": F.split("_t", BORDER)}).drop("_t")
    # the pieces are as long as what they stand for; a text of one piece needs no sums
    one = F.array(F.lit(0))
    base = once(base, {"_starts": F.when(F.size("_parts") == 1, one).otherwise(_starts(F.col("_parts")))})
    pieces = base.select(*keys, "_text", F.explode(F.arrays_zip(F.col("_starts").alias("a"), F.col("_parts").alias("p"))).alias("_at")).where(F.col("_at.p").rlike(r"[\p{L}\p{N}]"))
    pieces = pieces.select(*keys, F.col("_at.a").alias("_a"), F.substring("_text", F.col("_at.a") + 1, F.length("_at.p")).alias("_raw"))
    lead = F.length("_raw") - F.length(F.ltrim("_raw", F.lit(WHITE)))
    tail = F.length("_raw") - F.length(F.rtrim("_raw", F.lit(WHITE)))
    pieces = once(pieces, {"_lead": lead, "_tail": tail})
    size = F.length("_raw") - F.col("_lead") - F.col("_tail")
    return pieces.select(
        *keys,
        (F.col("_a") + F.col("_lead")).cast("long").alias(start),
        (F.col("_a") + F.col("_lead") + size).cast("long").alias(end),
        F.substring("_raw", F.col("_lead") + 1, size).alias("unit"),
    )
