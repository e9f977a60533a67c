"""Problem 6: text that looks the same, written with different characters.

Symbols (code points, and pairs of a base with a mark that compose) are joined
into look-alike classes by union-find: a code point with its compatibility
form, a pair with its composed form, invisible characters with nothing, spaces
with the space, and letters and signs of like shape with each other; classes
are transitive. Each class's representative is the member that the corpus uses
most (for classes that hold a longer string or nothing, that string). Texts are
rewritten greedily, longest pattern first, by one multi-pattern automaton, again
until nothing changes.

What is counted, and what is sent out, has at most one entry for each code
point and composable pair that Unicode has, whatever the corpus.

Defined results: a null text stays null, an empty one empty. A text of nothing
but invisible characters becomes empty. Ties of frequency go to the symbol that
is its own compatibility form, then to the smaller code point. Case is kept; circled and
raised characters, which do look different, are kept too.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Signs of like shape, each line one class: Latin with Cyrillic, Greek, Armenian, Cherokee, Lisu and Coptic letters,
# kana with Han signs, dashes, dots. Digits stay apart from letters: joined with O, l and I they would turn numbers into words.
ALIKE = """
a а α
c с ϲ ⲥ
d ԁ
e е ҽ
g ց
h һ հ
i і ι
j ј ϳ յ
k κ
n ո
o о ο օ ⲟ
p р ρ ⲣ
q ԛ
s ѕ
u υ ս
v ν ѵ
w ԝ ա
x х ⲭ
y у γ
A А Α Ꭺ ꓮ
B В Β Ᏼ ꓐ
C С Ϲ Ꮯ ꓚ Ⲥ
D Ꭰ ꓓ
E Е Ε Ꭼ ꓰ
F Ϝ ꓝ
G Ԍ Ꮐ ꓖ
H Н Η Ꮋ ꓧ Ⲏ
I І Ι Ӏ ꓲ
J Ј Ꭻ ꓙ
K К Κ Ꮶ ꓗ Ⲕ
L Ꮮ ꓡ
M М Μ Ϻ Ꮇ ꓟ Ⲙ
N Ν ꓠ Ⲛ
O О Ο Օ ꓳ Ⲟ
P Р Ρ Ꮲ ꓑ Ⲣ
R Ꭱ ꓣ
S Ѕ Տ Ꮪ ꓢ
T Т Τ Ꭲ ꓔ Ⲧ
U Ս ꓴ
V Ѵ Ꮩ ꓦ
W Ԝ Ꮃ ꓪ
X Х Χ ꓫ Ⲭ
Y Ү Υ ꓬ Ⲩ
Z Ζ Ꮓ ꓜ Ⲍ
エ 工
カ 力
ト 卜
ロ 口 囗
ニ 二
ハ 八
タ 夕
チ 千
ミ 彡
オ 才
ヌ 又
ム 厶
ノ 丿
ヒ 匕
メ 乂
ヘ へ
ベ べ
ペ ぺ
リ り
ー 一 ― — ─ ━
- ‐ ‑ – −
・ · • ‧ ∙ ⋅
〜 ～ ∼
、 ､
。 ｡
長 ⻑
青 ⻘
西 ⻄
食 ⻝
母 ⺟
"""

# Characters that leave no mark on the line, beside Unicode's format characters.
UNSEEN = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
# Compatibility forms that do look different.
DIFFERENT = ("<circle>", "<super>", "<sub>", "<fraction>")
MARKS = "̀-゙゚ͯﾞﾟ़"
PAIR = re.compile(f"[^\\s{MARKS}][{MARKS}]")


def form(s: str) -> str:
    """What a symbol stands for: its compatibility form, a space, or nothing."""
    if len(s) > 1:
        return unicodedata.normalize("NFKC", s)
    kind = unicodedata.category(s)
    if kind == "Cf" or ord(s) in UNSEEN:
        return ""
    if kind == "Zs":
        return " "
    if unicodedata.decomposition(s).startswith(DIFFERENT):
        return s
    out = unicodedata.normalize("NFKC", s)
    return s if out.startswith(" ") else out


def symbols(text: str) -> Iterable[str]:
    """The code points of a text, and the pairs in it that compose or widen."""
    yield from text
    for pair in PAIR.findall(text):
        if len(form(pair)) == 1:
            yield pair


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, s: str) -> str:
        root = s
        while self.up.setdefault(root, root) != root:
            root = self.up[root]
        while self.up[s] != root:
            self.up[s], s = root, self.up[s]
        return root

    def join(self, a: str, b: str) -> None:
        self.up[self.find(a)] = self.find(b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for s in list(self.up):
            out.setdefault(self.find(s), []).append(s)
        return out


def rewriting(counts: dict[str, int]) -> dict[str, str]:
    """pattern -> representative, for every symbol that isn't its own representative."""
    classes = Classes()
    for line in ALIKE.split("\n"):
        first, *others = line.split() or [""]
        for c in others:
            classes.join(first, c)
    for c in "".join(ALIKE.split()):
        # the alternatives in other widths and compositions belong to the class too
        if form(c) != c:
            classes.join(c, form(c))
    for s in counts:
        if form(s) != s:
            classes.join(s, form(s))
    # a base and a mark may come together only when what stands between them, or the width of one, is gone
    single = {c for s in counts for c in s}
    marks = [c for c in single if PAIR.fullmatch("a" + c)]
    for base in single | {form(c) for c in single}:
        for mark in marks:
            pair = base + mark
            if len(base) == 1 and len(form(pair)) == 1:
                classes.join(pair, form(pair))
    out: dict[str, str] = {}
    for members in classes.members().values():
        fixed = [m for m in members if m == "" or (len(m) > 1 and form(m) == m and not PAIR.fullmatch(m))]
        best = min(fixed or members, key=lambda m: (-counts.get(m, 0), form(m) != m, len(m), m)) if not fixed else min(fixed, key=len)
        for m in members:
            if m != best and m:
                out[m] = best
    return out


class Rewriter:
    """Greedy longest-match rewriting by one automaton."""

    def __init__(self, rules: dict[str, str]) -> None:
        self.rules = rules
        self.automaton = ahocorasick.Automaton()
        for a, b in rules.items():
            self.automaton.add_word(a, (len(a), b))
        if rules:
            self.automaton.make_automaton()
        self.firsts = re.compile("[" + re.escape("".join(sorted({a[0] for a in rules} | {a[-1] for a in rules}))) + "]") if rules else None

    def __call__(self, text: str | None) -> str | None:
        if text is None or not self.rules:
            return text
        # each round takes symbols to their representatives or makes the text shorter, so this ends
        while True:
            if not self.firsts.search(text):
                return text
            out, at = [], 0
            for end, (n, new) in self.automaton.iter_long(text):
                out += [text[at : end - n + 1], new]
                at = end + 1
            if not at:
                return text
            new_text = "".join(out) + text[at:]
            if new_text == text:
                return text
            text = new_text


def learn(texts: DataFrame, column: str) -> dict[str, str]:
    """The rewriting rules of a corpus. Symbols are counted in every partition first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, pairs = np.zeros(0x110000, np.int64), Counter()
        for pdf in batches:
            whole = "\n".join(pdf["t"])
            points += np.bincount(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4"), minlength=0x110000)
            points[10] -= max(0, len(pdf) - 1)  # the joins
            pairs.update(PAIR.findall(whole))
        total = {chr(i): int(points[i]) for i in np.flatnonzero(points)} | {p: n for p, n in pairs.items() if len(form(p)) == 1}
        yield pd.DataFrame(list(total.items()), columns=["s", "n"]).astype({"s": "object", "n": "int64"})

    counted = texts.select(F.col(column).alias("t")).where(F.col("t").isNotNull()).mapInPandas(count, "s string, n long").groupBy("s").agg(F.sum("n").alias("n"))
    return rewriting({r["s"]: r["n"] for r in counted.toLocalIterator()})


def canonicalised(df: DataFrame, text: str, rules: dict[str, str], out: str = "canonical") -> DataFrame:
    """df + out: the text with every symbol's representative."""
    sent = df.sparkSession.sparkContext.broadcast(rules)
    made: list[Rewriter] = []

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(Rewriter(sent.value))
        return texts.map(made[0])

    return df.withColumn(out, rewrite(F.col(text)))


def same_to_the_eye(df: DataFrame, keys: list[str], row_id: str, text: str, canonical: str) -> DataFrame:
    """keys, id_a, id_b: rows whose texts differ and have one canonical form.

    Distinct texts are paired first, within classes that have several; rows are
    joined only to these pairs, so a class of copies costs nothing.
    """
    # texts and forms go on as hashes of 128 bits
    rows = df.where(F.col(text).isNotNull()).select(*keys, F.col(row_id).alias("id"), _hashed(text).alias("t"), _hashed(canonical).alias("c")).distinct()
    variants = rows.groupBy(*keys, "c", "t").agg(F.lit(1).alias("one"))
    several = variants.groupBy(*keys, "c").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    variants = variants.join(several, [*keys, "c"], "left_semi").select(*keys, "c", "t")
    pairs = variants.withColumnRenamed("t", "ta").join(variants.withColumnRenamed("t", "tb"), [*keys, "c"]).where("ta < tb").select(*keys, "ta", "tb")
    ids = rows.select(*keys, "id", "t").join(variants.select(*keys, "t"), [*keys, "t"], "left_semi")
    out = pairs.join(ids.withColumnRenamed("t", "ta").withColumnRenamed("id", "a"), [*keys, "ta"]).join(ids.withColumnRenamed("t", "tb").withColumnRenamed("id", "b"), [*keys, "tb"])
    return out.where("a != b").select(*keys, F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def _hashed(x: str):
    return F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))


def eye_classes(df: DataFrame, keys: list[str], row_id: str, text: str, canonical: str) -> DataFrame:
    """keys, id, class_id, variants, links: every row's class of like-looking texts (named by its smallest id), the class's
    number of different texts, and the rows whose text differs from the row's and looks the same. No pairs are made.
    """
    rows = df.where(F.col(text).isNotNull()).select(*keys, F.col(row_id).alias("id"), _hashed(text).alias("t"), _hashed(canonical).alias("c")).distinct()
    per_text = rows.groupBy(*keys, "c", "t").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    per_class = per_text.groupBy(*keys, "c").agg(F.min("first").alias("class_id"), F.count("*").alias("variants"), F.sum("n").alias("all"))
    sized = per_text.join(per_class, [*keys, "c"]).select(*keys, "c", "t", "class_id", "variants", (F.col("all") - F.col("n")).alias("links"))
    return rows.join(sized, [*keys, "c", "t"]).select(*keys, "id", "class_id", "variants", "links")
