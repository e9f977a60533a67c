"""Problem 9: per-document text statistics, and which documents are no natural prose.

Statistics are taken in one pass over Arrow batches: code points are looked up
in a table of character classes and counted by numpy, lines are described by how
they start and end and by the separators in them. No statistic says by itself
what is prose; gradient-boosted trees find that out from all of them.

Weak labels don't come from the statistics. Training documents are put together
from passages that the corpus itself marks as prose (a bounded sample of them)
in many layouts, and from structural junk made of the same passages: lists,
numbered sentences, tables with sentences in their cells, navigation, records,
data, logs, and destroyed text. As the pieces are known, so is the share of
prose in each document, and with it the label. The margins are calibrated
(logistic scaling) on the hand-checked texts of quality_holdout, which take no
part in the training.

Defined results: a null, empty or blank text has counts of 0, ratios of 0 and
is no prose. Repeated rows are judged alike. Any length is read whole. Without
any marked passage the hand-checked prose is all that the trees learn from.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_holdout import CHECKED

#: Bound of the labelled passages (the smallest hashes of their texts), and training documents made of them.
SAMPLE, MADE = 4000, 8000
TREES, DEPTH, RATE, BINS = 120, 5, 0.1, 48

LATIN, DIGIT, HIRA, KATA, HAN, LETTER, SPACE, BREAK, END, PUNCT, TECH, CONTROL, UNSEEN, MARK, OTHER = range(15)

# Common words of English prose, and of Japanese (particles and endings).
COMMON = frozenset(
    "the a an of to in on at by and or but so then that this it he she they his her was were is are had has have been be not no with for from as "
    "when while because since if does do did who which there all what i you we my your me him them could would will can out up into never yet even to".split()
)
COMMON_JA = re.compile("[はがをにでともへのやか]|から|まで|った|んだ|して|いる|ない|です|ます|だった")

STAT_NAMES = [
    "n_chars", "n_words", "mean_word_len", "symbol_ratio", "digit_ratio", "space_ratio", "letter_ratio", "kana_share", "n_lines", "mean_line_len",
    "end_punct_lines", "end_punct_chars", "end_marks_per_100", "common_words", "marker_lines", "marker_chars", "separator_lines", "separator_chars", "commas_per_100",
    "brackets_per_100", "figure_lines", "opener_lines", "small_start_lines", "distinct_chars", "distinct_words", "longest_run", "longest_word", "control_ratio", "upper_ratio",
    "short_lines", "capital_words", "kind_changes",
]
COUNTS = ("n_chars", "n_words", "n_lines")

END_MARKS = ".!?。！？؟।…"
CLOSERS = "\"'”’»)]」』）】"
_MARKER = re.compile(r"[-*•・●○◦‣▪+–—](?=\s|[^\s\d.\-*=_–—])|[(\[（]?\d{1,5}[.)\]）．、:：](?=\s|[^\d.\s])|[①-⑳]|#{1,6}\s|[A-Za-z][.)]\s|(?:Part|Chapter|Section|第)\s*\d+\s*[:：章話回]?")
_GAPS = re.compile(r"\S(?: {2,}|\t+)\S")
_STRIP = ".,;:!?…\"'“”‘’()[]{}«»*_"


def _table() -> np.ndarray:
    t = np.full(0x110000, OTHER, dtype=np.uint8)
    for i in range(0x30000):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind[0] == "L":
            t[i] = LATIN if i < 0x250 or 0xFF21 <= i <= 0xFF5A else HIRA if 0x3040 <= i < 0x30A0 else KATA if 0x30A0 <= i < 0x3100 or 0xFF66 <= i < 0xFFA0 else HAN if 0x3400 <= i < 0xA000 or 0xF900 <= i < 0xFB00 or i >= 0x20000 else LETTER
        elif kind[0] == "M":
            t[i] = MARK
        elif kind == "Nd":
            t[i] = DIGIT
        elif kind == "Zs":
            t[i] = SPACE
        elif kind == "Cf":
            t[i] = UNSEEN
        elif kind[0] == "C":
            t[i] = CONTROL
        elif kind[0] == "P":
            t[i] = PUNCT
    t[0x30000:] = HAN
    for c in "\n\r\x0b\x0c\x85  ":
        t[ord(c)] = BREAK
    t[9] = SPACE
    for c in ".!?。！？؟।…":
        t[ord(c)] = END
    for c in "{}[]<>|=/\\#@~^*_%$&+`｜;:":
        t[ord(c)] = TECH
    t[0xFFFD] = CONTROL
    t[0x80:0xA0] = CONTROL
    t[0x85] = BREAK
    return t


CLASS = _table()
UPPER = np.array([chr(i).isupper() for i in range(0x2000)] + [False])


def stats(text: str | None) -> list[float]:
    """The statistics in the order of STAT_NAMES."""
    if not text or not text.strip():
        return [float(len(text or ""))] + [0.0] * (len(STAT_NAMES) - 1)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = CLASS[points]
    c = np.bincount(kinds, minlength=15).astype(float)
    n = len(points)
    letters = c[LATIN] + c[HIRA] + c[KATA] + c[HAN] + c[LETTER]
    solid = max(1.0, n - c[SPACE] - c[BREAK])
    change = np.flatnonzero(points[1:] != points[:-1])
    longest_run = float(np.max(np.diff(np.concatenate(([-1], change, [n - 1])))))
    split = text.split()
    # scripts without spaces: a word is a run of one script
    cjk = (kinds == HIRA) | (kinds == KATA) | (kinds == HAN)
    runs = int(np.count_nonzero(cjk[1:] & ((kinds[1:] != kinds[:-1]) | ~cjk[:-1]))) + int(cjk[0])
    some_cjk = bool(runs)
    spaced = [w for w in split if w.isascii()] if some_cjk else split
    n_words = len(spaced) + runs
    word_chars = sum(map(len, spaced)) + float(np.count_nonzero(cjk))
    bare = [w.strip(_STRIP) for w in spaced]
    common = sum(map(COMMON.__contains__, map(str.lower, bare)))
    common += len(COMMON_JA.findall(text)) if some_cjk else 0
    total = lines = ended = ended_chars = marked = marked_chars = parted = parted_chars = figures = opened = small = short = 0
    for line in text.splitlines():
        s = line.strip()
        if not s:
            continue
        size = len(s)
        total += size
        lines += 1
        short += size < 20
        first, core = s[0], s.rstrip(CLOSERS)
        if core and core[-1] in END_MARKS or s[-1] in "」』”":
            ended += 1
            ended_chars += size
        if _MARKER.match(s):
            marked += 1
            marked_chars += size
        if "|" in s or "｜" in s or "\t" in s or " / " in s or _GAPS.search(s):
            parted += 1
            parted_chars += size
        figures += first.isdigit() or s[-1].isdigit()
        opened += first in "「『“\"‘"
        small += first.islower()
    total, lines_ = max(1, total), max(1, lines)
    values = {
        "n_chars": n, "n_words": n_words, "mean_word_len": word_chars / max(1, n_words), "symbol_ratio": (c[TECH] + c[OTHER]) / solid, "digit_ratio": c[DIGIT] / solid,
        "space_ratio": c[SPACE] / n, "letter_ratio": letters / solid, "kana_share": c[HIRA] / max(1.0, c[HIRA] + c[KATA] + c[HAN]), "n_lines": lines, "mean_line_len": total / lines_,
        "end_punct_lines": ended / lines_, "end_punct_chars": ended_chars / total, "end_marks_per_100": 100 * c[END] / n, "common_words": common / max(1, n_words),
        "marker_lines": marked / lines_, "marker_chars": marked_chars / total, "separator_lines": parted / lines_, "separator_chars": parted_chars / total,
        "commas_per_100": 100 * text.count(",") / n, "brackets_per_100": 100 * sum(map(text.count, "{}[]<>=")) / n, "figure_lines": figures / lines_, "opener_lines": opened / lines_,
        "small_start_lines": small / lines_, "distinct_chars": len(np.unique(points)) / np.sqrt(n), "distinct_words": len(set(split)) / max(1, len(split)), "longest_run": longest_run / n,
        "longest_word": np.log1p(len(max(split, key=len))), "control_ratio": (c[CONTROL] + c[UNSEEN]) / n, "upper_ratio": float(np.count_nonzero(UPPER[np.minimum(points, 0x2000)])) / max(1.0, c[LATIN]),
        "short_lines": short / lines_, "capital_words": sum(w[:1].isupper() for w in bare) / max(1, len(bare)), "kind_changes": np.count_nonzero(kinds[1:] != kinds[:-1]) / n,
    }
    return [float(values[k]) for k in STAT_NAMES]


@dataclass
class Trees:
    """Boosted regression trees on the logistic loss, over binned statistics."""

    edges: np.ndarray  # inner bin edges of each statistic
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # statistic and bin of each inner node, value of each leaf
    scale: tuple[float, float] = (1.0, 0.0)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut_at, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut_at[node])
            out += value[node - (2**DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.margin(x) + b, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Train on statistics x and labels y (1: no prose)."""
    edges = np.stack([np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]) for j in range(x.shape[1])])
    p = np.clip(y.mean(), 0.01, 0.99)
    model = Trees(edges, float(np.log(p / (1 - p))), [])
    b = model.binned(x).astype(np.int64)
    out = np.full(len(x), model.base)
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-out))
        g, h = p - y, p * (1 - p)
        feature, cut_at, node = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64), np.zeros(len(x), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            best = np.full(width, 1e-6)
            for j in range(x.shape[1]):
                at = (node - first) * BINS + b[:, j]
                sg = np.cumsum(np.bincount(at, g, width * BINS).reshape(width, BINS), axis=1)
                sh = np.cumsum(np.bincount(at, h, width * BINS).reshape(width, BINS), axis=1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                gain[(sh < 1) | (th - sh < 1)] = 0
                k = gain.argmax(axis=1)
                better = gain[np.arange(width), k] > best
                best = np.where(better, gain[np.arange(width), k], best)
                feature[first : first + width] = np.where(better, j, feature[first : first + width])
                cut_at[first : first + width] = np.where(better, k, cut_at[first : first + width])
            node = 2 * node + 1 + (b[np.arange(len(x)), feature[node]] > cut_at[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        out += value[leaf]
        model.trees.append((feature, cut_at, value))
    return model


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic scaling of the margins with smoothed targets, by Newton steps."""
    m = model.margin(x)
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.array([0.5, 0.0])
    f = np.stack([m, np.ones_like(m)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        hess = f.T @ (f * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(hess, f.T @ (p - t) + 1e-3 * w)
    model.scale = (float(max(w[0], 0.05)), float(w[1]))


def _terms(passage: str) -> list[str]:
    """Words and short word groups of a passage, as lists and tables have them."""
    words = [w.strip(_STRIP) for w in passage.split()]
    if len(words) > 2:
        return [" ".join(words[i : i + k]) for i in range(len(words)) for k in (1, 2, 3, 5, 7) if all(words[i : i + k])] or [passage[:8]]
    return re.findall(r"[㐀-鿿々]+|[ァ-ヺー]{2,}|[㐀-鿿]+[ぁ-ゟ]{1,2}", passage) or [passage[:8]]


class Maker:
    """Training documents of known content, from passages of prose."""

    def __init__(self, passages: list[str], rng: np.random.Generator) -> None:
        self.rng, self.passages = rng, passages
        self.groups = {True: [p for p in passages if p.count(" ") >= 3], False: [p for p in passages if p.count(" ") < 3]}
        self.kinds = [self.items, self.numbered, self.cells, self.bars, self.delimited, self.records, self.data, self.navigation, self.pairs, self.contents, self.contents, self.words, self.destroyed, self.repeated, self.symbols, self.log, self.settings]

    def some(self, n: int) -> list[str]:
        """Passages of one kind of script."""
        own = self.groups[bool(self.rng.random() < 0.5)] or self.passages
        return [own[i] for i in self.rng.integers(len(own), size=n)]

    def one(self, choices):
        return choices[self.rng.integers(len(choices))]

    def number(self, top: int) -> int:
        return int(self.rng.integers(top))

    def size(self, top: int = 24) -> int:
        return 1 + int(top * self.rng.random() ** 2)

    def terms(self, n: int) -> list[str]:
        return [self.one(_terms(p)) for p in self.some(n)]

    def prose(self) -> str:
        out, spaced = [], bool(self.rng.random() < 0.5)
        own = self.groups[spaced] or self.passages
        if self.rng.random() < 0.1:  # talk in short lines
            own = sorted(own, key=len)[: max(1, len(own) // 5)]
        for _ in range(self.size(14)):
            line = (" " if spaced else "").join(own[i] for i in self.rng.integers(len(own), size=self.size(6)))
            out.append(line)
        text = self.one(["\n", "\n", "\n\n", "\n　"]).join(out)
        how = self.rng.random()
        if how < 0.2:  # wrapped at a width
            width, lines = 40 + self.number(50), []
            for line in text.split("\n"):
                while len(line) > width:
                    at = line.rfind(" ", 0, width)
                    at = at if at > 0 else width
                    lines.append(line[:at])
                    line = line[at:].lstrip()
                lines.append(line)
            text = "\n".join(lines)
        elif how < 0.3:
            text = self.one(["# ", "## ", "", "Part ", "第"]) + self.one([self.one(self.terms(1)), str(self.number(300))]) + "\n\n" + text
        elif how < 0.35:
            text = text.rstrip("".join(END_MARKS) + CLOSERS)
        elif how < 0.4:
            text = text.lower()
        elif how < 0.44:
            text += "\n" + self.one(["***", "※　※　※", "---", "◇"])
        return text

    def items(self) -> str:
        mark = self.one(["- ", "* ", "• ", "・", "– ", "● ", "+ "])
        return "\n".join(mark + x for x in (self.terms(2 + self.size()) if self.rng.random() < 0.6 else self.some(2 + self.size(9))))

    def numbered(self) -> str:
        form = self.one(["{}. ", "{}) ", "({}) ", "{}．", "{}、", "[{}] ", "{}: "])
        return "\n".join(form.format(i + 1) + x for i, x in enumerate(self.some(2 + self.size(12)) if self.rng.random() < 0.6 else self.terms(2 + self.size())))

    def cells(self) -> str:
        k, bar = 2 + self.number(3), self.one([" | ", "｜", "\t", "|"])
        long = self.rng.random() < 0.35
        rows = [bar.join((self.some(k) if long else self.terms(k - 1) + [str(self.number(900))])) for _ in range(2 + self.size(14))]
        if bar == " | " and self.rng.random() < 0.7:
            rows = ["| " + r + " |" for r in rows]
            rows.insert(1, "|" + "---|" * k)
        return "\n".join(rows)

    def bars(self) -> str:
        return "\n".join(f"{t:<{10 + self.number(8)}} {self.number(999):>5} {self.number(9999) / 100:>6.2f}% " + "#*="[self.number(3)] * self.number(12) for t in self.terms(2 + self.size(14)))

    def delimited(self) -> str:
        mark = self.one([",", ";", ","])
        rows = [mark.join([str(i), *(f'"{x}"' for x in self.some(1 + self.number(2))), f"{self.rng.random():.2f}"]) if self.rng.random() < 0.9 else str(i) for i in range(2 + self.size(12))]
        if self.rng.random() < 0.4:
            rows = [mark.join([str(i), *self.terms(2), str(self.number(500))]) for i in range(2 + self.size(16))]
        return "\n".join([mark.join(self.terms(3)), *rows])

    def records(self) -> str:
        keys = self.terms(3)
        rows = [{k: self.one([self.one(self.terms(1)), self.number(99), True, self.one(self.some(1))]) for k in keys} for _ in range(1 + self.size(6))]
        return json.dumps(rows if self.rng.random() < 0.7 else rows[0], ensure_ascii=False, indent=self.one([None, 1, 2]))

    def data(self) -> str:
        return "\n".join(" ".join(f"{self.rng.normal() * 10:.{1 + self.number(4)}f}" for _ in range(3 + self.number(8))) for _ in range(1 + self.size(14)))

    def navigation(self) -> str:
        few = self.terms(4 + self.number(8)) + ["Home", "Next", "Log in"][: self.number(4)]
        return self.one([" | ", "\n", " > ", " · ", " / ", " » "]).join(self.one(few) for _ in range(4 + self.size(40)))

    def pairs(self) -> str:
        mark = self.one([" / ", ": ", " = ", " → ", " — "])
        return "\n".join(mark.join(self.terms(2)) for _ in range(2 + self.size()))

    def contents(self) -> str:
        lead = self.one([" ... ", " ...... ", "……", "\t", "  "])
        return "\n".join(self.one(["", f"{i + 1}. ", f"Chapter {i + 1}: "]) + t + lead + str(self.number(400)) for i, t in enumerate(self.terms(2 + self.size())))

    def words(self) -> str:
        return self.one([" ", "\n", ", ", "、", "　"]).join(self.terms(5 + self.size(40))) + self.one(["", "", ".", "。", "…"])

    def destroyed(self) -> str:
        text = "".join(self.some(1 + self.size(6)))
        how = self.number(4)
        if how == 0:
            return text.encode("utf-8").decode("latin-1")
        chars = np.array(list(text), dtype=object)
        if how == 1:
            self.rng.shuffle(chars)
        elif how == 2:
            chars[self.rng.random(len(chars)) < 0.4] = "\ufffd"
        else:
            chars = np.array([c if self.rng.random() < 0.5 else chr(33 + self.number(15)) for c in chars], dtype=object)
        return "".join(chars)

    def repeated(self) -> str:
        return self.one([self.one(list(self.one(self.some(1)))) or "x", "=-", "_", "!", "！", "wow "]) * (20 + self.number(300))

    def symbols(self) -> str:
        signs = "{}[]<>|=/\\#@~^*_%$&+`;:!?0123456789x "
        return "".join(self.one(signs) for _ in range(30 + self.number(400)))

    def log(self) -> str:
        words = self.terms(3)
        return "\n".join(f"{self.number(24):02}:{self.number(60):02}:{self.number(60):02} {self.one(['INFO', 'WARN', 'ERROR'])} {self.one(words)}[{self.number(99)}] {self.one('abcdef')}={self.number(9)} {self.one('uvwxyz')}=0x{self.number(65535):x}" for _ in range(2 + self.size(20)))

    def settings(self) -> str:
        return "\n".join(f"{self.one(self.terms(1)).replace(' ', '_')}{self.one([' = ', ': ', '='])}{self.number(500)}" for _ in range(3 + self.size(14)))

    def junk(self) -> str:
        return self.one(self.kinds)()

    def document(self) -> tuple[str, float]:
        """(text, share of its characters in prose)"""
        how = self.rng.random()
        if how < 0.32:
            return self.prose(), 1.0
        if how < 0.64:
            return self.junk(), 0.0
        a, b = self.prose(), self.junk()
        if how < 0.76:  # a short piece of the other kind
            if self.rng.random() < 0.5:
                b = "\n".join(b.splitlines()[: 1 + self.number(4)])[: len(a) // 2]
            else:
                a = a.split("\n")[0][: max(10, len(b) // 2)]
        parts = [a, b] if self.rng.random() < 0.5 else [b, a]
        return self.one(["\n", "\n\n"]).join(parts), len(a) / max(1, len(a) + len(b))


def train(passages: list[str], seed: int = 5, made: int = MADE) -> Trees:
    """Trees from documents made of passages of prose; calibrated on the hand-checked texts."""
    rng = np.random.default_rng(seed)
    maker = Maker([p for p in passages if p and p.strip()] or [t for t, good in CHECKED if good], rng)
    docs = [maker.document() for _ in range(made)]
    model = boost(np.array([stats(t) for t, _ in docs]), np.array([float(share < 0.5) for _, share in docs]))
    calibrate(model, np.array([stats(t) for t, _ in CHECKED]), np.array([0.0 if good else 1.0 for _, good in CHECKED]))
    return model


def trained(prose: DataFrame, text: str, sample: int = SAMPLE) -> Trees:
    """Trees from the `sample` distinct passages with the smallest hashes; hashes go first, then the texts chosen."""
    h = F.xxhash64(F.lit(41), text)
    some = prose.where(F.length(text) > 0)
    last = some.select(h.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = [] if last is None else [r[0] for r in some.where(h <= last).select(text).distinct().collect()]
    return train(sorted(chosen))


def statistics(docs: DataFrame, row_id: str, text: str, model: Trees | None = None) -> DataFrame:
    """row_id + STAT_NAMES (+ p_junk with a model): one row a document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"{n} {'long' if n in COUNTS else 'double'}" for n in STAT_NAMES)
    kind = docs.schema[row_id].dataType.simpleString()

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([stats(t) for t in b.column(1).to_pylist()]).reshape(-1, len(STAT_NAMES))
            cols = [pa.array(x[:, j].astype(np.int64)) if n in COUNTS else pa.array(np.round(x[:, j], 6)) for j, n in enumerate(STAT_NAMES)]
            names = [row_id, *STAT_NAMES]
            if sent.value is not None:
                p = sent.value.probability(x) if len(x) else np.zeros(0)
                p[x[:, STAT_NAMES.index("n_lines")] == 0] = 1.0  # nothing to read
                cols.append(pa.array(np.round(p, 6)))
                names.append("p_junk")
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names)

    schema = f"{row_id} {kind}, {fields}" + (", p_junk double" if model is not None else "")
    return docs.select(row_id, text).mapInArrow(one, schema)
