"""Problem 4: sentences of two languages paired where one translates the other.

1. Lexicon. Tokens of both sides that stand in one passage are counted, and
   Dunning's log-likelihood ratio says which pairs go together; each token keeps
   its best senses, however many pairs there are. Up to `LEXICON` pairs are sent
   out whole, so that what is sent has a bound; of more, each group of texts is
   joined with the pairs of its own tokens, which gives the same.
2. Places. Sentences of a long document are not compared all with all. Pairs of
   rare words that stand once on either side of a document, read in the other
   language through the lexicon, anchor places to each other; the median shift
   of the anchors near a place maps it to the other side. Documents are cut into
   blocks of bounded size with a margin.
3. Scores. In a block each pair of sentences gets the weighted share of either's
   tokens that the other explains; so do spans of two or three neighbours of one
   side against a sentence of the other.
4. Assignment. A pair or span gains by how much its score beats `NULL`, the cost of
   going without a partner, twice; a span a little more for each further member. The pairs and spans that beat
   the null cost form small components; in each, the choice of spans and the
   Hungarian assignment of what they leave are optimised together. Order is free,
   so moved sentences are found.
5. Far moves. Units left without a partner whose rare words anchor them to each
   other at any distance are scored and assigned in the same way.

Defined results: null, empty and blank texts have no units. Repeated rows count
once. A document with one side only gives nothing. Ties of score go to the
nearer place, then to the earlier unit. With an empty lexicon nothing is paired.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hibiki.session import cut, tasks

from .sentences import units

#: Of the lexicon: pairs up to which it is sent out whole; least count and log-likelihood of a pair; translations of a token.
LEXICON, LEAST_COUNT, LEAST_RATIO, SENSES = 200_000, 3, 12.0, 6
#: Places of one block, and the margin on both sides of it.
BLOCK, MARGIN = 60, 8
#: What a unit without partner costs, of 1; each place of distance costs so much.
NULL, PER_PLACE = 0.5, 0.004
#: Longest merged span; least share of a member's weight that the other side explains; what each further member adds, as it needn't go without a partner; spans of a component of few units that are tried in all combinations.
SPAN, MEMBER, SPARED, TRIED, SMALL = 3, 0.65, 0.1, 5, 8
BUCKET = 400
#: Rows that are read together with their part of a lexicon that isn't sent out.
ROWS = 4000

_JA = re.compile(r"[㐀-鿿々]+|[ァ-ヺー]+|[0-9]+(?:[.,][0-9]+)*|[a-z]+|[぀-ゟ]{2,}")
_EN = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[a-zé]+(?:'[a-z]+)?")
_KANA = re.compile(r"[぀-ゟ]+")
_UNSEEN = re.compile("[" + "".join(re.escape(chr(i)) for i in [*range(0x110000)] if unicodedata.category(chr(i)) == "Cf") + "]")


def _plain(text: str) -> str:
    return text.lower() if text.isascii() else _UNSEEN.sub("", unicodedata.normalize("NFKC", text).lower().replace("’", "'"))


def _whole(t: str, most: int) -> list[str]:
    """A short text is a token of its own: what is a common word elsewhere can be all of an answer."""
    if len(t) > most + 8:
        return []
    letters = "".join(c for c in t if c.isalnum())
    return ["=" + letters] if 0 < len(letters) <= most else []


def tokens_ja(text: str) -> list[str]:
    """Runs of one script; a run of Han letters also with the kana that inflect it, and kana of a dialogue by twos."""
    t = _plain(text)
    out = []
    for m in _JA.finditer(t):
        s = m[0]
        out.append(s)
        if s[0] >= "㐀":
            k = _KANA.match(t, m.end())
            if k:
                out.append(s + k[0][:2])
            if len(s) >= 3:
                out += [s[i : i + 2] for i in range(len(s) - 1)]
        elif "぀" <= s[0] <= "ゟ" and len(s) > 3:
            out += [s[i : i + 3] for i in range(len(s) - 2)]
    return list(dict.fromkeys(out + _whole(t, 8)))


def tokens_en(text: str) -> list[str]:
    t = _plain(text)
    return list(dict.fromkeys(_EN.findall(t) + _whole(t, 24)))


def _counted(passages: DataFrame) -> DataFrame:
    """kind ('j', 'e', 'p', 'n'), j, e, n: in how many passages tokens and pairs of them stand.

    Counted in each partition first; a partial table is handed on before it grows large.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_j: dict[str, int] = {}
        ids_e: dict[str, int] = {}
        codes, counts, one, held = [], [], Counter(), 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            at, back = np.unique(np.concatenate(codes), return_inverse=True)
            return at, np.bincount(back, np.concatenate(counts)).astype(np.int64)

        def out() -> pd.DataFrame:
            at, n = merged() if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            names_j, names_e = np.array([*ids_j, ""], dtype=object), np.array([*ids_e, ""], dtype=object)
            pairs = pd.DataFrame({"j": names_j[at >> 32], "e": names_e[at & 0xFFFFFFFF], "n": n, "kind": "p"})
            singles = pd.DataFrame([(a, b, k, "j" if b == "" else "e") for (a, b), k in one.items()], columns=["j", "e", "n", "kind"])
            return pd.concat([pairs, singles]) if len(singles) else pairs

        for pdf in batches:
            new, size = [], 0
            for a, b in zip(pdf["a"], pdf["b"]):
                js, es = tokens_ja(a), tokens_en(b)
                one.update([(j, "") for j in js] + [("", e) for e in es] + [("", "")])
                x = np.array([ids_j.setdefault(j, len(ids_j)) for j in js], dtype=np.int64)
                y = np.array([ids_e.setdefault(e, len(ids_e)) for e in es], dtype=np.int64)
                new.append(((x << 32)[:, None] | y[None, :]).ravel())
                size += len(x) * len(y)
                if size > 4_000_000:
                    at, n = np.unique(np.concatenate(new), return_counts=True)
                    codes.append(at)
                    counts.append(n)
                    held, new, size = held + len(at), [], 0
            if new:
                at, n = np.unique(np.concatenate(new), return_counts=True)
                codes.append(at)
                counts.append(n)
                held += len(at)
            if held > 2_000_000:
                at, n = merged()
                codes, counts, held = [at], [n], len(at)
                if held > 1_000_000:  # hand the partial table on
                    yield out()
                    codes, counts, held = [], [], 0
                    ids_j.clear()
                    ids_e.clear()
                    one.clear()
        yield out()

    got = passages.where("a is not null and b is not null").select("a", "b").mapInPandas(count, "j string, e string, n long, kind string")
    return got.groupBy("kind", "j", "e").agg(F.sum("n").alias("n"))


def lexicon(passages: DataFrame) -> DataFrame:
    """j, e, weight, idf_j, idf_e: pairs of tokens that go together. passages: a (Japanese), b (English)."""
    counted = cut(_counted(passages))
    total = counted.where((F.col("j") == "") & (F.col("e") == "")).agg(F.sum("n")).first()[0] or 0
    js = counted.where("kind = 'j' and j != ''").select("j", F.col("n").alias("nj"))
    es = counted.where("e != '' and j = ''").select("e", F.col("n").alias("ne"))
    pairs = counted.where(f"kind = 'p' and n >= {LEAST_COUNT}").select("j", "e", "n").join(js, "j").join(es, "e")
    n, nj, ne, all_ = F.col("n").cast("double"), F.col("nj").cast("double"), F.col("ne").cast("double"), F.lit(float(max(1, total)))

    def xlogx(x):
        return F.when(x > 0, x * F.ln(x)).otherwise(0.0)

    ratio = 2 * (
        xlogx(n) + xlogx(nj - n) + xlogx(ne - n) + xlogx(all_ - nj - ne + n) + xlogx(all_) - xlogx(nj) - xlogx(all_ - nj) - xlogx(ne) - xlogx(all_ - ne)
    )
    kept = pairs.withColumn("ratio", ratio).where((F.col("ratio") >= LEAST_RATIO) & (n * all_ > nj * ne))
    kept = kept.withColumn("weight", n / F.sqrt(nj * ne))
    # a token's best senses, ranked on either side
    of_j, of_e = Window.partitionBy("j").orderBy(F.desc("weight"), F.desc("e")), Window.partitionBy("e").orderBy(F.desc("weight"), F.desc("j"))
    ranked = kept.withColumn("rank", F.least(F.row_number().over(of_j), F.row_number().over(of_e))).where(F.col("rank") <= 2 * SENSES)
    return ranked.select("j", "e", "weight", F.ln((all_ + 1) / nj).alias("idf_j"), F.ln((all_ + 1) / ne).alias("idf_e"), "ratio")


class Lexicon:
    """The lexicon in the form that scoring wants."""

    def __init__(self, rows: list[tuple[str, str, float, float, float]]) -> None:
        by_j: dict[str, list] = defaultdict(list)
        by_e: dict[str, list] = defaultdict(list)
        self.idf_j, self.idf_e = {}, {}
        for j, e, w, a, b in rows:
            by_j[j].append((w, e))
            by_e[e].append((w, j))
            self.idf_j[j], self.idf_e[e] = a, b
        self.of_j = {j: dict((e, w) for w, e in sorted(v, reverse=True)[:SENSES]) for j, v in by_j.items()}
        # a token counts as explained from a weight of half on
        self.strong = {j: [(e, min(1.0, 2.0 * w)) for e, w in s.items()] for j, s in self.of_j.items()}
        self.of_e = {e: {j for w, j in sorted(v, reverse=True)[: 2 * SENSES]} for e, v in by_e.items()}
        # a pair is kept when it is among the best of either side
        self.best = {j: max(s.items(), key=lambda x: (x[1], x[0])) for j, s in self.of_j.items() if s}

    def idf(self, token: str, side: str) -> float:
        """A number that the lexicon doesn't hold speaks for itself; another unknown token says little."""
        known = (self.idf_j if side == "j" else self.idf_e).get(token)
        return known if known is not None else 6.0 if token[0].isdigit() else 0.5 if token[0] == "=" else 1.5

    def match(self, j: str, e: str) -> float:
        if j == e:
            return 1.0
        return self.of_j.get(j, {}).get(e, 0.0)


class Senses:
    """Reads rows of texts with the lexicon.

    Up to LEXICON pairs it is sent out whole. A larger one is joined: each group
    of rows gets the senses of its own Japanese tokens, and which of its tokens
    are English ones of the lexicon. No more than that is ever looked up.
    """

    def __init__(self, rows: DataFrame) -> None:
        self.rows, self.sent = rows.select("j", "e", "weight", "idf_j", "idf_e"), None
        if len(few := self.rows.limit(LEXICON + 1).collect()) <= LEXICON:
            self.sent = rows.sparkSession.sparkContext.broadcast(Lexicon([tuple(r) for r in few]))
        else:
            self.rows = cut(self.rows)

    def read(self, rows: DataFrame, texts: Callable[[pd.DataFrame], Iterable[tuple[str, str]]], f: Callable[[pd.DataFrame, Lexicon], pd.DataFrame], schema: str, bucket: str | None = None) -> DataFrame:
        """f(rows, lexicon) of groups of rows: those of one bucket, or any. texts: the (side, text) that f looks up in some rows."""
        if sent := self.sent:
            if bucket:
                return rows.groupBy(bucket).applyInPandas(lambda pdf: f(pdf, sent.value), schema)
            return rows.mapInPandas(lambda batches: (f(pdf, sent.value) for pdf in batches), schema)
        columns = rows.columns
        rows = cut(rows)
        grouped = rows.withColumn("_group", F.col(bucket) if bucket else F.pmod(F.xxhash64(*columns), F.lit(rows.count() // ROWS + 1)))

        def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                seen = {(g, side, t): 0 for g, own in pdf.groupby("_group") for side, text in texts(own) for t in (tokens_ja if side == "j" else tokens_en)(text)}
                yield pd.DataFrame(list(seen), columns=["_group", "side", "t"])

        asked = cut(grouped.mapInPandas(named, "_group long, side string, t string").distinct())
        best = self.rows.withColumn("_rank", F.row_number().over(Window.partitionBy("j").orderBy(F.desc("weight"), F.desc("e")))).where(F.col("_rank") <= SENSES).drop("_rank")
        senses = asked.where("side = 'j'").select("_group", F.col("t").alias("j")).join(best, "j").select("_group", "j", "e", "weight", "idf_j", "idf_e")
        known = self.rows.groupBy("e").agg(F.max("idf_e").alias("idf_e"))  # one value
        alone = asked.select("_group", F.col("t").alias("e")).distinct().join(known, "e").selectExpr("_group", "cast(null as string) as j", "e", "0.0D as weight", "0.0D as idf_j", "idf_e")

        def read(pdf: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
            pairs, single = words[words["j"].notna()], words[words["j"].isna()]
            lex = Lexicon(list(pairs[["j", "e", "weight", "idf_j", "idf_e"]].itertuples(index=False, name=None)))
            for e, idf in zip(single["e"], single["idf_e"]):
                lex.idf_e[e] = idf
                lex.of_e.setdefault(e, set())
            return f(pdf[columns], lex)

        return grouped.groupBy("_group").cogroup(senses.unionByName(alone).groupBy("_group")).applyInPandas(lambda a, b: read(a, b), schema)


def _units_of(pdf: pd.DataFrame) -> Iterable[tuple[str, str]]:
    return zip(pdf["side"], pdf["unit"])


class Block:
    """What the sentences of one block explain of each other.

    by_e[j token, e sentence] and by_j[j sentence, e token] hold the best strength
    of a token with any token of the sentence; joined sentences need no more than these.
    """

    def __init__(self, js: list[list[str]], es: list[list[str]], lex: Lexicon) -> None:
        all_j, all_e = dict.fromkeys(t for s in js for t in s), dict.fromkeys(t for s in es for t in s)
        wj = {t: lex.idf(t, "j") for t in all_j}
        we = {t: lex.idf(t, "e") for t in all_e}
        # only tokens that can be explained need a place; the others just weigh
        vj: dict[str, int] = {}
        ve: dict[str, int] = {}
        at_j, at_e, links = [], [], []
        for t in all_j:
            for e, w in lex.strong.get(t, ()):
                if e in all_e:
                    at_j.append(vj.setdefault(t, len(vj)))
                    at_e.append(ve.setdefault(e, len(ve)))
                    links.append(w)
        same = [(vj.setdefault(t, len(vj)), ve.setdefault(t, len(ve))) for t in all_j if t in all_e]
        strength = np.zeros((len(vj) + 1, len(ve) + 1), np.float32)
        strength[at_j, at_e] = links
        for a, b in same:  # what is written alike explains itself
            strength[a, b] = 1.0
        self.a, self.total_j, rows_j = self._sides(js, vj, wj)
        self.b, self.total_e, rows_e = self._sides(es, ve, we)
        self.by_e = np.stack([strength[:-1, r].max(axis=1) if r else np.zeros(len(vj), np.float32) for r in rows_e], axis=1)
        self.by_j = np.stack([strength[r, :-1].max(axis=0) if r else np.zeros(len(ve), np.float32) for r in rows_j], axis=0)
        self.unknown_j = [{t: w for t in s if t not in vj for w in [wj[t]]} for s in js]
        self.unknown_e = [{t: w for t in s if t not in ve for w in [we[t]]} for s in es]

    @staticmethod
    def _sides(ss: list[list[str]], places: dict[str, int], weight: dict[str, float]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """(weights of the placed tokens, weight of all tokens, places) of each sentence."""
        m = np.zeros((len(ss), len(places)), np.float32)
        rows = []
        for r, s in enumerate(ss):
            at = [places[t] for t in s if t in places]
            m[r, at] = [weight[t] for t in s if t in places]
            rows.append(at)
        return m, np.array([sum(weight[t] for t in s) for s in ss], np.float32), rows

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """(share of j's weight that e explains, share of e's weight that j explains), for every pair."""
        cj = self.a @ self.by_e / np.maximum(1e-6, self.total_j)[:, None]
        ce = self.by_j @ self.b.T / np.maximum(1e-6, self.total_e)[None, :]
        return cj.astype(float), ce.astype(float)

    def span(self, side: int, i: int, k: int, w: int) -> float:
        """The score of the units i .. i + w - 1 of one side (0: j) as one, against unit k of the other."""
        m, unknown = (self.a, self.unknown_j) if side == 0 else (self.b, self.unknown_e)
        rows = m[i : i + w].max(axis=0)
        total = float(rows.sum()) + sum({t: v for u in unknown[i : i + w] for t, v in u.items()}.values())
        if side == 0:
            own, other = float(rows @ self.by_e[:, k]), float(self.by_j[i : i + w].max(axis=0) @ self.b[k]) / max(1e-6, float(self.total_e[k]))
        else:
            own, other = float(rows @ self.by_j[k]), float(self.by_e[:, i : i + w].max(axis=1) @ self.a[k]) / max(1e-6, float(self.total_j[k]))
        own /= max(1e-6, total)
        return 2 * own * other / max(1e-9, own + other)


def hungarian(weight: np.ndarray) -> list[tuple[int, int]]:
    """Assignment of greatest total weight; a pair of weight 0 or less is left out (the null partner)."""
    n, m = weight.shape
    if n == 0 or m == 0:
        return []
    if n == 1 or m == 1:  # one of either side: the greatest weight is the assignment
        a, b = np.unravel_index(int(np.argmax(weight)), weight.shape)
        return [(int(a), int(b))] if weight[a, b] > 0 else []
    if n > m:
        return [(a, b) for b, a in hungarian(weight.T)]
    # a private null column of weight 0 for each row
    cost = np.concatenate([-np.maximum(weight, 0), np.zeros((n, n))], axis=1)
    m = cost.shape[1]
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, np.int64)
    for i in range(1, n + 1):
        match[0], col = i, 0
        low, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64), np.zeros(m + 1, bool)
        while True:
            used[col] = True
            row = match[col]
            free = ~used[1:]
            now = cost[row - 1] - u[row] - v[1:]
            better = free & (now < low[1:])
            low[1:][better], way[1:][better] = now[better], col
            nxt = int(np.argmin(np.where(free, low[1:], np.inf))) + 1
            delta = low[nxt]
            u[match[used]] += delta
            v[used] -= delta
            low[~used] -= delta
            col = nxt
            if match[col] == 0:
                break
        while col:
            match[col], col = match[way[col]], way[col]
    return [(match[c] - 1, c - 1) for c in range(1, m + 1) if match[c] and c - 1 < weight.shape[1] and weight[match[c] - 1, c - 1] > 0]


Span = tuple[float, tuple[int, ...], tuple[int, ...]]  # gain, units of j, units of e


def _spans(block: Block, cj: np.ndarray, ce: np.ndarray, far: np.ndarray, single: np.ndarray) -> list[Span]:
    """Spans of neighbours of one side against one unit of the other that beat the null cost.

    Every member must have a share of its own in what the other side explains. A
    span that gains no more than a pair inside it is never chosen, and left out.
    """
    out: list[Span] = []
    for side, part, away, alone in ((0, cj, far, single), (1, ce.T, far.T, single.T)):
        fits = part >= MEMBER
        run = fits[:-1] & fits[1:]
        for w in range(2, SPAN + 1):
            for i, k in zip(*(x.tolist() for x in np.nonzero(run))):
                gain = 2 * (block.span(side, i, k, w) - away[i : i + w, k].max() - NULL) + SPARED * (w - 1)
                if gain > alone[i : i + w, k].max():
                    many = tuple(range(i, i + w))
                    out.append((gain, many, (k,)) if side == 0 else (gain, (k,), many))
            run = run[:-1] & fits[w:]
    return out


def assigned(gain: np.ndarray, spans: list[Span]) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """Matched (units of j, units of e) of one component, of greatest total gain over the null costs.

    gain: of each pair of units. Up to TRIED spans are tried in all combinations
    that don't touch, each with the Hungarian assignment of the other units. In
    larger components each, in the order of its gain, is taken if the total rises
    when it displaces the pairs that it touches and these and all units left over
    are assigned anew; the last assignment is that of the whole rest.
    """

    def solved(chosen: list[Span]) -> tuple[float, list]:
        used_j, used_e = {i for _, a, _ in chosen for i in a}, {k for _, _, b in chosen for k in b}
        rows, cols = [i for i in range(gain.shape[0]) if i not in used_j], [k for k in range(gain.shape[1]) if k not in used_e]
        rest = [((rows[r],), (cols[c],)) for r, c in hungarian(gain[np.ix_(rows, cols)])]
        return sum(g for g, _, _ in chosen) + sum(gain[a[0], b[0]] for a, b in rest), [(a, b) for _, a, b in chosen] + rest

    def apart(x: Span, chosen: list[Span]) -> bool:
        return all(set(x[1]).isdisjoint(a) and set(x[2]).isdisjoint(b) for _, a, b in chosen)

    spans = sorted(spans, key=lambda x: (-x[0], x[1], x[2]))
    best = solved([])
    if len(spans) <= TRIED and min(gain.shape) <= SMALL:
        sets: list[list[Span]] = [[]]
        for x in spans:
            sets += [[*c, x] for c in sets if apart(x, c)]
        for c in sets[1:]:
            now = solved(c)
            best = now if now[0] > best[0] + 1e-12 else best
        return best[1]
    chosen: list[Span] = []
    of_j, of_e = {a[0]: b[0] for a, b in best[1]}, {b[0]: a[0] for a, b in best[1]}
    for x in spans:
        if not apart(x, chosen):
            continue
        g, a, b = x
        lost = {(i, of_j[i]) for i in a if i in of_j} | {(of_e[k], k) for k in b if k in of_e}
        held_j, held_e = {i for _, y, _ in chosen for i in y} | set(a), {k for _, _, y in chosen for k in y} | set(b)
        rows = sorted({i for i, _ in lost if i not in held_j} | {i for i in range(gain.shape[0]) if i not in of_j and i not in held_j})
        cols = sorted({k for _, k in lost if k not in held_e} | {k for k in range(gain.shape[1]) if k not in of_e and k not in held_e})
        again = [(rows[r], cols[c]) for r, c in hungarian(gain[np.ix_(rows, cols)])]
        if g + sum(gain[i, k] for i, k in again) > sum(gain[i, k] for i, k in lost) + 1e-12:
            chosen.append(x)
            for i, k in lost:
                del of_j[i], of_e[k]
            of_j |= dict(again)
            of_e |= {k: i for i, k in again}
    return solved(chosen)[1] if chosen else best[1]


def pair_up(js: list[list[str]], es: list[list[str]], pj: np.ndarray, pe: np.ndarray, lex: Lexicon) -> list[tuple[int, int]]:
    """Pairs (place in js, place in es) of one block. pj, pe: their places on one scale."""
    if not js or not es:
        return []
    block = Block(js, es, lex)
    cj, ce = block.shares()
    far = PER_PLACE * np.abs(pj[:, None] - pe[None, :])
    gain = np.maximum(2 * (2 * cj * ce / np.maximum(1e-9, cj + ce) - far - NULL), 0)
    spans = _spans(block, cj, ce, far, gain) if len(js) > 1 or len(es) > 1 else []
    linked = gain.copy()
    for g, a, b in spans:
        linked[np.ix_(a, b)] = np.maximum(linked[np.ix_(a, b)], g)
    out: list[tuple[int, int]] = []
    for rows, cols in _components(linked):
        if len(rows) == 1 and len(cols) == 1:
            out.append((rows[0], cols[0]))
            continue
        at_j, at_e = {i: r for r, i in enumerate(rows)}, {k: c for c, k in enumerate(cols)}
        own = [(g, tuple(at_j[i] for i in a), tuple(at_e[k] for k in b)) for g, a, b in spans if a[0] in at_j and b[0] in at_e]
        for a, b in assigned(gain[np.ix_(rows, cols)], own):
            out += [(rows[r], cols[c]) for r in a for c in b]
    return sorted(out)


def _components(weight: np.ndarray) -> list[tuple[list[int], list[int]]]:
    """Rows and columns that positive weights connect."""
    return _linked(*weight.shape, list(zip(*(x.tolist() for x in np.nonzero(weight > 0)))))


def _linked(n: int, m: int, at: list[tuple[int, int]]) -> list[tuple[list[int], list[int]]]:
    """Rows and columns that edges connect."""
    up = list(range(n + m))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for r, c in at:
        up[find(r)] = find(n + c)
    parts: dict[int, tuple[set, set]] = defaultdict(lambda: (set(), set()))
    for r, c in at:
        own = parts[find(r)]
        own[0].add(r)
        own[1].add(c)
    return [(sorted(a), sorted(b)) for a, b in parts.values()]


def sentence_rows(texts: DataFrame) -> DataFrame:
    """doc, side, row_id, place, start, unit. texts: doc, side ('j' or 'e'), row_id, place double, text."""
    # spread by all columns, which is what distinct asks for
    texts = texts.select("doc", "side", "row_id", "place", "text")
    out = units(texts.repartition(tasks(texts.sparkSession), *texts.columns).distinct(), "text", ["doc", "side", "row_id", "place"], "start", "end").drop("end")
    return out.withColumn("place", F.col("place") + F.least(F.col("start") / 2000.0, F.lit(0.9)))


def _signed(rows: DataFrame, lex) -> DataFrame:
    """doc, and row, start and place of a j and an e unit (jr, js, pj, er, es, pe) whose pair of rare words stands once on either side of the document."""

    def sign(pdf: pd.DataFrame, lx: Lexicon) -> pd.DataFrame:
        out = []
        for doc, side, row, start, place, text in zip(pdf["doc"], pdf["side"], pdf["row_id"], pdf["start"], pdf["place"], pdf["unit"]):
            if side == "j":
                ts = {lx.best[t][0] if t in lx.best else t: 0 for t in tokens_ja(text) if (t in lx.best and lx.best[t][1] >= 0.6) or t[0].isdigit()}
            else:
                ts = {t: 0 for t in tokens_en(text) if t in lx.of_e or t[0].isdigit()}
            rare = sorted(ts, key=lambda t: (-lx.idf(t, "e"), t))[:5]
            rare.sort()
            marks = [zlib.crc32(t.encode()) for t in rare]
            out += [(doc, a << 31 ^ b, side, row, start, place) for i, a in enumerate(marks) for b in marks[i + 1 :]]
        return pd.DataFrame(out, columns=["doc", "sign", "side", "row_id", "start", "place"])

    signs = lex.read(rows.select("doc", "side", "row_id", "start", "place", "unit"), _units_of, sign, "doc string, sign long, side string, row_id long, start long, place double")
    unit = F.struct("row_id", "start", "place")
    once = signs.groupBy("doc", "sign").agg(
        F.count_if(F.col("side") == "j").alias("nj"), F.count_if(F.col("side") == "e").alias("ne"), F.min(F.when(F.col("side") == "j", unit)).alias("j"), F.min(F.when(F.col("side") == "e", unit)).alias("e")
    )
    return once.where("nj = 1 and ne = 1").select(
        "doc", F.col("j.row_id").alias("jr"), F.col("j.start").alias("js"), F.col("j.place").alias("pj"), F.col("e.row_id").alias("er"), F.col("e.start").alias("es"), F.col("e.place").alias("pe")
    )


def _mapped(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """rows + at: every place on the Japanese side's scale."""
    near = F.explode(F.sequence(F.floor(F.col("pe") / BLOCK) - 1, F.floor(F.col("pe") / BLOCK) + 1))
    shift = anchors.select("doc", near.alias("bin"), (F.col("pj") - F.col("pe")).alias("d")).groupBy("doc", "bin").agg(F.percentile_approx("d", 0.5, 1000).alias("shift"))
    ends = rows.groupBy("doc").agg(F.max(F.when(F.col("side") == "j", F.col("place"))).alias("top_j"), F.max(F.when(F.col("side") == "e", F.col("place"))).alias("top_e"))
    # without an anchor near, the places are stretched to the other side's length
    e = rows.where("side = 'e'").withColumn("bin", F.floor(F.col("place") / BLOCK)).join(ends, "doc").join(shift, ["doc", "bin"], "left")
    at = F.coalesce(F.col("place") + F.col("shift"), F.col("place") * (F.col("top_j") + 1) / (F.col("top_e") + 1))
    return rows.where("side = 'j'").withColumn("at", F.col("place")).unionByName(e.withColumn("at", at).select(*rows.columns, "at"))


_PAIR = "doc string, jp_row long, jp_start long, en_row long, en_start long"


def _far(rows: DataFrame, anchors: DataFrame, near: DataFrame, lex) -> DataFrame:
    """Pairs of units that got no partner in their blocks and that anchors tie to each other, however far apart."""
    j, e = ["doc", "jr", "js"], ["doc", "er", "es"]
    left = anchors.select("doc", "jr", "js", "er", "es").distinct()
    left = left.join(near.select("doc", F.col("jp_row").alias("jr"), F.col("jp_start").alias("js")), j, "left_anti").join(near.select("doc", F.col("en_row").alias("er"), F.col("en_start").alias("es")), e, "left_anti")
    text = rows.select("doc", "side", "row_id", "start", "unit")
    left = left.join(text.where("side = 'j'").select("doc", F.col("row_id").alias("jr"), F.col("start").alias("js"), F.col("unit").alias("tj")), j)
    left = left.join(text.where("side = 'e'").select("doc", F.col("row_id").alias("er"), F.col("start").alias("es"), F.col("unit").alias("te")), e)

    def score(pdf: pd.DataFrame, lx: Lexicon) -> pd.DataFrame:
        gains = []
        for a, b in zip(pdf["tj"], pdf["te"]):
            cj, ce = Block([tokens_ja(a)], [tokens_en(b)], lx).shares()
            gains.append(2 * (2 * cj[0, 0] * ce[0, 0] / max(1e-9, cj[0, 0] + ce[0, 0]) - NULL))
        return pdf[["doc", "jr", "js", "er", "es"]].assign(gain=np.array(gains, float))

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "jr", "js", "er", "es"])
        js, es = dict.fromkeys(zip(pdf["doc"], pdf["jr"], pdf["js"])), dict.fromkeys(zip(pdf["doc"], pdf["er"], pdf["es"]))
        at_j, at_e = {x: i for i, x in enumerate(js)}, {x: i for i, x in enumerate(es)}
        edges = [(at_j[d, a, b], at_e[d, x, y], g) for d, a, b, x, y, g in pdf[["doc", "jr", "js", "er", "es", "gain"]].itertuples(index=False)]
        js, es, out = list(js), list(es), []
        for rows, cols in _linked(len(js), len(es), [(r, c) for r, c, _ in edges]):
            ri, ci = {x: i for i, x in enumerate(rows)}, {x: i for i, x in enumerate(cols)}
            gain = np.zeros((len(rows), len(cols)))
            for r, c, g in edges:
                if r in ri and c in ci:
                    gain[ri[r], ci[c]] = g
            out += [(*js[rows[r]], *es[cols[c]][1:]) for r, c in hungarian(gain)]
        return pd.DataFrame(out, columns=["doc", "jp_row", "jp_start", "en_row", "en_start"])

    both = lambda pdf: [*(("j", t) for t in pdf["tj"]), *(("e", t) for t in pdf["te"])]
    scored = lex.read(left, both, score, "doc string, jr long, js long, er long, es long, gain double").where("gain > 0")
    return scored.groupBy("doc").applyInPandas(assign, _PAIR)


def aligned(rows: DataFrame, lex_rows: DataFrame, long_documents: bool) -> DataFrame:
    """doc, jp_row, jp_start, en_row, en_start: pairs of units of one document that translate each other.

    rows: what sentence_rows() gives, written already. long_documents: places are
    mapped and documents cut into blocks; else each document is one block.
    """
    spark = rows.sparkSession
    lex = Senses(lex_rows)
    both = rows.groupBy("doc").agg(F.count_if(F.col("side") == "j").alias("a"), F.count_if(F.col("side") == "e").alias("b")).where("a > 0 and b > 0").select("doc")
    rows = rows.join(both, "doc", "left_semi")
    if long_documents:
        anchors = cut(_signed(rows, lex))
        placed = _mapped(rows, anchors)
        first, last = F.floor((F.col("at") - MARGIN) / BLOCK), F.floor((F.col("at") + MARGIN) / BLOCK)
        placed = placed.withColumn("block", F.explode(F.sequence(first, last))).withColumn("core", F.floor(F.col("at") / BLOCK) == F.col("block"))
    else:
        placed = rows.withColumn("at", F.col("place")).withColumn("block", F.lit(0).cast("long")).withColumn("core", F.lit(True))
    # many groups a task, many tasks a core: groups of unlike cost even out, whatever their bytes
    groups = rows.count() // BUCKET + 1
    parts = max(tasks(spark), 8 * spark.sparkContext.defaultParallelism)
    bucketed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc", "block"), F.lit(groups))).repartition(min(groups, parts), "bucket")

    def align(pdf: pd.DataFrame, lx: Lexicon) -> pd.DataFrame:
        out = []
        doc, names = pd.factorize(pdf["doc"])
        at, row, start, block = (pdf[c].to_numpy() for c in ("at", "row_id", "start", "block"))
        order = np.lexsort((start, row, at, block, doc))
        doc, block, at, row, start = doc[order], block[order], at[order], row[order], start[order]
        is_j, core, text = (pdf["side"].to_numpy() == "j")[order], pdf["core"].to_numpy()[order], pdf["unit"].to_numpy()[order]
        border = np.flatnonzero((doc[1:] != doc[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *border], [*border, len(doc)]):
            j, e = a + np.flatnonzero(is_j[a:b]), a + np.flatnonzero(~is_j[a:b])
            if len(j) and len(e):
                for x, y in pair_up([tokens_ja(t) for t in text[j]], [tokens_en(t) for t in text[e]], at[j], at[e], lx):
                    if core[j[x]]:
                        out.append((names[doc[a]], row[j[x]], start[j[x]], row[e[y]], start[e[y]]))
        return pd.DataFrame(out, columns=["doc", "jp_row", "jp_start", "en_row", "en_start"])

    pairs = lex.read(bucketed, _units_of, align, _PAIR, "bucket")
    if not long_documents:
        return pairs
    pairs = cut(pairs)
    return pairs.unionByName(_far(rows, anchors, pairs, lex))
