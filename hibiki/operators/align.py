"""Monotone paragraph alignment by length (Gale and Church), one part a task."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T

# Mean length ratio, variance a character, and the prior of each shape.
RATIO, VARIANCE = 2.77, 13.0
SHAPES = [(1, 1, 0.92), (1, 2, 0.04), (2, 1, 0.03), (1, 0, 0.005), (0, 1, 0.005)]


def length_z(jp: float, en: float, ratio: float = RATIO, variance: float = VARIANCE) -> float:
    """Standard score of the target length given the source length; 0 where either is empty, for the prior alone counts then."""
    if jp <= 0 or en <= 0:
        return 0.0
    return (en - ratio * jp) / math.sqrt(variance * jp)


def length_score(jp: float, en: float) -> float:
    """How well the lengths fit, from 0 to 1; two empty sides fit, one doesn't."""
    if jp <= 0 or en <= 0:
        return 1.0 if jp <= 0 and en <= 0 else 0.0
    return math.exp(-(length_z(jp, en) ** 2) / 2)


#: best_path keeps the scores of about so many diagonals, at least LEAST_APART from each other.
KEPT, LEAST_APART = 128, 64


def best_path(jp: list[int], en: list[int]) -> list[tuple[int, int, int, int]]:
    """(jp from, jp to, en from, en to) of each step; prefix sums give span lengths, earlier shapes win ties.

    The table is filled a diagonal (i + j) at a time, since every step comes from
    one of the three diagonals before. Only some of them are kept; the steps
    between two are found again on the way back, in the cells that the path can
    come from. The path is that of the whole table, in memory of KEPT diagonals.
    """
    n, m = len(jp), len(en)
    if not n and not m:
        return []
    sj, se = np.concatenate(([0.0], np.cumsum(jp, dtype=float))), np.concatenate(([0.0], np.cumsum(en, dtype=float)))
    at_j, at_e = np.arange(n + 1), np.arange(m + 1)
    # by the sides' counts: expected length and deviation of the jp span that ends at i; length of the en span that ends at m - place
    spans_j = {a: sj - sj[np.maximum(at_j - a, 0)] for a in (1, 2)}
    wanted = {a: (RATIO * x, np.sqrt(VARIANCE * np.maximum(x, 1.0))) for a, x in spans_j.items()}
    spans_e = {b: (se - se[np.maximum(at_e - b, 0)])[::-1] for b in (1, 2)}
    priors = [math.log(prior) for _, _, prior in SHAPES]
    pad = 2  # places of no score before i = 0

    def totals(d: int, lo: int, hi: int, before: list[np.ndarray]):
        """The total of each shape in the cells lo..hi of diagonal d; before: the diagonals d - 1, d - 2, d - 3."""
        for (a, b, _), prior in zip(SHAPES, priors):
            held = before[a + b - 1][lo - a + pad : hi + 1 - a + pad]
            if not (a and b):
                yield held + prior
                continue
            mean, deviation = wanted[a]
            z = (spans_e[b][m - d + lo : m - d + hi + 1] - mean[lo : hi + 1]) / deviation[lo : hi + 1]
            z *= z
            z /= 2
            yield held + (prior - z)

    def nothing() -> np.ndarray:
        return np.full(n + 1 + pad, -np.inf)

    apart = max(LEAST_APART, (n + m) // KEPT)
    before = [nothing(), nothing(), nothing()]
    before[0][pad] = 0.0
    kept = {0: [x.copy() for x in before]}
    spare = nothing()
    for d in range(1, n + m + 1):
        lo, hi = max(0, d - m), min(n, d)
        spare.fill(-np.inf)
        best = spare[lo + pad : hi + 1 + pad]
        for total in totals(d, lo, hi, before):
            np.maximum(best, total, out=best)
        before, spare = [spare, before[0], before[1]], before[2]
        if d % apart == 0:
            kept[d] = [x.copy() for x in before]

    out, i, d = [], n, n + m
    while d:
        start = (d - 1) // apart * apart
        before, steps = kept[start], {}
        for x in range(start + 1, d + 1):
            lo, hi = max(0, x - m, i - (d - x)), min(n, x, i)
            now = nothing()
            if lo <= hi:
                each = np.stack(list(totals(x, lo, hi, before)))
                steps[x] = lo, each.argmax(axis=0)  # the first of equal ones
                now[lo + pad : hi + 1 + pad] = each.max(axis=0)
            before = [now, before[0], before[1]]
        while d > start:
            lo, shapes = steps[d]
            a, b, _ = SHAPES[shapes[i - lo]]
            j = d - i
            out.append((i - a, i, j - b, j))
            i, d = i - a, d - a - b
    return out[::-1]


def aligned(paras: DataFrame) -> DataFrame:
    """part_id, shape, jp_from, jp_to, en_from, en_to, length_score: the steps of every part, each part one path."""
    rows = paras.where("part_id is not null and side in ('jp', 'en')").where(T.paragraph_kind("text") != "blank")
    rows = rows.select("part_id", "side", "para_index", "para_id", F.length(T.trimmed("text")).alias("n"))
    both = rows.groupBy("part_id").agg(F.count_if(F.col("side") == "jp").alias("nj"), F.count_if(F.col("side") == "en").alias("ne")).where("nj > 0 and ne > 0")
    rows = rows.join(both, "part_id", "left_semi")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["para_index", "para_id"])
        j, e = pdf[pdf["side"] == "jp"], pdf[pdf["side"] == "en"]
        lj, le = j["n"].tolist(), e["n"].tolist()
        ij, ie = [*j["para_index"].tolist(), None], [*e["para_index"].tolist(), None]
        rows = [
            (pdf["part_id"].iloc[0], f"{b - a}:{d - c}", ij[a] if b > a else None, ij[b - 1] if b > a else None, ie[c] if d > c else None, ie[d - 1] if d > c else None, round(length_score(sum(lj[a:b]), sum(le[c:d])), 6))
            for a, b, c, d in best_path(lj, le)
        ]
        return pd.DataFrame(rows, columns=["part_id", "shape", "jp_from", "jp_to", "en_from", "en_to", "length_score"])

    schema = "part_id string, shape string, jp_from long, jp_to long, en_from long, en_to long, length_score double"
    return rows.groupBy("part_id").applyInPandas(one, schema)


def shape_counts(steps: DataFrame) -> DataFrame:
    return steps.groupBy("shape").agg(F.count("*").alias("n"))
