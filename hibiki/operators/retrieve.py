"""Exact cosine retrieval: top k a query, de-duplication across queries, caps and floors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries and rows that a task holds at once.
BLOCK, ROWS = 8192, 32_768


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """Length of a vector; 1 where it is zero, so that dividing is safe."""
    n = F.sqrt(dot(v, v))
    return F.when(n == 0, 1.0).otherwise(n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def topk(queries: DataFrame, rows: DataFrame, row_id: str, vector: str, label: str, k: int, same_label: bool = True) -> DataFrame:
    """q, row_id, score, rank: the k best rows of every query (not itself; not of its label if masked).

    Queries and rows are spread by hash over blocks of bounded size, and each block
    of queries meets each block of rows in a task that hands on its own k best; so
    no task holds more than a block of either and nothing passes the driver. Ties
    go to the smaller id; cosines are rounded to 6 decimals first.
    """
    clean = lambda df: df.where(F.col(vector).isNotNull()).select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("v"), F.col(label).alias("l"))
    q, r = clean(queries), clean(rows)
    nq, nr = (max(1, -(-df.count() // size)) for df, size in ((q, BLOCK), (r, ROWS)))
    q = q.select("id", "v", "l", F.pmod(F.xxhash64("id"), F.lit(nq)).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(nr - 1))).alias("rb"))
    r = r.select("id", "v", "l", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb2"), F.pmod(F.xxhash64("id"), F.lit(nr)).alias("rb2"))

    def meet(qs: pd.DataFrame, rs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(rs):
            return pd.DataFrame({"q": [], "row_id": [], "score": []}).astype({"q": "int64", "row_id": "int64", "score": "float64"})
        rs = rs.sort_values("id")
        ids, have, labels = rs["id"].to_numpy(), _unit(np.stack(rs["v"]).astype(np.float64)), rs["l"].to_numpy(dtype=object)
        out = []
        for at in range(0, len(qs), 256):
            part = qs.iloc[at : at + 256]
            own = part["id"].to_numpy()
            score = np.round(_unit(np.stack(part["v"]).astype(np.float64)) @ have.T, 6)
            score[own[:, None] == ids[None, :]] = -np.inf
            if not same_label:
                score[part["l"].to_numpy(dtype=object)[:, None] == labels[None, :]] = -np.inf
            # the k-th best and its equals, then by score and id
            least = np.partition(score, score.shape[1] - k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(part), -np.inf)
            row, col = np.nonzero((score >= least[:, None]) & (score > -np.inf))
            order = np.lexsort((ids[col], -score[row, col], row))
            row, col = row[order], col[order]
            ok = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append(pd.DataFrame({"q": own[row[ok]], "row_id": ids[col[ok]], "score": score[row[ok], col[ok]]}))
        return pd.concat(out)

    found = q.groupBy("qb", "rb").cogroup(r.groupBy("qb2", "rb2")).applyInPandas(meet, "q long, row_id long, score double")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


def deduplicated(hits: DataFrame, key: list[str], cap: int | None = None) -> DataFrame:
    """hits, a key once: the first query that found it keeps it, with its own score; then the cap by score."""
    w = Window.partitionBy(*key).orderBy("q", "rank")
    out = hits.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return out.orderBy(F.desc("score"), "q", "rank").limit(cap) if cap else out


def retrieved(hits: DataFrame, stages: list[list[str]], cap: int) -> DataFrame:
    """hits, de-duplicated in stages: in each a key once, kept by the first query that found it, with its own score; then the `cap` best.

    The stages follow each other as in a loop over queries and ranks: a row once, then a pair of texts once.
    """
    for key in stages:
        hits = deduplicated(hits, key)
    return hits.orderBy(F.desc("score"), "q", "rank").limit(cap)


def result_flags(hits: DataFrame, kinds: list[str]) -> DataFrame:
    """One row: the hits of each kind, total, is_empty. hits: kind."""
    out = hits.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds], F.count("*").alias("total"))
    return out.withColumn("is_empty", F.col("total") == 0)


def row_cosines(a: DataFrame, b: DataFrame, key: str, vector: str) -> DataFrame:
    """key, cosine: the similarity of each row of one side and the same row of the other; rows that a side lacks are left out."""
    other = b.select(key, F.col(vector).alias("_other"))
    return a.select(key, vector).join(other, key).select(key, F.round(cosine(F.col(vector), F.col("_other")), 6).alias("cosine"))


def outside(rows: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Rows whose part isn't in the set; rows without part stay."""
    return rows.join(parts.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def floored(hits: DataFrame, floor: float, key: list[str], cap: int) -> DataFrame:
    """hits above a score floor, a key once, at most `cap` of the best."""
    return deduplicated(hits.where(F.col("score") >= floor), key, cap)


def filter_counts(pairs: DataFrame, excluded: DataFrame, key: str, length_floor: float, semantic_floor: float) -> DataFrame:
    """total, excluded, short, unlike, kept: why pairs are left out, in one aggregate. A pair without a semantic score passes that floor."""
    ex = excluded.select(F.col(key).alias("_x")).distinct()
    j = pairs.join(ex, F.col(key) == F.col("_x"), "left")
    out = F.col("_x").isNotNull()
    short = ~out & ~F.coalesce(F.col("length_score") >= length_floor, F.lit(False))
    unlike = ~out & ~short & F.coalesce(F.col("semantic_score") < semantic_floor, F.lit(False))
    return j.agg(F.count("*").alias("total"), F.count_if(out).alias("excluded"), F.count_if(short).alias("short"), F.count_if(unlike).alias("unlike"), F.count_if(~out & ~short & ~unlike).alias("kept"))



def at_places(values: DataFrame, column: str, places: dict[str, int], width: float = 1e-4) -> dict[str, float]:
    """The values at places (from 0) of the order of a column: counts of ranges first, then ranks within the few ranges that hold a place.

    Ranges are `width` wide, so scores have at most 2 / width of them; equal values are counted, not sorted.
    """
    v = values.where(F.col(column).isNotNull()).select(F.col(column).alias("x"), F.floor(F.col(column) / width).alias("r"))
    before, want, start = 0, {}, {}
    for r, n in sorted((x["r"], x["n"]) for x in v.groupBy("r").agg(F.count("*").alias("n")).collect()):
        for name, place in places.items():
            if before <= place < before + n:
                want[name], start[r] = (r, place), before
        before += n
    if not want:
        return {}
    per = v.where(F.col("r").isin(list(start))).groupBy("r", "x").agg(F.count("*").alias("k"))
    upto = per.withColumn("upto", F.sum("k").over(Window.partitionBy("r").orderBy("x")))
    picks = [F.min(F.when((F.col("r") == r) & (F.col("upto") > place - start[r]), F.col("x"))).alias(name) for name, (r, place) in want.items()]
    return upto.agg(*picks).first().asDict()
