"""Problem 7: documents put together into containers of fixed capacity.

Sum-of-squares packing: let N(g) be the number of open containers with room g.
Each document goes where the sum of N(g)^2 after placing it is smallest; this
keeps the rooms that are left varied, so that what comes next finds a fit.

Documents are spread by a hash of their id over shards of about `shard_tokens`
tokens; each shard is packed by one task, whose state is one count a gap. Tasks
see ids and sizes, never texts. The unused room is that of the few containers
still open at each shard's end. A document larger than the capacity fills whole
containers of its own and only its rest is packed.

Defined results: a document without tokens (null or empty text) needs no room
and comes out with a null container. Repeated ids are packed as often as they
come. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_TOKENS = 4_000_000
MOST_SPECS = 1000


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each size (all at most the capacity), in the order given."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open containers by room; those without room are closed
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    made = 0
    for i, s in enumerate(sizes):
        # N^2 sums change by 2 N(g - s) + 1 - 2 N(g) + 1; rooms of 0 aren't counted
        after = 2 * count[: capacity + 1 - s] + 1
        after[0] = 0
        change = after + 1 - 2 * count[s:]
        change[count[s:] == 0] = np.iinfo(np.int64).max
        fresh = (2 * count[capacity - s] + 1) if s < capacity else 0
        best = int(np.argmin(change))  # the smallest room on a tie
        if change[best] <= fresh:
            g = best + s
            box = open_at[g].pop()
            count[g] -= 1
        else:
            g, box = capacity, made
            made += 1
        if g > s:
            open_at[g - s].append(box)
            count[g - s] += 1
        out[i] = box
    return out


def packed(docs: DataFrame, spec: DataFrame, row_id: str, tokens: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """spec_name, capacity, container, row_id, from_token, to_token: every piece's container.

    docs: row_id, tokens; spec: spec_name, capacity_tokens. Containers are named
    'shard-number'; a piece is a whole document unless that exceeds the capacity.
    """
    sized = docs.select(F.col(row_id).alias("_id"), F.col(tokens).alias("_n"))
    total = sized.agg(F.sum("_n")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    # one row a document and kind of container; the kinds are a handful of settings, held as a literal
    kinds = spec.where("spec_name is not null and capacity_tokens > 0").select("spec_name", "capacity_tokens").distinct().orderBy("spec_name", "capacity_tokens").collect()
    if len(kinds) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} kinds of container")
    listed = F.array(*[F.struct(F.lit(r[0]).alias("spec_name"), F.lit(r[1]).cast("long").alias("capacity")) for r in kinds]).cast("array<struct<spec_name: string, capacity: bigint>>")
    pairs = sized.withColumn("shard", F.pmod(F.xxhash64(F.lit(23), "_id"), F.lit(shards))).select("_id", "_n", "shard", F.explode(listed).alias("s")).select("_id", "_n", "shard", "s.spec_name", "s.capacity")

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        name, shard, capacity = key
        pdf = pdf[pdf["_n"] > 0].sort_values(["order", "_id"])
        ids, n = pdf["_id"].to_numpy(), pdf["_n"].to_numpy()
        whole, rest = n // capacity, n % capacity
        has = rest > 0
        box = pack(rest[has], capacity)
        made = int(box.max()) + 1 if len(box) else 0
        rows = [pd.DataFrame({"row": ids[has], "number": box, "from_token": (whole * capacity)[has], "to_token": n[has]})]
        if whole.any():
            row, piece = np.repeat(ids, whole), np.concatenate([np.arange(w) for w in whole])
            rows.append(pd.DataFrame({"row": row, "number": made + np.arange(len(row)), "from_token": piece * capacity, "to_token": (piece + 1) * capacity}))
        out = pd.concat(rows)
        return pd.DataFrame({"spec_name": name, "capacity": capacity, "container": f"{shard}-" + out["number"].astype(str), "row": out["row"], "from_token": out["from_token"], "to_token": out["to_token"]})

    schema = "spec_name string, capacity long, container string, row long, from_token long, to_token long"
    full = pairs.where("_n > 0").select("spec_name", "shard", "capacity", "_id", "_n", F.xxhash64(F.lit(29), "_id").alias("order"))
    placed = full.groupBy("spec_name", "shard", "capacity").applyInPandas(one, schema)
    none = pairs.where("coalesce(_n, 0) <= 0").select("spec_name", "capacity", F.lit(None).cast("string").alias("container"), F.col("_id").alias("row"), F.lit(0).cast("long").alias("from_token"), F.lit(0).cast("long").alias("to_token"))
    return placed.unionByName(none).withColumnRenamed("row", row_id)


def containers(pieces: DataFrame) -> DataFrame:
    """spec_name, container, capacity, pieces, fill_tokens, fill: every container."""
    return (
        pieces.where(F.col("container").isNotNull())
        .groupBy("spec_name", "container", "capacity")
        .agg(F.count("*").alias("pieces"), F.sum(F.col("to_token") - F.col("from_token")).alias("fill_tokens"))
        .withColumn("fill", F.round(F.col("fill_tokens") / F.col("capacity"), 6))
    )


def packing_report(pieces: DataFrame) -> DataFrame:
    """spec_name, capacity, containers, tokens, least_containers, fill: the use of all room."""
    return (
        containers(pieces)
        .groupBy("spec_name", "capacity")
        .agg(F.count("*").alias("containers"), F.sum("fill_tokens").alias("tokens"))
        .withColumn("least_containers", F.ceil(F.col("tokens") / F.col("capacity")))
        .withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))
    )
