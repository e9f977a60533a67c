"""Problem 8: records of several sources drawn in target shares of all tokens.

Sainte-Lague apportionment: the drawn size is cut into blocks of `block` tokens
and each goes to the source with the highest quotient share / (2 blocks + 1).
The blocks of all shards are apportioned in one sequence, so that each shard
gets integer quotas and the quotas of all shards together keep the shares.

Records are spread by a seeded hash over shards of bounded size and put into a
seeded order in each (shard, source); there they stand in blocks of `block`
tokens, each in the block that its middle falls into. Blocks are selected in a
seeded order as long as the quota's tokens last; where a quota exceeds what the
shard has, whole rounds over all its records come first. How often a
record is used is at most max_repeats, because the drawn total is what the
scarcest source allows; whole blocks that a shard lacks are taken, shard by
shard in a seeded order, from the spare ones of the source's other shards, so no
source falls short by chance of the hash.

Defined results: sources that have no target, or no tokens, get nothing; the
target shares of the others are brought to a sum of 1 and both shares are
reported. Null sources have no target. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TOKENS, SHARD_TOKENS, SEED = 4096, 4_000_000, 17


def apportion(shares: dict[str, float], blocks: int, shards: int, shard: int) -> dict[str, int]:
    """Blocks of each source in one shard: a run of the sequence, all runs nearly equal in length.

    Within a prefix of the sequence each source's count is a Sainte-Lague count,
    so the difference of two is found without listing what lies between.
    """
    before, upto = count_upto(shares, blocks * shard // shards), count_upto(shares, blocks * (shard + 1) // shards)
    return {s: upto[s] - before[s] for s in shares}


def count_upto(shares: dict[str, float], blocks: int) -> dict[str, int]:
    """Sainte-Lague counts of the first `blocks` blocks, in time independent of their number."""
    names = sorted(s for s in shares if shares[s] > 0)
    given = dict.fromkeys(sorted(shares), 0)
    if not names:
        return given
    # a count differs from its share of the blocks by less than the number of sources: start there, then give and take
    given |= {s: max(0, int(shares[s] * blocks)) for s in names}
    while True:  # no block may have a higher quotient than one that was given
        least = min((s for s in given if given[s]), key=lambda s: (shares[s] / (2 * given[s] - 1), [-ord(c) for c in s]), default=None)
        best = max(names, key=lambda s: shares[s] / (2 * given[s] + 1))
        if least is None or best == least or shares[least] / (2 * given[least] - 1) >= shares[best] / (2 * given[best] + 1):
            break
        given[least] -= 1
        given[best] += 1
    while sum(given.values()) > blocks:
        least = min((s for s in given if given[s]), key=lambda s: (shares[s] / (2 * given[s] - 1), [-ord(c) for c in s]))
        given[least] -= 1
    while sum(given.values()) < blocks:
        best = max(names, key=lambda s: shares[s] / (2 * given[s] + 1))
        given[best] += 1
    return given


def drawn(docs: DataFrame, targets: DataFrame, row_id: str, source: str, tokens: str, block: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, seed: int = SEED) -> DataFrame:
    """row_id, source, tokens, uses: every drawn record and how often it is used.

    docs: row_id, source, tokens. targets: source, target_share, max_repeats.
    """
    goals = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.where("source is not null and target_share > 0 and max_repeats > 0").collect()}
    rows = docs.select(F.col(row_id).alias("id"), F.col(source).alias("source"), F.col(tokens).alias("n")).where(F.col("source").isin(list(goals)) & (F.col("n") > 0))
    have = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # a row a listed source
    total_share = sum(goals[s][0] for s in have)
    shares = {s: goals[s][0] / total_share for s in have}
    spark = docs.sparkSession
    out_schema = "id long, source string, n long, uses int"
    if not have:
        return spark.createDataFrame([], out_schema).withColumnsRenamed({"id": row_id, "n": "tokens"})
    total = min(int(have[s] * goals[s][1] / shares[s]) for s in have)
    blocks = max(1, total // block)
    shards = max(1, sum(have.values()) // shard_tokens)
    most = {s: goals[s][1] for s in have}

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, s, n, most[s]) for k in pdf["id"] for s, n in apportion(shares, blocks, shards, k).items()]
            yield pd.DataFrame(rows, columns=["shard", "source", "quota", "most"]).astype({"shard": "int32", "quota": "int64", "most": "int32"})

    quota = spark.range(shards).mapInPandas(plan, "shard int, source string, quota long, most int")
    spread = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(shards)).cast("int")).withColumn("order", F.xxhash64(F.lit(seed + 1), "id"))
    turn = Window.partitionBy("shard", "source").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, 0)
    # the block that a record's middle falls into
    placed = spread.select("id", "source", "n", "shard", F.floor((F.sum("n").over(turn) - F.col("n") / 2) / block).alias("block"))
    sizes = placed.groupBy("shard", "source", "block").agg(F.sum("n").alias("size"))
    filled = sizes.groupBy("shard", "source").agg(F.sum("size").alias("all"))
    by_shard = quota.join(filled, ["shard", "source"], "left").withColumn("all", F.coalesce("all", F.lit(0)))
    # blocks that a shard lacks come from the source's other shards, as many as each can spare, in a seeded order
    room = F.floor(F.col("all") * F.col("most") / block)
    of = Window.partitionBy("source")
    others = of.orderBy(F.xxhash64(F.lit(seed + 2), "shard"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    by_shard = by_shard.withColumn("given", F.least("quota", room)).withColumn("spare", room - F.col("given"))
    short = F.sum(F.col("quota") - F.col("given")).over(of) - F.coalesce(F.sum("spare").over(others), F.lit(0))
    # a quota is a row a shard and source; the optimizer sees its size
    final = by_shard.withColumn("wanted", (F.col("given") + F.greatest(F.lit(0), F.least(F.col("spare"), short))) * block).where("all > 0")
    final = final.withColumn("rounds", F.floor(F.col("wanted") / F.col("all"))).select("shard", "source", "most", "rounds", (F.col("wanted") - F.col("rounds") * F.col("all")).alias("left"))
    # seeded selection of blocks: one is in when its middle lies within what is left
    chosen = Window.partitionBy("shard", "source").orderBy(F.xxhash64(F.lit(seed + 3), "shard", "source", "block"), "block").rowsBetween(Window.unboundedPreceding, 0)
    picked = sizes.withColumn("upto", F.sum("size").over(chosen)).join(final, ["shard", "source"])
    extra = F.when((F.col("rounds") < F.col("most")) & (F.col("upto") - F.col("size") / 2 <= F.col("left")), 1).otherwise(0)
    picked = picked.select("shard", "source", "block", (F.col("rounds") + extra).cast("int").alias("uses")).where("uses > 0")
    return placed.join(picked, ["shard", "source", "block"]).select("id", "source", "n", "uses").withColumnsRenamed({"id": row_id, "n": "tokens"})


def shares_report(draws: DataFrame, targets: DataFrame) -> DataFrame:  # draws: written already
    """source, target_share, max_repeats, records, draws, most_used, tokens, actual_share of every listed source."""
    got = draws.groupBy("source").agg(
        F.count("*").alias("records"), F.sum("uses").alias("draws"), F.max("uses").alias("most_used"), F.sum(F.col("tokens") * F.col("uses")).alias("tokens")
    )
    all_tokens = got.agg(F.sum("tokens")).first()[0] or 0
    return (
        targets.select("source", "target_share", "max_repeats")
        .join(got, "source", "left")
        .select(
            "source", "target_share", "max_repeats",
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("records", "draws", "most_used", "tokens")],
            F.round(F.coalesce(F.col("tokens"), F.lit(0)) / F.lit(float(max(1, all_tokens))), 6).alias("actual_share"),
        )
    )
