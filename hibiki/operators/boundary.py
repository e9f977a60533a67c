"""Where a model or a service is called: the plan around an injected function.

The function gets a pandas batch and returns one; what it calls is its own
affair. Results go through the cache tables like any other source.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECKERS: dict[str, Callable[..., Column]] = {}


def register_checker(name: str, make: Callable[..., Column]) -> None:
    CHECKERS[name] = make


def checker(name: str, *args) -> Column:
    """The verdict column of a registered checker."""
    if name not in CHECKERS:
        raise KeyError(f"unknown checker {name}; known: {', '.join(sorted(CHECKERS))}")
    return CHECKERS[name](*args)


register_checker("contains", lambda text, anchor: F.when(F.contains(text, anchor), "PRESENT").when(text.isNull() | anchor.isNull(), "UNCLEAR").otherwise("RESOLVED"))


class Permanent(Exception):
    """An error that another try won't mend (a refused request, a bad key)."""


def called(df: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str, tries: int = 3, wait: float = 0.0, most_wait: float = 60.0) -> DataFrame:
    """Each Arrow batch through `call`, `tries` times in all; the wait before the next try doubles each time, up to `most_wait`.

    A Permanent error ends the task at once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n in range(tries):
                try:
                    yield call(pdf)
                    break
                except Permanent:
                    raise
                except Exception:
                    if n == tries - 1:
                        raise
                    time.sleep(min(most_wait, wait * 2**n))

    return df.mapInPandas(run, schema)


def embedded(df: DataFrame, key: str, text: str, embed: Callable[[list[str]], list[list[float]]], batch: int = 1024) -> DataFrame:
    """key, embedding: unit vectors of the texts, `batch` at a time."""
    import numpy as np

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i in range(0, len(pdf), batch):
            m = np.asarray(embed(pdf["t"].iloc[i : i + batch].tolist()), dtype=np.float64)
            n = np.linalg.norm(m, axis=1, keepdims=True)
            out += list((m / np.where(n == 0, 1, n)).astype(np.float32))
        return pd.DataFrame({"k": pdf["k"], "embedding": out})

    kind = df.schema[key].dataType.simpleString()
    return called(df.select(F.col(key).alias("k"), F.col(text).alias("t")), call, f"k {kind}, embedding array<float>").withColumnRenamed("k", key)


def answered_once(work: DataFrame, cache: DataFrame, keys: list[str], call: Callable[[pd.DataFrame], pd.DataFrame], force: bool = False) -> DataFrame:
    """The cache with answers for work that it lacks (all work if forced)."""
    todo = work if force else work.join(cache.select(*keys).distinct(), keys, "left_anti")
    new = called(todo, call, cache.schema)
    kept = cache.join(work.select(*keys).distinct(), keys, "left_anti") if force else cache
    return kept.unionByName(new)


def extracted(inputs: DataFrame, keys: list[str], prompt: Column, complete: Callable[[list[str]], list[str]], payload: str, tries: int = 3, wait: float = 0.0) -> DataFrame:
    """keys, prompt, answer, body: a model's answers to a prompt a row, parsed. This is the form of every model step:
    inputs joined into a prompt, an injected function, answers parsed strictly (a body of null: no JSON that parses).

    payload: the DDL of the answer's records.
    """
    from hibiki.functions import text as T

    asked = inputs.select(*keys, prompt.alias("prompt"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema) + ", answer string"
    got = called(asked, lambda pdf: pdf.assign(answer=complete(pdf["prompt"].tolist())), schema, tries, wait)
    inner = T.unfenced("answer")
    ok = F.try_parse_json(inner).isNotNull() & (inner != "")
    return got.withColumn("body", F.from_json(F.when(ok, inner), payload))


def sampling(model: Column, temperature: float, fixed: tuple[str, ...]) -> Column:
    """The temperature to ask for; null for models (by prefix) that accept none."""
    out = F
    for p in fixed:
        out = out.when(F.lower(model).startswith(p), F.lit(None).cast("double"))
    return out.otherwise(F.lit(temperature)) if fixed else F.lit(temperature)


def now_utc() -> Column:
    """The time of the query in UTC, as text; to be kept out of what is compared."""
    return F.concat(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
