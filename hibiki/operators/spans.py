"""Where spans first stand in texts that are put together from paragraphs, whatever the size of a text.

Paragraphs that follow one another become one row of up to about CHUNK
characters, so what comes after handles few rows. A text is looked at in chunks
of CHUNK characters, each with as many characters of the next one as the longest
span has, and never put together whole. All spans of a text go to a chunk as one
row, and are looked for at once: hashes of its windows, of a length each, are
compared with those of the spans; what is equal is compared as it is written.
Many spans of one text are cut into pieces.

Defined results: places are counted in characters (code points) from 1. A text's
paragraphs stand in the order of para_index, then para_id, nulls last.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.session import cut, tasks

from . import ranges

#: Characters of a chunk; spans that are looked for in it at once; characters times spans up to which each span is just searched.
CHUNK, PIECE, FEW = 500_000, 100_000, 2_000_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_GROUP = ["part_id", "side"]


class _Hashes:
    """Hashes of any windows of a text: sums of its characters times powers, modulo 2**64."""

    def __init__(self, text: str) -> None:
        s = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        power = lambda x: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(0, len(s) - 1), x, np.uint64)]))[: len(s)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s * power(_BASE), dtype=np.uint64)])
        self.back = power(_INVERSE)

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def all(self, length: int) -> np.ndarray:
        n = len(self.back) - length + 1
        return (self.sums[length:] - self.sums[:n]) * self.back[:n] if n > 0 else np.zeros(0, np.uint64)


def _among(h: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of h that hold one of the sorted values `want`, and which one."""
    bits = min(22, max(12, len(want).bit_length() + 4))
    table, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
    table[want >> shift] = True
    at = np.flatnonzero(table[h >> shift])
    which = np.minimum(np.searchsorted(want, h[at]), len(want) - 1)
    good = want[which] == h[at]
    return at[good], which[good]


def places(text: str, spans: list[str]) -> list[int]:
    """Where each span, none of them empty, first stands in the text; -1: nowhere."""
    if len(text) * len(spans) <= FEW:
        return [text.find(x) for x in spans]
    out = np.full(len(spans), -1, np.int64)
    length = np.array([len(x) for x in spans])
    hashes, own = _Hashes(text), _Hashes("".join(spans))
    first = np.cumsum(length) - length
    whole = own.of(first, length)
    # spans of one power of two are looked for where the window of that length begins as one of them
    power = 1 << (np.frexp(length)[1] - 1)
    for head in np.unique(power[length <= len(text)]):
        at, _ = _among(hashes.all(int(head)), np.unique(own.of(first[power == head], int(head))))
        for n in np.unique(length[power == head]):
            here = at[at <= len(text) - n]
            want = np.unique(whole[length == n])
            if not len(here):
                continue
            hit, which = _among(hashes.of(here, int(n)), want)
            found, earliest = np.unique(which, return_index=True)  # places ascend
            place = dict(zip(want[found].tolist(), here[hit[earliest]].tolist()))
            for i in np.flatnonzero(length == n):
                a = place.get(int(whole[i]))
                if a is not None:  # another text may have the hash
                    out[i] = a if text.startswith(spans[i], a) else text.find(spans[i])
    return out.tolist()


def _put_together(paras: DataFrame, key: Callable[[str], Column]) -> DataFrame:
    """part_id, side, range, within, place, text, n: paragraphs that follow one another, in the order of range, within and place.

    Rows are sorted in ranges of their numbers, those without para_index in ranges of para_id, so a large part is spread over tasks.
    """
    most, order = CHUNK, [*_GROUP, "range", "within"]
    ranged = lambda c: F.floor(F.col(c) / ranges.RANGE)
    last = F.lit((1 << 63) - 1)
    rows = paras.withColumns({"para_index": F.coalesce(F.col("para_index").cast("long"), last), "para_id": F.coalesce(F.col("para_id").cast("long"), last)})
    rows = rows.withColumns({"range": ranged("para_index"), "within": F.when(F.col("para_index") == last, ranged("para_id")).otherwise(F.lit(0).cast("long"))})
    # the one exchange of the paragraphs: rows that are alike meet in it, too
    rows = rows.repartition(tasks(paras.sparkSession), *order).distinct().sortWithinPartitions(*order, "para_index", "para_id", "text")

    def joined(batches):
        for b in batches:
            if b.num_rows:
                text = b.column("text")
                size = np.cumsum(pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)) // most
                new = size[1:] != size[:-1]
                for c in order:
                    new |= pc.not_equal(b.column(c)[1:], b.column(c)[:-1]).to_numpy(zero_copy_only=False)
                first = np.concatenate([[0], np.flatnonzero(new) + 1])
                runs = pa.ListArray.from_arrays(pa.array(np.append(first, b.num_rows), pa.int32()), text)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(first)) for c in order), pc.binary_join(runs, "")], names=[*order, "text"])

    runs = rows.select(*order, key("text").alias("text")).mapInArrow(joined, "part_id string, side string, range long, within long, text string")
    return runs.select(*order, F.monotonically_increasing_id().alias("place"), "text", F.length("text").cast("long").alias("n")).where("n > 0")


def first_places(paras: DataFrame, spans: DataFrame, key: Callable[[str], Column] = F.col) -> tuple[DataFrame, DataFrame]:
    """(part_id, side, span, at: where a span first stands, none if nowhere), (part_id, side, size: characters of the text).

    paras: part_id, side, para_index, para_id, text, not null but for the numbers, and any others; rows alike in every column count once. spans: part_id, side, span, not null and not empty.
    Texts are those of the parts that spans has; key gives the form in which a paragraph's text is looked at.
    """
    spark = paras.sparkSession
    runs = cut(_put_together(paras, key))
    own = Window.partitionBy(*_GROUP)
    asked = spans.select(*_GROUP, "span").repartition(tasks(spark), *_GROUP).distinct()  # the one exchange of the spans: all that follows is by part and side
    asked = asked.withColumn("pieces", F.ceil(F.count("*").over(own) / PIECE)).withColumn("piece", F.pmod(F.xxhash64("span"), F.col("pieces")))
    asked = cut(asked.groupBy(*_GROUP, "piece").agg(F.first("pieces").alias("pieces"), F.max(F.length("span")).cast("long").alias("longest"), F.collect_list("span").alias("spans")))

    known = cut(runs.select(*_GROUP, "range", "within", "place", "n"))  # a row has no text
    sizes = known.groupBy(*_GROUP).agg(F.sum("n").alias("size"))
    per = sizes.join(asked.groupBy(*_GROUP).agg(F.max("longest").alias("longest"), F.first("pieces").alias("pieces")), _GROUP)
    per = cut(per.withColumn("longest", F.least("longest", "size")))
    buckets = max(8 * tasks(spark), 1 + (per.agg(F.sum(F.col("size") * F.col("pieces"))).first()[0] or 0) // CHUNK)
    bucket = F.pmod(F.xxhash64(*_GROUP, "chunk", "piece"), F.lit(buckets)).alias("bucket")
    before = Window.partitionBy(*_GROUP).orderBy("range", "within", "place").rowsBetween(Window.unboundedPreceding, -1)
    at = known.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    at = at.join(per, _GROUP).select("place", "start", "longest", "pieces")

    # a run goes to the chunks that its characters are of, and to those whose spans may end in it
    t = runs.join(at, "place").withColumn("end", F.col("start") + F.col("n"))
    t = t.withColumn("chunk", F.explode(F.sequence(F.floor(F.greatest(F.col("start") - F.col("longest") + 1, F.lit(0)) / CHUNK), F.floor((F.col("end") - 1) / CHUNK))))
    low = F.greatest("start", F.col("chunk") * CHUNK)
    high = F.least("end", (F.col("chunk") + 1) * CHUNK + F.col("longest") - 1)
    t = t.withColumn("_low", low).withColumn("text", F.substring("text", (F.col("_low") - F.col("start") + 1).cast("int"), (high - F.col("_low")).cast("int")))
    t = t.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).select(*_GROUP, "chunk", "piece", F.col("_low").alias("start"), "text", bucket)
    s = asked.select(*_GROUP, "piece", "spans").join(per.select(*_GROUP, "size"), _GROUP).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / CHUNK))))
    s = s.select(*_GROUP, "chunk", "piece", "spans", bucket)

    def look(t: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        t, texts, out = t.sort_values("start"), defaultdict(list), []
        for part, side, chunk, piece, start, text in zip(t["part_id"], t["side"], t["chunk"], t["piece"], t["start"], t["text"]):
            texts[part, side, chunk, piece].append((start, text))
        for part, side, chunk, piece, mine in zip(s["part_id"], s["side"], s["chunk"], s["piece"], s["spans"]):
            if own := texts.get((part, side, chunk, piece)):
                mine, start = list(mine), own[0][0]
                out += [(part, side, x, start + a + 1) for x, a in zip(mine, places("".join(x for _, x in own), mine)) if a >= 0]
        return pd.DataFrame(out, columns=[*_GROUP, "span", "at"])

    found = t.groupBy("bucket").cogroup(s.groupBy("bucket")).applyInPandas(look, "part_id string, side string, span string, at long")
    return found.groupBy(*_GROUP, "span").agg(F.min("at").alias("at")), sizes
