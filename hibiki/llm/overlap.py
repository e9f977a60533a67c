"""Problem 3: evaluation records that stand, exactly or nearly, in the training split.

Records are canonicalised (compatibility form, case, punctuation, white space)
and hashed to 128 bits; records of one hash are one class, so that copies are
compared once and never paired with each other. Then hashes are joined,
evaluation with training:

* the hashes of whole canonical texts find the exact overlaps;
* for near overlaps (the longest common subsequence holds at least `share` of
  the longer text) each class is filed under hashes of its rarest characters.
  Two texts with so many characters in common must share one of the
  n - ceil(share * n) + 1 rarest of either, so no pair is lost; a length band in
  the key and a bitmap of the characters drop nearly all others inside the
  join, and what is left is checked exactly. A character of many classes has its
  training side split by a salt, and the evaluation side sent to every piece.

Results are pairs of classes with their numbers of records, and membership;
rows are paired only where row pairs are asked for.

Defined results: a null text, or a null split, is in no pair. A pair whose
longer canonical text has fewer than `least` characters is none. Repeated rows
(the same id) give one pair. Empty canonical texts are alike only to none.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hibiki.session import cut

SHARE, LEAST = 0.85, 20
#: Occurrences of one character beyond this one are counted together in the rarity order.
OCCURRENCES = 4
#: Classes of one character that one piece of a key holds, about.
PIECE = 20_000
#: Bitmap of the characters, in words of 64 bits.
WORDS = 4

_DROPPED = regex.compile(r"[\p{P}\p{Z}\p{C}\s]+")


def canonical_text(s: str) -> str:
    return _DROPPED.sub("", unicodedata.normalize("NFKC", s).casefold())


@F.pandas_udf(StringType())
def canonical(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: None if s is None else canonical_text(s))


def tokens(text: str) -> list[tuple[str, int]]:
    """Each character with the number of its occurrence: equal multisets are equal sets."""
    seen: Counter[str] = Counter()
    out = []
    for c in text:
        seen[c] += 1
        out.append((c, seen[c]))
    return out


def prefix(text: str, rarity: dict[tuple[str, int], int], share: float = SHARE) -> list[tuple[str, int]]:
    """The rarest tokens, of which a partner must have one."""
    n = len(text)
    keep = n - math.ceil(share * n - 1e-9) + 1
    return sorted(tokens(text), key=lambda t: (rarity.get((t[0], min(t[1], OCCURRENCES)), 0), t))[:keep]


def band(n: int, share: float = SHARE) -> int:
    return math.floor(math.log(n) / -math.log(share) + 1e-9)


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & at.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def alike(a: str, b: str, share: float = SHARE, least: int = LEAST) -> bool:
    n = max(len(a), len(b))
    return n >= least and min(len(a), len(b)) >= share * n - 1e-9 and common(a, b) >= share * n - 1e-9


def _rarity(texts: DataFrame) -> dict[tuple[str, int], int]:
    """In how many texts each character stands (once, twice ...).

    The result has at most OCCURRENCES entries for each code point that Unicode
    has, whatever the corpus; so it may be held by the driver and sent out.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((0x110000, OCCURRENCES), np.int64)
        for pdf in batches:
            doc, cp, _ = _points(pdf["canon"])
            _, cp, k = _occurrences(doc, cp)
            for i in range(OCCURRENCES):
                total[:, i] += np.bincount(cp[k == i + 1], minlength=0x110000)
        c, k = np.nonzero(total)
        yield pd.DataFrame({"c": c, "k": k + 1, "n": total[c, k]})

    counted = texts.select("canon").mapInPandas(count, "c long, k int, n long").groupBy("c", "k").agg(F.sum("n").alias("n"))
    return {(chr(r["c"]), r["k"]): r["n"] for r in counted.toLocalIterator()}


def _points(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code point) of every character of a batch, and the texts' lengths."""
    each = [np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4") for s in texts]
    size = np.array([len(x) for x in each], np.int64)
    return np.repeat(np.arange(len(each)), size), np.concatenate([*each, np.zeros(0, "<u4")]).astype(np.int64), size


def _occurrences(doc: np.ndarray, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, code point and number of the occurrence of every character, ordered by text and code point."""
    order = np.lexsort((cp, doc))
    doc, cp = doc[order], cp[order]
    at = np.arange(len(cp))
    first = np.ones(len(cp), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (cp[1:] != cp[:-1])
    return doc, cp, at - np.maximum.accumulate(np.where(first, at, 0)) + 1


def prefixes(texts: pd.Series, ranks: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, code point, occurrence and count of what prefix() gives, for a batch of texts. ranks: counts by code point and occurrence."""
    doc, cp, size = _points(texts)
    doc, cp, k = _occurrences(doc, cp)
    rank = ranks[cp, np.minimum(k, OCCURRENCES) - 1]
    order = np.lexsort((k, cp, rank, doc))
    doc, cp, k, rank = doc[order], cp[order], k[order], rank[order]
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    ok = place < np.repeat(size - np.ceil(share * size - 1e-9).astype(np.int64) + 1, size)
    return doc[ok], cp[ok], k[ok], rank[ok]


def _filed(classes: DataFrame, rarity, share: float, least: int, train: bool) -> DataFrame:
    """key, piece, band, cls, n, w0.. of every class: under each prefix token, in its own length
    band and one piece of the key (training), or in all pieces, with low and high, the bands of
    possible partners (evaluation)."""
    words = [f"w{i}" for i in range(WORDS)]

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = np.zeros((0x110000, OCCURRENCES), np.int64)
        for (c, k), n in rarity.value.items():
            ranks[ord(c), k - 1] = n
        for pdf in batches:
            pdf = pdf[pdf["canon"].str.len() / share >= least - 1e-9]
            if not len(pdf):
                continue
            doc, cp, size = _points(pdf["canon"])
            bits = np.zeros((len(pdf), WORDS), np.uint64)
            own = np.unique(doc << 21 | cp)
            place = ((own & 0x1FFFFF) * 2654435761 >> 7) % (64 * WORDS)
            np.bitwise_or.at(bits, (own >> 21, place // 64), np.uint64(1) << (place % 64).astype(np.uint64))
            doc, cp, k, rank = prefixes(pdf["canon"], ranks, share)
            pieces = 1 + rank // PIECE
            cls = pdf["cls"].to_numpy()
            if train:
                piece = cls[doc] % pieces
            else:
                at = np.repeat(np.arange(len(doc)), pieces)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                doc, cp, k = doc[at], cp[at], k[at]
            in_band = lambda n: np.floor(np.log(n) / -math.log(share) + 1e-9).astype(np.int64)
            low, high = in_band(np.maximum(1, np.ceil(share * size - 1e-9))), in_band(np.floor(size / share + 1e-9))
            out = {"key": cp << 20 | np.minimum(k, (1 << 20) - 1), "piece": piece, "band": in_band(size)[doc], "low": low[doc], "high": high[doc], "cls": cls[doc], "n": size[doc]}
            yield pd.DataFrame(out | {w: bits[doc, i].view(np.int64) for i, w in enumerate(words)})

    return classes.select("cls", "canon").mapInPandas(file, "key long, piece long, band long, low long, high long, cls long, n long, " + ", ".join(f"{w} long" for w in words))


def _near(classes: DataFrame, share: float, least: int) -> DataFrame:
    """e, t: evaluation and training classes with different, nearly equal texts."""
    rarity = classes.sparkSession.sparkContext.broadcast(_rarity(classes))
    words = [f"w{i}" for i in range(WORDS)]
    train = _filed(classes.where("n_train > 0"), rarity, share, least, True).select("key", "piece", "band", F.col("cls").alias("t"), F.col("n").alias("m"), *[F.col(w).alias(f"t{w}") for w in words])
    evals = _filed(classes.where("n_eval > 0"), rarity, share, least, False)
    evals = evals.select("key", "piece", F.explode(F.sequence("low", "high")).alias("band"), F.col("cls").alias("e"), "n", *words)
    longer, apart = F.greatest("n", "m"), sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"t{w}"))) for w in words), F.lit(0))
    need = F.ceil(longer * share - 1e-9)
    pairs = (
        evals.join(train, ["key", "piece", "band"])
        .where((F.col("e") != F.col("t")) & (longer >= least) & (F.least("n", "m") >= need) & (apart <= F.col("n") + F.col("m") - 2 * need))
        .select("e", "t")
        .distinct()
    )
    texts = classes.select("cls", "canon")
    pairs = pairs.join(texts.select(F.col("cls").alias("e"), F.col("canon").alias("a")), "e").join(texts.select(F.col("cls").alias("t"), F.col("canon").alias("b")), "t")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [alike(a, b, share, least) for a, b in zip(pdf["a"], pdf["b"])]
            yield pdf.loc[ok, ["e", "t"]]

    return pairs.select("e", "t", "a", "b").mapInPandas(verify, "e long, t long")


def class_overlaps(records: DataFrame, row_id: str, split: str, text: str, train: str = "train", share: float = SHARE, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(e, t, exact, n_eval, n_train): pairs of an evaluation and a training class that are alike, with their
    numbers of records, and (id, held, e): the class of every record. Classes are named by their smallest id.

    records: row_id bigint, split (`train` or the name of an evaluation split), text.
    """
    rows = cut(
        records.where(F.col(split).isNotNull() & F.col(text).isNotNull())
        .select(F.col(row_id).alias("id"), (F.col(split) != train).alias("held"), canonical(text).alias("canon"))
        .where(F.length("canon") > 0)
        .select("id", "held", "canon", F.xxhash64("canon").alias("h1"), F.xxhash64(F.lit(1), "canon").alias("h2"))
        .distinct()
    )
    named = rows.groupBy("h1", "h2").agg(F.min("id").alias("cls"), F.count_if("held").alias("n_eval"), F.count_if(~F.col("held")).alias("n_train"), F.min("canon").alias("canon"))
    classes = cut(named)
    # whole texts: evaluation hashes with training hashes
    evals = classes.where((F.col("n_eval") > 0) & (F.length("canon") >= least)).select("h1", "h2", F.col("cls").alias("e"))
    trains = classes.where("n_train > 0").select("h1", "h2", F.col("cls").alias("t"))
    exact = evals.join(trains, ["h1", "h2"]).select("e", "t", F.lit(True).alias("exact"))
    pairs = cut(exact.unionByName(_near(classes, share, least).withColumn("exact", F.lit(False))))
    sized = pairs.join(classes.select(F.col("cls").alias("e"), "n_eval"), "e").join(classes.select(F.col("cls").alias("t"), "n_train"), "t")
    member = rows.join(classes.select("h1", "h2", "cls"), ["h1", "h2"]).select("id", "held", "cls")
    return sized.select("e", "t", "exact", "n_eval", "n_train"), member


def overlaps(records: DataFrame, row_id: str, split: str, text: str, train: str = "train", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """eval_id, train_id, exact: all pairs of an evaluation and a training record that are alike."""
    pairs, member = class_overlaps(records, row_id, split, text, train, share, least)
    # only classes of a pair are led back to their rows
    return (
        pairs.select("e", "t", "exact")
        .join(member.where("held").select(F.col("id").alias("eval_id"), F.col("cls").alias("e")), "e")
        .join(member.where(~F.col("held")).select(F.col("id").alias("train_id"), F.col("cls").alias("t")), "t")
        .select("eval_id", "train_id", "exact")
    )


def split_of(records: DataFrame, part: str, plans: DataFrame) -> DataFrame:
    """records + split: the split of the plan that lists the part, else 'train'; null where the part is null."""
    listed = plans.select(F.explode("part_ids").alias("_part"), F.col("split").alias("_split")).distinct()
    return (
        records.join(listed, F.col(part) == F.col("_part"), "left")
        .withColumn("split", F.when(F.col(part).isNotNull(), F.coalesce("_split", F.lit("train"))))
        .drop("_part", "_split")
    )
