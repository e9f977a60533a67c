"""The pN_ queries over the tables of the project, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hibiki.session import cut, spread, table

from . import alignment, lookalike, mixture, neighbours, overlap, packing, quality, sentences, tokens, truncation
from .sql import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _kind():
    return F.when(F.col("extracted_at").isNotNull(), "extraction").when(F.col("scanned_at").isNotNull(), "risk").otherwise("unknown")


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "raw_cache"), "raw_id", "model", "raw_response").select("raw_id").distinct()


@query
def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation_report(table(spark, sf_dir, "raw_cache"), "raw_id", "model", "raw_response", _kind())


@query
def p1_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histograms of whole answers: per source, unit (characters, bytes) and length, the answers and distinct answers."""
    r = table(spark, sf_dir, "raw_cache").where("trim(raw_response) <> ''").select("model", F.regexp_replace("raw_response", r"\s+$", "").alias("t"))
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.length("t").alias("len")), F.struct(F.lit("bytes").alias("unit"), F.octet_length("t").alias("len")))).alias("u")
    return r.select("model", "t", units).groupBy("model", "u.unit", "u.len").agg(F.count("*").alias("n"), F.countDistinct("t").alias("n_distinct"))


def _sentence_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, start_pos, end_pos, unit over both tables; repeated deliveries count once."""
    para = spread(table(spark, sf_dir, "paragraphs").select(F.lit("paragraphs").alias("tbl"), F.col("para_id").alias("row_id"), "text"))
    prec = spread(table(spark, sf_dir, "precedent").select(F.lit("precedent").alias("tbl"), F.col("pr_id").alias("row_id"), F.col("jp_text").alias("text")))
    return sentences.units(para.unionByName(prec), "text", ["tbl", "row_id"])


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentence_units(spark, sf_dir).select("tbl", "row_id", "start_pos", "end_pos").distinct()


@query
def p2_conserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: the rows that have units, and the letters and digits in them; a letter belongs to one unit."""
    return _sentence_units(spark, sf_dir).distinct().groupBy("tbl").agg(F.countDistinct("row_id").alias("rows"), F.sum(F.length(F.regexp_replace("unit", r"[^\p{L}\p{N}]", ""))).alias("letters"))


def _split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    precedent = table(spark, sf_dir, "precedent").select("pr_id", "part_id", "jp_text")
    return overlap.split_of(precedent, "part_id", table(spark, sf_dir, "holdout"))


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = overlap.overlaps(_split_records(spark, sf_dir), "pr_id", "split", "jp_text")
    return pairs.select(F.least("eval_id", "train_id").alias("id_a"), F.greatest("eval_id", "train_id").alias("id_b")).distinct()


@query
def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of every split."""
    return _split_records(spark, sf_dir).groupBy("split").agg(F.count("*").alias("records"), F.count("jp_text").alias("texts"))


@query
def p3_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation records whose very text is in the training split, among those that the operator finds to be exact overlaps."""
    records = _split_records(spark, sf_dir)
    found = overlap.overlaps(records, "pr_id", "split", "jp_text").where("exact")
    text = records.select("pr_id", "jp_text")
    both = found.join(text.select(F.col("pr_id").alias("eval_id"), F.col("jp_text").alias("a")), "eval_id").join(text.select(F.col("pr_id").alias("train_id"), F.col("jp_text").alias("b")), "train_id")
    return both.where("a = b").select("eval_id", "train_id")


@query
def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of classes of equal canonical texts, with their numbers of records."""
    pairs, _ = overlap.class_overlaps(_split_records(spark, sf_dir), "pr_id", "split", "jp_text")
    return pairs.select(F.col("e").alias("eval_class"), F.col("t").alias("train_class"), "exact", F.col("n_eval").alias("eval_records"), F.col("n_train").alias("train_records"))


@query
def p3_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with a split and text: its class, and how many training records its class is linked to."""
    pairs, member = overlap.class_overlaps(_split_records(spark, sf_dir), "pr_id", "split", "jp_text")
    links = pairs.groupBy("e").agg(F.sum("n_train").alias("links"))
    return member.join(links.withColumnRenamed("e", "cls"), "cls", "left").select(
        F.col("id").alias("pr_id"), "held", F.col("cls").alias("class_id"), F.when(F.col("held"), F.coalesce("links", F.lit(0))).otherwise(0).alias("links")
    )


@query
def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split and part: its records, those that stand in the training split too, and the pairs, counted by class."""
    records = _split_records(spark, sf_dir)
    pairs, member = overlap.class_overlaps(records, "pr_id", "split", "jp_text")
    by_class = pairs.groupBy("e").agg(F.sum("n_train").alias("pairs"), F.sum(F.when(F.col("exact"), F.col("n_train")).otherwise(0)).alias("exact_pairs"))
    hits = member.where("held").join(by_class, F.col("cls") == F.col("e")).select(F.col("id").alias("eval_id"), "pairs", "exact_pairs")
    held = records.where(F.col("split").isNotNull() & (F.col("split") != "train")).select("pr_id", "split", "part_id")
    return (
        held.join(hits, F.col("pr_id") == F.col("eval_id"), "left")
        .groupBy("split", "part_id")
        .agg(
            F.count("*").alias("records"),
            F.count("eval_id").alias("overlapping"),
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
            F.coalesce(F.sum("exact_pairs"), F.lit(0)).alias("exact_pairs"),
        )
    )


VECTOR_SIZE = 96


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = neighbours.nearest(table(spark, sf_dir, "precedent_embedding"), "row_id", "embedding", VECTOR_SIZE)
    near = near.where(F.col("cos") >= 0.8)
    return near.select(F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).distinct()


@query
def p5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brute force, which the index is measured against: the ten most similar rows of every row whose id 50 divides."""
    return neighbours.exact(table(spark, sf_dir, "precedent_embedding"), "row_id", "embedding", VECTOR_SIZE)


@query
def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "precedent_embedding"), "row_id", "embedding", VECTOR_SIZE)


@query
def p5_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.recall(table(spark, sf_dir, "precedent_embedding"), "row_id", "embedding", VECTOR_SIZE)


def _alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    precedent = table(spark, sf_dir, "precedent").select("pr_id", "jp_text", "en_text").distinct()
    para = table(spark, sf_dir, "paragraphs").where("part_id is not null and side in ('jp', 'en')").select("part_id", "side", "para_id", "para_index", "text").distinct()
    one_side = F.when(F.col("side") == "jp", "j").otherwise("e").alias("side")
    texts = para.select(F.concat(F.lit("p:"), "part_id").alias("doc"), one_side, F.col("para_id").alias("row_id"), F.coalesce("para_index", F.lit(0)).cast("double").alias("place"), "text")
    doc = F.concat(F.lit("r:"), F.col("pr_id").cast("string")).alias("doc")
    for side, column in (("j", "jp_text"), ("e", "en_text")):
        texts = texts.unionByName(precedent.select(doc, F.lit(side).alias("side"), F.col("pr_id").alias("row_id"), F.lit(0.0).alias("place"), F.col(column).alias("text")))
    rows = cut(alignment.sentence_rows(texts))
    lex = cut(alignment.lexicon(precedent.select(F.col("jp_text").alias("a"), F.col("en_text").alias("b"))))
    long_, short = rows.where("doc like 'p:%'"), rows.where("doc like 'r:%'")
    pairs = alignment.aligned(long_, lex, True).withColumn("unit", F.lit("paragraph")).unionByName(alignment.aligned(short, lex, False).withColumn("unit", F.lit("precedent")))
    return pairs


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alignment(spark, sf_dir).where("unit = 'precedent' or jp_row < en_row").select("unit", "jp_row", "jp_start", "en_row", "en_start").distinct()


@query
def p4_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any alignment: pairs that cross documents or sides, start where no unit does, or come twice: none."""
    pairs = cut(p4_found(spark, sf_dir))
    side = table(spark, sf_dir, "paragraphs").select("para_id", "part_id", "side").distinct()
    p = pairs.where("unit = 'paragraph'").join(side.select(F.col("para_id").alias("jp_row"), F.col("part_id").alias("pj"), F.col("side").alias("sj")), "jp_row", "left").join(side.select(F.col("para_id").alias("en_row"), F.col("part_id").alias("pe"), F.col("side").alias("se")), "en_row", "left")
    crossed = p.where("not coalesce(pj = pe and sj = 'jp' and se = 'en', false)").agg(F.count("*").alias("n"))
    apart = pairs.where("unit = 'precedent' and jp_row <> en_row").agg(F.count("*").alias("n"))
    units = _sentence_units(spark, sf_dir).select(F.when(F.col("tbl") == "precedent", "precedent").otherwise("paragraph").alias("unit"), F.col("row_id").alias("jp_row"), F.col("start_pos").alias("jp_start")).distinct()
    astray = pairs.join(units, ["unit", "jp_row", "jp_start"], "left_anti").agg(F.count("*").alias("n"))
    twice = pairs.agg((F.count("*") - F.countDistinct("unit", "jp_row", "jp_start", "en_row", "en_start")).alias("n"))
    rows = [("across documents", crossed), ("across rows", apart), ("no unit's start", astray), ("twice", twice)]
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("fault"), "n") for name, df in rows])


def _eye_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    para = table(spark, sf_dir, "paragraphs").select(F.lit("paragraph").alias("unit"), F.col("para_id").alias("id"), "text")
    phrase = table(spark, sf_dir, "phrase_precedent").select(F.lit("phrase").alias("unit"), F.col("ph_id").alias("id"), F.col("jp_span").alias("text"))
    texts = para.unionByName(phrase).distinct()
    return lookalike.canonicalised(texts, "text", lookalike.learn(texts, "text"))


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.same_to_the_eye(cut(_eye_texts(spark, sf_dir)), ["unit"], "id", "text", "canonical")


@query
def p6_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's text in its one consistent form."""
    return _eye_texts(spark, sf_dir).select("unit", "id", "canonical", (F.col("text") != F.col("canonical")).alias("changed"))


@query
def p6_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's class of like-looking texts, and its number of links: no pairs are made."""
    return lookalike.eye_classes(cut(_eye_texts(spark, sf_dir)), ["unit"], "id", "text", "canonical")


@query
def p6_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any consistent form: rows by unit, texts in their form, no invisible space or full-width letter left in it."""
    rows = cut(_eye_texts(spark, sf_dir))
    return rows.groupBy("unit").agg(
        F.count("*").alias("rows"), F.count("canonical").alias("forms"), F.count_if(F.col("canonical").rlike("[\u200b\u200c\u200d\u2060\ufeff\u00ad]")).alias("unseen"),
        F.count_if(F.col("canonical").rlike("[\uff21-\uff3a\uff41-\uff5a\uff66-\uff9f]")).alias("wide"), F.count_if(F.col("canonical").rlike("[\u00a0\u2007\u202f\u3000]") & F.col("canonical").contains(" ")).alias("spaces"),
    )


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens: counted once, written, read as often as needed."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cut(tokens.with_tokens(docs, ["doc_id", "source"], "text"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_sized(spark, sf_dir), table(spark, sf_dir, "packing_spec"), "doc_id", "tokens")


@query
def p7_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's container, or containers where it alone exceeds one."""
    return _packed(spark, sf_dir)


@query
def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(_packed(spark, sf_dir))


@query
def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(_packed(spark, sf_dir))


@query
def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any packing, per kind of container: every document once and whole, no container over its capacity, none split without need."""
    sized = _sized(spark, sf_dir)
    spec = table(spark, sf_dir, "packing_spec")
    pieces = cut(packing.packed(sized, spec, "doc_id", "tokens"))
    per = pieces.groupBy("spec_name", "capacity", "doc_id").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("packed"), F.count("*").alias("pieces"))
    j = per.join(sized.select("doc_id", "tokens"), "doc_id", "full")
    over = packing.containers(pieces).groupBy("spec_name").agg(F.count_if(F.col("fill_tokens") > F.col("capacity")).alias("over_full"))
    out = j.groupBy("spec_name", "capacity").agg(
        F.count("*").alias("documents"), F.count_if(~F.coalesce(F.col("packed") == F.col("tokens"), F.lit(False))).alias("not_whole"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("split_without_need")
    )
    return out.join(over, "spec_name", "left").select("spec_name", F.col("capacity").alias("capacity_tokens"), "documents", "not_whole", "split_without_need", F.coalesce("over_full", F.lit(0)).alias("over_full"))


@query
def p8_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn records and how often each is used."""
    return mixture.drawn(_sized(spark, sf_dir), table(spark, sf_dir, "mix_target"), "doc_id", "source", "tokens")


@query
def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.shares_report(cut(p8_draws(spark, sf_dir)), table(spark, sf_dir, "mix_target"))


@query
def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any mixture, per listed source: records that aren't of the source, records used too often or drawn
    twice, and whether the tokens are within two blocks and a document of the target's among the sources that have documents."""
    sized, targets = _sized(spark, sf_dir), table(spark, sf_dir, "mix_target")
    d = cut(mixture.drawn(sized, targets, "doc_id", "source", "tokens"))
    j = d.join(sized.select("doc_id", F.col("source").alias("own")), "doc_id", "left").join(targets.select("source", "max_repeats"), "source")
    bad = j.groupBy("source").agg(F.count_if(~F.coalesce(F.col("own") == F.col("source"), F.lit(False))).alias("astray"), F.count_if(F.col("uses") > F.col("max_repeats")).alias("too_often"), (F.count("*") - F.countDistinct("doc_id")).alias("twice"))
    rep = mixture.shares_report(d, targets)
    there = rep.where("tokens > 0").agg(F.sum("target_share").alias("sum"), F.sum("tokens").alias("total"))
    largest = sized.agg(F.max("tokens").alias("largest"))
    goal = F.when(F.col("tokens") > 0, F.col("target_share") / F.col("sum") * F.col("total")).otherwise(0)
    rep = rep.join(there, F.lit(True)).join(largest, F.lit(True)).withColumn("near", F.abs(F.col("tokens") - goal) <= 2 * mixture.BLOCK_TOKENS + F.col("largest"))
    none = F.lit(0).cast("long")
    return rep.join(bad, "source", "left").select("source", F.col("max_repeats").cast("long").alias("max_repeats"), *[F.coalesce(F.col(c), none).alias(c) for c in ("astray", "too_often", "twice")], F.col("near").alias("near_target"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and p_junk of all documents; the trees learn from paragraphs that are marked as prose."""
    prose = table(spark, sf_dir, "paragraphs").where("kind in ('narration', 'dialogue')").select("text")
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality.statistics(docs, "doc_id", "text", quality.trained(prose, "text"))


@query
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).where("p_junk >= 0.5").select("doc_id").distinct()


@query
def p9_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir)


@query
def p9_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain ones of the statistics: characters, lines that hold any, shares of lines that are short or start with a small letter."""
    stats = quality.statistics(table(spark, sf_dir, "documents"), "doc_id", "text")
    return stats.select("doc_id", "n_chars", "n_lines", "short_lines", "commas_per_100")
