"""Issues, verdicts over labelled runs, and the transcripts that issues are mined from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T

VERDICTS = ("RESOLVED", "PRESENT", "UNCLEAR")


def checked(issues: DataFrame, found: DataFrame) -> DataFrame:
    """issues ⟕ found: an issue without a verdict is UNCLEAR with low confidence. found: issue, verdict, confidence."""
    f = found.select(F.col("issue").alias("_i"), F.col("verdict").alias("_v"), F.col("confidence").alias("_c"))
    return issues.join(f, F.col("issue") == F.col("_i"), "left").withColumn("verdict", F.coalesce("_v", F.lit("UNCLEAR"))).withColumn("confidence", F.coalesce("_c", F.lit("low"))).drop("_i", "_v", "_c")


def second_opinion(first: Column, confidence: Column, second: Column) -> Column:
    """The second verdict where the first is unclear or of low confidence, if there is one."""
    return F.when((first == "UNCLEAR") | (confidence == "low"), F.coalesce(second, first)).otherwise(first)


def scorecard(verdicts: DataFrame, issues: DataFrame) -> DataFrame:
    """category, part, resolved, present, unclear, total: over all, by part and by category, in one pass.

    A verdict without issue is dropped. 'all' stands for a column that isn't grouped by.
    """
    j = verdicts.join(issues.select("issue", "category", F.col("part").cast("string").alias("part")), "issue")
    sets = j.groupingSets([[], [F.col("part")], [F.col("category")]], F.col("category"), F.col("part"))
    out = sets.agg(*[F.count_if(F.col("verdict") == v).alias(v.lower()) for v in VERDICTS], F.count("*").alias("total"), F.grouping("category").alias("_c"), F.grouping("part").alias("_p"))
    return out.withColumn("category", F.when(F.col("_c") == 1, "all").otherwise(F.col("category"))).withColumn("part", F.when(F.col("_p") == 1, "all").otherwise(F.col("part"))).drop("_c", "_p")


def changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """issue, was, verdict, change: regressions (resolved, now present) and improvements (the other way)."""
    b = before.select(F.col("issue").alias("_i"), F.col("verdict").alias("was"))
    j = now.join(b, F.col("issue") == F.col("_i"), "left").select("issue", "was", "verdict")
    change = F.when((F.col("was") == "RESOLVED") & (F.col("verdict") == "PRESENT"), "regression").when((F.col("was") == "PRESENT") & (F.col("verdict") == "RESOLVED"), "improvement")
    return j.withColumn("change", change).where("change is not null")


def history(verdicts: DataFrame, issues: DataFrame) -> DataFrame:
    """issue, part, label, verdict of every run; '?' where the ledger doesn't know the issue. issues: issue, part.

    The long form holds every run, whatever their number; pivoted() makes columns of chosen labels.
    """
    part = issues.select("issue", F.col("part").cast("string").alias("part"))
    return verdicts.join(part, "issue", "left").select("issue", F.coalesce("part", F.lit("?")).alias("part"), "label", "verdict")


def pivoted(history_rows: DataFrame, labels: list[str]) -> DataFrame:
    """issue + one column a label. The labels are given, so the pivot needs no pass of its own."""
    return history_rows.groupBy("issue").agg(*[F.max(F.when(F.col("label") == x, F.col("verdict"))).alias(x) for x in labels])


def needs_revision(flags: DataFrame, group: str, severity: str, minors: int = 3) -> DataFrame:
    """group, major, minor, revise: one major flag, or so many minor ones."""
    out = flags.groupBy(group).agg(F.count_if(F.col(severity) == "major").alias("major"), F.count_if(F.col(severity) == "minor").alias("minor"))
    return out.withColumn("revise", (F.col("major") > 0) | (F.col("minor") >= minors))


def follow_ups(turns: DataFrame, chat: str, order: list[str], opens: Column, text: str, cap: int = 2500) -> DataFrame:
    """chat, turn, reply: what follows each opening turn up to the next: trimmed texts a blank line apart, capped; blank ones are left out."""
    w = Window.partitionBy(chat).orderBy(*order)
    t = turns.withColumn("turn", F.count_if(opens).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_seq", F.row_number().over(w))
    rest = t.where(~opens & (F.col("turn") > 0)).withColumn("_text", T.trimmed(text)).where("_text <> ''")
    return rest.groupBy(chat, "turn").agg(F.substring(F.expr("listagg(_text, '\n\n') WITHIN GROUP (ORDER BY _seq)"), 1, cap).alias("reply"))


def enabled(issues: DataFrame, flag: str = "enabled") -> DataFrame:
    """Issues that are switched on; without a value they are."""
    return issues.where(F.coalesce(F.col(flag), F.lit(True)))


def first_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """A key once: the first row in the order (not any row, as dropDuplicates gives)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def problems(issues: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """issues + problems: the names of the rules that a row breaks."""
    return issues.withColumn("problems", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), n) for n, c in rules])))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with new rows put in place of those with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def back_filled(df: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """df with the column filled from values where these have the key."""
    v = values.select(F.col(key).alias("_k"), F.col(column).alias("_v"))
    return df.join(v, F.col(key) == F.col("_k"), "left").withColumn(column, F.coalesce("_v", column)).drop("_k", "_v")


def unseen(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that isn't done yet; null keys are never done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def ranked_rules(rules: DataFrame, group: str, priority: str, rule_id: str) -> DataFrame:
    """group, rules: ids by falling priority, then id, put together."""
    return rules.groupBy(group).agg(F.expr(f"listagg({rule_id}, ',') WITHIN GROUP (ORDER BY {priority} DESC, {rule_id})").alias("rules"))
