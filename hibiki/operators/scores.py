"""Scores of translations, their means, round summaries, critiques and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a judge scores.
AXES = ("semantic_accuracy", "voice_fidelity", "naturalness", "style_match")


def judge_mean(axes: list[Column | str]) -> Column:
    """The mean of the axes; null if one is."""
    return sum((F.col(a) if isinstance(a, str) else a for a in axes[1:]), F.col(axes[0]) if isinstance(axes[0], str) else axes[0]) / len(axes)


def score_inputs(parts: DataFrame, outputs: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Parts that have both an output and a reference, with both. outputs: key, output. references: key, reference."""
    return parts.select(key).join(outputs, key).join(references, key)


def scored(pairs: DataFrame, schema: str, score: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """The rows of an injected scorer, batch by batch; it gets and gives pandas frames."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield score(pdf)

    return pairs.mapInPandas(run, schema)


def score_means(scores: DataFrame, columns: list[str]) -> DataFrame:
    """metric, n, mean of each column over the rows that have it: one pass for all."""
    sums = scores.agg(*[F.struct(F.lit(c).alias("metric"), F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean")).alias(c) for c in columns])
    return sums.select(F.explode(F.array(*columns)).alias("m")).select("m.*")


def round_summary(scores: DataFrame, columns: list[str], rules: DataFrame, round_: int) -> DataFrame:
    """round, chapters_evaluated, <column>_mean ..., rules_added, rules_pruned, rules_inactive, rules_active_total: one row.

    scores: a row a chapter. rules: state, changed_round (the round in which the state was set).
    """
    s = scores.agg(F.count("*").alias("chapters_evaluated"), *[F.round(F.avg(c), 6).alias(f"{c}_mean") for c in columns])
    now = F.col("changed_round") == round_
    r = rules.agg(
        F.count_if(now & (F.col("state") == "active")).alias("rules_added"), F.count_if(now & (F.col("state") == "pruned")).alias("rules_pruned"),
        F.count_if(now & (F.col("state") == "inactive")).alias("rules_inactive"), F.count_if(F.col("state") == "active").alias("rules_active_total"),
    )
    return s.join(F.broadcast(r), F.lit(True)).select(F.lit(round_).alias("round"), "*")  # one row each


def round_note(columns: list[str]) -> Column:
    """The text of a round summary's row."""
    c = F.col
    means = [F.coalesce(F.concat(F.lit(f"- **{x} mean:** "), F.format_string("%.4f", c(f"{x}_mean")), F.lit("\n")), F.lit("")) for x in columns]
    return F.concat(
        F.format_string("# Round %02d Summary\n\n- **Chapters evaluated:** %d\n", c("round"), c("chapters_evaluated")), *means,
        F.format_string(
            "\n## Rule changes\n\n- Added (candidate -> active): %d\n- Pruned (regressed): %d\n- Inactive (no measurable effect): %d\n- Active rules total: %d",
            c("rules_added"), c("rules_pruned"), c("rules_inactive"), c("rules_active_total"),
        ),
    )


def critiques(flags: DataFrame, keys: list[str]) -> DataFrame:
    """keys, flag_count, major_count, minor_count, critique: the flags of each as one JSON object, by idx.

    flags: keys, idx, severity and whatever else a flag has. A key's flags are one answer of one model.
    """
    others = [c for c in flags.columns if c not in [*keys, "idx"]]
    per = flags.groupBy(*keys).agg(
        F.count("*").alias("flag_count"), F.count_if(F.col("severity") == "major").alias("major_count"), F.count_if(F.col("severity") == "minor").alias("minor_count"),
        F.array_sort(F.collect_list(F.struct("idx", *others))).alias("flags"),
    )
    return per.withColumn("critique", F.to_json(F.struct(*keys, "flag_count", "major_count", "minor_count", "flags"))).drop("flags")


def report_rows(verdicts: DataFrame, issues: DataFrame, baseline: DataFrame) -> DataFrame:
    """issue, part, category, verdict, baseline_verdict, change by (part, issue): the rows of a report. A verdict without issue is dropped.

    verdicts, baseline: issue, verdict. issues: issue, part, category.
    """
    b = baseline.select("issue", F.col("verdict").alias("baseline_verdict"))
    j = verdicts.join(issues.select("issue", "part", "category"), "issue").join(b, "issue", "left")
    change = F.when((F.col("baseline_verdict") == "RESOLVED") & (F.col("verdict") == "PRESENT"), "regression").when((F.col("baseline_verdict") == "PRESENT") & (F.col("verdict") == "RESOLVED"), "improvement")
    return j.select("issue", "part", "category", "verdict", "baseline_verdict", change.alias("change")).orderBy("part", "issue")


def status_counts(items: DataFrame, area: str, state: str) -> DataFrame:
    """area, state, n with the totals of each area and of all ('all')."""
    out = items.groupingSets([[], [F.col(area)], [F.col(area), F.col(state)]], F.col(area), F.col(state)).agg(F.count("*").alias("n"), F.grouping(area).alias("_a"), F.grouping(state).alias("_s"))
    return out.select(F.when(F.col("_a") == 1, "all").otherwise(F.col(area)).alias("area"), F.when(F.col("_s") == 1, "all").otherwise(F.col(state)).alias("state"), "n")


def scrape_counters(pages: DataFrame, bucket: str, status: str) -> DataFrame:
    """bucket, attempted, succeeded, skipped, errors; attempted ones are those that weren't skipped."""
    s = F.col(status)
    return pages.groupBy(bucket).agg(F.count_if(s != "skipped").alias("attempted"), F.count_if(s == "ok").alias("succeeded"), F.count_if(s == "skipped").alias("skipped"), F.count_if(s == "error").alias("errors"))


def revised(
    drafts: DataFrame, key: str, critic: Callable[[DataFrame], DataFrame], reviser: Callable[[DataFrame], DataFrame], most: int, minors: int = 3, cut: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """key, draft, revisions, major, minor: drafts criticised and revised until the gate is satisfied, `most` times at most.

    drafts: key, draft. critic gives key, severity (a row a flag) for drafts; reviser gives key, draft for the drafts
    that the gate holds back. The critic runs once even when nothing may be revised. Every round is a plan over all
    open drafts; `cut` is called on each round's result (a checkpoint on a cluster).
    """
    from . import ledger

    def judged(df: DataFrame) -> DataFrame:
        gate = ledger.needs_revision(critic(df), key, "severity", minors)
        none = F.lit(0).cast("long")
        j = df.join(gate, key, "left")
        return cut(j.withColumn("major", F.coalesce("major", none)).withColumn("minor", F.coalesce("minor", none)).withColumn("revise", F.coalesce("revise", F.lit(False))))

    now = judged(drafts.select(key, "draft", F.lit(0).alias("revisions")))
    for _ in range(most):
        open_ = now.where("revise")
        if open_.isEmpty():
            break
        new = open_.select(key, "revisions").join(reviser(open_.select(key, "draft")), key).select(key, "draft", (F.col("revisions") + 1).alias("revisions"))
        now = cut(now.where("not revise").unionByName(judged(new).select(*now.columns)))
    return now.select(key, "draft", "revisions", "major", "minor")
