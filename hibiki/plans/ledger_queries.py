"""Queries over issues, verdicts, transcripts and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.operators import audit, corpus, ledger
from hibiki.session import table
from hibiki.streaming import incremental

from .registry import ENTRIES, WS, query

_VERDICT = "CASE event_type WHEN 'purchase' THEN 'RESOLVED' WHEN 'error' THEN 'PRESENT' ELSE 'UNCLEAR' END"
_RUN = f"run AS (SELECT user_id AS issue, strftime(ts, '%Y-%m-%d') AS label, arg_max({_VERDICT}, (ts, event_id)) AS verdict FROM events GROUP BY 1, 2)"
_ISSUE = "issue AS (SELECT c_custkey AS issue, c_mktsegment AS category, c_nationkey AS part FROM customer)"


def _run(spark, d) -> DataFrame:
    """issue, label, verdict: the last event of a user and day says how the issue stood."""
    verdict = F.when(F.col("event_type") == "purchase", "RESOLVED").when(F.col("event_type") == "error", "PRESENT").otherwise("UNCLEAR")
    e = table(spark, d, "events").select(F.col("user_id").alias("issue"), F.date_format("ts", "yyyy-MM-dd").alias("label"), verdict.alias("verdict"), F.struct("ts", "event_id").alias("at"))
    return e.groupBy("issue", "label").agg(F.max_by("verdict", "at").alias("verdict"))


def _issues(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("issue"), F.col("c_mktsegment").alias("category"), F.col("c_nationkey").alias("part"))


@query(
    f"WITH {_RUN}, {_ISSUE} SELECT CASE WHEN grouping(category) = 1 THEN 'all' ELSE category END AS category, CASE WHEN grouping(part) = 1 THEN 'all' ELSE part::VARCHAR END AS part, count(*) FILTER (verdict = 'RESOLVED') AS resolved, count(*) FILTER (verdict = 'PRESENT') AS present, count(*) FILTER (verdict = 'UNCLEAR') AS unclear, count(*) AS total "
    "FROM run JOIN issue USING (issue) GROUP BY GROUPING SETS ((), (part), (category))"
)
def q_scorecard(spark, d):
    return ledger.scorecard(_run(spark, d), _issues(spark, d))


_DAY = lambda x: f"{x} AS (SELECT issue, verdict FROM run WHERE label = '2024-01-{'02' if x == 'now' else '01'}')"


def _on(spark, d, day: str) -> DataFrame:
    return _run(spark, d).where(F.col("label") == day).select("issue", "verdict")


@query(
    f"WITH {_RUN}, {_DAY('now')}, {_DAY('old')}, j AS (SELECT now.issue, old.verdict AS was, now.verdict FROM now LEFT JOIN old ON old.issue = now.issue) "
    "SELECT *, CASE WHEN was = 'RESOLVED' THEN 'regression' ELSE 'improvement' END AS change FROM j WHERE (was = 'RESOLVED' AND verdict = 'PRESENT') OR (was = 'PRESENT' AND verdict = 'RESOLVED')"
)
def q_regressions(spark, d):
    return ledger.changes(_on(spark, d, "2024-01-02"), _on(spark, d, "2024-01-01"))


@query(f"WITH {_RUN}, {_ISSUE} SELECT run.issue, coalesce(part::VARCHAR, '?') AS part, label, verdict FROM run LEFT JOIN issue ON issue.issue = run.issue")
def q_verdict_history(spark, d):
    """The verdicts of every issue in every run, in long form, with the issue's part."""
    return ledger.history(_run(spark, d), _issues(spark, d))


@query(
    f"WITH {_RUN}, {_ISSUE}, f AS (SELECT issue, verdict FROM run WHERE label = '2024-01-01') SELECT i.issue, i.category, coalesce(f.verdict, 'UNCLEAR') AS verdict, "
    "CASE WHEN f.issue IS NULL THEN 'low' ELSE 'high' END AS confidence FROM issue i LEFT JOIN f ON f.issue = i.issue"
)
def q_issue_check(spark, d):
    found = _on(spark, d, "2024-01-01").withColumn("confidence", F.lit("high"))
    return ledger.checked(_issues(spark, d).select("issue", "category"), found)


@query(
    f"WITH {_RUN}, a AS (SELECT issue, verdict FROM run WHERE label = '2024-01-01'), b AS (SELECT issue, verdict FROM run WHERE label = '2024-01-03') "
    "SELECT a.issue, CASE WHEN a.verdict = 'UNCLEAR' THEN coalesce(b.verdict, a.verdict) ELSE a.verdict END AS verdict FROM a LEFT JOIN b ON b.issue = a.issue"
)
def q_second_opinion(spark, d):
    b = _on(spark, d, "2024-01-03").select(F.col("issue").alias("i"), F.col("verdict").alias("second"))
    return _on(spark, d, "2024-01-01").join(b, F.col("issue") == F.col("i"), "left").select("issue", ledger.second_opinion(F.col("verdict"), F.lit("high"), F.col("second")).alias("verdict"))


_SEV = "CASE WHEN event_type = 'error' THEN 'major' WHEN event_type = 'click' THEN 'minor' ELSE 'none' END"


@query(f"WITH f AS (SELECT user_id, {_SEV} AS s FROM events) SELECT user_id, count(*) FILTER (s = 'major') AS major, count(*) FILTER (s = 'minor') AS minor, count(*) FILTER (s = 'major') > 0 OR count(*) FILTER (s = 'minor') >= 3 AS revise FROM f GROUP BY user_id")
def q_revision_gate(spark, d):
    s = F.when(F.col("event_type") == "error", "major").when(F.col("event_type") == "click", "minor").otherwise("none")
    return ledger.needs_revision(table(spark, d, "events").select("user_id", s.alias("severity")), "user_id", "severity")


@query(
    "WITH t AS (SELECT user_id, event_type, count(*) FILTER (event_type = 'view') OVER w AS turn, row_number() OVER w AS seq FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) "
    "SELECT user_id, turn, left(string_agg(event_type, chr(10) || chr(10) ORDER BY seq), 2500) AS reply FROM t WHERE event_type <> 'view' AND turn > 0 GROUP BY user_id, turn"
)
def q_transcript_followup(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    return ledger.follow_ups(e, "user_id", ["ts", "event_id"], F.col("event_type") == "view", "event_type")


_HINTS = [("place", ("station", "school", "駅前", "学校")), ("weather", ("rain", "wind", "雨", "風")), ("speech", ("said", "whispered", "言った", "囁いた"))]
_CUT = ("\nReply", "\n- ")


def _hint_sql(x: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({x}, '{w}')" for w in ws) + f" THEN '{n}'" for n, ws in _HINTS) + " ELSE 'other' END"


@query(
    "WITH c AS (SELECT doc_id, part_id, trim(regexp_replace(string_split(string_split(text, chr(10) || 'Reply')[1], chr(10) || '- ')[1], '" + WS + "+', ' ', 'g')) AS comment FROM documents WHERE source = 'reader_comment' AND text IS NOT NULL), "
    "f AS (SELECT *, row_number() OVER (PARTITION BY part_id, lower(comment) ORDER BY doc_id) rn FROM c WHERE comment <> '') SELECT doc_id, part_id, comment, " + _hint_sql("lower(comment)") + " AS category FROM f WHERE rn = 1"
)
def q_comment_mine_dedup(spark, d):
    c = table(spark, d, "documents").where("source = 'reader_comment' and text is not null").select("doc_id", "part_id", T.clean_comment("text", _CUT).alias("comment")).where("comment <> ''")
    once = ledger.first_of(c.withColumn("_k", F.lower("comment")), ["part_id", "_k"], ["doc_id"])
    return once.select("doc_id", "part_id", "comment", T.first_match("comment", _HINTS, "other").alias("category"))


@query("SELECT p_brand, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_size DESC, p_partkey) AS rules FROM part GROUP BY p_brand")
def q_rules_ranked(spark, d):
    rules = table(spark, d, "part").select("p_brand", "p_size", F.col("p_partkey"))
    return ledger.ranked_rules(rules, "p_brand", "p_size", "p_partkey")


@query("WITH n AS (SELECT s_suppkey AS k, s_name AS name, 1 AS version FROM supplier WHERE s_nationkey = 1), o AS (SELECT s_suppkey AS k, s_name AS name, 0 AS version FROM supplier) SELECT * FROM o WHERE k NOT IN (SELECT k FROM n) UNION ALL SELECT * FROM n")
def q_manifest_upsert(spark, d):
    s = table(spark, d, "supplier")
    old = s.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit(0).alias("version"))
    new = s.where("s_nationkey = 1").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit(1).alias("version"))
    return ledger.upserted(old, new, "k")


@query("SELECT pr_id, CASE WHEN s.pr_id2 IS NOT NULL THEN s.v ELSE query_score END AS query_score FROM precedent LEFT JOIN (SELECT pr_id AS pr_id2, length_score AS v FROM precedent WHERE query_score = 0.0 AND length_score IS NOT NULL) s ON pr_id2 = pr_id")
def q_score_back_fill(spark, d):
    p = table(spark, d, "precedent")
    values = p.where("query_score = 0.0 and length_score is not null").select("pr_id", F.col("length_score").alias("query_score"))
    return ledger.back_filled(p.select("pr_id", "query_score"), values, "pr_id", "query_score")


@query(
    "SELECT ph_id, list_filter(['no_part', 'no_target', 'short_span', 'bad_score'], lambda x: (x = 'no_part' AND part_id IS NULL) OR (x = 'no_target' AND en_span IS NULL) OR (x = 'short_span' AND coalesce(length(jp_span) < 2, true)) "
    "OR (x = 'bad_score' AND coalesce(query_score NOT BETWEEN 0 AND 1, true))) AS problems FROM (SELECT DISTINCT ph_id, part_id, jp_span, en_span, query_score FROM phrase_precedent)"
)
def q_record_problems(spark, d):
    rows = table(spark, d, "phrase_precedent").select("ph_id", "part_id", "jp_span", "en_span", "query_score").distinct()
    rules = [("no_part", F.col("part_id").isNull()), ("no_target", F.col("en_span").isNull()), ("short_span", F.length("jp_span") < 2), ("bad_score", ~F.col("query_score").between(0, 1))]
    return ledger.problems(rows, rules).select("ph_id", "problems")


@query(
    f"WITH {ENTRIES}, c AS (SELECT 'unique_passages' AS name, count(*) = count(DISTINCT pr_id) AS passed FROM precedent UNION ALL SELECT 'vectors_for_passages', count(*) = 0 FROM precedent WHERE pr_id NOT IN (SELECT row_id FROM precedent_embedding) "
    "UNION ALL SELECT 'parts_in_contents', count(*) = 0 FROM paragraphs WHERE part_id IS NOT NULL AND part_id NOT IN (SELECT id FROM entry) UNION ALL SELECT 'shares_sum_to_one', abs(sum(target_share) - 1) < 1e-9 FROM mix_target UNION ALL SELECT 'glossary_loads', count(english) > 0 FROM glossary "
    "UNION ALL SELECT 'index_is_not_empty', count(*) > 0 FROM precedent UNION ALL SELECT 'plans_name_no_part_twice', count(*) = count(DISTINCT p) FROM (SELECT unnest(part_ids) AS p FROM holdout) UNION ALL SELECT 'one_target_a_source', count(*) = count(DISTINCT source) FROM mix_target) "
    "SELECT name, passed, bool_and(passed) OVER () AS overall FROM c"
)
def q_vault_checks(spark, d):
    p = table(spark, d, "precedent")
    v = table(spark, d, "precedent_embedding").select(F.col("row_id").alias("pr_id"))
    entries = corpus.entries(table(spark, d, "toc")).select(F.col("id").alias("part_id"))
    para = table(spark, d, "paragraphs").where("part_id is not null").select("part_id").distinct()
    none = lambda df: df.agg((F.count("*") == 0).alias("passed"))
    repeated = p.groupBy("pr_id").agg(F.count("*").alias("n")).where("n > 1")
    return audit.battery(
        [
            ("unique_passages", none(repeated)),
            ("vectors_for_passages", none(p.join(v, "pr_id", "left_anti"))),
            ("parts_in_contents", none(para.join(entries, "part_id", "left_anti"))),
            ("glossary_loads", table(spark, d, "glossary").agg((F.count("english") > 0).alias("passed"))),
            ("index_is_not_empty", p.agg((F.count("*") > 0).alias("passed"))),
            ("plans_name_no_part_twice", none(table(spark, d, "holdout").select(F.explode("part_ids").alias("p")).groupBy("p").agg(F.count("*").alias("n")).where("n > 1"))),
            ("one_target_a_source", none(table(spark, d, "mix_target").groupBy("source").agg(F.count("*").alias("n")).where("n > 1"))),
            ("shares_sum_to_one", table(spark, d, "mix_target").agg((F.abs(F.sum("target_share") - 1) < 1e-9).alias("passed"))),
        ]
    )


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_stream_daily_counts(spark, d):
    return incremental.daily_counts(spark, f"{d}/events.parquet")
