"""Queries over the precedent index: retrieval, audits, model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.operators import answers, audit, corpus, ledger, retrieve
from hibiki.session import spread, table

from .registry import COUNTS, ENTRIES, PARAS, WS, query, squeezed, visible

_UNIT = "list_transform(embedding, lambda x: x::DOUBLE)"
_HITS = (
    f"v AS (SELECT vec_id, label, {_UNIT} AS e, sqrt(list_dot_product({_UNIT}, {_UNIT})) AS n FROM embeddings), "
    "s AS (SELECT q.vec_id AS q, t.vec_id AS row_id, q.label = t.label AS same, round(list_dot_product(q.e, t.e) / (q.n * t.n), 6) AS score FROM v q, v t WHERE q.vec_id % 50 = 0 AND q.vec_id <> t.vec_id)"
)
_TOP = f"{_HITS}, h AS (SELECT q, row_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, row_id) AS rank FROM s) WHERE rank <= 10)"
_OTHER = f"{_HITS}, h AS (SELECT q, row_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, row_id) AS rank FROM s WHERE NOT same) WHERE rank <= 10)"
_DEDUP = "k AS (SELECT h.*, label, row_id % 7 AS slot FROM h JOIN embeddings e ON e.vec_id = h.row_id), u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, slot ORDER BY q, rank) rn FROM k) WHERE rn = 1)"


def _hits(spark, d, same_label: bool = True) -> DataFrame:
    """The queries are the stated set: every row whose id 50 divides, against all rows."""
    e = table(spark, d, "embeddings")
    return retrieve.topk(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", "label", 10, same_label)


def _keyed(spark, d, hits: DataFrame) -> DataFrame:
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), "label", (F.col("vec_id") % 7).alias("slot"))
    return hits.join(labels, "row_id")


@query(f"WITH {_TOP} SELECT q, row_id, score, rank::INT AS rank FROM h")
def q_precedent_topk(spark, d):
    return _hits(spark, d)


@query(f"WITH {_OTHER} SELECT q, row_id, score, rank::INT AS rank FROM h")
def q_precedent_topk_masked(spark, d):
    return _hits(spark, d, same_label=False)


@query(f"WITH {_TOP}, {_DEDUP} SELECT q, row_id, score, label, slot FROM u ORDER BY score DESC, q, rank LIMIT 40")
def q_precedent_dedup_cap(spark, d):
    return retrieve.deduplicated(_keyed(spark, d, _hits(spark, d)), ["label", "slot"], 40).select("q", "row_id", "score", "label", "slot")


@query(f"WITH {_TOP}, {_DEDUP.replace('JOIN embeddings e ON e.vec_id = h.row_id', 'JOIN embeddings e ON e.vec_id = h.row_id WHERE score >= 0.2')} SELECT q, row_id, score, label, slot FROM u ORDER BY score DESC, q, rank LIMIT 30")
def q_phrase_topk_floor(spark, d):
    return retrieve.floored(_keyed(spark, d, _hits(spark, d)), 0.2, ["label", "slot"], 30).select("q", "row_id", "score", "label", "slot")


@query(
    "WITH h AS (SELECT DISTINCT unnest(part_ids) AS id FROM holdout), p AS (SELECT part_id IN (SELECT id FROM h) AS x, length_score AS l, query_score AS s FROM precedent), "
    "f AS (SELECT coalesce(x, false) AS x, NOT coalesce(x, false) AND NOT coalesce(l >= 0.3, false) AS short, s FROM p) "
    "SELECT count(*) AS total, count(*) FILTER (x) AS excluded, count(*) FILTER (short) AS short, count(*) FILTER (NOT x AND NOT short AND coalesce(s < 0.3, false)) AS unlike, "
    "count(*) FILTER (NOT x AND NOT short AND NOT coalesce(s < 0.3, false)) AS kept FROM f"
)
def q_precedent_filter_counts(spark, d):
    held = table(spark, d, "holdout").select(F.explode("part_ids").alias("part_id"))
    return retrieve.filter_counts(table(spark, d, "precedent").withColumnRenamed("query_score", "semantic_score"), held, "part_id", 0.3, 0.3)


@query(
    "WITH s AS (SELECT list_sort(list(query_score) FILTER (query_score IS NOT NULL)) a, avg(query_score) m FROM precedent), c AS (SELECT list_sort(list(query_score)) b FROM precedent WHERE shape = '1:1' AND query_score IS NOT NULL) "
    "SELECT len(a) AS n, round(m, 6) AS mean, a[least(len(a), floor(len(a) * 0.05)::INT + 1)] AS p05, a[least(len(a), floor(len(a) * 0.1)::INT + 1)] AS p10, a[least(len(a), floor(len(a) * 0.25)::INT + 1)] AS p25, "
    "b[len(b) // 20 + 1] AS calibrated, (SELECT count(*) FROM precedent WHERE length_score >= 0.3 AND coalesce(query_score, 1.0) < b[len(b) // 20 + 1]) AS suspects FROM s, c"
)
def q_index_scores_summary(spark, d):
    """The quantiles are elements at floor(n p) of the ordered scores, found by rank and not by gathering them."""
    p = table(spark, d, "precedent").where("query_score is not null")
    n = p.agg(F.count("*").alias("n"), F.round(F.avg("query_score"), 6).alias("mean"), F.count_if(F.col("shape") == "1:1").alias("c"))
    counts = n.first()
    total, aligned = counts["n"], counts["c"]
    quantiles = retrieve.at_places(p, "query_score", {name: min(max(0, total - 1), int(total * q)) for name, q in (("p05", 0.05), ("p10", 0.1), ("p25", 0.25))})
    calibrated = retrieve.at_places(p.where("shape = '1:1'"), "query_score", {"at": aligned // 20}).get("at")
    suspects = table(spark, d, "precedent").agg(F.count_if((F.col("length_score") >= 0.3) & (F.coalesce("query_score", F.lit(1.0)) < F.lit(calibrated))).alias("suspects"))
    return n.join(suspects, F.lit(True)).select("n", "mean", *[F.lit(quantiles.get(k)).cast("double").alias(k) for k in ("p05", "p10", "p25")], F.lit(calibrated).cast("double").alias("calibrated"), "suspects")


_KEY = lambda x: f"lower({squeezed(x)})"


@query(f"SELECT ph_id, {_KEY('jp_span')} <> '' AND contains({_KEY('context_jp')}, {_KEY('jp_span')}) AS found FROM (SELECT DISTINCT ph_id, jp_span, context_jp FROM phrase_precedent) WHERE jp_span IS NOT NULL AND context_jp IS NOT NULL")
def q_verbatim_spans(spark, d):
    rows = table(spark, d, "phrase_precedent").where("jp_span is not null and context_jp is not null").select("ph_id", "jp_span", "context_jp").distinct()
    return rows.select("ph_id", audit.holds("context_jp", "jp_span").alias("found"))


@query(
    f"WITH r AS (SELECT part_id, ph_id, {_KEY('jp_span')} <> '' AND contains({_KEY('context_jp')}, {_KEY('jp_span')}) AS found FROM (SELECT DISTINCT ph_id, part_id, jp_span, context_jp FROM phrase_precedent)) "
    "SELECT part_id, count(*) AS n, count(*) FILTER (NOT coalesce(found, false)) AS hits, round(count(*) FILTER (NOT coalesce(found, false))::DOUBLE / count(*), 6) AS rate FROM r WHERE part_id IS NOT NULL GROUP BY part_id"
)
def q_span_miss_rate(spark, d):
    rows = table(spark, d, "phrase_precedent").select("ph_id", "part_id", "jp_span", "context_jp").distinct()
    return audit.rate(rows, "part_id", ~audit.holds("context_jp", "jp_span"))


@query(
    f"WITH k AS (SELECT ph_id, {_KEY('jp_span')} AS x, {_KEY('literal_alternative')} AS y FROM (SELECT DISTINCT ph_id, jp_span, literal_alternative FROM phrase_precedent)) "
    "SELECT count(*) AS n, count(*) FILTER (coalesce(length(x) <= 30 AND length(y) <= 30 AND (x = y OR contains(x, y) OR contains(y, x)), false)) AS trivial FROM k"
)
def q_trivial_pairs(spark, d):
    rows = table(spark, d, "phrase_precedent").select("ph_id", "jp_span", "literal_alternative").distinct()
    return rows.agg(F.count("*").alias("n"), F.count_if(audit.trivial("jp_span", "literal_alternative")).alias("trivial"))


_COVER = (
    f"{PARAS}, a AS (SELECT part_id, coalesce(sum({visible('text')}), 0)::BIGINT AS source_chars FROM para WHERE side = 'jp' AND part_id IS NOT NULL GROUP BY part_id), "
    f"b AS (SELECT part_id, coalesce(sum({visible('jp_text')}), 0)::BIGINT AS n FROM precedent WHERE part_id IS NOT NULL GROUP BY part_id)"
)


@query(f"WITH {_COVER} SELECT a.part_id, source_chars, coalesce(n, 0) AS indexed_chars, round(coalesce(n, 0)::DOUBLE / greatest(source_chars, 1), 6) AS coverage FROM a LEFT JOIN b USING (part_id)")
def q_coverage_audit(spark, d):
    paras = corpus.paragraphs(table(spark, d, "paragraphs")).where("side = 'jp'")
    return audit.coverage(table(spark, d, "precedent").select("part_id", F.col("jp_text").alias("text")), paras)


@query("WITH p AS (SELECT part_id, count(*) AS n FROM precedent WHERE part_id IS NOT NULL GROUP BY part_id), s AS (SELECT avg(n) m, stddev_samp(n) sd FROM p) SELECT part_id, n, round((n - m) / sd, 6) AS z FROM p, s WHERE (n - m) / sd < -0.3")
def q_sparse_parts(spark, d):
    return audit.count_outliers(table(spark, d, "precedent"), "part_id", -0.3)


@query("SELECT part_id, count(*) AS n, count(*) FILTER (length_score < 0.5) AS hits, round(count(*) FILTER (length_score < 0.5)::DOUBLE / count(*), 6) AS rate FROM precedent WHERE part_id IS NOT NULL GROUP BY part_id ORDER BY rate DESC, part_id LIMIT 10")
def q_borderline_rate(spark, d):
    """The ten worst parts: a report."""
    return audit.rate(table(spark, d, "precedent"), "part_id", F.col("length_score") < 0.5).orderBy(F.desc("rate"), "part_id").limit(10)


@query(
    f"WITH {PARAS}, b AS (SELECT part_id, side, para_id < lag(para_id) OVER (PARTITION BY part_id, side ORDER BY para_index, para_id) AS back FROM para WHERE part_id IS NOT NULL AND para_id IS NOT NULL) "
    "SELECT part_id, side, count(*) AS n, count(*) FILTER (back) AS inversions FROM b GROUP BY part_id, side"
)
def q_order_inversions(spark, d):
    paras = corpus.paragraphs(table(spark, d, "paragraphs")).where("part_id is not null")
    return audit.inversions(paras, ["part_id", "side"], ["para_index", "para_id"], "para_id")


@query(
    f"WITH {ENTRIES}, a AS (SELECT DISTINCT id AS part_id FROM entry WHERE id IS NOT NULL), b AS (SELECT DISTINCT part_id FROM precedent WHERE part_id IS NOT NULL) "
    "SELECT part_id, 'only_left' AS gap FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT part_id, 'only_right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"
)
def q_index_representation(spark, d):
    return corpus.set_gaps(corpus.entries(table(spark, d, "toc")).select(F.col("id").alias("part_id")), table(spark, d, "precedent").select("part_id"), "part_id")


_TRIM = f"regexp_replace(raw_response, '^{WS}+|{WS}+$', '', 'g')"
_INNER = rf"regexp_extract({_TRIM}, '(?s)^```[A-Za-z]*\s*(.*?)\s*```', 1)"
_BODY = rf"regexp_extract(CASE WHEN {_INNER} <> '' THEN {_INNER} ELSE {_TRIM} END, '(?s)(\{{.*\}})', 1)"
# DuckDB lets a comma stand before a closing bracket; outside strings that is no JSON.
_STRICT = r"""NOT regexp_matches(regexp_replace(b, '"(?:[^"\\]|\\.)*"', 's', 'g'), ',\s*[\]}]')"""
_JSON = f"j AS (SELECT raw_id, part_id, model, extracted_at, CASE WHEN json_valid(b) AND {_STRICT} THEN b END AS body FROM (SELECT *, {_BODY} AS b FROM raw_cache))"
_CATS = "('set_phrase', 'onomatopoeia', 'facial_idiom', 'register', 'restructured', 'other')"


@query(
    f"WITH {_JSON}, p AS (SELECT raw_id, unnest(from_json(body -> '$.phrase_pairs', '[\"JSON\"]')) AS p, generate_subscripts(from_json(body -> '$.phrase_pairs', '[\"JSON\"]'), 1) - 1 AS idx FROM j WHERE body IS NOT NULL) "
    f"SELECT raw_id, idx::BIGINT AS idx, p ->> '$.jp_span' AS jp_span, p ->> '$.en_span' AS en_span, CASE WHEN lower(trim(p ->> '$.category')) IN {_CATS} THEN lower(trim(p ->> '$.category')) ELSE 'other' END AS category, coalesce(p ->> '$.notes', '') AS notes "
    "FROM p WHERE trim(p ->> '$.jp_span') <> '' AND trim(p ->> '$.en_span') <> ''"
)
def q_json_payload(spark, d):
    return answers.phrases(spread(table(spark, d, "raw_cache").select("raw_id", "raw_response")), ["raw_id"], "raw_response")


@query(
    f"WITH {_JSON}, p AS (SELECT raw_id, unnest(from_json(body -> '$.risks', '[\"JSON\"]')) AS p, generate_subscripts(from_json(body -> '$.risks', '[\"JSON\"]'), 1) - 1 AS idx FROM j WHERE body IS NOT NULL) "
    f"SELECT raw_id, idx::BIGINT AS idx, p ->> '$.jp_span' AS jp_span, CASE WHEN lower(trim(p ->> '$.category')) IN {_CATS} THEN lower(trim(p ->> '$.category')) ELSE 'other' END AS category, "
    "CASE WHEN lower(trim(p ->> '$.risk_level')) IN ('low', 'medium', 'high') THEN lower(trim(p ->> '$.risk_level')) ELSE 'medium' END AS risk_level FROM p WHERE trim(p ->> '$.jp_span') <> ''"
)
def q_json_risks(spark, d):
    return answers.risks(spread(table(spark, d, "raw_cache").select("raw_id", "raw_response")), ["raw_id"], "raw_response")


@query(
    f"WITH {_JSON}, {COUNTS}, src AS (SELECT part_id, chars AS source_chars FROM cnt WHERE side = 'jp'), q AS (SELECT part_id, unnest(from_json(body -> '$.paragraph_pairs', '[\"JSON\"]')) AS p FROM j WHERE body IS NOT NULL), "
    f"r AS (SELECT part_id, count(*) AS pairs, max(length(p ->> '$.jp')) AS lj, max(length(p ->> '$.en')) AS le, sum({visible(chr(40) + 'p ->> ' + chr(39) + '$.jp' + chr(39) + chr(41))})::BIGINT AS c FROM q GROUP BY part_id), "
    "g AS (SELECT s.part_id, source_chars, coalesce(pairs, 0) AS pairs, coalesce(lj, 0)::INT AS longest_jp, coalesce(le, 0)::INT AS longest_en, coalesce(c, 0)::DOUBLE / nullif(source_chars, 0) AS cov FROM src s LEFT JOIN r ON r.part_id = s.part_id) "
    "SELECT part_id, pairs, longest_jp, longest_en, round(cov, 6) AS coverage, CASE WHEN source_chars > 2000 AND pairs < 5 THEN 'too_few' WHEN longest_jp > 600 OR longest_en > 1800 THEN 'too_large' WHEN coalesce(cov < 0.7, false) THEN 'low_coverage' ELSE 'ok' END AS verdict FROM g"
)
def q_extraction_gates(spark, d):
    pairs = answers.paragraph_pairs(table(spark, d, "raw_cache"), ["part_id"], "raw_response")
    sources = corpus.side_counts(corpus.paragraphs(table(spark, d, "paragraphs"))).where("side = 'jp'").select("part_id", F.col("chars").alias("source_chars"))
    return audit.gates(pairs, sources)


@query("SELECT raw_id, part_id, model FROM raw_cache r WHERE extracted_at IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_cache s WHERE s.scanned_at IS NOT NULL AND s.part_id = r.part_id AND s.model = r.model)")
def q_incremental_new_parts(spark, d):
    """Extractions whose part and model have no risk scan yet: the work list against the cache."""
    r = table(spark, d, "raw_cache")
    return ledger.unseen(r.where("extracted_at is not null").select("raw_id", "part_id", "model"), r.where("scanned_at is not null").select("part_id", "model"), ["part_id", "model"])


@query("WITH l AS (SELECT *, row_number() OVER (PARTITION BY part_id, model ORDER BY extracted_at DESC, raw_id DESC) rn FROM raw_cache WHERE extracted_at IS NOT NULL) SELECT part_id, model, raw_id FROM l WHERE rn = 1")
def q_latest_answer(spark, d):
    r = table(spark, d, "raw_cache").where("extracted_at is not null")
    return ledger.first_of(r.select("part_id", "model", "raw_id", "extracted_at"), ["part_id", "model"], [F.desc("extracted_at"), F.desc("raw_id")]).select("part_id", "model", "raw_id")


@query("SELECT japanese, max(english) AS english, count(*) AS n FROM glossary WHERE english IS NOT NULL GROUP BY japanese")
def q_glossary_entries(spark, d):
    return table(spark, d, "glossary").where("english is not null").groupBy("japanese").agg(F.max("english").alias("english"), F.count("*").alias("n"))


@query("SELECT shape, count(*) AS n FROM precedent GROUP BY shape")
def q_index_shapes(spark, d):
    return table(spark, d, "precedent").groupBy("shape").agg(F.count("*").alias("n"))


@query(
    "WITH v AS (SELECT row_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM precedent_embedding WHERE len(embedding) = 96) "
    "SELECT a.row_id, round(list_dot_product(a.e, b.e) / (CASE WHEN list_dot_product(a.e, a.e) = 0 THEN 1 ELSE sqrt(list_dot_product(a.e, a.e)) END * CASE WHEN list_dot_product(b.e, b.e) = 0 THEN 1 ELSE sqrt(list_dot_product(b.e, b.e)) END), 6) AS cosine "
    "FROM v a JOIN v b ON b.row_id = a.row_id + 1"
)
def q_neighbour_cosine(spark, d):
    """Row-wise similarity of each passage and the next: an equi-join and a built-in dot product."""
    v = table(spark, d, "precedent_embedding").where("size(embedding) = 96")
    return retrieve.row_cosines(v, v.select((F.col("row_id") - 1).alias("row_id"), "embedding"), "row_id", "embedding")
