"""Queries over the corpus: scope, validation, calibration, holdouts, windows, contents."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.operators import align, corpus, holdout, sections, toc, validate
from hibiki.session import table

from .registry import COUNTS, ENTRIES, PARAS, WS, count_of, kind, query, squeezed, trimmed, visible

POVS = ["hiiragi", "narumi", "both"]
STRATA = ["hiiragi", "narumi"]
NAMES = [("柊", ["Hiiragi-san", "Hiiragi"]), ("鳴海", ["Narumi"])]
_IN = "('hiiragi', 'narumi', 'both')"


def _entries(spark, d) -> DataFrame:
    return corpus.entries(table(spark, d, "toc"))


def _paras(spark, d) -> DataFrame:
    return corpus.paragraphs(table(spark, d, "paragraphs"))


def _counts(spark, d) -> DataFrame:
    return corpus.side_counts(_paras(spark, d))


def _measures(spark, d) -> DataFrame:
    return validate.measures(_paras(spark, d), NAMES)


@query(f"WITH {ENTRIES} SELECT id, part_number, pov FROM entry WHERE kind = 'part' AND part_number IS NOT NULL AND pov IN {_IN}")
def q_scope_filter(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).where(corpus.is_target(POVS)).select("id", "part_number", "pov").orderBy("part_number")


@query(f"WITH {ENTRIES} SELECT id, coalesce(nullif(part_number, 0), 1000000) AS story_key FROM entry")
def q_scope_canonical_order(spark, d):
    return _entries(spark, d).select("id", corpus.story_key().alias("story_key")).orderBy("story_key", "id")


@query(f"WITH {ENTRIES} SELECT id, notes FROM entry WHERE mapping_confidence = 'needs_review'")
def q_review_selection(spark, d):
    return _entries(spark, d).where("mapping_confidence = 'needs_review'").select("id", "notes")


@query(f"WITH {COUNTS} SELECT part_id, side, n_paragraphs, chars FROM cnt")
def q_visible_chars(spark, d):
    return _counts(spark, d)


def _measure_sql() -> str:
    def total(side, expr, name):
        return f"coalesce(sum(CASE WHEN side = '{side}' THEN {expr} END), 0)::BIGINT AS {name}"

    t = "coalesce(text, '')"
    marks = {"open": "「", "close": "」", "lq": "“", "rq": "”", "dq": '"'}
    cols = ["count(*) FILTER (side = 'jp') jp_rows", "count(*) FILTER (side = 'en') en_rows", total("jp", visible(t), "jp_chars"), total("en", visible(t), "en_chars")]
    cols += [total("jp", count_of(t, marks[m]), f"jp_{m}") for m in ("open", "close")] + [total("en", count_of(t, c), f"en_{m}") for m, c in marks.items()]
    for i, (a, b) in enumerate(NAMES):
        cols += [total("jp", count_of(t, a), f"jp_name{i}"), total("en", " + ".join(count_of(t, x) for x in b), f"en_name{i}")]
    return (
        f"{PARAS}, s AS (SELECT part_id, {', '.join(cols)} FROM para WHERE part_id IS NOT NULL GROUP BY part_id), "
        "m AS (SELECT part_id, jp_chars, en_chars, least(jp_open, jp_close) jp_blocks, CASE WHEN least(en_open, en_close) > 0 THEN least(en_open, en_close) "
        "WHEN en_lq + en_rq > 0 THEN least(en_lq, en_rq) ELSE en_dq // 2 END en_blocks, jp_name0, jp_name1, en_name0, en_name1 FROM s WHERE jp_rows > 0 AND en_rows > 0)"
    )


MEASURES = _measure_sql()
_RATIO = "en_chars::DOUBLE / nullif(jp_chars, 0)"
_RATIO_STATUS = f"CASE WHEN jp_chars = 0 THEN 'warn' WHEN {_RATIO} BETWEEN 1.85 AND 2.94 THEN 'pass' WHEN {_RATIO} BETWEEN 1.85 * 0.85::DOUBLE AND 2.94 * 1.15::DOUBLE THEN 'warn' ELSE 'fail' END"
_SKEW = "CASE WHEN jp_blocks > 0 OR en_blocks > 0 THEN abs(jp_blocks - en_blocks)::DOUBLE / greatest(jp_blocks, en_blocks, 1) END"
_DIALOGUE = f"CASE WHEN coalesce({_SKEW}, 0) <= 0.107 THEN 'pass' ELSE 'fail' END"


def _name_skew(i: int) -> str:
    return f"CASE WHEN jp_name{i} > 0 OR en_name{i} > 0 THEN abs(jp_name{i} - en_name{i})::DOUBLE / greatest(jp_name{i}, en_name{i}, 1) END"


_NAMES = f"CASE WHEN coalesce(greatest({_name_skew(0)}, {_name_skew(1)}), 0) > 0.9 THEN 'fail' WHEN coalesce(greatest({_name_skew(0)}, {_name_skew(1)}), 0) > 0.65 THEN 'warn' ELSE 'pass' END"


@query(f"WITH {MEASURES} SELECT part_id, jp_chars, en_chars, round({_RATIO}, 6) AS ratio, {_RATIO_STATUS} AS status FROM m")
def q_length_ratio(spark, d):
    return _measures(spark, d).select("part_id", "jp_chars", "en_chars", F.round(validate.length_ratio(), 6).alias("ratio"), validate.ratio_status().alias("status"))


@query(f"WITH {MEASURES} SELECT part_id, jp_blocks, en_blocks, round({_SKEW}, 6) AS skew, {_DIALOGUE} AS status FROM m")
def q_dialogue_parity(spark, d):
    return _measures(spark, d).select("part_id", "jp_blocks", "en_blocks", F.round(validate.dialogue_skew(), 6).alias("skew"), validate.dialogue_status().alias("status"))


@query(
    f"WITH {MEASURES}, r AS (SELECT part_id, '柊' AS name, jp_name0 AS jp_n, en_name0 AS en_n FROM m UNION ALL SELECT part_id, '鳴海', jp_name1, en_name1 FROM m) "
    "SELECT part_id, name, jp_n, en_n, round(abs(jp_n - en_n)::DOUBLE / greatest(jp_n, en_n, 1), 6) AS skew FROM r WHERE jp_n > 0 OR en_n > 0"
)
def q_name_frequency(spark, d):
    return validate.name_skews(_measures(spark, d), NAMES).withColumn("skew", F.round("skew", 6))


@query(
    f"WITH {MEASURES}, v AS (SELECT part_id, {_RATIO_STATUS} AS length, {_DIALOGUE} AS dialogue, {_NAMES} AS names FROM m) "
    "SELECT *, CASE WHEN 'fail' IN (length, dialogue, names) THEN 'fail' WHEN 'warn' IN (length, dialogue, names) THEN 'warn' ELSE 'pass' END AS overall FROM v"
)
def q_validate_all(spark, d):
    return validate.validated(_measures(spark, d), NAMES)


_METRICS = f"{MEASURES}, v AS (SELECT 'length_ratio' AS metric, {_RATIO} AS value FROM m UNION ALL SELECT 'dialogue_skew', {_SKEW} FROM m UNION ALL SELECT 'name_skew_0', {_name_skew(0)} FROM m UNION ALL SELECT 'name_skew_1', {_name_skew(1)} FROM m)"
_DIST = (
    f"{_METRICS}, d AS (SELECT metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS stdev, round(min(value), 6) AS min, "
    + ", ".join(f"round(quantile_cont(value, {q}), 6) AS {n}" for q, n in ((0.05, "p05"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95")))
    + ", round(max(value), 6) AS max FROM v WHERE value IS NOT NULL GROUP BY metric)"
)


@query(f"WITH {_DIST} SELECT * FROM d")
def q_calibrate(spark, d):
    return validate.distribution(validate.metrics(_measures(spark, d), NAMES))


@query(f"WITH {_DIST} SELECT metric, round(p05 * 0.9::DOUBLE, 6) AS low, round(p95 * 1.1::DOUBLE, 6) AS high FROM d")
def q_calibrate_recommend(spark, d):
    return validate.recommended(validate.distribution(validate.metrics(_measures(spark, d), NAMES)))


@query(
    f"WITH {_DIST} SELECT coalesce(round(max(p05) FILTER (metric = 'length_ratio') * 0.9::DOUBLE, 2), 1.0) AS length_min, coalesce(round(max(p95) FILTER (metric = 'length_ratio') * 1.1::DOUBLE, 2), 3.0) AS length_max, "
    "coalesce(round(max(p95) FILTER (metric = 'dialogue_skew'), 3), 0.1) AS dialogue_max FROM d"
)
def q_recommendations(spark, d):
    return validate.recommendations(validate.distribution(validate.metrics(_measures(spark, d), NAMES)))


@query(f"WITH {ENTRIES} SELECT coalesce(pov, 'unknown') AS pov, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM entry WHERE kind = 'part' GROUP BY 1")
def q_stratum_share(spark, d):
    n = _entries(spark, d).where("kind = 'part'").groupBy(F.coalesce("pov", F.lit("unknown")).alias("pov")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(total, F.lit(True)).select("pov", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query(
    f"WITH {PARAS}, n AS (SELECT part_id, sum({count_of('text', '柊')})::BIGINT AS a_n, sum({count_of('text', '鳴海')})::BIGINT AS b_n FROM para "
    f"WHERE side = 'jp' AND part_id IS NOT NULL AND {kind('text')} = 'narration' GROUP BY part_id) "
    "SELECT part_id, a_n, b_n, CASE WHEN a_n + b_n >= 3 AND a_n < b_n THEN '柊' WHEN a_n + b_n >= 3 AND b_n < a_n THEN '鳴海' END AS narrator, "
    "a_n + b_n >= 3 AND a_n <> b_n AND (greatest(a_n, b_n) > 2 * least(a_n, b_n) OR abs(a_n - b_n) >= 3) AS confident FROM n"
)
def q_narrator_detect(spark, d):
    return validate.narrator(_paras(spark, d), "柊", "鳴海")


_VERIFIED = (
    f"{ENTRIES}, {COUNTS}, ver AS (SELECT e.id, j.n_paragraphs AS jp, k.n_paragraphs AS en, CASE WHEN j.part_id IS NOT NULL THEN 'present' WHEN coalesce(kakuyomu_episode_id, '') = '' THEN 'print_only' ELSE 'missing' END AS jp_status, "
    "CASE WHEN k.part_id IS NOT NULL THEN 'present' WHEN coalesce(url_en, '') = '' THEN 'source_only' ELSE 'missing' END AS en_status, j.part_id IS NOT NULL AND k.part_id IS NOT NULL AS complete, "
    "coalesce(j.n_paragraphs > 0 AND k.n_paragraphs > 0 AND abs(j.n_paragraphs - k.n_paragraphs)::DOUBLE / greatest(j.n_paragraphs, k.n_paragraphs) > 0.25, false) AS skewed "
    f"FROM entry e LEFT JOIN cnt j ON j.part_id = e.id AND j.side = 'jp' LEFT JOIN cnt k ON k.part_id = e.id AND k.side = 'en' WHERE e.kind = 'part' AND part_number IS NOT NULL AND pov IN {_IN})"
)


@query(
    f"WITH {_VERIFIED} SELECT * FROM ver"
)
def q_verify_pairs(spark, d):
    return corpus.verify_pairs(_entries(spark, d).where(corpus.is_target(POVS)), _counts(spark, d))


@query(
    f"WITH {_VERIFIED} SELECT count(*) AS in_scope, (SELECT count(*) FROM entry) - count(*) AS out_of_scope, count(*) FILTER (jp_status = 'present') AS jp_present, count(*) FILTER (en_status = 'present') AS en_present, count(*) FILTER (complete) AS complete_pairs, "
    "count(*) FILTER (jp_status = 'missing') AS missing_jp, count(*) FILTER (jp_status = 'print_only') AS missing_jp_print_only, count(*) FILTER (en_status = 'missing') AS missing_en, count(*) FILTER (en_status = 'source_only') AS missing_en_source_only, count(*) FILTER (skewed) AS skewed FROM ver"
)
def q_verify_report(spark, d):
    return corpus.verify_report(q_verify_pairs(spark, d), _entries(spark, d))


@query(f"WITH {COUNTS}, w AS (SELECT part_id, max(n_paragraphs) FILTER (side = 'jp') jp, max(n_paragraphs) FILTER (side = 'en') en FROM cnt GROUP BY part_id) SELECT part_id, jp AS n_paragraphs FROM w WHERE jp = en AND jp > 0")
def q_align_exact_count_parts(spark, d):
    return corpus.equal_count_parts(_counts(spark, d))


_ELIGIBLE = (
    f"{ENTRIES}, eligible AS (SELECT id, part_number, pov FROM entry WHERE kind = 'part' AND part_number IS NOT NULL AND pov IN {_IN} "
    "AND id IN (SELECT part_id FROM paragraphs WHERE side = 'en' AND part_id IS NOT NULL))"
)
_PICK = (
    f"{_ELIGIBLE}, s AS (SELECT * FROM eligible WHERE pov IN ('hiiragi', 'narumi')), b AS (SELECT *, CASE WHEN part_number / greatest((SELECT max(part_number) FROM s), 1) < 1.0::DOUBLE / 3 THEN 'early' "
    "WHEN part_number / greatest((SELECT max(part_number) FROM s), 1) < 2.0::DOUBLE / 3 THEN 'middle' ELSE 'late' END AS bucket FROM s), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY bucket, pov ORDER BY md5(concat('7:', id)), id) rn FROM b), h AS (SELECT id, part_number, pov, bucket FROM r WHERE rn <= 5)"
)


def _eligible(spark, d) -> DataFrame:
    en = table(spark, d, "paragraphs").where("side = 'en' and part_id is not null").select(F.col("part_id").alias("id")).distinct()
    return _entries(spark, d).where(corpus.is_target(POVS)).join(en, "id", "left_semi").select("id", "part_number", "pov")


@query(f"WITH {_PICK} SELECT * FROM h")
def q_holdout(spark, d):
    return holdout.picked(_eligible(spark, d), STRATA)


@query(f"WITH {_PICK} SELECT bucket, pov, count(*) AS n FROM h GROUP BY bucket, pov")
def q_holdout_counts(spark, d):
    return holdout.cell_counts(holdout.picked(_eligible(spark, d), STRATA))


@query("SELECT plan_name, e.key AS bucket, f.key AS pov, f.value AS n FROM holdout, unnest(map_entries(per_bucket_counts)) u(e), unnest(map_entries(e.value)) w(f)")
def q_holdout_plan_counts(spark, d):
    rows = table(spark, d, "holdout").select("plan_name", F.explode("per_bucket_counts").alias("bucket", "cells"))
    return rows.select("plan_name", "bucket", F.explode("cells").alias("pov", "n"))


_PARTS = (
    f"{_ELIGIBLE}, held AS (SELECT DISTINCT unnest(part_ids) AS id FROM holdout), parts AS (SELECT id, part_number, id IN (SELECT id FROM eligible) AND id NOT IN (SELECT id FROM held) AS eligible, title_en AS title FROM entry WHERE kind = 'part' AND part_number IS NOT NULL), "
    "r AS (SELECT id, part_number, coalesce(sum(eligible::INT) OVER (ORDER BY part_number, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) rk FROM parts), "
    "e AS (SELECT id AS ref_id, part_number AS ref_number, row_number() OVER (ORDER BY part_number, id) erk FROM parts WHERE eligible), "
    "win AS (SELECT r.id, r.part_number, ref_id, ref_number, (erk - greatest(rk - 9, 1) + 1)::BIGINT AS place FROM r JOIN e ON erk <= rk AND erk > rk - 10)"
)


def _parts(spark, d) -> DataFrame:
    held = table(spark, d, "holdout").select(F.explode("part_ids").alias("id")).distinct().withColumn("_held", F.lit(True))
    ok = _eligible(spark, d).select("id").withColumn("_ok", F.lit(True))
    parts = _entries(spark, d).where("kind = 'part' and part_number is not null").select("id", "part_number", F.col("title_en").alias("title"))
    return parts.join(ok, "id", "left").join(held, "id", "left").select("id", "part_number", (F.col("_ok").isNotNull() & F.col("_held").isNull()).alias("eligible"), "title")


@query(f"WITH {_PARTS} SELECT * FROM win")
def q_reference_window(spark, d):
    return holdout.reference_windows(_parts(spark, d))


@query(f"WITH {_PARTS} SELECT p.id, count(w.id) AS have, 10 - count(w.id) AS lacking FROM parts p LEFT JOIN win w ON w.id = p.id GROUP BY p.id HAVING count(w.id) < 10")
def q_window_underfill(spark, d):
    return holdout.underfilled(_parts(spark, d))


@query(f"WITH {_PARTS} SELECT w.id, string_agg(ref_id || ': ' || coalesce(p.title, ''), chr(10) ORDER BY place) AS prompt FROM win w LEFT JOIN parts p ON p.id = ref_id GROUP BY w.id")
def q_window_prompt(spark, d):
    parts = _parts(spark, d)
    return holdout.window_prompt(holdout.reference_windows(parts), parts)


@query(
    f"WITH {_PARTS}, x AS (SELECT p.id AS target, h.id AS ref_id, q.part_number AS ref_number, 0 AS k FROM parts p JOIN held h ON true JOIN parts q ON q.id = h.id WHERE q.part_number = p.part_number - 1 "
    "UNION ALL SELECT id, ref_id, ref_number, 1 FROM win), o AS (SELECT *, row_number() OVER (PARTITION BY target, ref_id ORDER BY k) a FROM x), "
    "l AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY k, ref_number DESC, ref_id) b FROM o WHERE a = 1) SELECT target, ref_id, ref_number FROM l WHERE b <= 5"
)
def q_ai_reference_recent(spark, d):
    """The held-out part just before a target is named explicitly; the newest of its window fill up to five."""
    parts = _parts(spark, d)
    held = table(spark, d, "holdout").select(F.explode("part_ids").alias("id")).distinct()
    ref = parts.join(held, "id", "left_semi").select(F.col("id").alias("ref_id"), F.col("part_number").alias("ref_number"), (F.col("part_number") + 1).alias("part_number"))
    explicit = parts.join(ref, "part_number").select(F.col("id").alias("target"), "ref_id", "ref_number")
    recent = holdout.reference_windows(parts).select(F.col("id").alias("target"), "ref_id", "ref_number")
    return holdout.merged_references(explicit, recent, 5)


_FLAT = f"{ENTRIES}, flat AS (SELECT id AS episode, (row_number() OVER (ORDER BY chapter_number, file_pos, id) - 1)::INT AS position FROM entry WHERE url_jp IS NOT NULL), map AS (SELECT e.id, e.part_number, f.episode, CASE WHEN f.episode IS NULL THEN 'needs_review' ELSE 'high' END AS confidence FROM entry e LEFT JOIN flat f ON f.position + 1 = e.part_number WHERE e.kind = 'part')"


def _flat(spark, d) -> DataFrame:
    return toc.flattened(_entries(spark, d).where("url_jp is not null").withColumn("episode", F.col("id")), ["chapter_number", "file_pos"], "episode")


def _mapping(spark, d) -> DataFrame:
    return toc.mapped(_entries(spark, d).where("kind = 'part'"), _flat(spark, d))


@query(f"WITH {_FLAT} SELECT * FROM map")
def q_toc_flatten_map(spark, d):
    return _mapping(spark, d)


_OVER = [("part_001", "part_003"), ("part_003", None), ("part_004", "nowhere")]


@query(
    f"WITH {_FLAT}, o(id, epi) AS (VALUES ('part_001', 'part_003'), ('part_003', NULL), ('part_004', 'nowhere')), j AS (SELECT m.id, m.part_number, m.episode, o.id AS oid, o.epi, f.episode AS known FROM map m LEFT JOIN o ON o.id = m.id LEFT JOIN flat f ON f.episode = o.epi), "
    "k AS (SELECT *, CASE WHEN oid IS NULL THEN 'kept' WHEN epi IS NULL THEN 'not_on_site' WHEN known IS NULL THEN 'unknown_episode' ELSE 'bound' END AS outcome FROM j) "
    "SELECT id, part_number, CASE outcome WHEN 'bound' THEN epi WHEN 'not_on_site' THEN NULL ELSE episode END AS episode, outcome FROM k"
)
def q_toc_overrides(spark, d):
    return toc.overridden(_mapping(spark, d), spark.createDataFrame(_OVER, "id string, episode string"), _flat(spark, d))


@query(f"WITH {_FLAT} SELECT episode, position FROM flat WHERE episode NOT IN (SELECT episode FROM map WHERE episode IS NOT NULL)")
def q_toc_source_only_tail(spark, d):
    return toc.source_only(_flat(spark, d), _mapping(spark, d))


@query("SELECT o_orderkey, 1 + coalesce(sum((o_orderpriority = '1-URGENT')::INT) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS volume FROM orders")
def q_toc_volumes(spark, d):
    return toc.volumes(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "volume")


@query(
    f"WITH {ENTRIES}, p AS (SELECT id, part_number, mapping_confidence FROM entry WHERE part_number IS NOT NULL) SELECT a.id, b.id AS other, b.part_number - a.part_number AS distance FROM p a JOIN p b ON b.part_number BETWEEN a.part_number - 3 AND a.part_number + 3 WHERE a.mapping_confidence = 'needs_review'"
)
def q_toc_review_neighbours(spark, d):
    p = _entries(spark, d).where("part_number is not null").select("id", "part_number", "mapping_confidence")
    return toc.neighbours(p, p.where("mapping_confidence = 'needs_review'"))


@query(f"WITH {ENTRIES}, u AS (SELECT DISTINCT volume_number AS g, chapter_number AS n FROM entry WHERE volume_number IS NOT NULL AND chapter_number >= 1), s AS (SELECT g, n + 1 AS n FROM u UNION ALL SELECT DISTINCT g, 1 FROM u) SELECT s.g AS volume_number, min(s.n) AS next_free FROM s WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.g = s.g AND u.n = s.n) GROUP BY s.g")
def q_rule_next_index(spark, d):
    return toc.first_gaps(_entries(spark, d), "volume_number", "chapter_number")


@query(
    "WITH top AS (SELECT part_id, count(*) AS n FROM precedent WHERE part_id IS NOT NULL GROUP BY part_id), x AS (SELECT DISTINCT ph_id, part_id FROM phrase_precedent WHERE part_id IS NOT NULL) "
    "SELECT x.ph_id, x.part_id, coalesce(top.n, 0) + row_number() OVER (PARTITION BY x.part_id ORDER BY ph_id) AS number FROM x LEFT JOIN top USING (part_id)"
)
def q_issue_ids(spark, d):
    """Phrases numbered on from the passages of their part."""
    used = table(spark, d, "precedent").where("part_id is not null").groupBy("part_id").agg(F.count("*").alias("number"))
    new = table(spark, d, "phrase_precedent").where("part_id is not null").select("ph_id", "part_id").distinct()
    return toc.sequence_ids(new, used, "part_id", ["ph_id"], "number")


_SPLIT = r"regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')"
_LINES = f"ln AS (SELECT doc_id, list_filter(list_transform({_SPLIT}, lambda x: {trimmed('x')}), lambda x: x <> '') AS a FROM documents WHERE text IS NOT NULL)"


@query(f"WITH {_LINES} SELECT doc_id, (i - 1)::INT AS idx, a[i] AS paragraph FROM ln, unnest(range(1, len(a) + 1)) t(i)")
def q_paragraph_split(spark, d):
    return corpus.split_paragraphs(table(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {PARAS} SELECT side, CASE WHEN side = 'jp' AND left({trimmed('text')}, 1) IN ('“', '\"') THEN 'narration' ELSE {kind('text')} END AS found, coalesce(kind, 'none') AS given, count(*) AS n FROM para GROUP BY ALL")
def q_paragraph_kind(spark, d):
    return _paras(spark, d).groupBy("side", T.side_kind("text", "side").alias("found"), F.coalesce("kind", F.lit("none")).alias("given")).agg(F.count("*").alias("n"))


@query(r"SELECT id, CASE WHEN length(c) > 60 THEN left(c, 50) || '_' || left(sha1(url), 10) ELSE c END || '.html' AS name FROM (SELECT id, url, regexp_replace(regexp_replace(url, '^https?://', ''), '[^A-Za-z0-9._-]', '_', 'g') AS c FROM (SELECT DISTINCT id, url_jp || '?title=' || coalesce(title_en, '') AS url FROM toc WHERE url_jp IS NOT NULL))")
def q_page_safe_name(spark, d):
    urls = table(spark, d, "toc").where("url_jp is not null").select("id", F.concat("url_jp", F.lit("?title="), F.coalesce("title_en", F.lit(""))).alias("url")).distinct()
    return urls.select("id", T.safe_name("url", 60, 50).alias("name"))


@query(r"SELECT doc_id, unnest(regexp_extract_all(text, 'chapter (\d+)', 1)) AS chapter FROM documents")
def q_chapter_references(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"chapter (\d+)"), F.lit(1))).alias("chapter"))


# The alignment as recursion over diagonals: a cell is reached from cells one, two or three diagonals back, which are
# carried along by their age; the best total wins, the earlier shape on a tie. Then the path is followed back.
_SHAPE_ROWS = ", ".join(f"({k}, {a}, {b}, {math.log(p)!r}::DOUBLE)" for k, (a, b, p) in enumerate(align.SHAPES))
_STEPS = (
    f"{PARAS}, x AS (SELECT part_id, side, para_index, para_id, length({trimmed('text')}) AS n FROM para WHERE part_id IS NOT NULL AND side IN ('jp', 'en') AND {kind('text')} <> 'blank'), "
    "g AS (SELECT part_id, side, count(*) AS c, list(n ORDER BY para_index, para_id) AS ns, list(para_index ORDER BY para_index, para_id) AS ix FROM x GROUP BY part_id, side), "
    "u AS (SELECT part_id, side, c, ix, list_transform(range(0, c + 1), lambda k: list_sum(ns[1:k])) AS s0 FROM g), s AS (SELECT part_id, side, c, ix, list_transform(s0, lambda v: coalesce(v, 0)::DOUBLE) AS s FROM u), "
    "dim AS (SELECT j.part_id, j.c AS n, e.c AS m, j.s AS sj, e.s AS se, j.ix AS xj, e.ix AS xe FROM s j JOIN s e ON j.part_id = e.part_id AND j.side = 'jp' AND e.side = 'en'), "
    f"sh(k, a, b, prior) AS (VALUES {_SHAPE_ROWS}), "
    "cell(part_id, d, i, f, k, age) AS (SELECT part_id, 0::BIGINT, 0::BIGINT, 0.0::DOUBLE, -1, 0 FROM dim UNION ALL ("
    "WITH c AS (SELECT t.part_id, t.d + a + b AS d, t.i + a AS i, sh.k, t.f + CASE WHEN a * b = 0 THEN prior ELSE prior - pow(((se[t.d + a + b - t.i - a + 1] - se[t.d - t.i + 1]) - 2.77::DOUBLE * (sj[t.i + a + 1] - sj[t.i + 1])) / sqrt(13.0::DOUBLE * greatest(sj[t.i + a + 1] - sj[t.i + 1], 1.0)), 2) / 2 END AS f "
    "FROM cell t JOIN sh ON a + b = t.age + 1 JOIN dim ON dim.part_id = t.part_id WHERE t.i + a <= n AND t.d + b - t.i <= m) "
    "SELECT part_id, d, i, max(f), arg_max(k, (f, -k)), 0 FROM c GROUP BY part_id, d, i UNION ALL SELECT part_id, d, i, f, k, age + 1 FROM cell WHERE age < 2)), "
    "best AS (SELECT part_id, i, d - i AS j, k FROM cell WHERE age = 0), "
    "path(part_id, i, j, k) AS (SELECT best.part_id, i, j, k FROM best JOIN dim ON dim.part_id = best.part_id AND i = n AND j = m UNION ALL SELECT p.part_id, best.i, best.j, best.k FROM path p JOIN sh ON sh.k = p.k JOIN best ON best.part_id = p.part_id AND best.i = p.i - a AND best.j = p.j - b), "
    "step AS (SELECT part_id, a || ':' || b AS shape, CASE WHEN a > 0 THEN xj[i - a + 1] END AS jp_from, CASE WHEN a > 0 THEN xj[i] END AS jp_to, CASE WHEN b > 0 THEN xe[j - b + 1] END AS en_from, CASE WHEN b > 0 THEN xe[j] END AS en_to, "
    "CASE WHEN a * b = 0 THEN 0.0 ELSE round(exp(-pow(((se[j + 1] - se[j - b + 1]) - 2.77::DOUBLE * (sj[i + 1] - sj[i - a + 1])) / sqrt(13.0::DOUBLE * (sj[i + 1] - sj[i - a + 1])), 2) / 2), 6) END AS length_score FROM path JOIN sh USING (k) JOIN dim USING (part_id))"
)


@query(f"WITH RECURSIVE {_STEPS} SELECT * FROM step")
def q_align_length_dp(spark, d):
    return align.aligned(_paras(spark, d))


@query(f"WITH RECURSIVE {_STEPS} SELECT shape, count(*) AS n FROM step GROUP BY shape")
def q_align_shape_counts(spark, d):
    return align.shape_counts(align.aligned(_paras(spark, d)))


@query(
    f"WITH {PARAS}, k AS (SELECT part_id, side, para_index, para_id, {kind('text')} = 'dialogue' AS d FROM para WHERE part_id IS NOT NULL), "
    "s AS (SELECT *, d AND NOT coalesce(lag(d) OVER (PARTITION BY part_id, side ORDER BY para_index, para_id), false) AS b FROM k), "
    "r AS (SELECT *, count(*) FILTER (b) OVER (PARTITION BY part_id, side ORDER BY para_index, para_id) AS run FROM s) SELECT part_id, side, run, min(para_index) AS first, count(*) AS lines FROM r WHERE d GROUP BY part_id, side, run"
)
def q_dialogue_turns(spark, d):
    return sections.dialogue_turns(_paras(spark, d).where("part_id is not null"), ["part_id", "side"], ["para_index", "para_id"])
