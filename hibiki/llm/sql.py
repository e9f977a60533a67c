"""DuckDB SQL of those pN_ queries that SQL can state: the others are tested against brute force, round trips or held-out texts."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_T = r"regexp_replace(raw_response, '\s+$', '')"
ORACLE["p1_lengths"] = (
    f"WITH r AS (SELECT model, {_T} AS t FROM raw_cache WHERE trim(raw_response) <> ''), u AS (SELECT model, t, 'chars' AS unit, length(t) AS len FROM r UNION ALL SELECT model, t, 'bytes', strlen(t) FROM r) "
    "SELECT model, unit, len, count(*) AS n, count(DISTINCT t) AS n_distinct FROM u GROUP BY model, unit, len"
)

_LETTERS = r"regexp_replace(t, '[^\p{L}\p{N}]', '', 'g')"
ORACLE["p2_conserved"] = (
    "WITH x AS (SELECT DISTINCT 'paragraphs' AS tbl, para_id AS id, text AS t FROM paragraphs UNION ALL SELECT 'precedent', pr_id, jp_text FROM precedent) "
    f"SELECT tbl, count(DISTINCT id) AS rows, sum(length({_LETTERS}))::BIGINT AS letters FROM x WHERE length({_LETTERS}) > 0 GROUP BY tbl"
)

_SPLIT = "l AS (SELECT DISTINCT unnest(part_ids) AS id, split AS s FROM holdout), r AS (SELECT pr_id, jp_text, CASE WHEN part_id IS NOT NULL THEN coalesce(s, 'train') END AS split FROM precedent LEFT JOIN l ON l.id = part_id)"
ORACLE["p3_splits"] = f"WITH {_SPLIT} SELECT split, count(*) AS records, count(jp_text) AS texts FROM r GROUP BY split"
# the 20 characters count without white space and punctuation
ORACLE["p3_same"] = (
    f"WITH {_SPLIT} SELECT a.pr_id AS eval_id, b.pr_id AS train_id FROM r a JOIN r b ON a.jp_text = b.jp_text WHERE a.split <> 'train' AND b.split = 'train' "
    r"AND length(regexp_replace(a.jp_text, '[\p{P}\p{Z}\p{C}\s]+', '', 'g')) >= 20"
)

ORACLE["p4_checked"] = "SELECT unnest(['across documents', 'across rows', 'no unit''s start', 'twice']) AS fault, 0::BIGINT AS n"

_VEC = "list_transform(embedding, lambda x: x::DOUBLE)"
ORACLE["p5_exact"] = (
    f"WITH v AS (SELECT DISTINCT row_id, {_VEC} AS e FROM precedent_embedding WHERE len(embedding) = 96 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0), w AS (SELECT row_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE list_dot_product(e, e) > 0), "
    "s AS (SELECT q.row_id AS id, t.row_id AS neighbour, round(list_dot_product(q.e, t.e) / (q.n * t.n), 6) AS cos FROM w q, w t WHERE q.row_id % 50 = 0 AND q.row_id <> t.row_id), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cos DESC, neighbour)::INT AS rank FROM s) SELECT id, neighbour, cos, rank FROM k WHERE rank <= 10"
)

ORACLE["p6_checked"] = (
    "WITH x AS (SELECT DISTINCT 'paragraph' AS unit, para_id AS id, text AS t FROM paragraphs UNION ALL SELECT DISTINCT 'phrase', ph_id, jp_span FROM phrase_precedent) "
    "SELECT unit, count(*) AS rows, count(t) AS forms, 0::BIGINT AS unseen, 0::BIGINT AS wide, 0::BIGINT AS spaces FROM x GROUP BY unit"
)

ORACLE["p7_checked"] = "SELECT spec_name, capacity_tokens::BIGINT AS capacity_tokens, (SELECT count(*) FROM documents) AS documents, 0::BIGINT AS not_whole, 0::BIGINT AS split_without_need, 0::BIGINT AS over_full FROM packing_spec"
ORACLE["p8_checked"] = "SELECT source, max_repeats::BIGINT AS max_repeats, 0::BIGINT AS astray, 0::BIGINT AS too_often, 0::BIGINT AS twice, true AS near_target FROM mix_target"

_LINES = r"list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'), lambda x: regexp_replace(x, '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g')), lambda x: x <> '')"
ORACLE["p9_counts"] = (
    f"WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_LINES} AS a FROM documents) SELECT doc_id, length(text) AS n_chars, len(a)::BIGINT AS n_lines, round(CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_filter(a, lambda x: length(x) < 20))::DOUBLE / len(a) END, 6) AS short_lines, "
    "round(CASE WHEN len(a) = 0 THEN 0.0 ELSE 100 * (length(text) - length(replace(text, ',', '')))::DOUBLE / length(text) END, 6) AS commas_per_100 FROM d"
)
