"""Queries over contents pages, retrieval with text de-duplication, spans in their sources, notes, scores and mined comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.operators import answers, audit, corpus, holdout, ledger, links, mining, notes, retrieve, scores, sections
from hibiki.session import table

from .corpus_queries import _IN, POVS, _entries
from .ledger_queries import _ISSUE, _RUN, _issues, _run
from .registry import ENTRIES, PARAS, WS, query, squeezed, trimmed, visible


def literal(name: str, columns: str, rows: list[tuple]) -> str:
    """A CTE of literal rows, for pages and chats that no table holds."""

    def one(v) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)})"


# A contents page: links (page, block, place, label, href, text of the block) and the blocks where a volume ends.
LINKS = [
    ("p", 1, 0, "Part 1", "https://a.example/1", "Chapter One – A quiet room (Miyagi PoV) [Part 1] [Part 2]"),
    ("p", 1, 1, "Part 2", "https://a.example/2", "Chapter One – A quiet room (Miyagi PoV) [Part 1] [Part 2]"),
    ("p", 2, 2, "Part 3", "https://a.example/3", "Chapter Twenty-two - The pier (Sendai PoVs) [Part 3]"),
    ("p", 3, 3, "Interlude", "https://a.example/i", "Chapter Two – Volume One Interlude [Interlude]"),
    ("p", 5, 4, "Extra", "https://a.example/x", "Chapter Three – Rain (Sendai PoV) [Part 4] Volume Two Extra (Both PoVs) [Extra]"),
    ("p", 6, 5, "Maika Side Story", "https://a.example/m", "Maika Side Story Vol. 7, read after Part 12 [Side Story]"),
    ("p", 7, 6, "Part 1", "https://a.example/s", "April Fool special chapter (Both PoVs)"),
    ("p", 8, 7, "BookWalker bonus", "https://a.example/b", "Volume Two Side Story on BookWalker"),
    ("p", 9, 8, "Afterword", "https://a.example/a", "Afterword"),
    ("p", 10, 9, "Side Story", "https://a.example/t", "A side story of the summer, vol. 3"),
    ("q", 0, 0, "Part 120", "https://b.example/120", "Chapter thirty – 　 (maika pov) [Part 120]"),
    ("q", 2, 1, None, "https://b.example/0", None),
]
BREAKS = [("p", 4), ("p", 8), ("q", 1)]
_LINK_COLUMNS = "page, block_index, pos, label, href, block"
_NUMBERS = ", ".join(f"('{w}', {n})" for n, w in [*((n, w) for w, n in T.UNITS.items()), *((t, w) for w, t in T.TENS.items()), *((t + u, f"{w}{x}") for w, t in T.TENS.items() for x, u in T.UNITS.items() if u < 10)])
_TAG = r"'\((Miyagi|Sendai|Maika|Both)\s*PoVs?\)'"
_KIND = (
    "CASE WHEN contains(b, 'april fool') OR contains(b, 'special chapter') THEN 'special' WHEN contains(b, 'bookwalker') OR contains(a, 'bookwalker') THEN 'bookwalker' "
    "WHEN contains(b, 'maika side story') OR contains(b, 'maika ss') THEN 'side_story_maika' WHEN contains(b, 'interlude') THEN 'interlude' WHEN contains(b, 'extra') AND contains(a, 'extra') THEN 'extra' "
    "WHEN starts_with(a, 'part') THEN 'part' WHEN contains(b, 'side story') THEN 'side_story_maika' ELSE 'part' END"
)
_CONTENTS = (
    literal("link", _LINK_COLUMNS, LINKS) + ", " + literal("br", "page, block_index", BREAKS) + f", num(w, n) AS (VALUES {_NUMBERS}), "
    "r AS (SELECT *, lower(coalesce(label, '')) AS a, lower(coalesce(block, '')) AS b, coalesce(label, '') AS l, coalesce(block, '') AS t, 1 + (SELECT count(*) FROM br WHERE br.page = link.page AND br.block_index < link.block_index) AS v FROM link), "
    f"k AS (SELECT *, {_KIND} AS kind FROM r), "
    r"m AS (SELECT *, CASE WHEN kind <> 'special' THEN TRY_CAST(regexp_extract(l, '^part\s+(\d+)', 1, 'i') AS INT) END AS part_number, "
    r"(CASE WHEN kind = 'side_story_maika' THEN coalesce(TRY_CAST(regexp_extract(t, 'vol\.\s*(\d+)', 1, 'i') AS INT), v) ELSE v END)::INT AS volume, "
    r"regexp_replace(lower(regexp_extract(t, 'Chapter\s+([A-Za-z\-]+)', 1, 'i')), '[\s-]', '', 'g') AS w, "
    f"CASE WHEN l = '' OR instr(t, l) = 0 THEN '' ELSE left(t, length(t) - length(string_split(t, l)[-1]) - length(l)) END AS head, "
    f"regexp_extract_all(t, {_TAG}, 1, 'i') AS tags FROM k), "
    f"n AS (SELECT m.*, num.n AS chapter_number, row_number() OVER (PARTITION BY page, volume ORDER BY pos) AS idx, lower(coalesce(regexp_extract_all(head, {_TAG}, 1, 'i')[-1], tags[1])) AS tag FROM m LEFT JOIN num USING (w)), "
    r"c AS (SELECT *, regexp_replace(t, '^Chapter\s+[A-Za-z\-]+\s*[–\-]\s*', '', 'i') AS t1 FROM n), "
    f"d AS (SELECT *, {trimmed(f'regexp_replace(t1, {_TAG}, {chr(39)}{chr(39)}, {chr(39)}gi{chr(39)})')} AS t2 FROM c), "
    rf"e AS (SELECT *, {trimmed(chr(114) + 'egexp_replace(t2, ' + chr(39) + '[[](?:Part|Interlude|Extra|Side Story).*' + chr(39) + ', ' + chr(39) * 2 + ')')} AS t3 FROM d), "
    r"entry2 AS (SELECT page, pos, CASE WHEN kind = 'part' AND part_number IS NOT NULL THEN printf('part_%03d', part_number) WHEN kind IN ('interlude', 'extra', 'bookwalker') THEN kind || '_v' || volume "
    r"WHEN kind = 'side_story_maika' THEN 'maika_ss_v' || volume WHEN kind = 'special' THEN printf('special_%02d', volume) ELSE printf('unknown_v%d_%02d', volume, idx) END AS id, kind, part_number, chapter_number, "
    r"CASE WHEN kind = 'interlude' THEN chapter_number + 0.5::DOUBLE END AS chapter_subnumber, volume AS volume_number, "
    r"CASE WHEN kind = 'side_story_maika' THEN 'maika' WHEN tag IS NULL THEN CASE kind WHEN 'interlude' THEN 'sendai' ELSE 'miyagi' END WHEN tag IN ('miyagi', 'sendai', 'maika') THEN tag ELSE 'both' END AS pov, "
    rf"label AS title_en, href AS url_en, nullif({trimmed(chr(114) + 'egexp_replace(t3, ' + chr(39) + '[–-]+$' + chr(39) + ', ' + chr(39) * 2 + ')')}, '') AS chapter_title_en, "
    r"TRY_CAST(regexp_extract(t, 'read after part\s+(\d+)', 1, 'i') AS INT) AS read_after_part, CASE WHEN kind IN ('interlude', 'extra', 'side_story_maika', 'bookwalker', 'special') THEN 'manual' ELSE 'auto' END AS mapping_confidence, "
    r"CASE WHEN kind IN ('interlude', 'extra', 'side_story_maika', 'bookwalker', 'special') THEN 'LN-exclusive (no web-novel source on Kakuyomu)' END AS notes FROM e)"
)
EPISODES = [("e1", 0), ("e2", 1), ("e3", 2), ("e4", 3)]
OVERRIDES = [("part_002", "e4"), ("part_003", None)]


def _links(spark) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame(LINKS, "page string, block_index int, pos int, label string, href string, block string"), spark.createDataFrame(BREAKS, "page string, block_index int")


@query(f"WITH {_CONTENTS} SELECT * FROM entry2")
def q_toc_links(spark, d):
    """The typed entries of a contents page's links."""
    return links.contents(*_links(spark))


@query(
    f"WITH {_CONTENTS}, {literal('epi', 'episode, position', EPISODES)}, {literal('o', 'oid, ep', OVERRIDES)}, p AS (SELECT id, part_number, epi.episode AS e0, oid, ep, k.episode AS known FROM entry2 LEFT JOIN epi ON epi.position + 1 = part_number LEFT JOIN o ON oid = id LEFT JOIN epi k ON k.episode = ep "
    "WHERE kind = 'part' AND part_number IS NOT NULL), x AS (SELECT id, part_number, CASE WHEN oid IS NULL THEN 'kept' WHEN ep IS NULL THEN 'not_on_site' WHEN known IS NULL THEN 'unknown_episode' ELSE 'bound' END AS outcome, e0, ep FROM p), "
    "y AS (SELECT id, 'part' AS kind, part_number, CASE outcome WHEN 'bound' THEN ep WHEN 'not_on_site' THEN NULL ELSE e0 END AS episode, outcome FROM x) SELECT * FROM y "
    "UNION ALL SELECT id, kind, part_number, NULL, 'kept' FROM entry2 WHERE kind <> 'part' OR part_number IS NULL "
    "UNION ALL SELECT 'source_' || episode, 'source_only', NULL, episode, 'source_only' FROM epi WHERE episode NOT IN (SELECT episode FROM y WHERE episode IS NOT NULL)"
)
def q_toc_build(spark, d):
    """The whole contents: entries, positional binding, overrides, and the source's tail."""
    return links.build_contents(*_links(spark), spark.createDataFrame(EPISODES, "episode string, position int"), spark.createDataFrame(OVERRIDES, "id string, episode string"))


# Retrieval over the passages: queries are every row whose id 50 divides, rows those of parts that aren't held out.
_VEC = "list_transform(embedding, lambda x: x::DOUBLE)"
_FOUND = (
    f"held AS (SELECT DISTINCT unnest(part_ids) AS id FROM holdout), v AS (SELECT row_id, part_id, jp_text, en_text, {_VEC} AS e FROM precedent_embedding JOIN precedent ON pr_id = row_id WHERE len(embedding) = 96), "
    "w AS (SELECT *, CASE WHEN list_dot_product(e, e) = 0 THEN 1 ELSE sqrt(list_dot_product(e, e)) END AS n FROM v), t AS (SELECT * FROM w WHERE coalesce(part_id NOT IN (SELECT id FROM held), true)), "
    "s AS (SELECT q.row_id AS q, t.row_id, t.jp_text, t.en_text, round(list_dot_product(q.e, t.e) / (q.n * t.n), 6) AS score FROM w q, t WHERE q.row_id % 50 = 0 AND q.row_id <> t.row_id), "
    "h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, row_id) AS rank FROM s) WHERE rank <= 10)"
)
_TWICE = (
    "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY q, rank) AS a FROM h) WHERE a = 1), g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY jp_text, en_text ORDER BY q, rank) AS b FROM f) WHERE b = 1)"
)


def _found(spark, d) -> DataFrame:
    v = table(spark, d, "precedent_embedding").where("size(embedding) = 96").withColumn("all", F.lit(0))
    p = table(spark, d, "precedent").select(F.col("pr_id").alias("row_id"), "part_id", "jp_text", "en_text")
    held = table(spark, d, "holdout").select(F.explode("part_ids").alias("part_id")).distinct()
    rows = v.join(retrieve.outside(p, held, "part_id").select("row_id"), "row_id", "left_semi")
    queries = v.where("row_id % 50 = 0").join(p.select("row_id"), "row_id", "left_semi")
    return retrieve.topk(queries, rows, "row_id", "embedding", "all", 10).join(p, "row_id")


@query(f"WITH {_FOUND}, {_TWICE} SELECT q, row_id, score, jp_text, en_text FROM g ORDER BY score DESC, q, rank LIMIT 40")
def q_passages_retrieved(spark, d):
    """Passages for the queries: a row once, then a pair of texts once, by the first query that found it; the 40 best."""
    return retrieve.retrieved(_found(spark, d), [["row_id"], ["jp_text", "en_text"]], 40).select("q", "row_id", "score", "jp_text", "en_text")


@query(f"WITH {_FOUND.replace('WHERE rank <= 10', 'WHERE rank <= 10 AND score >= 0.5')}, g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY jp_text, en_text ORDER BY q, rank) AS b FROM h) WHERE b = 1) SELECT q, row_id, score FROM g ORDER BY score DESC, q, rank LIMIT 30")
def q_phrases_retrieved(spark, d):
    """The phrase variant: a score floor, a pair of spans once, the 30 best."""
    return retrieve.retrieved(_found(spark, d).where("score >= 0.5"), [["jp_text", "en_text"]], 30).select("q", "row_id", "score")


@query("SELECT p.pr_id, e.row_id IS NOT NULL AS has_row, coalesce(len(e.embedding), 0)::INT AS dims, p.pr_id IS NOT NULL AS has_pair FROM precedent p FULL JOIN precedent_embedding e ON e.row_id = p.pr_id")
def q_pairs_with_vectors(spark, d):
    """Pairs and their vectors by row, with what either lacks."""
    e = table(spark, d, "precedent_embedding").select("row_id", "embedding")
    j = table(spark, d, "precedent").select("pr_id").join(e, F.col("row_id") == F.col("pr_id"), "full")
    return j.select("pr_id", F.col("row_id").isNotNull().alias("has_row"), F.coalesce(F.when(F.col("embedding").isNotNull(), F.size("embedding")), F.lit(0)).alias("dims"), F.col("pr_id").isNotNull().alias("has_pair"))


_KEYED = lambda x: f"lower({squeezed(x)})"
_SOURCE = (
    f"{PARAS}, src AS (SELECT part_id, side, string_agg({_KEYED('text')}, '' ORDER BY para_index, para_id) AS key FROM para WHERE part_id IS NOT NULL GROUP BY part_id, side), "
    f"ph AS (SELECT DISTINCT ph_id, part_id, jp_span, en_span FROM phrase_precedent), "
    f"z AS (SELECT ph.*, j.part_id IS NOT NULL AS has_source, CASE WHEN {_KEYED('jp_span')} <> '' THEN coalesce(instr(j.key, {_KEYED('jp_span')}), 0) ELSE 0 END AS spot, coalesce({_KEYED('jp_span')} = '' OR instr(j.key, {_KEYED('jp_span')}) > 0, false) AS jp_ok, coalesce({_KEYED('en_span')} = '' OR instr(e.key, {_KEYED('en_span')}) > 0, false) AS en_ok, coalesce(length(j.key), 0) AS source_chars "
    "FROM ph LEFT JOIN src j ON j.part_id = ph.part_id AND j.side = 'jp' LEFT JOIN src e ON e.part_id = ph.part_id AND e.side = 'en')"
)


def _spans(spark, d) -> DataFrame:
    return audit.spans_in_sources(table(spark, d, "phrase_precedent").select("ph_id", "part_id", "jp_span", "en_span").distinct(), table(spark, d, "paragraphs").select("para_id", "part_id", "side", "para_index", "kind", "text"))


@query(f"WITH {_SOURCE} SELECT ph_id, jp_ok, en_ok, jp_ok AND en_ok AS kept FROM z")
def q_verbatim_phrases(spark, d):
    """Which phrases stand in their parts' sources, with both spans."""
    return _spans(spark, d).select("ph_id", "jp_ok", "en_ok", (F.col("jp_ok") & F.col("en_ok")).alias("kept"))


@query(
    f"WITH {_SOURCE} SELECT part_id, count(*) AS phrases, count(*) FILTER (jp_ok AND en_ok) AS survivors, count(*) FILTER (NOT (jp_ok AND en_ok)) AS dropped, max(source_chars)::BIGINT AS source_chars, "
    "max(source_chars) > 2000 AND count(*) FILTER (jp_ok AND en_ok) < 5 AS too_few FROM z WHERE part_id IS NOT NULL GROUP BY part_id"
)
def q_phrase_yield(spark, d):
    return audit.phrase_yield(_spans(spark, d))


@query(
    f"WITH {_SOURCE}, o AS (SELECT part_id, spot < lag(spot) OVER (PARTITION BY part_id ORDER BY ph_id, spot) AS back FROM z WHERE part_id IS NOT NULL AND spot > 0) SELECT part_id, count(*) AS n, count(*) FILTER (back) AS inversions FROM o GROUP BY part_id"
)
def q_span_inversions(spark, d):
    """Phrases that stand in another order than in their source."""
    placed = _spans(spark, d).where("part_id is not null and at > 0")
    return audit.inversions(placed, ["part_id"], ["ph_id", "at"], "at")


@query(f"WITH {_SOURCE} SELECT count(*) AS n, count(*) FILTER (NOT en_ok) AS misses, round(count(*) FILTER (NOT en_ok)::DOUBLE / greatest(count(*), 1), 6) AS rate FROM z")
def q_span_misses(spark, d):
    return audit.span_misses(_spans(spark, d), 8)[0]


@query(f"WITH {_SOURCE}, g AS (SELECT part_id, count(*) AS n, count(*) FILTER (NOT en_ok) AS misses FROM z WHERE part_id IS NOT NULL GROUP BY part_id) SELECT *, round(misses::DOUBLE / n, 6) AS rate FROM g WHERE misses > 0 ORDER BY misses DESC, part_id LIMIT 8")
def q_span_misses_worst(spark, d):
    """The eight parts with the most missing spans: a report."""
    return audit.span_misses(_spans(spark, d), 8)[1]


CATEGORIES = [("set_phrase", "Set phrase", "fixed wording"), ("onomatopoeia", "Sound word", "sounds and moods"), ("register", "Register", "level of speech"), ("other", "Other", "anything else")]


@query(
    f"WITH {literal('reg', 'key, label, description', CATEGORIES)}, p AS (SELECT coalesce(reg.key, 'other') AS category FROM phrase_precedent LEFT JOIN reg ON lower(trim(category)) = reg.key) SELECT category, label, description, count(*) AS n FROM p JOIN reg ON reg.key = category GROUP BY ALL"
)
def q_category_labels(spark, d):
    """Phrases by the category that a registry knows, with its label."""
    reg = spark.createDataFrame(CATEGORIES, "key string, label string, description string")
    return answers.registered(table(spark, d, "phrase_precedent").select("category"), "category", reg).groupBy("category", "label", "description").agg(F.count("*").alias("n"))


PROFILE = [("d1", "intro\n## 2. the VOICE\nfirst\n## 1) tone of it\nsoft\n\n## 2. Voice again\n\nsecond\n## 40. none\nx"), ("d2", "# 16: other\nlast")]
SECTIONS = [
    ("d1", 1, "Tone", "01-tone.md", "## 1. Tone\n\nsoft"), ("d1", 2, "Voice", "02-voice.md", "## 2. Voice\n\nsecond"),
    ("d2", 16, "Character voice differentiation", "16-character-voice-differentiation.md", "## 16. Character voice differentiation\n\nlast"),
]


@query(f"WITH {literal('s', 'doc, number, name, file, body', SECTIONS)} SELECT * FROM s")
def q_style_sections(spark, d):
    """Numbered sections of literal documents, against stored rows."""
    return sections.style_sections(spark.createDataFrame(PROFILE, "doc string, text string"), "doc", "text")


@query(f"WITH {_FOUND}, x AS (SELECT CASE WHEN score >= 0.8 THEN 'phrase' ELSE 'paragraph' END AS kind FROM h) SELECT count(*) FILTER (kind = 'phrase') AS phrase, count(*) FILTER (kind = 'paragraph') AS paragraph, count(*) AS total, count(*) = 0 AS is_empty FROM x")
def q_result_flags(spark, d):
    return retrieve.result_flags(_found(spark, d).select(F.when(F.col("score") >= 0.8, "phrase").otherwise("paragraph").alias("kind")), ["phrase", "paragraph"])


@query(
    "WITH r AS (SELECT part_id, avg((length_score < 0.5)::INT) AS rate FROM precedent WHERE part_id IS NOT NULL AND length_score IS NOT NULL GROUP BY part_id) "
    "SELECT count(*) AS parts, round(avg(rate), 6) AS mean, round(quantile_cont(rate, 0.5), 6) AS median, round(max(rate), 6) AS max FROM r"
)
def q_borderline_spread(spark, d):
    """How the share of borderline pairs varies over the parts."""
    per = table(spark, d, "precedent").where("part_id is not null and length_score is not null").groupBy("part_id").agg(F.avg((F.col("length_score") < 0.5).cast("int")).alias("rate"))
    return per.agg(F.count("*").alias("parts"), F.round(F.avg("rate"), 6).alias("mean"), F.round(F.percentile("rate", 0.5), 6).alias("median"), F.round(F.max("rate"), 6).alias("max"))


@query(
    "WITH c AS (SELECT quantile_disc(query_score, 0.05) AS floor FROM precedent WHERE shape = '1:1' AND query_score IS NOT NULL) SELECT part_id, count(*) AS n, count(*) FILTER (coalesce(query_score, 1.0) < floor AND length_score >= 0.3) AS suspects, round(quantile_cont(query_score, 0.5), 6) AS median FROM precedent, c WHERE part_id IS NOT NULL GROUP BY part_id"
)
def q_suspects_by_part(spark, d):
    """Pairs that fit in length but are less alike than 95 % of the one-to-one pairs, by part."""
    p = table(spark, d, "precedent")
    floor = F.broadcast(p.where("shape = '1:1' and query_score is not null").agg(F.expr("percentile_disc(0.05) WITHIN GROUP (ORDER BY query_score)").alias("floor")))  # one row
    j = p.where("part_id is not null").join(floor, F.lit(True))
    return j.groupBy("part_id").agg(F.count("*").alias("n"), F.count_if((F.coalesce("query_score", F.lit(1.0)) < F.col("floor")) & (F.col("length_score") >= 0.3)).alias("suspects"), F.round(F.percentile("query_score", 0.5), 6).alias("median"))


_TARGETS = f"{ENTRIES}, target AS (SELECT * FROM entry WHERE kind = 'part' AND part_number IS NOT NULL AND pov IN {_IN})"


@query(f"WITH {_TARGETS} SELECT id FROM entry WHERE id IN ('part_003', 'part_001', 'interlude_v1')")
def q_selected_only(spark, d):
    """Entries named one by one, whatever the scope."""
    return corpus.selected(_entries(spark, d), corpus.is_target(POVS), only=["part_003", "part_001", "interlude_v1"]).select("id")


@query(f"WITH {_TARGETS} SELECT id FROM target ORDER BY part_number, id LIMIT 12")
def q_selected_first(spark, d):
    """The first twelve entries of the scope: the limit is the feature."""
    return corpus.selected(_entries(spark, d), corpus.is_target(POVS), limit=12).select("id")


@query(
    f"WITH {_TARGETS}, {PARAS}, held AS (SELECT DISTINCT unnest(part_ids) AS id FROM holdout), en AS (SELECT part_id, sum({visible('text')})::BIGINT AS chars FROM para WHERE side = 'en' AND part_id IS NOT NULL GROUP BY part_id HAVING sum({visible('text')}) > 0), "
    "g AS (SELECT t.id, t.pov, en.chars, t.id IN (SELECT id FROM held) AS held FROM target t JOIN en ON en.part_id = t.id WHERE t.part_number <= 150) SELECT pov, count(*) FILTER (NOT held) AS parts, coalesce(sum(chars) FILTER (NOT held), 0)::BIGINT AS chars, count(*) FILTER (held) AS skipped_holdout FROM g GROUP BY pov"
)
def q_style_corpus(spark, d):
    """What a style profile may be taken from: translated parts up to a number, without held-out ones, which are counted."""
    en = corpus.side_counts(corpus.paragraphs(table(spark, d, "paragraphs"))).where("side = 'en' and chars > 0").select(F.col("part_id").alias("id"), "chars")
    held = table(spark, d, "holdout").select(F.explode("part_ids").alias("id"))
    parts = holdout.style_corpus(_entries(spark, d).where(corpus.is_target(POVS)).join(en, "id"), held, 150)
    ok = ~F.col("held")
    return parts.groupBy("pov").agg(F.count_if(ok).alias("parts"), F.coalesce(F.sum(F.when(ok, F.col("chars"))), F.lit(0)).alias("chars"), F.count_if("held").alias("skipped_holdout"))


@query("SELECT pr_id, left(jp_text, 80) AS jp, left(en_text, 120) AS en FROM precedent WHERE length_score < 0.5")
def q_suspect_samples(spark, d):
    """Suspect pairs, their texts shortened for a report."""
    return table(spark, d, "precedent").where("length_score < 0.5").select("pr_id", F.left("jp_text", F.lit(80)).alias("jp"), F.left("en_text", F.lit(120)).alias("en"))


@query(
    f"WITH {_RUN}, {_ISSUE}, now AS (SELECT * FROM run WHERE label = '2024-01-02'), old AS (SELECT * FROM run WHERE label = '2024-01-01') SELECT now.issue, part, category, now.verdict, old.verdict AS baseline_verdict, "
    "CASE WHEN old.verdict = 'RESOLVED' AND now.verdict = 'PRESENT' THEN 'regression' WHEN old.verdict = 'PRESENT' AND now.verdict = 'RESOLVED' THEN 'improvement' END AS change FROM now JOIN issue USING (issue) LEFT JOIN old ON old.issue = now.issue"
)
def q_report_rows(spark, d):
    run = _run(spark, d)
    return scores.report_rows(run.where("label = '2024-01-02'").select("issue", "verdict"), _issues(spark, d), run.where("label = '2024-01-01'").select("issue", "verdict"))


@query(
    "SELECT CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS area, CASE WHEN grouping(mapping_confidence) = 1 THEN 'all' ELSE mapping_confidence END AS state, count(*) AS n FROM toc GROUP BY GROUPING SETS ((), (kind), (kind, mapping_confidence))"
)
def q_status_counts(spark, d):
    return scores.status_counts(table(spark, d, "toc"), "kind", "mapping_confidence")


_STATUS = "CASE WHEN raw_response IS NULL THEN 'skipped' WHEN trim(raw_response) = '' THEN 'error' ELSE 'ok' END"


@query(
    f"WITH s AS (SELECT model, {_STATUS} AS s FROM raw_cache) SELECT model, count(*) FILTER (s <> 'skipped') AS attempted, count(*) FILTER (s = 'ok') AS succeeded, count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'error') AS errors FROM s GROUP BY model"
)
def q_fetch_counters(spark, d):
    return scores.scrape_counters(table(spark, d, "raw_cache").select("model", F.expr(_STATUS).alias("status")), "model", "status")


@query("SELECT l_orderkey, count(*) AS n, round(avg((l_quantity + l_linenumber + l_discount + l_tax) / 4), 6) AS mean FROM lineitem GROUP BY l_orderkey")
def q_judge_means(spark, d):
    """The mean of four axes a row, then of a group's rows."""
    axes = [F.col(c).cast("double") for c in ("l_quantity", "l_linenumber", "l_discount", "l_tax")]
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.avg(scores.judge_mean(axes)), 6).alias("mean"))


@query("SELECT 'length_score' AS metric, count(length_score) AS n, round(avg(length_score), 6) AS mean FROM precedent UNION ALL SELECT 'query_score', count(query_score), round(avg(query_score), 6) FROM precedent")
def q_score_means(spark, d):
    return scores.score_means(table(spark, d, "precedent"), ["length_score", "query_score"])


@query(
    f"WITH {ENTRIES}, {PARAS}, c AS (SELECT part_id, side, count(*) AS n FROM para WHERE part_id IS NOT NULL GROUP BY part_id, side) SELECT e.id, j.n AS output, k.n AS reference FROM entry e JOIN c j ON j.part_id = e.id AND j.side = 'jp' JOIN c k ON k.part_id = e.id AND k.side = 'en'"
)
def q_score_inputs(spark, d):
    """Parts that have both sides, with the rows of either."""
    n = corpus.paragraphs(table(spark, d, "paragraphs")).where("part_id is not null").groupBy(F.col("part_id").alias("id"), "side").agg(F.count("*").alias("n"))
    return scores.score_inputs(_entries(spark, d), n.where("side = 'jp'").select("id", F.col("n").alias("output")), n.where("side = 'en'").select("id", F.col("n").alias("reference")), "id")


@query(
    "WITH s AS (SELECT count(*) AS chapters_evaluated, round(avg(length_score), 6) AS length_score_mean, round(avg(query_score), 6) AS query_score_mean FROM precedent), "
    "r AS (SELECT CASE p_size % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'pruned' ELSE 'inactive' END AS state, p_size % 5 AS changed FROM part), q AS (SELECT count(*) FILTER (changed = 2 AND state = 'active') AS rules_added, count(*) FILTER (changed = 2 AND state = 'pruned') AS rules_pruned, "
    "count(*) FILTER (changed = 2 AND state = 'inactive') AS rules_inactive, count(*) FILTER (state = 'active') AS rules_active_total FROM r) SELECT 2 AS round, s.*, q.* FROM s, q"
)
def q_round_summary(spark, d):
    rules = table(spark, d, "part").select(F.when(F.col("p_size") % 3 == 0, "active").when(F.col("p_size") % 3 == 1, "pruned").otherwise("inactive").alias("state"), (F.col("p_size") % 5).alias("changed_round"))
    return scores.round_summary(table(spark, d, "precedent").select("length_score", "query_score"), ["length_score", "query_score"], rules, 2)


_RULE = "'rule-' || lpad(p_partkey::VARCHAR, 6, '0')"


def _rules(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        F.concat(F.lit("rule-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("id"), F.lit("active").alias("state"), F.array("p_brand").alias("pov_scope"), F.array().cast("array<string>").alias("scene_scope"), F.col("p_size").alias("priority"),
        F.array(F.lit("part-011-r01-d01"), F.lit("part-012-r01-d02")).alias("supporting"), F.lit(1).alias("created_round"), F.lit(None).cast("int").alias("last_validated_round"), F.lit(None).cast("double").alias("score_delta"),
        F.when(F.col("p_size") > 40, "stale").alias("prune_reason"), F.col("p_name").alias("text"), F.when(F.col("p_size") < 10, F.col("p_type")).alias("extra"),
    )


@query(
    f"SELECT {_RULE} AS id, '---' || chr(10) || 'id: ' || {_RULE} || chr(10) || 'state: active' || chr(10) || 'pov_scope:' || chr(10) || '- ' || p_brand || chr(10) || 'scene_scope: []' || chr(10) || 'priority: ' || p_size || chr(10) || "
    "'supporting_deviations:' || chr(10) || '- part-011-r01-d01' || chr(10) || '- part-012-r01-d02' || chr(10) || 'created_round: 1' || chr(10) || CASE WHEN p_size > 40 THEN 'prune_reason: stale' || chr(10) ELSE '' END || '---' || chr(10) || chr(10) || "
    "'# Rule' || chr(10) || chr(10) || p_name || chr(10) || CASE WHEN p_size < 10 THEN chr(10) || p_type || chr(10) ELSE '' END AS note FROM part"
)
def q_rule_notes(spark, d):
    return _rules(spark, d).select("id", notes.rule_note().alias("note"))


@query(
    f"SELECT {_RULE} AS id, '- [' || {_RULE} || '] ' || p_name || ' (pov_scope=[''' || p_brand || '''], scene_scope=[], priority=' || p_size || CASE WHEN p_size > 40 THEN ', prune_reason=stale' ELSE '' END || ')' AS line, '011' AS chapter FROM part"
)
def q_rule_lines(spark, d):
    return _rules(spark, d).select("id", notes.rule_line().alias("line"), notes.chapter_of(F.col("supporting")).alias("chapter"))


@query(
    "WITH d AS (SELECT DISTINCT part_id, chapter_number AS round FROM (SELECT id AS part_id, chapter_number FROM toc WHERE kind = 'part' AND chapter_number IS NOT NULL) WHERE part_id LIKE 'part\\_%' ESCAPE '\\'), "
    "p AS (SELECT part_id, count(*) AS n FROM (SELECT DISTINCT ph_id, part_id FROM phrase_precedent WHERE part_id IS NOT NULL) GROUP BY part_id) "
    "SELECT d.part_id, round, printf('round-%02d/', round) || replace(d.part_id, '_', '-') || '-deviations.md' AS path, printf('part-%s-r%02d-d01', substr(d.part_id, 6), round) AS first_id, d.part_id || '-bench-x/translation.en.txt' AS output FROM d"
)
def q_note_paths(spark, d):
    """Where the notes and outputs of a part stand, and the form of ids."""
    rows = table(spark, d, "toc").where("kind = 'part' and chapter_number is not null").select(F.col("id").alias("part_id"), F.col("chapter_number").alias("round")).where(F.col("part_id").startswith("part_")).distinct()
    part, round_ = F.col("part_id"), F.col("round")
    return rows.select("part_id", "round", notes.deviation_file(part, round_).alias("path"), notes.deviation_id(part, round_, F.lit(1)).alias("first_id"), notes.output_path(part, notes.label_suffix(F.lit("x"))).alias("output"))


@query("WITH d(number, name, file) AS (VALUES " + ", ".join(f"({i}, '{n}', '{i:02d}-{n.lower().replace(' ', '-')}.md')" for i, n in enumerate(notes.DIMENSIONS, 1)) + ", (17, 'dim 17', '17-dim-17.md'), (0, 'dim 0', '00-dim-0.md')) SELECT * FROM d")
def q_style_dimensions(spark, d):
    rows = spark.range(18).select(F.col("id").cast("int").alias("number"), F.format_string("dim %d", "id").alias("given"))
    name = notes.canonical_dimension(F.col("number"), F.col("given"))
    return rows.select("number", name.alias("name"), notes.dimension_file(F.col("number"), name).alias("file"))


@query("SELECT doc_id, list_filter(['「', 'the ', '。'], lambda x: NOT contains(coalesce(text, ''), x)) AS missing FROM documents")
def q_template_gaps(spark, d):
    """Which required pieces a text lacks."""
    return table(spark, d, "documents").select("doc_id", notes.missing_placeholders(F.col("text"), ["「", "the ", "。"]).alias("missing"))


@query(
    "WITH o AS (SELECT 'part_001-' || s_suppkey AS k, s_name AS v FROM supplier WHERE s_suppkey < 50), n AS (SELECT 'part_001-' || s_suppkey AS k, 'new ' || s_name AS v FROM supplier WHERE s_suppkey BETWEEN 45 AND 60), m AS (SELECT max(x) AS top FROM (SELECT s_suppkey AS x FROM supplier WHERE s_suppkey <= 60)), "
    "t AS (SELECT n.k, n.v, row_number() OVER (ORDER BY n.k) AS r FROM n WHERE n.k IN (SELECT k FROM o)) SELECT * FROM o UNION ALL SELECT * FROM n WHERE k NOT IN (SELECT k FROM o) UNION ALL SELECT 'part_001-' || (top + r), v FROM t, m"
)
def q_merged_rekeyed(spark, d):
    """Two ledgers as one; what comes under a taken id is numbered on."""
    s = table(spark, d, "supplier")
    key = F.concat(F.lit("part_001-"), F.col("s_suppkey").cast("string")).alias("k")
    return notes.rekeyed(s.where("s_suppkey < 50").select(key, F.col("s_name").alias("v")), s.where("s_suppkey between 45 and 60").select(key, F.concat(F.lit("new "), "s_name").alias("v")), "k", "part_001-")


TURNS = [
    ("c1", 0, "user", "Look: @data/output/part_231-v2-auto/translation.en.txt:12-14 the tense is wrong here\n\n@data/output/part_231/translation.en.txt:40 A strange  analogy.\nPlease analyze these."),
    ("c1", 1, "assistant", "  It should be past tense.  "), ("c1", 2, "tool", "{}"), ("c1", 3, "assistant", "Line 40 is a simile.\n"), ("c1", 4, "assistant", " "),
    ("c1", 5, "user", "@data/output/part_232-x/translation.en.txt:3 ok @data/output/part_232-x/translation.en.txt:9 What is nabe? </user_query> more"), ("c1", 6, "assistant", "A stew."),
    ("c2", 0, "user", "@data/output/part_231/translation.en.txt:12-14 The Tense is wrong here @/tmp/x no @src/a.py:3 not this"), ("c2", 1, "user", "nothing"), ("c3", 0, "assistant", "@data/output/part_231/translation.en.txt:1 said by nobody"),
]
MINED = [
    ("c1", 0, 1, "data/output/part_231-v2-auto/translation.en.txt", "part_231", "v2-auto", "12-14", "the tense is wrong here", "tense", "major", "It should be past tense.\n\nLine 40 is a simile."),
    ("c1", 0, 2, "data/output/part_231/translation.en.txt", "part_231", "", "40", "A strange analogy.", "metaphor", "minor", "It should be past tense.\n\nLine 40 is a simile."),
    ("c1", 5, 1, "data/output/part_232-x/translation.en.txt", "part_232", "x", "9", "What is nabe?", "untranslated_term", "minor", "A stew."),
]


@query(f"WITH {literal('m', 'chat, turn, pos, path, part_id, suffix, lines, comment, category, severity, reply', MINED)} SELECT * FROM m")
def q_comments_mined(spark, d):
    """Comments of literal chats, against stored rows (RE2 knows no lookahead)."""
    return mining.mined(spark.createDataFrame(TURNS, "chat string, turn int, role string, text string"), "chat", "turn")


@query("SELECT id, part_number FROM toc WHERE regexp_full_match(id, 'part_[0-9]+') AND part_number IS NOT NULL")
def q_part_numbers(spark, d):
    rows = table(spark, d, "toc").where(F.col("id").rlike(r"^part_\d+$") & F.col("part_number").isNotNull())
    return rows.select("id", mining.part_number(F.col("id")).alias("part_number"))


@query("SELECT user_id, count(*) AS n FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY user_id")
def q_enabled_in_set(spark, d):
    """Rows of enabled issues only."""
    on = _issues(spark, d).select(F.col("issue").alias("user_id")).join(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), (F.col("c_acctbal") > 0).alias("enabled")), "user_id")
    return table(spark, d, "events").join(ledger.enabled(on).select("user_id"), "user_id", "left_semi").groupBy("user_id").agg(F.count("*").alias("n"))
