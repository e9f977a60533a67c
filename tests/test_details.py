"""Contents pages, notes, scores, mined comments and their files."""

import json
import os
import random
import time

import __spark_entry__
import pytest
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.operators import audit, boundary, corpus, links, mining, notes, retrieve, scores, spans
from hibiki.sources import readers, writers

PAGE = """<html><div class="menu"><p><a href="https://a.example/no">Part 9</a></p></div><div class="entry-content">
<p>Chapter Sixty-eight – The well (Sendai PoV) <a href="https://a.example/1"><b>Part</b> 168</a> <a href="/relative">x</a> <a href="https://other.example/2">Part 2</a></p>
<h2>This is where volume one of the light novel ends</h2>
<p>Volume Two Interlude<br><a href="https://a.example/3">Interlude</a></p></div></html>"""


def test_links_of_a_page(spark):
    pages = spark.createDataFrame([("p", PAGE), ("q", None), ("r", "<p>")], "page string, html string")
    found, breaks = readers.contents_links(pages, "page", "html", "entry-content", ["a.example"], links.BREAK)
    assert [(r["block_index"], r["pos"], r["label"], r["href"]) for r in found.orderBy("pos").collect()] == [(0, 0, "Part168", "https://a.example/1"), (2, 1, "Interlude", "https://a.example/3")]
    assert [tuple(r) for r in breaks.collect()] == [("p", 1)]
    rows = {r["kind"]: r for r in links.contents(found, breaks).collect()}
    assert (rows["part"]["chapter_number"], rows["part"]["volume_number"], rows["part"]["pov"], rows["part"]["chapter_title_en"]) == (68, 1, "sendai", "The well  Part 168 x Part 2")
    assert (rows["interlude"]["id"], rows["interlude"]["pov"], rows["interlude"]["mapping_confidence"]) == ("interlude_v2", "sendai", "manual")
    assert links.contents(found.limit(0), breaks).count() == 0


@pytest.mark.parametrize(
    ("label", "block", "kind"),
    [("Part 1", "April Fool's", "special"), ("Part 1", "Chapter One", "part"), ("BookWalker", "x", "bookwalker"), ("x", "Maika SS", "side_story_maika"), ("Extra", "Volume Six Extra", "extra"), ("Part 4", "Volume Six Extra", "part"), ("x", "a side story", "side_story_maika"), (None, None, "part")],
)
def test_kinds(spark, label, block, kind):
    df = spark.createDataFrame([(label, block)], "l string, b string")
    assert df.select(links.link_kind("l", "b")).first()[0] == kind


def test_the_whole_contents(spark):
    ls = spark.createDataFrame([("p", 0, 0, "Part 1", "u", "Chapter One"), ("p", 0, 1, "Part 5", "u", "Chapter One")], "page string, block_index int, pos int, label string, href string, block string")
    br = spark.createDataFrame([], "page string, block_index int")
    ep = spark.createDataFrame([("e1", 0), ("e2", 1)], "episode string, position int")
    got = {(r["id"], r["episode"], r["outcome"]) for r in links.build_contents(ls, br, ep).collect()}
    assert got == {("part_001", "e1", "kept"), ("part_005", None, "kept"), ("source_e2", "e2", "source_only")}


def test_retrieval_drops_rows_then_texts(spark):
    hits = [(0, 1, 1, 0.9, "a", "x"), (0, 2, 2, 0.8, "a", "y"), (50, 1, 1, 0.95, "a", "x"), (50, 3, 2, 0.7, "a", "x"), (50, 4, 3, 0.6, "b", "x")]
    df = spark.createDataFrame(hits, "q int, row_id int, rank int, score double, jp_text string, en_text string")
    got = retrieve.retrieved(df, [["row_id"], ["jp_text", "en_text"]], 10).collect()
    assert [(r["row_id"], r["score"]) for r in got] == [(1, 0.9), (2, 0.8), (4, 0.6)]  # the first query's score stays
    parts = spark.createDataFrame([("p",), (None,)], "part_id string")
    rows = spark.createDataFrame([(1, "p"), (2, None), (3, "o")], "id int, part_id string")
    assert {r["id"] for r in retrieve.outside(rows, parts, "part_id").collect()} == {2, 3}


def test_spans_run_over_paragraphs(spark):
    paras = spark.createDataFrame([(1, "p", "jp", 0, "雨が ふる"), (2, "p", "jp", 1, None), (3, "p", "jp", 2, "夜に。"), (4, "p", "en", 0, "It RAINS at night.")], "para_id long, part_id string, side string, para_index long, text string")
    ph = spark.createDataFrame([(1, "p", "ふる夜", "rains  AT"), (2, "p", "雪", "it"), (3, "o", "雨", "it"), (4, None, "雨", "it"), (5, "p", "", None)], "ph_id long, part_id string, jp_span string, en_span string")
    got = {r["ph_id"]: (r["at"], r["jp_ok"], r["en_ok"]) for r in audit.spans_in_sources(ph, paras).collect()}
    assert got == {1: (3, True, True), 2: (0, False, True), 3: (0, False, False), 4: (0, False, False), 5: (0, True, False)}
    y = audit.phrase_yield(audit.spans_in_sources(ph, paras)).where("part_id = 'p'").first()
    assert (y["phrases"], y["survivors"], y["dropped"], y["too_few"]) == (3, 1, 2, False)


def joined(paras, part, side):
    """Definition: keys in the order of para_index, para_id, nulls last."""
    own = sorted(((x is None, x or 0, n), t) for n, p, d, x, t in paras if (p, d) == (part, side) and t is not None)
    return "".join(t.lower().replace(" ", "") for _, t in own)


def test_spans_are_found_in_chunks_and_pieces(spark, monkeypatch):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("aB 雨夜𝒳") for _ in range(n))
    paras = [(i, r.choice("pqp"), r.choice(["jp", "en"]), r.choice([None, r.randrange(40_000)]), r.choice([None, text(r.randrange(12)), text(40)])) for i in range(300)]
    phrases = [(i, r.choice(["p", "q", "r", None]), r.choice([None, "", " ", text(r.randint(1, 6))]), r.choice([None, text(2), text(9)])) for i in range(300)]
    whole = {(p, d): joined(paras, p, d) for p in "pqr" for d in ("jp", "en")}
    phrases += [(400 + i, p, whole[p, "jp"][i * 9 : i * 9 + n], whole[p, "en"][-n:]) for i, n in enumerate((1, 15, 50, 64, 200, 999)) for p in "pq"]
    want = set()
    for i, p, a, b in phrases:
        a, b = (x if x is None else x.lower().replace(" ", "") for x in (a, b))
        at = whole[p, "jp"].find(a) + 1 if p and a else 0
        want.add((i, p, at, a == "" or at > 0, b == "" or bool(p and b and b in whole[p, "en"]), len(whole.get((p, "jp"), ""))))
    df = spark.createDataFrame(paras, "para_id long, part_id string, side string, para_index long, text string")
    ph = spark.createDataFrame(phrases, "ph_id long, part_id string, jp_span string, en_span string")
    for chunk, piece in ((500_000, 100_000), (70, 20)):
        monkeypatch.setattr(spans, "CHUNK", chunk)
        monkeypatch.setattr(spans, "PIECE", piece)
        assert {tuple(x) for x in audit.spans_in_sources(ph, df).collect()} == want


def test_all_spans_of_a_text_are_looked_for_at_once(monkeypatch):
    r = random.Random(6)
    text = "".join(r.choice("ab雨夜𝒳") for _ in range(5_000))
    some = {text[i : i + r.randint(1, 90)] for i in r.sample(range(5_000), 400)} | {"".join(r.choice("ab雨") for _ in range(n)) for n in range(1, 40)} | {text, text[1:], text + "a"}
    want = [text.find(x) for x in sorted(some)]
    monkeypatch.setattr(spans, "FEW", 0)
    assert spans.places(text, sorted(some)) == want and -1 in want
    monkeypatch.setattr(spans, "_BASE", 1)  # hashes that agree for other texts
    monkeypatch.setattr(spans, "_INVERSE", 1)
    assert spans.places(text, sorted(some)) == want


@pytest.mark.parametrize("name", ["q_phrase_yield", "q_verbatim_phrases"])
def test_no_row_holds_a_whole_source(spark, tmp_path, name):
    """29,999 phrases of one part of 1.3 million characters a side: a search for each of them takes many minutes."""
    one = spark.range(60_000).selectExpr("id as para_id", "'p' as part_id", "if(id % 2 = 0, 'jp', 'en') as side", "id as para_index", "'narration' as kind", "concat('<', repeat('雨', 35), id div 2, '>') as text")
    one.write.parquet(f"{tmp_path}/paragraphs.parquet")
    # spans run over the border of two paragraphs, every tenth stands nowhere
    span = "concat(id, '><', if(id % 10 = 0, 'x', '雨'))"
    spark.range(29_999).selectExpr("id as ph_id", "'p' as part_id", f"{span} as jp_span", f"{span} as en_span").write.parquet(f"{tmp_path}/phrase_precedent.parquet")
    got = __spark_entry__.queries()[name](spark, str(tmp_path)).collect()
    if name == "q_phrase_yield":
        assert [(x["phrases"], x["survivors"], x["dropped"], x["too_few"]) for x in got] == [(29_999, 26_999, 3_000, False)]
    else:
        assert len(got) == 29_999 and sum(x["kept"] for x in got) == 26_999 and all(x["kept"] == (x["ph_id"] % 10 > 0) for x in got)


def written(spark):
    """Bytes that shuffles have written so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    time.sleep(0.3)
    spark.range(1).collect()  # a task that ends makes the store take up those before
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()


def test_texts_move_three_times_at_most(spark, tmp_path):
    """To where their paragraphs are put together, to what is known of them, to the spans; twice delivered rows count once."""
    sha = lambda x: f"sha2(concat({x}), 512)"
    one = spark.range(40_000).selectExpr("id as para_id", "concat('p', id % 50) as part_id", "if(id % 4 < 2, 'jp', 'en') as side", "if(id % 3 = 0, null, id) as para_index", "'narration' as kind", f"{sha('id')} as text").repartition(4)
    one.unionByName(one.where("para_id % 20 = 0")).write.parquet(f"{tmp_path}/paragraphs.parquet")
    # a null source span has no place, its part has characters all the same
    spark.range(2_000).selectExpr("id as ph_id", "concat('p', id % 50) as part_id", f"if(id % 2 = 0, null, substring({sha('id + 50')}, 5, 19)) as jp_span", f"substring({sha('id')}, 1, 20) as en_span").write.parquet(f"{tmp_path}/phrase_precedent.parquet")
    begun = written(spark)
    spark.read.parquet(f"{tmp_path}/paragraphs.parquet").repartition(4, "para_id").write.format("noop").mode("overwrite").save()
    once = written(spark) - begun
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with larger tables
    try:
        got = __spark_entry__.queries()["q_verbatim_phrases"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    moved = written(spark) - begun - once
    assert moved < 4 * once, moved / once
    assert len(got) == 2_000 and all(x["en_ok"] == (x["ph_id"] % 4 >= 2) and x["kept"] == (x["ph_id"] % 4 == 3) for x in got)
    chars = {f"p{i}": 0 for i in range(50)}
    for x in one.where("side = 'jp'").select("part_id", "text").collect():
        chars[x["part_id"]] += len(x["text"])
    ph, paras = (spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("phrase_precedent", "paragraphs"))
    rows = audit.spans_in_sources(ph.withColumn("jp_span", F.lit(None).cast("string")), paras).select("part_id", "source_chars").distinct().collect()
    assert {x["part_id"]: x["source_chars"] for x in rows} == chars


def test_white_space_of_spans(spark):
    """Every code point, against the pattern that all other queries take."""
    df = spark.createDataFrame([(f"a{chr(i)}B{chr(i)}{chr(i)}",) for i in range(0x110000) if not 0xD800 <= i < 0xE000], "x string")
    assert df.where(audit._key("x") != T.verbatim_key("x")).count() == 0 and df.where(F.length(audit._key("x")) == 2).count() == 29


def test_unknown_parts_are_errors(spark):
    e = spark.createDataFrame([("a", 1)], "id string, part_number int")
    assert corpus.found_part(e, "a").count() == 1
    with pytest.raises(Exception, match="unknown part"):
        corpus.found_part(e, "b").collect()
    df = spark.createDataFrame([("part_7",), ("x",)], "id string")
    assert df.where("id = 'part_7'").select(mining.part_number(F.col("id"))).first()[0] == 7
    with pytest.raises(Exception, match="invalid part id"):
        df.select(mining.part_number(F.col("id"))).collect()
    sides = spark.createDataFrame([("a", "jp", "x")], "part_id string, side string, text string")
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in corpus.with_texts(e.unionByName(spark.createDataFrame([("b", 2)], e.schema)), sides).collect()] == [("a", "x", None)]


def test_mining_of_hard_input(spark):
    turns = spark.createDataFrame([("c", 0, "user", None), ("c", 1, "user", ""), ("c", 2, None, "x"), ("c", 3, "user", "@data/output/part_1/translation.en.txt:1 abc"), ("c", 4, "user", "@data/output/part_1/translation.en.txt:1 " + "long " * 5000)], "chat string, turn int, role string, text string")
    got = mining.mined(turns, "chat", "turn").collect()
    assert len(got) == 1 and got[0]["turn"] == 4 and got[0]["reply"] == "" and got[0]["severity"] == "minor"
    assert mining.mined(turns.limit(0), "chat", "turn").count() == 0


def test_deviation_notes(spark):
    parts = spark.createDataFrame([("part_012", 1, "a"), ("part_013", 1, "b")], "part_id string, round int, pov string")
    dev = spark.createDataFrame([("part_012", 1, 2, "tense", "minor", False, "j", "l", "r", "", None), ("part_012", 1, 1, "tone", "major", True, "j", "l", "r", "rule-000-06", "n")], "part_id string, round int, idx int, category string, severity string, pov_specific boolean, jp_source string, llm_rendering string, reference_rendering string, violates_rule_id string, notes string")
    got = {r["part_id"]: (r["path"], r["note"]) for r in notes.deviation_notes(parts, dev).collect()}
    assert got["part_012"][0] == "round-01/part-012-deviations.md" and "deviation_count: 2" in got["part_012"][1]
    body = got["part_012"][1]
    assert body.index("part-012-r01-d01") < body.index("part-012-r01-d02") and "[[rule-000-06]]" in body and body.count("Violates") == 1
    assert "_No deviations flagged._" in got["part_013"][1]


def test_profiles_and_chapters(spark):
    d = spark.createDataFrame([(2, "## b\n", None), (1, " ## a", "2024")], "number int, body string, extracted_at string")
    assert notes.profile_prompt(d).first()["prompt"] == "## a\n\n## b"
    assert notes.profile_prompt(d.withColumn("extracted_at", F.lit(""))).first()["prompt"] == notes.NO_PROFILE and notes.profile_prompt(d.limit(0)).first()["n_dimensions"] == 0
    s = spark.createDataFrame([(["x", " part-011-r02-dev1"],), ([],), (None,)], "s array<string>")
    assert [r[0] for r in s.select(notes.chapter_of(F.col("s"))).collect()] == ["011", "000", "000"]


def test_a_profile_without_sections_is_an_error(spark):
    from hibiki.operators import answers, sections

    df = spark.createDataFrame([("a", "## 1. x\ny"), ("b", "nothing")], "doc string, text string")
    with pytest.raises(Exception, match="no numbered sections"):
        sections.style_sections(df, "doc", "text").collect()
    reg = spark.createDataFrame([("tense", "T", "d"), ("other", "O", "e")], "key string, label string, description string")
    rows = spark.createDataFrame([(" Tense",), ("x",), (None,)], "category string")
    assert [tuple(r) for r in answers.registered(rows, "category", reg).orderBy("label").collect()] == [("other", "O", "e"), ("other", "O", "e"), ("tense", "T", "d")]
    assert answers.described(reg).first()["text"] == "- other: e\n- tense: d"
    assert retrieve.result_flags(rows.limit(0).select(F.col("category").alias("kind")), ["a"]).first()["is_empty"]


def test_the_revision_loop(spark):
    drafts = spark.createDataFrame([("a", "xxx"), ("b", "ok"), ("c", "xxxxxxx")], "id string, draft string")

    def critic(df):
        return df.where("draft like '%x%'").select("id", F.lit("major").alias("severity"))

    def reviser(df):
        return df.select("id", F.expr("substring(draft, 3)").alias("draft"))

    got = {r["id"]: (r["draft"], r["revisions"], r["major"]) for r in scores.revised(drafts, "id", critic, reviser, 3).collect()}
    assert got == {"a": ("", 2, 0), "b": ("ok", 0, 0), "c": ("x", 3, 1)}
    assert {r["revisions"] for r in scores.revised(drafts, "id", critic, reviser, 0).collect()} == {0}


def test_scores(spark):
    s = spark.createDataFrame([(0.5, None), (0.7, 0.2), (None, None)], "comet double, bert double")
    assert {(r["metric"], r["n"], r["mean"]) for r in scores.score_means(s, ["comet", "bert"]).collect()} == {("comet", 2, 0.6), ("bert", 1, 0.2)}
    rules = spark.createDataFrame([("active", 3), ("pruned", 3), ("active", 1)], "state string, changed_round int")
    one = scores.round_summary(s, ["comet", "bert"], rules, 3)
    r = one.first()
    assert (r["round"], r["chapters_evaluated"], r["comet_mean"], r["rules_added"], r["rules_pruned"], r["rules_active_total"]) == (3, 3, 0.6, 1, 1, 2)
    assert "- **comet mean:** 0.6000" in one.select(scores.round_note(["comet", "bert"])).first()[0]
    flags = spark.createDataFrame([("p", 1, "minor", "b"), ("p", 0, "major", "a")], "part_id string, idx int, severity string, note string")
    c = json.loads(scores.critiques(flags, ["part_id"]).first()["critique"])
    assert (c["flag_count"], c["major_count"], [f["note"] for f in c["flags"]]) == (2, 1, ["a", "b"])
    out = scores.scored(spark.createDataFrame([("a", "ab")], "k string, t string"), "k string, comet double", lambda pdf: pdf.assign(comet=pdf["t"].str.len() / 4.0)[["k", "comet"]])
    assert out.first()["comet"] == 0.5


def test_files(spark, tmp_path):
    root = str(tmp_path / "vault")
    writers.scaffold(spark, root, {"a/x.md": "first", "y.md": "second"})
    writers.scaffold(spark, root, {"a/x.md": "other", "z.md": "third"})
    read = lambda p: open(os.path.join(root, p)).read()
    assert read("a/x.md") == "first" and read("z.md") == "third"
    writers.write_texts(spark.createDataFrame([("a/x.md", "new"), ("n.md", None)], "path string, text string"), root)
    assert read("a/x.md") == "new" and read("n.md") == ""
    with pytest.raises(Exception, match="outside the root"):
        writers.write_texts(spark.createDataFrame([("../x", "t")], "path string, text string"), root)
    rows = spark.createDataFrame([(1, "4", "tense", "PRESENT", "RESOLVED", "regression"), (2, "3", "a|b", "UNCLEAR", None, None)], "issue int, part string, category string, verdict string, baseline_verdict string, change string")
    writers.write_report(rows, root, "l2", "l1")
    got = json.loads(read("l2-vs-l1.json"))
    assert got["counts"]["PRESENT"] == 1 and got["regressions"] == ["1"] and [r["part"] for r in got["rows"]] == ["3", "4"]
    assert read("l2-vs-l1.md").index("| 3 |") < read("l2-vs-l1.md").index("| 4 |") and "a\\|b" in read("l2-vs-l1.md")


def test_an_index_is_whole_or_not_there(spark, tmp_path):
    path = str(tmp_path / "ix")
    assert readers.index(spark, path) is None and not readers.index_exists(spark, path)
    pairs = spark.createDataFrame([(0, "a"), (1, "b")], "row_id long, jp_text string")
    v = spark.createDataFrame([(0, [1.0]), (1, [0.5])], "row_id long, embedding array<float>")
    writers.write_index(pairs, v, path, "m", "phrases")
    assert readers.index(spark, path).count() == 2 and readers.index_exists(spark, path)
    writers.write_index(pairs, v.limit(1), path, "m", "phrases")
    with pytest.raises(Exception, match="don't match"):
        readers.index(spark, path).collect()


def test_issue_files_of_gone_parts_go(spark, tmp_path):
    path = str(tmp_path / "issues")
    df = spark.createDataFrame([("i1", "p1"), ("i2", "p2")], "id string, part_id string")
    writers.write_issues(df, path)
    writers.write_issues(df.where("part_id = 'p2'"), path)
    assert sorted(x for x in os.listdir(path) if x.startswith("part_id")) == ["part_id=p2"]


def test_promotion_rules(spark):
    m = spark.createDataFrame([("p1", "a", "m1", None, None)], "part_id string, en_text string, model string, source_suffix string, promoted_at string")
    meta = spark.createDataFrame([("from meta",)], "model string")
    got = {r["part_id"]: (r["en_text"], r["model"]) for r in writers.promote(m, "p2", en_text="t", meta=meta).collect()}
    assert got == {"p1": ("a", "m1"), "p2": ("t", "from meta")}
    for bad in ({}, {"en_text": "t", "source": spark.createDataFrame([("s",)], "text string")}):
        with pytest.raises(ValueError):
            writers.promote(m, "p2", **bad)


def test_missing_files_read_as_empty(spark, tmp_path):
    assert readers.manifest(spark, str(tmp_path / "no.json")).count() == 0 and readers.overrides(spark, str(tmp_path / "no.json")).count() == 0
    (tmp_path / "bad.json").write_text("{nope")
    assert readers.overrides(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "o.json").write_text('{"part_001": "e1", "part_002": null}')
    assert {tuple(r) for r in readers.overrides(spark, str(tmp_path / "o.json")).collect()} == {("part_001", "e1"), ("part_002", None)}


def test_parts_and_profiles_from_files(spark, tmp_path):
    for name, text in {"part_1.jp.txt": "雨", "part_1.en.txt": "rain", "part_2.en.txt": "snow"}.items():
        (tmp_path / name).write_text(text)
    assert {tuple(r) for r in readers.part_texts(spark, str(tmp_path), "part_1").collect()} == {("jp", "雨"), ("en", "rain")}
    with pytest.raises(Exception, match="no source text"):
        readers.part_texts(spark, str(tmp_path), "part_2").collect()
    d = tmp_path / "style"
    d.mkdir()
    (d / "02-voice.md").write_text("---\ndimension: Voice\nmodel: m\nextracted_at: '2024'\n---\n\n## Voice\n")
    (d / "01-tone.md").write_text("## Tone")
    (d / "notes.md").write_text("no")
    rows = readers.style_dimensions(readers.notes(spark, str(d))).orderBy("number").collect()
    assert [(r["number"], r["slug"], r["model"]) for r in rows] == [(1, "tone", "m"), (2, "voice", "m")]
    cache = tmp_path / "cache" / "toc"
    cache.mkdir(parents=True)
    (cache / "a.html").write_text("<p>x</p>")
    assert [tuple(r) for r in readers.cached_pages(spark, str(tmp_path / "cache")).collect()] == [("toc", "a.html", "<p>x</p>")]


def test_model_steps(spark):
    df = spark.createDataFrame([(1, "x"), (2, "bad")], "k int, t string")
    answer = lambda ps: ["no json" if "bad" in p else 'Sure: {"v": "%s"}' % p for p in ps]
    got = {r["k"]: r["body"] and r["body"]["v"] for r in boundary.extracted(df, ["k"], F.concat(F.lit("ask "), "t"), answer, "v string").collect()}
    assert got == {1: "ask x", 2: None}
    m = spark.createDataFrame([("o1-mini",), ("other",)], "m string")
    assert [r[0] for r in m.select(boundary.sampling(F.col("m"), 0.2, ("o1",))).collect()] == [None, 0.2]
    assert len(spark.range(1).select(boundary.now_utc()).first()[0]) == 25

    def refused(pdf):
        raise boundary.Permanent("refused")

    with pytest.raises(Exception, match="refused"):
        boundary.called(df, refused, "k int, t string", 3, 60.0).collect()


def test_merged_ledgers_keep_all_rows(spark):
    old = spark.createDataFrame([("p-1", "a"), ("p-3", "b")], "k string, v string")
    new = spark.createDataFrame([("p-3", "c"), ("p-4", "d"), ("q", "e")], "k string, v string")
    assert {tuple(r) for r in notes.rekeyed(old, new, "k", "p-").collect()} == {("p-1", "a"), ("p-3", "b"), ("p-5", "c"), ("p-4", "d"), ("q", "e")}
