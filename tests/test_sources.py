"""Readers, writers, pages and streams, on invented files."""

import json

import pytest
from pyspark.sql import functions as F

from hibiki.sources import readers, writers
from hibiki.streaming import incremental


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_toc_keeps_order_and_fails_on_damage(spark, tmp_path):
    p = put(tmp_path / "toc.json", json.dumps([{"id": "b", "part_number": 2}, {"id": "a", "unknown": 1}]))
    assert [(r["file_pos"], r["id"], r["part_number"]) for r in readers.toc(spark, p).collect()] == [(0, "b", 2), (1, "a", None)]
    with pytest.raises(Exception):
        readers.toc(spark, put(tmp_path / "bad.json", "[{")).collect()


def test_part_files_round_trip(spark, tmp_path):
    rows = [("p1", "jp", 0, "narration", "雨。"), ("p1", "jp", 1, "blank", ""), ("p1", "jp", 2, "dialogue", "「a」")]
    df = spark.createDataFrame(rows, "part_id string, side string, para_index int, kind string, text string")
    writers.write_parts(df, str(tmp_path / "parts"))
    put(tmp_path / "parts" / "broken.json", "{not json")
    back = readers.parts(spark, str(tmp_path / "parts"))
    assert back.where("id is null").count() == 1
    assert sorted(map(tuple, readers.paragraphs(back).collect())) == sorted(rows)
    assert writers.part_text(df).first()["text"] == "雨。\n\n「a」"


def test_json_lines_skip_comments_and_fail(spark, tmp_path):
    p = put(tmp_path / "i.jsonl", '# head\n\n{"id": "x1", "part_id": "p", "zzz": 1}\n')
    assert [r["id"] for r in readers.issues(spark, p).collect()] == ["x1"]
    with pytest.raises(Exception):
        readers.issues(spark, put(tmp_path / "b.jsonl", "{oops\n")).collect()


def test_runs_manifest_holdout(spark, tmp_path):
    p = put(tmp_path / "r.json", json.dumps({"label": "l", "results": {"a": {"verdict": "RESOLVED"}, "b": {"issue_id": "B", "verdict": "UNCLEAR"}}}, indent=1))
    assert {(r["issue_id"], r["verdict"]) for r in readers.runs(spark, p).collect()} == {("a", "RESOLVED"), ("B", "UNCLEAR")}
    p = put(tmp_path / "m.json", json.dumps({"1": {"part_id": "part_001", "model": "m"}}))
    m = readers.manifest(spark, p)
    assert m.first()["part_id"] == "part_001"
    assert writers.demote(writers.promote(m, m.first()["part_id"], en_text="t", model="n"), "part_009").first()["model"] == "n"
    h = readers.holdout(spark, put(tmp_path / "h.json", '{"part_ids": ["p"]}')).first()
    assert (h["seed"], h["target_count"], h["part_ids"]) == (7, 30, ["p"])


def test_transcripts(spark, tmp_path):
    lines = [json.dumps({"role": "user", "message": {"content": [{"type": "text", "text": "hi"}]}}), "{bad", json.dumps({"role": "assistant", "message": {"content": "yo"}})]
    put(tmp_path / "t" / "a.jsonl", "\n".join(lines))
    put(tmp_path / "t" / "subagents" / "b.jsonl", lines[2])
    assert [(r["turn"], r["role"], r["text"]) for r in readers.transcripts(spark, str(tmp_path / "t")).orderBy("turn").collect()] == [(0, "user", "hi"), (1, "assistant", "yo")]


def test_notes_rules_and_tables(spark, tmp_path):
    put(tmp_path / "v" / "a.md", "---\nid: r1\npriority: 2\nstate: active\npov_scope: [x, y]\n---\n# Rule\n\nKeep it.\n\nMore here.")
    put(tmp_path / "v" / "b.md", "---\nid: r2\npriority: 5\n---\nShort.")
    put(tmp_path / "v" / "c.md", "---\n: [bad\n---\nx")
    notes = readers.notes(spark, str(tmp_path / "v"))
    assert notes.count() == 2
    got = readers.rules(notes).collect()
    assert [(r["id"], r["state"], r["text"], r["extra"]) for r in got] == [("r2", "candidate", "Short.", ""), ("r1", "active", "Keep it.", "More here.")]
    put(tmp_path / "g" / "g.md", "Intro\n\n| Japanese | English | Notes |\n|---|---|---|\n| 雨 | rain | — |\n| 鍵 | key | tool |\n| 短 |\n\n| Other | x |\n|---|---|\n| a | b |\n")
    g = {(r["japanese"], r["english"], r["notes"]) for r in readers.glossary(spark, str(tmp_path / "g")).collect()}
    assert g == {("雨", "rain", None), ("鍵", "key", "tool")}


PAGE = """<html><head><meta property="og:title" content="A title"></head><body>
<div class="nav"><p>outside</p></div>
<div class="entry body"><p>　<ruby>雨<rt>あめ</rt></ruby>だ。</p><p class="blank"><br></p><p>「行く<br>ぞ」</p><p>Next | Previous</p></div>
<a href="https://story.example/2"><b>Part</b> 2</a><a href="https://other.example/x">no</a>
<script id="data" type="application/json">{"Work:1": {"toc": [{"__ref": "Ep:2"}, {"__ref": "Ep:1"}]}, "Ep:1": {"t": "one"}, "Ep:2": {"t": "two"}}</script></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([("u", PAGE), ("v", None)], "url string, html string")
    assert [(r["kind"], r["text"]) for r in readers.page_paragraphs(df, "url", "html", "body").orderBy("idx").collect()] == [("narration", "雨だ。"), ("blank", ""), ("dialogue", "「行く\nぞ」")]
    assert [(r["href"], r["label"]) for r in readers.page_links(df, "url", "html", ["story.example"]).collect()] == [("https://story.example/2", "Part 2")]
    graph = readers.page_json(df, "url", "html", "data")
    assert [r["name"] for r in readers.referenced(graph, "url", "Work:", "toc").orderBy("pos").collect()] == ["Ep:2", "Ep:1"]


def test_excerpts_and_overrides(spark):
    f = spark.createDataFrame([("d/a.txt", "1\n\n3\n4")], "file string, text string")
    assert readers.excerpt(f, "a.txt", 1, 3).first()["excerpt"] == "1 3"
    assert readers.excerpt(f, "a.txt", 4, 99).first()["excerpt"] == "4"
    a, b = spark.createDataFrame([("x", "1"), ("y", "2")], "k string, v string"), spark.createDataFrame([("y", "9")], "k string, v string")
    assert {tuple(r) for r in readers.with_default(a, b, "k", "v").collect()} == {("x", "1", "packaged"), ("y", "9", "override")}


def test_index_appends_only_new_parts(spark, tmp_path):
    p = str(tmp_path / "idx")
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "part_id string, jp string")
    assert writers.append_index(rows, p) == 3 and writers.append_index(rows, p) == 0
    more = rows.unionByName(spark.createDataFrame([("c", "4")], "part_id string, jp string"))
    assert writers.append_index(more, p) == 1
    assert sorted(r["row_id"] for r in spark.read.parquet(p).collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        writers.append_unique(rows, str(tmp_path / "u"), "part_id")


def test_ids_and_cells(spark):
    df = spark.createDataFrame([("part_012", 3, 1), ("part_012", 3, 0)], "part_id string, round int, idx int")
    assert {r["id"] for r in writers.deviation_ids(df).collect()} == {"part-012-r03-d01", "part-012-r03-d02"}
    c = spark.createDataFrame([("a|b\nc", None)], "x string, y string")
    assert writers.markdown_rows(c, ["x", "y"]).first()[0] == "| a\\|b c |  |"


def test_streams_process_a_file_once(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string").write.parquet(src)
    name = f"t-{tmp_path.name}-{id(tmp_path)}"
    assert incremental.ingest(spark, src, out, "k", name).count() == 2
    spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string").write.mode("append").parquet(src)
    assert sorted(r["k"] for r in incremental.ingest(spark, src, out, "k", name).collect()) == [1, 2, 3]
