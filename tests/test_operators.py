"""Each sequential operator against a plain loop, and the invariants of the rest."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from hibiki.operators import align, answers, audit, boundary, corpus, holdout, ledger, retrieve, sections, toc


def parts(spark, n=40, seed=1):
    r = random.Random(seed)
    rows = [(f"part_{i:03d}", i, r.choice(["hiiragi", "narumi"]), r.random() < 0.6) for i in range(1, n + 1)]
    return rows, spark.createDataFrame(rows, "id string, part_number int, pov string, eligible boolean")


def test_windows_equal_the_loop(spark):
    rows, df = parts(spark)
    got = {}
    for r in holdout.reference_windows(df, 5).collect():
        got.setdefault(r["id"], []).append((r["place"], r["ref_id"]))
    for id_, number, _, _ in rows:
        want = [x[0] for x in rows if x[3] and x[1] < number][-5:]
        assert [b for _, b in sorted(got.get(id_, []))] == want


def test_underfilled_windows(spark):
    rows, df = parts(spark, 12)
    got = {r["id"]: r["have"] for r in holdout.underfilled(df, 5).collect()}
    for id_, number, _, _ in rows:
        have = min(5, sum(1 for x in rows if x[3] and x[1] < number))
        assert got.get(id_, 5) == have


def test_holdout_is_deterministic_balanced_and_seeded(spark):
    _, df = parts(spark, 200)
    pick = lambda seed: {r["id"] for r in holdout.picked(df, ["hiiragi", "narumi"], 30, seed).collect()}
    assert pick(7) == pick(7) != pick(8)
    cells = {(r["bucket"], r["pov"]): r["n"] for r in holdout.cell_counts(holdout.picked(df, ["hiiragi", "narumi"])).collect()}
    assert set(cells.values()) == {5} and len(cells) == 6
    assert holdout.quotas(10, ["a", "b"]) == {("early", "a"): 1, ("early", "b"): 2, ("middle", "a"): 1, ("middle", "b"): 2, ("late", "a"): 2, ("late", "b"): 2}


def test_merged_references_keep_the_newest(spark):
    e = spark.createDataFrame([("t", "x", 1)], "target string, ref_id string, ref_number int")
    r = spark.createDataFrame([("t", "a", 2), ("t", "b", 3), ("t", "x", 1)], "target string, ref_id string, ref_number int")
    assert {x["ref_id"] for x in holdout.merged_references(e, r, 2).collect()} == {"x", "b"}


def test_volumes_equal_the_loop(spark):
    rows = [(i, i % 7 == 3) for i in range(25_000)]
    df = spark.createDataFrame(rows, "k int, b boolean")
    got = {r["k"]: r["volume"] for r in toc.volumes(df, ["k"], F.col("b")).collect()}
    n = 1
    for k, b in rows:
        assert got[k] == n
        n += b


def test_first_gaps_and_sequences(spark):
    used = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 2), ("c", None)], "g string, n int")
    assert {(r["g"], r["next_free"]) for r in toc.first_gaps(used, "g", "n").collect()} == {("a", 3), ("b", 1)}
    new = spark.createDataFrame([("a", "x"), ("a", "y"), ("z", "w")], "g string, k string")
    got = toc.sequence_ids(new, used, "g", ["k"], "n").collect()
    assert {(r["k"], r["n"]) for r in got} == {("x", 5), ("y", 6), ("w", 1)}


def test_mapping_and_overrides(spark):
    p = spark.createDataFrame([("p1", 1), ("p2", 2), ("p3", 9)], "id string, part_number int")
    e = spark.createDataFrame([("e1", 0), ("e2", 1), ("e3", 2)], "episode string, position int")
    m = toc.mapped(p, e)
    assert {(r["id"], r["episode"], r["confidence"]) for r in m.collect()} == {("p1", "e1", "high"), ("p2", "e2", "high"), ("p3", None, "needs_review")}
    o = spark.createDataFrame([("p1", "e3"), ("p2", None), ("p3", "zz")], "id string, episode string")
    assert {(r["id"], r["episode"], r["outcome"]) for r in toc.overridden(m, o, e).collect()} == {("p1", "e3", "bound"), ("p2", None, "not_on_site"), ("p3", None, "unknown_episode")}
    assert [r["episode"] for r in toc.source_only(e, m).collect()] == ["e3"]


def vectors(spark, n=300, d=8, seed=3):
    m = np.random.default_rng(seed).normal(size=(n, d)).astype("f4")
    m[5] = m[6]
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(m)]
    return m, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("same", [True, False])
def test_topk_equals_brute_force(spark, same):
    m, df = vectors(spark)
    u = m.astype("f8") / np.linalg.norm(m.astype("f8"), axis=1, keepdims=True)
    got = retrieve.topk(df.where("vec_id % 50 = 0"), df, "vec_id", "embedding", "label", 7, same).collect()
    for q in range(0, 300, 50):
        s = [(-round(float(u[q] @ u[i]), 6), i) for i in range(300) if i != q and (same or i % 3 != q % 3)]
        assert [r["row_id"] for r in sorted((x for x in got if x["q"] == q), key=lambda x: x["rank"])] == [i for _, i in sorted(s)[:7]]


def test_topk_crosses_query_blocks(spark, monkeypatch):
    _, df = vectors(spark, 60)
    whole = {tuple(r) for r in retrieve.topk(df, df, "vec_id", "embedding", "label", 3).collect()}
    monkeypatch.setattr(retrieve, "BLOCK", 7)
    assert {tuple(r) for r in retrieve.topk(df, df, "vec_id", "embedding", "label", 3).collect()} == whole


def test_dedup_first_query_keeps_its_score(spark):
    rows = [(1, 10, 0.5, 1, "k"), (2, 10, 0.9, 1, "k"), (1, 11, 0.4, 2, "l")]
    df = spark.createDataFrame(rows, "q int, row_id int, score double, rank int, key string")
    assert {(r["key"], r["score"]) for r in retrieve.deduplicated(df, ["key"]).collect()} == {("k", 0.5), ("l", 0.4)}


def test_cosine_of_zero_vectors_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(retrieve.cosine(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_length_alignment_finds_merges():
    jp, en = [10, 10, 5, 5, 30], [28, 28, 28, 40, 43]
    steps = align.best_path(jp, en)
    assert [(b - a, d - c) for a, b, c, d in steps] == [(1, 1), (1, 1), (2, 1), (1, 2)]
    assert align.best_path([], []) == [] and align.best_path([3], []) == [(0, 1, 0, 0)]


def test_alignment_is_monotone_and_whole(spark):
    rows = [Row(para_id=i, part_id="p", side=s, para_index=i, kind="narration", text="x" * (10 + i % 5)) for s in ("jp", "en") for i in range(300)]
    got = align.aligned(spark.createDataFrame(rows, "para_id long, part_id string, side string, para_index long, kind string, text string")).collect()
    covered = sorted(i for r in got if r["jp_from"] is not None for i in range(r["jp_from"], r["jp_to"] + 1))
    assert covered == list(range(300))


def _loop_path(jp, en):
    """The table cell by cell."""
    score, step = {(0, 0): 0.0}, {}
    for i in range(len(jp) + 1):
        for j in range(len(en) + 1):
            for a, b, prior in align.SHAPES:
                if (i - a, j - b) in score:
                    total = score[i - a, j - b] + math.log(prior) - (align.length_z(sum(jp[i - a : i]), sum(en[j - b : j])) ** 2 / 2 if a and b else 0)
                    if total > score.get((i, j), -math.inf):
                        score[i, j], step[i, j] = total, (a, b)
    out, at = [], (len(jp), len(en))
    while at != (0, 0):
        (i, j), (a, b) = at, step[at]
        out.append((i - a, i, j - b, j))
        at = (i - a, j - b)
    return out[::-1]


def test_length_alignment_equals_the_loop(monkeypatch):
    monkeypatch.setattr(align, "LEAST_APART", 4)
    monkeypatch.setattr(align, "KEPT", 8)
    r = random.Random(5)
    for n, m in [(0, 3), (3, 0), (1, 1), (1, 9), (9, 1), (2, 2), (17, 23), (40, 31), (60, 60)]:
        jp = [r.randint(1, 90) for _ in range(n)]
        en = [max(1, round(2.77 * x + r.gauss(0, 20))) for x in jp][: m] + [r.randint(1, 250) for _ in range(m - n)]
        assert align.best_path(jp, en) == _loop_path(jp, en)


def test_a_long_part_with_omissions_is_one_path(spark):
    r = random.Random(3)
    jp = [r.randint(5, 120) for _ in range(260)]
    en = [max(1, round(2.77 * x)) for i, x in enumerate(jp) if not 20 <= i < 45]
    rows = [Row(para_id=i, part_id="p", side=s, para_index=i, kind="narration", text="x" * x) for s, side in (("jp", jp), ("en", en)) for i, x in enumerate(side)]
    got = align.aligned(spark.createDataFrame(rows, "para_id long, part_id string, side string, para_index long, kind string, text string")).collect()
    last = lambda a, b: (a, b - 1) if b > a else (None, None)
    assert {(x["jp_from"], x["jp_to"], x["en_from"], x["en_to"]) for x in got} == {(*last(a, b), *last(c, d)) for a, b, c, d in _loop_path(jp, en)}
    assert sum(x["shape"] == "1:1" and x["en_from"] == x["jp_from"] - 25 for x in got if x["jp_from"] and x["jp_from"] >= 45) > 200


def test_verify_and_gaps(spark):
    p = spark.createDataFrame([("a", "k", "u"), ("b", "k", "u"), ("c", "k", None), ("d", None, "u"), ("e", "k", "u"), ("z", "k", "u")], "id string, kakuyomu_episode_id string, url_en string")
    c = spark.createDataFrame([("a", "jp", 4), ("a", "en", 4), ("b", "jp", 4), ("b", "en", 2), ("c", "jp", 1), ("z", "jp", 0), ("z", "en", 9)], "part_id string, side string, n_paragraphs long")
    got = {r["id"]: (r["jp_status"], r["en_status"], r["complete"], r["skewed"]) for r in corpus.verify_pairs(p, c).collect()}
    assert got == {
        "a": ("present", "present", True, False), "b": ("present", "present", True, True), "c": ("present", "source_only", False, False), "d": ("print_only", "missing", False, False),
        "e": ("missing", "missing", False, False), "z": ("present", "present", True, False),
    }
    r = corpus.verify_report(corpus.verify_pairs(p, c), p.unionByName(p.limit(2))).first().asDict()
    assert r == {"in_scope": 6, "jp_present": 4, "en_present": 3, "complete_pairs": 3, "missing_jp": 1, "missing_jp_print_only": 1, "missing_en": 2, "missing_en_source_only": 1, "skewed": 1, "out_of_scope": 2}


def test_answers_parse_and_default(spark):
    good = '```json\n{"phrase_pairs": [{"jp_span": "a", "en_span": "b", "category": "Register "}, {"jp_span": "", "en_span": "c"}], "paragraph_pairs": [{"jp": "x", "en": "y"}]}\n```'
    df = spark.createDataFrame([(1, good), (2, '{"phrase_pairs": [{]}'), (3, None), (4, ""), (5, '{"risks": [{"jp_span": "z", "risk_level": "dire"}]} ok')], "raw_id int, t string")
    assert [(r["jp_span"], r["category"], r["notes"]) for r in answers.phrases(df, ["raw_id"], "t").collect()] == [("a", "register", "")]
    assert [tuple(r) for r in answers.paragraph_pairs(df, ["raw_id"], "t").collect()] == [(1, 0, "x", "y", "1:1")]
    assert [(r["raw_id"], r["category"], r["risk_level"]) for r in answers.risks(df, ["raw_id"], "t").collect()] == [(5, "other", "medium")]


def test_gates_name_the_first_failure(spark):
    src = spark.createDataFrame([("few", 3000), ("big", 100), ("thin", 100), ("good", 10), ("none", 0)], "part_id string, source_chars long")
    pairs = spark.createDataFrame([("few", "a", "b"), ("big", "x" * 601, "y"), ("thin", "x", "y"), ("good", "x" * 10, "y")], "part_id string, jp string, en string")
    assert {r["part_id"]: r["verdict"] for r in audit.gates(pairs, src).collect()} == {"few": "too_few", "big": "too_large", "thin": "low_coverage", "good": "ok", "none": "ok"}


def test_inversions_equal_the_loop(spark):
    r = random.Random(2)
    rows = [("g", i, r.randrange(100)) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o int, p int")
    want = sum(b[2] < a[2] for a, b in zip(rows, rows[1:]))
    assert audit.inversions(df, ["g"], ["o"], "p").first()["inversions"] == want


def test_scorecard_drops_orphans_and_history_keeps_them(spark):
    v = spark.createDataFrame([(1, "l1", "RESOLVED"), (1, "l2", "PRESENT"), (9, "l1", "PRESENT")], "issue int, label string, verdict string")
    i = spark.createDataFrame([(1, "tense", 4)], "issue int, category string, part int")
    rows = {(r["category"], r["part"]): r["total"] for r in ledger.scorecard(v, i).collect()}
    assert rows == {("all", "all"): 2, ("all", "4"): 2, ("tense", "all"): 2}
    assert {(r["issue"], r["l1"], r["l2"]) for r in ledger.pivoted(ledger.history(v, i), ["l1", "l2"]).collect()} == {(1, "RESOLVED", "PRESENT"), (9, "PRESENT", None)}
    assert {r["part"] for r in ledger.history(v, i).where("issue = 9").collect()} == {"?"}
    now, old = v.where("label = 'l2'").select("issue", "verdict"), v.where("label = 'l1'").select("issue", "verdict")
    assert [r["change"] for r in ledger.changes(now, old).collect()] == ["regression"]


def test_the_whole_history_has_every_label(spark, tmp_path):
    import __spark_entry__ as entry

    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 12) for d in range(1, 29)]
    rows = [(i, i % 3, f"{x} 10:00:00", "error") for i, x in enumerate(days)] + [(900, 0, f"{days[0]} 11:00:00", "purchase")]
    spark.createDataFrame([(0, "x", 4)], "c_custkey int, c_mktsegment string, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame(rows, "event_id long, user_id int, ts string, event_type string").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "events.parquet"))
    got = {(r["issue"], r["label"]): r["verdict"] for r in entry.queries()["q_verdict_history"](spark, str(tmp_path)).collect()}
    assert got == {(i % 3, x): "PRESENT" for i, x in enumerate(days)} | {(0, days[0]): "RESOLVED"}


def test_follow_ups(spark):
    rows = [("c", 0, "a", "x"), ("c", 1, "u", "q"), ("c", 2, "a", "r1"), ("c", 3, "a", " r2 "), ("c", 4, "a", " "), ("c", 5, "u", "q2")]
    df = spark.createDataFrame(rows, "chat string, n int, role string, text string")
    assert [tuple(r) for r in ledger.follow_ups(df, "chat", ["n"], F.col("role") == "u", "text").collect()] == [("c", 1, "r1\n\nr2")]


def test_boundary(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "")], "k int, t string")
    got = boundary.embedded(df, "k", "t", lambda ts: [[len(t), 0.0] for t in ts]).collect()
    assert {(r["k"], tuple(r["embedding"])) for r in got} == {(1, (1.0, 0.0)), (2, (0.0, 0.0))}
    cache = spark.createDataFrame([(1, "old")], "k int, answer string")
    out = boundary.answered_once(df.select("k"), cache, ["k"], lambda p: p.assign(answer="new"))
    assert {tuple(r) for r in out.collect()} == {(1, "old"), (2, "new")}
    with pytest.raises(KeyError):
        boundary.checker("nobody")
    v = df.select(boundary.checker("contains", F.col("t"), F.lit("a")).alias("v")).collect()
    assert [r["v"] for r in v] == ["PRESENT", "RESOLVED"]


def test_topk_is_pruned_before_the_shuffle(spark):
    _, df = vectors(spark, 50)
    plan = retrieve.topk(df.limit(2), df, "vec_id", "embedding", "label", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sections(spark):
    text = "intro\n## 1. One\nbody one\n## 2) Two\nb\n\n# 1. Again\nlater\n## 99. no\nx"
    df = spark.createDataFrame([("d", text), ("e", None)], "k string, t string")
    got = sections.numbered_sections(df, "k", "t")
    assert {(r["number"], r["name"], r["body"]) for r in got.collect()} == {(1, "Again", "later"), (2, "Two", "b")}
    assert sections.missing_numbers(got, "k", 1, 3).first()["missing"] == [3]


def test_tags_and_prefixes(spark):
    block = "Chapter (Ada PoV) Part 1 (Bo PoV) Part 2"
    df = spark.createDataFrame([(block, "Part 2"), (block, "Part 1"), ("Part 3 (Cy PoV)", "Part 3"), ("none", "x")], "b string, l string")
    assert [r[0] for r in df.select(sections.tag_of_label("b", "l", r"\((\w+) PoV\)")).collect()] == ["bo", "ada", "cy", None]
    m = spark.createDataFrame([("alpha-2",), ("zeta",)], "m string")
    assert [r[0] for r in m.select(sections.by_prefix("m", {"alpha": "A"}, "other")).collect()] == ["A", "other"]


def test_token_prefix(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, "ab"), (3, None)], "k int, t string")
    got = {r["k"]: (r["text"], r["tokens"], r["shortened"]) for r in sections.token_prefix(df, "k", "t", lambda s: [ord(c) for c in s], lambda i: "".join(map(chr, i)), 4).collect()}
    assert got == {1: ("abcd", 4, True), 2: ("ab", 2, False), 3: (None, 0, False)}


def test_values_at_places_equal_the_sorted_list(spark):
    r = random.Random(4)
    xs = [round(r.random(), r.choice([2, 6])) for _ in range(500)] + [0.5] * 200
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "s double")
    want = sorted(xs)
    assert retrieve.at_places(df, "s", {"a": 0, "b": 35, "c": 350, "d": 699}, 0.05) == {"a": want[0], "b": want[35], "c": want[350], "d": want[699]}
    assert retrieve.at_places(df.limit(0), "s", {"a": 0}) == {}


def test_a_hot_part_is_numbered_in_ranges(spark):
    new = spark.createDataFrame([(i, "p") for i in range(0, 60_000, 7)] + [(3, "q")], "k long, part string")
    used = spark.createDataFrame([("p", 5)], "part string, n int")
    got = {r["k"]: r["n"] for r in toc.sequence_ids(new, used, "part", ["k"], "n").where("part = 'p'").collect()}
    assert [got[i] for i in range(0, 60_000, 7)] == list(range(6, 6 + len(got)))


def test_windows_in_ranges_equal_plain_windows(spark):
    from pyspark.sql import Window

    from hibiki.operators import ranges

    r = random.Random(6)
    rows = [(r.choice(["a", "a", "b", None]), r.choice([None, *range(0, 400, 3)]), i, r.choice([None, 1, 2, 3])) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, o int, k int, v int")
    w = Window.partitionBy("g").orderBy("o", "k")
    got = {x["k"]: x["p"] for x in ranges.with_previous(df, ["g"], ["o", "k"], F.col("v"), "p", 50).collect()}
    assert got == {x["k"]: x["p"] for x in df.withColumn("p", F.lag("v").over(w)).collect()}
    got = {x["k"]: x["n"] for x in ranges.with_running_count(df, ["g"], ["o", "k"], F.col("v") > 1, "n", 50).collect()}
    assert got == {x["k"]: x["n"] for x in df.withColumn("n", F.count_if(F.col("v") > 1).over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}
    assert ranges.with_previous(df.limit(0), ["g"], ["o"], F.col("v"), "p").count() == 0
