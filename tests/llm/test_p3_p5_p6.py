"""Overlaps, neighbours and look-alikes against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hibiki.llm import lookalike, neighbours, overlap


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_common_is_the_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randrange(30))) for _ in "ab")
        assert overlap.common(a, b) == lcs(a, b)


def test_the_prefix_loses_no_pair():
    r = random.Random(2)
    letters = [chr(0x3042 + i) for i in range(40)]
    for _ in range(300):
        a = [r.choice(letters) for _ in range(r.randrange(20, 60))]
        b = list(a)
        for _ in range(r.randrange(12)):
            k = r.randrange(len(b))
            b[k : k + r.choice([0, 1, 1])] = [r.choice(letters)] if r.random() < 0.6 else []
        a, b = "".join(a), "".join(b)
        rarity = {(c, k): r.randrange(50) for c in letters for k in range(1, overlap.OCCURRENCES + 1)}
        if overlap.alike(a, b):
            assert set(overlap.prefix(a, rarity)) & set(overlap.prefix(b, rarity))


def test_prefixes_of_a_batch_are_those_of_each_text():
    import pandas as pd

    r = random.Random(9)
    letters = "あいうえおabc😀"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(1, 40))) for _ in range(50)] + ["a" * 30, ""]
    rarity = {(c, k): r.randrange(6) for c in letters for k in range(1, overlap.OCCURRENCES + 1)}
    ranks = np.zeros((0x110000, overlap.OCCURRENCES), np.int64)
    for (c, k), n in rarity.items():
        ranks[ord(c), k - 1] = n
    doc, cp, k, rank = overlap.prefixes(pd.Series(texts), ranks, 0.85)
    for i, t in enumerate(texts):
        want = overlap.prefix(t, rarity) if t else []
        assert [(chr(c), n) for c, n in zip(cp[doc == i], k[doc == i])] == want
        assert [rarity[c, min(n, overlap.OCCURRENCES)] for c, n in want] == list(rank[doc == i])


def records(seed=3):
    r = random.Random(seed)
    words = ["雨", "カバン", "学校", "机", "走った", "歩いた", "買った", "梶", "瀬名", "駅前", "古い", "新しい", "で", "を", "に", "は"]
    base = ["".join(r.choice(words) for _ in range(r.randrange(6, 16))) for _ in range(60)]
    rows = []
    for i in range(560):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 3, 6])):
            t[r.randrange(len(t))] = r.choice("空海山川")
        t = "".join(t)
        if r.random() < 0.3:
            t = "　" + t.replace("は", "は、") + "。"
        if r.random() < 0.1:
            t = t.replace("カバン", "ｶﾊﾞﾝ")
        rows.append((i, r.choice(["train", "train", "dev", "test", None]), t if r.random() > 0.02 else None))
    return rows


def test_overlaps_equal_brute_force(spark):
    rows = records()
    df = spark.createDataFrame(rows + rows[:20], "pr_id long, split string, jp_text string").selectExpr("*", "1 as canon", "2 as cls", "3 as n")
    got = {(r["eval_id"], r["train_id"]): r["exact"] for r in overlap.overlaps(df, "pr_id", "split", "jp_text").collect()}
    want = {}
    canon = {i: overlap.canonical_text(t) for i, s, t in rows if t is not None and s}
    for i, s, _ in rows:
        for j, z, _ in rows:
            if i in canon and j in canon and s not in (None, "train") and z == "train" and max(len(canon[i]), len(canon[j])) >= 20:
                a, b = canon[i], canon[j]
                if lcs(a, b) >= 0.85 * max(len(a), len(b)) - 1e-9:
                    want[i, j] = a == b
    assert len(want) > 100 and got == want


def test_split_keys_and_classes_lose_no_pair(spark, monkeypatch):
    rows = records(5)
    df = spark.createDataFrame(rows, "pr_id long, split string, jp_text string")
    whole = {tuple(r) for r in overlap.overlaps(df, "pr_id", "split", "jp_text").collect()}
    monkeypatch.setattr(overlap, "PIECE", 7)
    assert {tuple(r) for r in overlap.overlaps(df, "pr_id", "split", "jp_text").collect()} == whole
    pairs, member = overlap.class_overlaps(df, "pr_id", "split", "jp_text")
    of = {(r["id"], r["held"]): r["cls"] for r in member.collect()}
    got = {(r["e"], r["t"]): (r["exact"], r["n_eval"], r["n_train"]) for r in pairs.collect()}
    assert set(got) == {(of[a, True], of[b, False]) for a, b, _ in whole} and sum(a * b for _, a, b in got.values()) == len(whole)


def test_overlaps_of_hard_input(spark):
    long = "あいうえおかきくけこ" * 400
    rows = [(1, "train", long), (2, "dev", long[:-5] + "ん"), (3, "dev", ""), (4, "train", "。。"), (5, "dev", None), (6, None, long), (7, "test", "短い"), (8, "train", "短い")]
    df = spark.createDataFrame(rows, "id long, split string, t string")
    assert {(r["eval_id"], r["train_id"]) for r in overlap.overlaps(df, "id", "split", "t").collect()} == {(2, 1)}
    assert overlap.overlaps(df.limit(0), "id", "split", "t").count() == 0


def clustered(n=1500, size=16, seed=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(40, size))
    m = (centres[r.integers(40, size=n)] + 0.3 * r.normal(size=(n, size))).astype("f4")
    m[50:80] = m[50]  # copies
    m[90:95] = 3 * m[91]
    return m


def truth(m, k):
    u = m.astype("f8")
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    return [sorted(range(len(m)), key=lambda j: (-s[i, j], j))[:k] for i in range(len(m))]


def test_neighbours_reach_the_target(spark):
    m = clustered()
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    rows += [(9001, None), (9002, [0.0] * 16), (9003, [1.0] * 8), (9004, [float("nan")] + [1.0] * 15), rows[3]]
    df = spark.createDataFrame(rows, "row_id long, embedding array<float>").selectExpr("*", "1 as cls", "2 as v", "3 as leaf")
    got = {}
    for r in neighbours.nearest(df, "row_id", "embedding", 16, 5, sample=800, leaves=64, calibration=200).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    want = truth(m, 5)
    assert set(got) == set(range(len(m)))
    assert all(len(v) == 5 and [a for a, _ in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values())
    hits = sum(len({b for _, b in got[i]} & set(want[i])) for i in got)
    assert hits / (5 * len(m)) >= 0.93
    assert [b for _, b in sorted(got[60])] == want[60] and [b for _, b in sorted(got[50])] == want[50]


def test_visited_leaves_are_those_of_the_queue():
    r = np.random.default_rng(8)
    x = r.normal(size=(600, 8)).astype("f4")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = neighbours.fit(x, 60)
    for visits in (1, 5, 17, len(tree.leaves) - 1, len(tree.leaves)):
        seen = tree.visited(x[:200], visits)
        for i in range(200):
            assert set(np.flatnonzero(seen[i])) == set(tree.walk(x[i], visits))


def test_a_sample_is_all_that_the_driver_gets(spark):
    df = spark.range(6000).selectExpr("id * 7 as cls", "unhex(lpad(hex(id), 16, '0')) as b").repartition(24)
    rows = df.withColumn("v", F.concat(*[F.col("b")] * 8)).select("cls", "v").cache()  # 64 bytes: 16 floats
    for n, salt in ((500, ()), (400, (11,)), (6000, ()), (9000, ())):
        want = rows.orderBy(F.xxhash64("cls", *[F.lit(x) for x in salt]), "cls").limit(n).collect()
        ids, v = neighbours.smallest(rows, n, 16, *salt)
        assert ids.tolist() == [r["cls"] for r in want] and [x.tobytes() for x in v] == [bytes(r["v"]) for r in want]
    limit = spark.sparkContext._jsc.sc().conf()
    limit.set("spark.driver.maxResultSize", "200k")  # an ordered limit of 1,500 rows sends all 6,000 of 24 partitions, over 400 KB
    try:
        assert len(neighbours.smallest(rows, 1500, 16)[0]) == 1500
    finally:
        limit.set("spark.driver.maxResultSize", "1g")
        rows.unpersist()
    assert neighbours.smallest(rows.limit(0), 5, 16)[1].shape == (0, 16)


def test_steps_are_those_of_the_walk():
    r = np.random.default_rng(9)
    x = r.normal(size=(600, 8)).astype("f4")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = neighbours.fit(x, 60)
    for q in x[:100]:
        order = tree.walk(q, len(tree.leaves))
        assert tree.steps(q, np.array(order)).tolist() == list(range(len(order)))


def test_neighbours_cut_crowded_groups(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 64)
    m = clustered(500)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "row_id long, embedding array<float>")
    r = neighbours.recall(df, "row_id", "embedding", 16, 5, each=5, sample=300, leaves=16, calibration=100).first()
    assert r["recall"] >= 0.93


def test_recall_is_that_of_rows(spark):
    m = clustered(500)
    m[200:365] = m[7]  # a third are copies
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "row_id long, embedding array<float>")
    options = {"sample": 300, "leaves": 16, "calibration": 100, "target": 0.8}
    r = neighbours.recall(df, "row_id", "embedding", 16, 5, each=5, **options).first()
    want, got = truth(m, 5), {}
    for x in neighbours.nearest(df, "row_id", "embedding", 16, 5, **options).where("id % 5 = 0").collect():
        got.setdefault(x["id"], set()).add(x["neighbour"])
    same = sum(len(got[i] & set(want[i])) for i in range(0, 500, 5))
    assert (r["queries"], r["truth"], r["same"]) == (100, 500, same) and same <= r["found"] <= 500 and r["recall"] == r["found"] / 500


def test_exact_search_is_brute_force(spark):
    m = clustered(400)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "row_id long, embedding array<float>")
    got, want = {}, truth(m, 5)
    for r in neighbours.exact(df, "row_id", "embedding", 16, 5, each=20).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    assert {i: [b for _, b in sorted(v)] for i, v in got.items()} == {i: want[i] for i in range(0, 400, 20)}


def test_neighbours_of_few(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1])], "row_id long, embedding array<float>")
    assert {(r["id"], r["neighbour"]) for r in neighbours.nearest(df, "row_id", "embedding", 2).collect()} == {(1, 2), (2, 1)}
    assert neighbours.nearest(df.limit(0), "row_id", "embedding", 2).count() == 0


SAME = [
    ("Ｐｉａｎｏ", "Piano"), ("ｶﾊﾞﾝ", "カバン"), ("が", "が"), ("a​b", "ab"), ("a\xadb⁠", "ab"), ("a b", "a\xa0b"), ("a b", "a　b"), ("РС", "PC"), ("Νοtе", "Note"),
    ("卜ンネル", "トンネル"), ("カナ工", "カナエ"), ("ス―パー", "スーパー"), ("⽉", "月"), ("隣", "隣"), ("ﬁre", "fire"), ("café", "café"), ("夜︀", "夜"), ("ｶ‍ﾞ", "ガ"), ("⾧い", "長い"), ("ᎪᏴ", "AB"), ("օո", "on"), ("ꓐꓳ", "BO"), ("天オ", "天才"),
]
OTHER = [("か", "が"), ("ab", "a b"), ("Piano", "piano"), ("①", "1"), ("は", "ば"), ("x²", "x2"), ("雨", "雪"), ("a\nb", "a b"), ("10", "IO")]


@pytest.mark.parametrize("rich", [True, False])
def test_lookalikes(spark, rich):
    texts = [x for p in SAME + OTHER for x in p]
    texts += ["カバンのトンネルで Piano を月に"] * 50 if rich else []
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rules = lookalike.learn(df, "t")
    f = lookalike.Rewriter(rules)
    for a, b in SAME:
        assert f(a) == f(b), (a, b, f(a), f(b))
    for a, b in OTHER:
        assert f(a) != f(b), (a, b)
    for t in texts:
        assert f(f(t)) == f(t)
    assert f(None) is None and f("") == "" and f("​") == ""


def test_pairs_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate([x for p in SAME for x in p] + ["ab", "ab", None, "", "​", "ab"])]
    df = spark.createDataFrame(rows + rows[:5], "id long, text string").selectExpr("'u' as unit", "*", "1 as t", "2 as c")
    rules = lookalike.learn(df, "text")
    f = lookalike.Rewriter(rules)
    got = {(r["id_a"], r["id_b"]) for r in lookalike.same_to_the_eye(lookalike.canonicalised(df, "text", rules), ["unit"], "id", "text", "canonical").collect()}
    assert got == {(i, j) for i, a in rows for j, b in rows if i < j and a is not None and b is not None and a != b and f(a) == f(b)}
    members = {r["id"]: (r["class_id"], r["variants"], r["links"]) for r in lookalike.eye_classes(lookalike.canonicalised(df, "text", rules), ["unit"], "id", "text", "canonical").collect()}
    for i, a in rows:
        if a is not None:
            like = [(j, b) for j, b in rows if b is not None and f(a) == f(b)]
            assert members[i] == (min(j for j, _ in like), len({b for _, b in like}), sum(b != a for _, b in like))
    empty = df.limit(0)
    assert lookalike.eye_classes(lookalike.canonicalised(empty, "text", rules), ["unit"], "id", "text", "canonical").count() == 0
    assert lookalike.same_to_the_eye(lookalike.canonicalised(empty, "text", lookalike.learn(empty, "text")), ["unit"], "id", "text", "canonical").count() == 0
