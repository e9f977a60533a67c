"""Truncation and sentence units."""

import json

import pytest

from hibiki.llm import sentences, truncation


def answers(spark, rows):
    return spark.createDataFrame(rows, "raw_id long, model string, raw_response string")


def cut_ids(df):
    return {r["raw_id"] for r in truncation.truncated(df, "raw_id", "model", "raw_response").collect()}


WHOLE = json.dumps({"risks": [{"jp_span": "雨", "reason": "It \"rains\"."}]}, ensure_ascii=False)


@pytest.mark.parametrize(
    ("text", "cut"),
    [
        (None, False), ("", False), (" \n", False), (WHOLE, False), ("```json\n" + WHOLE + "\n```", False), (WHOLE + "\n\nAll spans were checked.", False),
        (WHOLE[:-3], True), (WHOLE[:20], True), (WHOLE[:24] + "…", True), (WHOLE[:24] + "...", True), ("```json\n" + WHOLE[:-2], True),
        (WHOLE + "\n\nAll spans were checked against the sour", True),
        ('{"risks": [{"a": "b"},]}', False), ("{'risks': []}", False), ('{"risks": [{"reason": "the so" called"}]}', False),
        ("The rain fell. Nobody saw the lett", True), ("The rain fell. Nobody saw the letter.", False), ("Nobody knew. It was at the [truncated]", True), ("No risks", False),
        ("- one thing\n- another thing\n- a third thing", False),
    ],
)
def test_ends(spark, text, cut):
    assert (cut_ids(answers(spark, [(1, "m", text)])) == {1}) == cut


def test_a_limit_of_values_inside_answers(spark):
    rows, want = [], set()
    for i in range(200):
        note = f"Note {i}: " + "word " * (8 + i % 37) + "end."
        if i % 3 == 0 and len(note) > 90:
            note = note[:90]
            want.add(i)
        rows.append((i, "capped", json.dumps({"phrase_pairs": [{"jp_span": "雨", "notes": note}], "paragraph_pairs": []})))
    rows += [(1000 + i, "free", json.dumps({"phrase_pairs": [{"notes": f"Note {i} " + "word " * (8 + i % 37) + "end."}]})) for i in range(200)]
    got = cut_ids(answers(spark, rows))
    assert len(want) > 20 and got == want


@pytest.mark.parametrize("copied", ["cut at the limit", "whole at the limit", "whole beside the limit"])
def test_copies_hide_no_limit(spark, copied):
    def answer(note):
        return json.dumps({"phrase_pairs": [{"jp_span": "雨", "notes": note}], "paragraph_pairs": []})

    rows, want = [], set()
    for i in range(200):
        note = f"Note {i}: " + "word " * (8 + i % 37) + "end."
        if i % 3 == 0 and len(note) > 90:
            note = note[:90]
            want.add(i)
        rows.append((i, "capped", answer(note)))
    one = {"cut at the limit": "Copy: " + "word " * 16 + "wo", "whole at the limit": "Copy: " + "word " * 16 + "en.", "whole beside the limit": "Copy: " + "word " * 15 + "end."}[copied]
    one = one + "d" * (90 - len(one)) if copied == "cut at the limit" else one[:-1] + "d" * ((90 if "at" in copied else 85) - len(one)) + "."
    rows += [(1000 + i, "capped", answer(one)) for i in range(1000)]
    if copied == "cut at the limit":
        want |= set(range(1000, 2000))
    assert cut_ids(answers(spark, rows)) == want


def test_lists_of_words_are_no_limit(spark):
    rows = [(i, "m", json.dumps({"risks": [{"category": "x" * 40 if i % 2 else "y" * 35}]})) for i in range(100)]
    assert cut_ids(answers(spark, rows)) == set()


def test_truncation_of_hard_input(spark):
    rows = [(1, None, WHOLE[:-3]), (1, None, WHOLE[:-3]), (None, "m", WHOLE[:-3]), (2, "m", "{" + '"a": "' + "x" * 200_000), (3, "m", "\\" * 5000)]
    df = answers(spark, rows).withColumnsRenamed({}).selectExpr("*", "1 as value", "2 as field", "3 as _tail", "4 as chars")
    assert {1, 2} <= cut_ids(df)
    assert cut_ids(answers(spark, [])) == set()
    from pyspark.sql import functions as F

    rep = {r["model"]: (r["answers"], r["cut"]) for r in truncation.truncation_report(answers(spark, rows[:1] + [(9, "m", WHOLE)]), "raw_id", "model", "raw_response", F.lit("risk")).collect()}
    assert rep == {None: (1, 1), "m": (1, 0)}


CASES = [
    ("Mr. Abe paid 3.50 yen. Then he left.", ["Mr. Abe paid 3.50 yen.", "Then he left."]),
    ("At 6:30 a.m. Irie ran. Sena left at 10 p.m. Kaji slept.", ["At 6:30 a.m. Irie ran.", "Sena left at 10 p.m.", "Kaji slept."]),
    ("The name Y. Kasai was on Note B. Makabe saw it.", ["The name Y. Kasai was on Note B.", "Makabe saw it."]),
    ("“Be quiet?” Hoashi whispered to Kaji. “Go!”", ["“Be quiet?” Hoashi whispered to Kaji.", "“Go!”"]),
    ("Kaji said, “Go home! It's late.” Sena left.", ["Kaji said, “Go home! It's late.”", "Sena left."]),
    ("“It's cold,” Kaji said. She (forget it!). He... ran... Then", ["“It's cold,” Kaji said.", "She (forget it!).", "He... ran...", "Then"]),
    ("She bought pens, ink, etc. Then rain fell (e.g. hail) vs. the rest.", ["She bought pens, ink, etc.", "Then rain fell (e.g. hail) vs. the rest."]),
    ("The smell of the coat\nreached the hall. In room No. 4,\nhe sat?! Yes", ["The smell of the coat\nreached the hall.", "In room No. 4,\nhe sat?!", "Yes"]),
    ("See https://a.example/x.html?q=1 now. It's ‘Don't go!’ in vol. 3 of it.", ["See https://a.example/x.html?q=1 now.", "It's ‘Don't go!’ in vol. 3 of it."]),
    ("　彼は走った。「待って！行くな」と梶が言った。雨だ！？寒い", ["彼は走った。", "「待って！行くな」と梶が言った。", "雨だ！？", "寒い"]),
    ("汐見は……針を奪った……雨だった……。\n昨日、寝た\n重さは２５．１キロだった。", ["汐見は……針を奪った……", "雨だった……。", "昨日、寝た", "重さは２５．１キロだった。"]),
    ("買った（忘れて。）。『もう帰ろう！』という題だ。", ["買った（忘れて。）。", "『もう帰ろう！』という題だ。"]),
    ("今天的风很大！你真的要回去吗？", ["今天的风很大！", "你真的要回去吗？"]),
    ("कोई नहीं आया। क्या तुम आए?", ["कोई नहीं आया।", "क्या तुम आए?"]),
    ("هل ستعود؟ الريح قوية.", ["هل ستعود؟", "الريح قوية."]),
    ("오늘은 바람이 세다. 정말?", ["오늘은 바람이 세다.", "정말?"]),
    ("วันนี้ลมแรง ไม่มีใครรู้", ["วันนี้ลมแรง", "ไม่มีใครรู้"]),
    ("***", []), ("※　※　※\n雨だ。\n◇", ["雨だ。"]), ("  \n", []), ("", []),
]


def test_units(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, text string")
    got = {}
    for r in sentences.units(df, "text", ["id"]).collect():
        assert CASES[r["id"]][0][r["start_pos"] : r["end_pos"]] == r["unit"]
        got.setdefault(r["id"], []).append((r["start_pos"], r["unit"]))
    for i, (text, want) in enumerate(CASES):
        assert [u for _, u in sorted(got.get(i, []))] == want, text


def test_units_of_hard_input(spark):
    long = "雨だ。" * 3000 + "😀 Yes. " * 500
    rows = [(1, None), (2, long), (2, long), (3, "a「b。c"), (4, "((((" * 500), (5, "")]
    df = spark.createDataFrame(rows, "id int, text string").selectExpr("*", "1 as unit", "2 as start_pos", "3 as _k")
    got = sentences.units(df, "text", ["id"]).collect()
    assert sum(r["id"] == 2 for r in got) == 2 * 3500
    assert all(long[r["start_pos"] : r["end_pos"]] == r["unit"] for r in got if r["id"] == 2)
    assert [r["unit"] for r in got if r["id"] == 3] == ["a「b。", "c"] and not any(r["id"] in (1, 4, 5) for r in got)
    assert sentences.units(df.limit(0), "text", ["id"]).count() == 0


def test_starts_are_running_sums(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 63, 64, 65, 200, 1000):
        parts = ["x" * (1 + i % 7) for i in range(n)]
        got = spark.createDataFrame([(parts,)], "p array<string>").select(sentences._starts(F.col("p"))).first()[0]
        assert got == [sum(map(len, parts[:i])) for i in range(n)]


def test_long_addresses_are_whole(spark):
    text = "See https://a.example/" + "x.y?z!" * 200 + "end. Then go."
    got = [r["unit"] for r in sentences.units(spark.createDataFrame([(1, text)], "id int, text string"), "text", ["id"]).collect()]
    assert sorted(map(len, got)) == [8, len(text) - 9]


def test_escapes_count_as_what_they_stand_for(spark):
    df = spark.createDataFrame([(1, "m", '{"n": "\\u96e8 \\"a\\" \\u0041\\n\\ud83d\\ude00 end."}')], "_id long, _src string, _text string")
    r = truncation.measured(truncation.with_shape(df, "_text")).where("field = '.n'").first()
    assert (r["chars"], r["bytes"], r["complete"]) == (14, 19, True)
