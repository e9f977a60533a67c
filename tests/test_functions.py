"""Literal-frame tests of the text functions and validators."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.operators import validate


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()[0]


def test_white_space_is_pythons(spark):
    s = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
    assert one(spark, T.visible_chars("x"), "a" + s + "b") == 2
    assert one(spark, T.trimmed("x"), s + "a b" + s) == "a b"
    assert one(spark, T.collapsed("x"), "　a\n\n b\xa0") == "a b"


def test_lines_are_pythons(spark):
    s = "a\r\nb\nc\rd\x0be\x0cf\x1cg\x85h i j"
    assert one(spark, T.lines("x"), s) == s.splitlines()


def test_counts_and_dialogue(spark):
    assert one(spark, T.count_of("x", "aa"), "aaaaa") == 2
    assert one(spark, T.count_any("x", ["Hana-san", "Hana"]), "Hana-san Hana") == 3
    assert one(spark, T.dialogue_blocks_target("x"), "「a」「b” “c”") == 1
    assert one(spark, T.dialogue_blocks_target("x"), "“a” “b”") == 2
    assert one(spark, T.dialogue_blocks_target("x"), '"a" "b" "') == 2
    assert one(spark, T.dialogue_blocks_source("x"), "「a」「b") == 1


def test_paragraph_kind(spark):
    for text, kind in (("　", "blank"), (None, "blank"), ("　「a」", "dialogue"), ("a「b」", "narration"), ("\xa0“a”", "dialogue")):
        assert one(spark, T.paragraph_kind("x"), text) == kind


def test_number_words_and_ids(spark):
    for w, n in (("twelve", 12), ("Thirty-eight", 38), ("sixty eight", 68), ("40", 40), ("ninety", 90), ("dozen", None), ("twentyten", None)):
        assert one(spark, T.word_to_number("x"), w) == n, w
    assert one(spark, T.part_id_of("x"), "4") == "part_004"
    assert one(spark, T.part_id_of("x"), "extra_v1") == "extra_v1"


def test_templates_replace_in_one_pass(spark):
    got = one(spark, T.substituted("x", {"a": F.lit("$b"), "ab": F.lit("2"), "b": F.lit("3")}), "$a $ab $b $zz $")
    assert got == "$b 2 3 $zz $"


def test_safe_names_tell_long_urls_apart(spark):
    a, b = "https://e.example/" + "x" * 300, "https://e.example/" + "x" * 301
    na, nb = one(spark, T.safe_name("x"), a), one(spark, T.safe_name("x"), b)
    assert na != nb and len(na) == 186 and one(spark, T.safe_name("x"), "http://a/b??c") == "a_b__c.html"


def test_unfenced(spark):
    assert one(spark, T.unfenced("x"), '```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(spark, T.unfenced("x"), 'Here: {"a": {"b": 1}} done') == '{"a": {"b": 1}}'


NAMES = [("柊", ["Hiiragi-san", "Hiiragi"]), ("鳴海", ["Narumi"])]


def measured(spark, jp, en):
    rows = [Row(part_id="p", side="jp", text=jp), Row(part_id="p", side="en", text=en)]
    return validate.measures(spark.createDataFrame(rows, "part_id string, side string, text string"), NAMES)


def test_ratio_bands(spark):
    for n, status in ((200, "pass"), (160, "warn"), (330, "warn"), (100, "fail"), (400, "fail")):
        assert validate.validated(measured(spark, "あ" * 100, "a" * n), NAMES).first()["length"] == status, n
    assert validate.validated(measured(spark, "", "a"), NAMES).first()["length"] == "warn"


def test_dialogue_and_names(spark):
    m = measured(spark, "「a」" * 10, "“a”" * 9)
    assert validate.validated(m, NAMES).first()["dialogue"] == "pass"
    assert m.select(validate.dialogue_skew()).first()[0] == 0.1
    assert measured(spark, "a", "b").select(validate.dialogue_skew()).first()[0] is None
    rows = validate.name_skews(measured(spark, "柊" * 4, "Hiiragi-san"), NAMES).collect()
    assert [(r["name"], r["jp_n"], r["en_n"], r["skew"]) for r in rows] == [("柊", 4, 2, 0.5)]


def test_distribution_of_nothing_and_one(spark):
    v = spark.createDataFrame([("m", 2.0)], "metric string, value double")
    r = validate.distribution(v).first()
    assert (r["n"], r["mean"], r["stdev"], r["p95"]) == (1, 2.0, 0.0, 2.0)
    assert validate.distribution(v.limit(0)).count() == 0
    assert tuple(validate.recommendations(validate.distribution(v.limit(0))).first()) == (1.0, 3.0, 0.1)
