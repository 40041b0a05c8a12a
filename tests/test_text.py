"""Column functions against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from cuelake.functions import linebreak, spoken
from cuelake.functions import text as T


def apply(spark, function, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(function(F.col("x")).alias("y")).collect()]


def test_punctuation_and_ellipsis(spark):
    assert apply(spark, T.fix_punctuation, ["Stop! Nu! Meteen!", "Eerste; tweede."]) == ["Stop. Nu. Meteen.", "Eerste. tweede."]
    assert apply(spark, T.fix_ellipsis, ["Eerste… en tweede…"]) == ["Eerste... en tweede..."]
    assert apply(spark, T.visible_length, ["a...b", "....", ""]) == [3, 2, 0]


def test_speaker_dash(spark):
    assert apply(spark, T.fix_speaker_dash, ["- Eerste spreker\n- Tweede spreker", "Een\n-Twee", "- Een", "-A\nB"]) == ["Eerste spreker\n-Tweede spreker", "Een\n-Twee", "- Een", "-A\nB"]
    assert apply(spark, T.is_dual_speaker, ["A\n - B", "A - B", "A-B", "A\nB"]) == [True, True, False, False]


def test_line_length(spark):
    long = "Dit is een veel te lange regel die gebroken moet worden"
    out = apply(spark, T.fix_line_length, ["A" * 42, f"x\n{'A' * 50}", long])
    assert out[:2] == ["A" * 42, f"x\n{'A' * 50}"]
    top, bottom = out[2].split("\n")
    assert f"{top} {bottom}" == long and len(top) <= len(bottom)
    assert apply(spark, T.fix_line_length, ["A" * 50]) == ["A" * 50]


def test_markers_and_replies(spark):
    assert apply(spark, T.marker, ["  [SC] Tekst.", "Dit is [SC] tekst.", "[SC]", "[NM] x"]) == ["SC", "", "SC", "NM"]
    assert apply(spark, T.unmarked, ["  [SC] Tekst.", "Dit is [SC] tekst.", "[SC]"]) == ["Tekst.", "Dit is [SC] tekst.", ""]
    assert apply(spark, T.is_trivial_reply, ["Ja.", " Dank je ", "Ja, dat klopt.", "PRECIES?."]) == [True, True, False, True]


def test_wrap(spark):
    assert apply(spark, T.wrap_text, ["", "A" * 50, "kort", "  a \n b "]) == ["", None, "kort", "a b"]
    assert apply(spark, T.wrap_text, [" ".join(["woord"] * 30)]) == [None]


def test_timecodes(spark):
    assert apply(spark, T.timecode_to_ms, ["01:02:03,004", "00:00:01.500", "x", "1:2:3,4"]) == [3723004, 1500, None, None]
    assert apply(spark, T.ms_to_timecode, [3723004, -5], "x bigint") == ["01:02:03,004", "00:00:00,000"]


def test_fps(spark):
    assert apply(spark, T.classify_fps, ["23.976", "24000/1001", "25", "29.97", "x"]) == [24, 24, 25, 25, None]


@pytest.mark.parametrize(("number", "words"), [("0", "zero"), ("21", "twenty one"), ("100", "hundred"), ("101", "one hundred and one"), ("340", "three hundred and forty"), ("1000", "thousand"), ("1,000", "thousand"), ("1984", "nineteen eighty four"), ("1905", "nineteen five"), ("1900", "nineteen hundred"), ("2000", "two thousand"), ("2005", "two thousand and five"), ("2024", "twenty twenty four"), ("3rd", "third"), ("1234", "one two three four"), ("007", "zero zero seven")])
def test_numbers(spark, number, words):
    assert apply(spark, spoken.number_to_words, [number]) == [words]


def test_normalize(spark):
    assert apply(spark, spoken.normalize_words, ["<i>It's</i> 25 o'clock...\n- Don't 'shout'!"]) == ["it is twenty five o'clock do not shout"]


def test_register_and_idiom(spark):
    assert apply(spark, T.register, ["Wilt u dat ", "Heb je u gezien", "als je wilt", "niets"]) == ["formal", "mixed", "informal", None]
    df = spark.createDataFrame([("it rains cats and dogs", "het regent pijpenstelen buiten"), ("a b c d", "a b c d")], "e string, n string")
    assert [r[0] for r in df.select(T.is_idiom_candidate(F.col("e"), F.col("n"))).collect()] == [True, False]


def test_balance(spark):
    found = apply(spark, linebreak.balance_issues, ["Ja\nmaar dat is een heel andere zaak", "Dit is de\nzaak van de eeuw", "Een regel", "A\n-B"])
    assert [[(i["type"], i["severity"]) for i in x] for x in found] == [[("orphan_top", "high")], [("bad_break", "high")], [], []]


def test_best_break(spark):
    df = spark.createDataFrame([("Ik wilde naar huis gaan, maar de trein was al vertrokken",), ("kort",), ("A" * 60,)], "t string")
    out = [r["b"] for r in linebreak.with_best_break(df, "t", "b").select("b").collect()]
    assert out[0]["top"].endswith(",") and out[0]["bottom"].startswith("maar")
    assert out[1:] == [None, None]
