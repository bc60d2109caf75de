import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.functions import edit, normalize, speech, vectors
from voxloom.functions import text as t


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_operations(a, b):
    s, i, d = edit.operations(a, b)
    assert min(s, i, d) >= 0 and s + i + d == distance(a, b) and i - d == len(b) - len(a)


def test_edit_udfs(spark):
    df = spark.createDataFrame([("abc", "abd"), (None, "a"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(edit.char_operations("a", "b")["s"]).collect()] == [1, None, 0]
    assert df.select(edit.word_operations("a", "b")["n"]).collect()[2][0] == 1  # an empty text counts one word
    assert df.select(edit.match_ratio("a", "b")).first()[0] == pytest.approx(2 / 3)


@pytest.mark.parametrize(
    "raw, want",
    [
        ("三百二十万零五", "⟦NUM:3200005⟧"), ("2025/02/30", "2025/02/30"), ("二〇二四年二月二十九日", "⟦DATE:2024-02-29⟧"), ("九点三刻", "⟦TIME:09:45⟧"), ("23:61", "23:61"), ("百分之三十五点五", "⟦PERCENT:35.5⟧"), ("forty two percent", "⟦PERCENT:42⟧"),
        ("€7.50", "⟦MONEY:EUR:7.5⟧"), ("三块五毛钱", "⟦MONEY:CNY:3.5⟧"), ("6/8 kg", "⟦QTY:3/4:kg⟧"), ("15 minutes", "⟦QTY:15:min⟧"), ("四分之三", "⟦FRACTION:3/4⟧"), ("two thirds", "⟦FRACTION:2/3⟧"), ("¾", "⟦FRACTION:3/4⟧"), ("第三十一", "⟦ORDINAL:31⟧"),
        ("22nd", "⟦ORDINAL:22⟧"), ("23th", "23th"), ("thirty-first", "⟦ORDINAL:31⟧"), ("电话是一二三四", "电话是⟦DIGITS:1234⟧"), ("007", "⟦DIGITS:007⟧"), ("12,345,678", "⟦NUM:12345678⟧"), ("three thousand two hundred and six", "⟦NUM:3206⟧"), ("minus five", "⟦NUM:-5⟧"),
        ("&lt;b&gt;", "b"), ("&nosuch;", "⟦HTML:nosuch⟧"), ("万一下雨", "万一下雨"), ("一起走", "一起走"), ("比分2/3", "比分2/3"), ("five six", "⟦NUM:5⟧ ⟦NUM:6⟧"), ("", ""),
    ],
)
def test_safe(raw, want):
    assert normalize.safe(raw) == want and normalize.safe(want) == want


@settings(max_examples=200, deadline=None)
@given(st.text("0123456789一二十百万亿点分之年月日第块钱%/:.-,$ abonetwhdr", max_size=14))
def test_safe_settles(s):
    try:
        once = normalize.safe(s)
    except ValueError:
        return
    assert normalize.safe(once) == once


def test_strict():
    assert normalize.strict("Ｈｉ　there，ｉｔ’ｓ　ＯＫ！") == "hi there it's ok"
    assert normalize.strict("好 的 ， go") == "好的go"


def test_text_columns(spark):
    df = spark.createDataFrame([("[laughter]好玩[sigh] ok", "cn_mostly"), ("", "pure_cn"), (None, None)], "text string, k string")
    r = df.select(t.tags("text"), t.speech_units("text"), t.fits_language("text", "k"), t.conflict_issues("text"), t.start_issues("text")).collect()
    assert r[0][0] == ["laughter", "sigh"] and r[0][1] == 3 and r[0][2] and r[0][3] == 1 and r[0][4] == 2
    assert r[1][1] == 0 and not r[1][2] and r[2][0] is None and not r[2][2]
    g = spark.createDataFrame([("abcab",), ("ab",), ("",)], "s string")
    assert [sorted(x[0]) for x in g.select(t.grams("s", 2)).collect()] == [["ab", "bc", "ca"], ["ab"], []]
    assert [x[0] for x in g.select(F.size(t.shingles("s"))).collect()] == [3, 2, 0]


def test_chunks_and_durations():
    assert speech.chunks("Dr. Lee came. He sat! Then, he left.", 16) == ["Dr. Lee came.", "He sat! Then,", "he left."]
    assert speech.chunks("A. Bcdefgh ijkl mnop.", 10, 5) == ["A. Bcdefgh ijkl mnop."]
    assert speech.chunks(None, 5) == [] and speech.chunks("  ", 5) == []
    assert speech.total("a你 1") == pytest.approx(1 + 3 + 0.2 + 3.5)
    assert speech.estimate("ab", None, 1.0) == 0 and speech.estimate("ab" * 100, "ab", 1.0) == pytest.approx(100)
    assert speech.estimate("ab", "ab", 1.0) == pytest.approx(50 * (1 / 50) ** (1 / 3))


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 0 and got[1] == pytest.approx(1) and got[2] is None and got[3] is None
    x = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (2.1,), (None,)], "x double")
    assert [r[0] for r in x.select(vectors.bucket("x", 0.5, 2.0, 3)).collect()] == [0, 0, 2, None, None]
