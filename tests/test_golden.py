"""Rows with results worked out by hand, one or more for each rule; they don't use the rules' own tables."""

import pytest
from pyspark.sql import functions as F

from voxloom.functions import normalize, voices
from voxloom.functions import text as t
from voxloom.operators import quality

SAFE = [
    ("二十三", "⟦NUM:23⟧"), ("五千零六", "⟦NUM:5006⟧"), ("七百万", "⟦NUM:7000000⟧"), ("三亿五千万", "⟦NUM:350000000⟧"), ("两万亿", "⟦NUM:2000000000000⟧"), ("2031-2-8", "⟦DATE:2031-02-08⟧"), ("2030.12.31", "⟦DATE:2030-12-31⟧"), ("2028年2月29日", "⟦DATE:2028-02-29⟧"),
    ("一九九八年十一月三号", "⟦DATE:1998-11-03⟧"), ("23:59", "⟦TIME:23:59⟧"), ("7:30 a.m.", "⟦TIME:07:30⟧"), ("12:15 pm", "⟦TIME:12:15⟧"), ("晚上八点半", "⟦TIME:20:30⟧"), ("凌晨十二点", "⟦TIME:00:00⟧"), ("中午12:05", "⟦TIME:12:05⟧"), ("六点一刻", "⟦TIME:06:15⟧"), ("九点零七", "⟦TIME:09:07⟧"),
    ("十点钟", "⟦TIME:10:00⟧"), ("seven o'clock", "⟦TIME:07:00⟧"), ("5 o'clock pm", "⟦TIME:17:00⟧"), ("3.25%", "⟦PERCENT:3.25⟧"), ("百分之九十九", "⟦PERCENT:99⟧"), ("6 percent", "⟦PERCENT:6⟧"), ("thirty-five percent", "⟦PERCENT:35⟧"), ("£8", "⟦MONEY:GBP:8⟧"), ("￥1,200", "⟦MONEY:CNY:1200⟧"),
    ("三十元", "⟦MONEY:CNY:30⟧"), ("8元5角2分", "⟦MONEY:CNY:8.52⟧"), ("两块钱", "⟦MONEY:CNY:2⟧"), ("45 km", "⟦QTY:45:km⟧"), ("半 3.5千克", "半⟦QTY:3.5:kg⟧"), ("三十摄氏度", "⟦QTY:30:degc⟧"), ("ten minutes", "⟦QTY:10:min⟧"), ("3/6 liters", "⟦QTY:1/2:l⟧"), ("五分之二", "⟦FRACTION:2/5⟧"), ("10/15", "⟦FRACTION:2/3⟧"),
    ("⅝", "⟦FRACTION:5/8⟧"), ("three quarters", "⟦FRACTION:3/4⟧"), ("one half", "⟦FRACTION:1/2⟧"), ("第九", "⟦ORDINAL:9⟧"), ("第 40", "⟦ORDINAL:40⟧"), ("43rd", "⟦ORDINAL:43⟧"), ("113th", "⟦ORDINAL:113⟧"), ("eighty-first", "⟦ORDINAL:81⟧"), ("sixth", "⟦ORDINAL:6⟧"), ("he was first", "he was ⟦ORDINAL:1⟧"),
    ("手机号是一三八零零", "手机号是⟦DIGITS:13800⟧"), ("area code 415", "area code ⟦DIGITS:415⟧"), ("number was nine oh two", "number was ⟦DIGITS:902⟧"), ("3,4,5", "⟦DIGITS:3,4,5⟧"), ("021-5555", "⟦DIGITS:0215555⟧"), ("13800138000", "⟦DIGITS:13800138000⟧"), ("08", "⟦DIGITS:08⟧"),
    ("98,765", "⟦NUM:98765⟧"), ("4.50", "⟦NUM:4.5⟧"), ("two hundred and six", "⟦NUM:206⟧"), ("four million", "⟦NUM:4000000⟧"), ("minus three", "⟦NUM:-3⟧"), ("one point zero five", "⟦NUM:1.05⟧"), ("x &lt; 9", "x ⟦NUM:9⟧"), ("&#50;&#51;", "⟦NUM:23⟧"), ("&bogus;", "⟦HTML:bogus⟧"), ("⟦TAG:sob⟧ 7", "⟦TAG:sob⟧ ⟦NUM:7⟧"),
    ("全角：８８％", "全角⟦PERCENT:88⟧"), ("买了3个和五十个", "买了⟦NUM:3⟧个和⟦NUM:50⟧个"), ("at 6:00, 2 people", "at ⟦TIME:06:00⟧ ⟦NUM:2⟧ people"),
]
UNCHANGED = [
    "我们一起去", "一点点", "三三两两", "万一呢", "千万别忘", "2/0", "25:10", "6:75", "22th", "2025-13-01", "五月六日", "someone else", "tone", "twenties", "thirty thirteen", "thousands", "a second", "second best", "比分2:1", "ratio 3/4", "score 2:1",
    "1.2.3.4", "7:08:09", "百分之", "零点五", "一块糖", "给我一点", "and", "minus", "point", "v2", "x7y", "",
]
DIFFERENT = [("八点", "八点钟"), ("1,234", "12,34"), ("3/4", "比分3/4"), ("first", "the first"), ("007", "7"), ("一千", "千"), ("8%", "8"), ("第三", "三")]


@pytest.mark.parametrize("raw, want", SAFE)
def test_safe_rows(raw, want):
    assert normalize.safe(raw) == want and normalize.safe(want) == want


@pytest.mark.parametrize("raw", UNCHANGED)
def test_unchanged_rows(raw):
    assert normalize.safe(raw) == raw


@pytest.mark.parametrize("a, b", DIFFERENT)
def test_different_rows(a, b):
    assert normalize.safe(a) != normalize.safe(b)


def test_what_does_not_settle_is_null(spark, monkeypatch):
    assert normalize.safe("一&amp;amp;amp;amp;amp;amp;lt;", most=1) is None
    df = spark.createDataFrame([("a",), (None,), ("二十",)], "x string")
    assert [r[0] for r in df.select(normalize.normalized_safe("x")).collect()] == ["a", None, "⟦NUM:20⟧"]


def _each(spark, fn, rows):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, text string")
    got = {r["i"]: r["x"] for r in df.select("i", fn("text").alias("x")).collect()}
    assert [got[i] for i in range(len(rows))] == [r[1] for r in rows]


def test_complete(spark):
    _each(spark, t.is_complete, [("今天很好。", True), ("今天很好，", False), ("因为", False), ("我想回家可是呢", False), ("我本来想，那个", False), ("we was gonna", False), ("I like it when", False), ("算了不说了。", False), ("never mind!", False), ("[sigh]", False), ("Good night!", True), ("然后呢？", True), ("等下", False), ("他说：", False)])


def test_phonetic(spark):
    _each(spark, t.phonetic_markup, [("妈妈 mā", True), ("ma1 ma", True), ("ㄅㄆ", True), ("/kæt/", True), ("读作大", True), ("拼音是", True), ("拼音：", True), ("谐音为", True), ("谐音好听", False), ("画个星号", True), ("press at sign", True), ("· 第一", True), ("ˊ", True), ("普通的话", False), ("room 12", False), ("", False)])


def test_child(spark):
    _each(spark, t.child_markers, [("吃饭饭", True), ("抱抱我", True), ("抱抱", False), ("走走走", True), ("走走看", True), ("好吃嘛", True), ("好吃呀！", True), ("好吃呀？", False), ("妈咪来了", True), ("不要嘛我不", True), ("今天天气好", False), ("[laughter]亲亲", True)])


def test_autocorrected(spark):
    _each(spark, t.autocorrected, [("等等...再说", "等等，再说"), ("嗯……好", "嗯，好"), ("好，，走", "好，走"), ("好 [sigh] 吧", "好[sigh] 吧"), ("好[sigh]，吧", "好[sigh]，吧"), ("[laughter][sigh]x", "[laughter] [sigh] x"), ("a  b", "a b"), ("[sigh] ", "[sigh]"), ("[odd] x", "[odd] x"), ("走.. [sigh]", "走..[sigh]"), (None, None), ("", "")])


def test_reasons(spark):
    base = {"text": "今天我们一起去公园玩[surprise-wa]，好开心。", "lang_type": "pure_cn", "length_type": "medium", "scenario": "play", "subscene": None, "age_tier": "upper_elem"}
    rows = [
        ({}, "pass"), ({"text": " "}, "empty"), ({"text": None}, "empty"), ({"text": "我要买股票。"}, "bad_marker"), ({"text": "今天我们去玩[laughter]。"}, "bad_marker"), ({"lang_type": "cn"}, "lang_type"), ({"lang_type": "pure_en"}, "language_content"), ({"text": "今天[snore]我们一起去公园玩。"}, "invalid_tags"),
        ({"text": "今天我们一起去公园玩，"}, "incomplete_asr"), ({"text": "今天我们一起读作大去公园。"}, "pinyin_phonetic"), ({"text": "今[surprise-yo]天[sigh]我[surprise-yo]们[question-ah]去[question-oh]公园玩。"}, "too_many_tags"), ({"text": "今[sigh]天[sigh]我[sigh]们去公园玩。"}, "repeat_tag"),
        ({"text": "好。", "length_type": "very_long"}, "severe_length"), ({"text": "今天我们一起去公园玩。"}, "too_few_tags"), ({"age_tier": "preschool"}, "preschool_markers"), ({"length_type": None}, "pass"), ({"text": "今天我们一起去公园玩。", "scenario": "primary_math"}, "pass"),
    ]
    df = spark.createDataFrame([(i, *(base | x).values(), "clash") for i, (x, _) in enumerate(rows)], "i int, text string, lang_type string, length_type string, scenario string, subscene string, age_tier string, reason string")
    got = {r["i"]: r["reason"] for r in quality.rejected(df).collect()}
    assert [got[i] for i in range(len(rows))] == [w for _, w in rows]
    assert quality.rejected(df.limit(0)).count() == 0


def test_transcripts(spark):
    df = spark.createDataFrame([("[laughter]我有二十个。", "zh", None), ("[surprise-wa]It's 5%", "en", None), ("[sigh]", None, "pure_en"), ("[odd]", "zh", None), (None, "zh", None), ("", "zh", None)], "text string, language string, lang_type string")
    assert [r["text_tn"] for r in quality.with_text_tn(df).collect()] == ["哈哈我有⟦NUM:20⟧个", "wow it's ⟦PERCENT:5⟧", None, "⟦TAG:odd⟧", None, None]
    left = spark.createDataFrame([("[laughter]",), ("！？",), ("&amp;",), ("5",)], "text string")
    assert [r[0] for r in left.select(quality.no_text_tn("text")).collect()] == [False, True, True, False]


def test_error_rate_forms(spark):
    assert voices.by_language("Ｈｅｌｌｏ, World!", "en", "eng") == "hello world" and voices.by_language("오늘 연을", "ko", "kor") == "오 늘 | 연 을" and voices.by_language("私は 今日", "ja", "jpn") == "私 は 今 日"
    assert voices.by_language("A—B don’t (take 2) (go)", "en", "eng") == "a b don't go" and voices.by_language("Odd, TEXT", "unknown", "unknown") == "odd, text"
    assert voices.by_language("漢字", "zh", "zho", simplify=lambda x: x.replace("漢", "汉")) == "汉 字"
    assert voices.by_character("我 爱 you too", "zho_Hans") == "我 爱 y o u | t o o" and voices.by_character("Guten Tag.", "deu_Latn") == "g u t e n | t a g"
    assert voices.evaluated("a 12 b", "eng", numbers=False) == "a b" and voices.evaluated("x\u00ady", "mon") == "xy" and voices.evaluated("café", "jav") == "cafe"
    assert [voices.zh_words(x) for x in ("0", "10", "15", "20", "105", "110", "1005", "10000", "100203", "120000000", "00")] == ["零", "十", "十五", "二十", "一百零五", "一百一十", "一千零五", "一万", "十万零二百零三", "一亿二千万", "零"]
    assert voices.cantonese("我有12個。") == "我 有 十 二 個"
    df = spark.createDataFrame([("Hi, 5", "en"), (None, "en"), ("", None), ("好 5", "zh")], "t string, k string")
    assert [tuple(r["f"]) for r in df.select(voices.error_rate_forms("t", "k").alias("f")).collect()] == [("hi 5", "h i | 5", None), (None, None, None), ("", "", None), ("好 5", "好 5", "好 五")]
