"""Training of the language models: stock phrases, kana and Hangul by the parse, cost linear in the stretches, confidence."""

import random
import time

from voxloom.llm import language
from test_texts import TRAIN


def test_stock_phrases_come_from_all_rows(spark):
    rows = [("Oh no!", "en")] * 30 + [("oh no.", "es")] * 4 + [("¡Hola!", "es")] * 6 + [("¡Hola!", "de")] * 6 + [("好的。", "zh")] * 9 + [("好的。", "unknown")] * 9 + [("rare words", "en")] * 4 + [(None, "en"), ("", None)]
    got = language.stock(spark.createDataFrame([(*r, 1) for r in rows], "t string, l string, s int"), "t", "l")
    assert got == {"zh": ["好的"], "en": ["oh no"], "es": [], "fr": [], "de": [], "ja": [], "ko": []}


def test_stock_phrases_decide_short_rows(spark):
    rows = [("Oh no.", "en")] * 40 + [(f"{TRAIN['es']} {i % 3}. sí o no. no oh.", "es") for i in range(30)] + [(TRAIN["en"], "en")] * 3
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k bigint, t string, l string")
    assert language.wrong_labels(df, "k", "t", "l").count() == 0


def test_kana_and_hangul_are_parsed():
    p = language.Parser(TRAIN)
    assert set(p.costs("私は今日", "H")) == {"zh", "ja", "ko"} and p.main("오늘 공원에서")[0] == "ko"
    only_zh = language.Parser({"zh": TRAIN["zh"] + "さくら", "ja": "私", "ko": TRAIN["ko"]})
    assert only_zh.main("さくら")[0] == "zh"  # the automaton that knows the letters decides, not the script
    assert language.Parser({}).main("さくら")[0] == "ja" and language.Parser({}).main("나무")[0] == "ko"


def test_cost_is_linear_in_stretches():
    p = language.Parser(TRAIN)
    took = []
    for n in (1000, 8000):
        text = "".join(f"我们{i}去 the dog {i}。" for i in range(n))
        began = time.perf_counter()
        p.stretches(text)
        took.append(time.perf_counter() - began)
    assert took[1] < 24 * max(took[0], 0.01)


def test_confidence_follows_accuracy():
    rnd = random.Random(6)
    p = language.Parser(TRAIN)
    words = {k: TRAIN[k].split() for k in ("en", "fr", "de", "es")}
    seen = [(p.main(" ".join(rnd.choices(words[k], k=n)))[:2], k) for k in words for n in (1, 2, 6) for _ in range(200)]
    sure = [got == k for (got, c), k in seen if c > 0.95]
    unsure = [got == k for (got, c), k in seen if c <= 0.7]
    assert len(sure) > 800 and sum(sure) / len(sure) > 0.97 and (not unsure or sum(unsure) / len(unsure) < 0.9)
