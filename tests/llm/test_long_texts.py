"""Very long texts of any make are worked through whole, in time about linear in their length."""

import time

import pytest

from voxloom.llm import encoding, language, lookalike, neardup, repetition, tokens
from test_texts import CLEAN, TRAIN

N = 150_000
TEXTS = {
    "one letter": "a" * N, "other alphabet": "а" * N, "accents": "e\u0301" * (N // 2), "kana": "ロ" * N, "kana and more": "ラ口" * (N // 2), "han": "春" * N, "hangul": "가" * N, "signs": "@" * N, "bars": "a|" * (N // 2), "digits": "7" * N, "blanks": " " * N, "lines": "ab\n" * (N // 3),
    "garbled": "Ã©" * (N // 2), "hidden": "銇勭煶" * (N // 3), "replaced": "\ufffd" * N, "brackets": "[" * N, "tags": "[sigh]" * (N // 6), "mixed": "我a" * (N // 2), "emoji": "😀" * N, "sentences": CLEAN[2] * (N // len(CLEAN[2])),
}


@pytest.fixture(scope="module")
def model(spark):
    return encoding.train(spark.createDataFrame([(t,) for t in CLEAN * 40], "text string"), "text")


@pytest.mark.parametrize("name", TEXTS)
def test_in_time(model, name):
    parser, e, t = language.Parser(TRAIN), tokens.encoder(), TEXTS[name]
    work = {
        "repetition": lambda: repetition.judge(t), "language": lambda: parser.main(t), "look": lambda: lookalike.unify(t), "shingles": lambda: neardup.shingles(t), "tokens": lambda: e.encode(t), "encoding": lambda: encoding.repair(t, model, encoding.BASE),
    }
    slow = {}
    for k, fn in work.items():
        began = time.perf_counter()
        fn()
        if (took := time.perf_counter() - began) > 8:
            slow[k] = took
    assert not slow
