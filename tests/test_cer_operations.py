"""Character operations and rate of every scored row, other scripts too, against brute force."""

from voxloom.plans import catalog


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_rate_of_any_script(spark, tmp_path):
    pairs = [("今天天气很好", "今天天汽好吗"), ("こんにちは世界", "こんばんは世界"), ("안녕하세요", "안녕하새요"), ("café olé", "cafe ole"), ("plain text", "plane text"), ("😀好", "好"), ("", "多"), ("有", ""), (None, "x"), ("没有", None)]
    spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(pairs)], "wav string, ref_normalized string, hypo_normalized string").write.parquet(str(tmp_path / "eval.parquet"))
    got = {r["wav"]: r for r in catalog.QUERIES["cer_operations"](spark, str(tmp_path)).collect()}
    assert got.keys() == {str(i) for i, (_, b) in enumerate(pairs) if b is not None}
    for i, (a, b) in enumerate(pairs):
        if b is None:
            continue
        r = got[str(i)]
        if a is None:
            assert r["n"] is None and r["cer"] is None
            continue
        assert r["s"] + r["i"] + r["d"] == _distance(a, b) and r["n"] == len(a) and r["i"] - r["d"] == len(b) - len(a)
        assert r["cer"] == (_distance(a, b) / len(a) if a else None)
