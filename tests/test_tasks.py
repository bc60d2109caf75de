from pyspark.sql import functions as F

from voxloom.functions import voices
from voxloom.operators import contracts, models, tasks


def test_tasks(spark):
    t = tasks.task_list(spark, 4000, {"scenario": {"a": 3.0, "b": 1.0}}, {"s": 1.0}, 0.25).cache()
    n = {r["scenario"]: r["count"] for r in t.groupBy("scenario").count().collect()}
    assert abs(n["s"] - 1000) < 150 and abs(n["a"] - 2250) < 200 and t.count() == 4000
    r = tasks.rotated(t, "scenario", {"a": ["x", "y", "z"], "b": ["q"]}).where("scenario = 'a'").orderBy("task_id").limit(50).collect()
    assert all(p["subscene"] != q["subscene"] for p, q in zip(r, r[1:]))


def test_refill_stops(spark):
    make = lambda k, n: spark.range(k * 10, k * 10 + min(n, 4)).select(F.col("id").alias("x"))
    out = tasks.refill(spark.createDataFrame([], "x bigint"), 10, make, lambda new, have: new.join(have, "x", "left_anti"), lambda d: spark.createDataFrame(d.collect(), "x bigint"))
    assert out.count() >= 10
    none = tasks.refill(spark.createDataFrame([], "x bigint"), 10, lambda k, n: make(0, 0), lambda new, have: new, lambda d: spark.createDataFrame(d.collect(), "x bigint"))
    assert none.count() == 0


def test_audit(spark):
    counters, examples = tasks.audit(spark.createDataFrame([(1, "12 km"), (2, "plain"), (3, "!!"), (4, "50%")], "k int, t string"), "k", "t")
    assert tuple(counters.first()) == (4, 3, 1, 0) and {r["kind"] for r in examples.collect()} == {"QTY", "PERCENT"}


def test_instructions_and_forms():
    assert voices.instruct("Male,  indian accent") == ("male, indian accent", None)
    assert voices.instruct("male，四川话") == ("男，四川话", None) and voices.instruct("男", False) == ("male", None) and voices.instruct("", True) == (None, None)
    assert voices.instruct("male, female")[1] == "more than one gender" and "female" in voices.instruct("femal")[1] and voices.instruct("四川话, indian accent")[1]
    assert voices.truncate("一二三四五六七八[sigh]", "ultra_short") == "一二三四五...[sigh]" and voices.truncate("one two three four five six", "ultra_short") == "one two three..." and voices.truncate(None, "x") is None
    assert voices.by_language("你好，世界 12", "zh", "zho") == "你 好 世 界 1 2" and voices.by_language("It’s (no 5) OK!", "en", "eng") == "it's ok"


def test_hook_falls_back_to_rows(spark):
    def load():
        def model(pdf):
            if (pdf["x"] < 0).any():
                raise ValueError("negative")
            return list(pdf["x"] * 2.0)

        return model

    got = {r["k"]: r for r in models.scored(spark.createDataFrame([(1, 1.0), (2, -1.0)], "k int, x double").coalesce(1), "k", ["x"], load, "y").collect()}
    assert got[1]["y"] == 2.0 and got[2]["y"] is None and "negative" in got[2]["error"]
    left = models.missing_only(spark.createDataFrame([("a", 1), ("b", 1)], "p string, size int"), spark.createDataFrame([("a", 1), ("b", 2)], "p string, size int"), ["p", "size"])
    assert [r["p"] for r in left.collect()] == ["b"]


def test_masked(spark):
    df = spark.createDataFrame([(i, list(range(20))) for i in range(50)], "k int, ids array<int>")
    r = models.masked(df, "k", "ids", (0.2, 0.2), (0.5, 0.5), -1).collect()
    assert all(x["inputs"][:4] == [0, 1, 2, 3] and set(x["labels"][:4]) == {-100} for x in r)
    assert all((a == -1) == (b != -100) for x in r for a, b in zip(x["inputs"], x["labels"])) and 0.4 < sum(a == -1 for x in r for a in x["inputs"]) / (50 * 16) < 0.6


def test_fresh(spark):
    df = spark.createDataFrame([("a", (1, 2)), ("b", (1, 2))], "p string, s struct<size: bigint, mtime_ns: bigint>")
    assert [r["p"] for r in contracts.fresh(df, spark.createDataFrame([("a", 1, 2), ("b", 1, 3)], "p string, size bigint, mtime_ns bigint"), "p", "s").collect()] == ["a"]


def test_stale_inputs_are_left_out(spark):
    clips = spark.createDataFrame([("a", "x", None), ("b", "y", "zh")], "k string, t string, l string").withColumn("f", contracts.canonical_json(["t", "l"]))
    evals = clips.selectExpr("k", "sha2(f, 256) as fp").unionByName(spark.createDataFrame([("a", "old"), ("gone", "x")], "k string, fp string"))
    got = contracts.unchanged_inputs(evals, clips.withColumn("t", F.when(F.col("k") == "b", "changed").otherwise(F.col("t"))), "k", "fp", ["t", "l"])
    assert [r["k"] for r in got.collect()] == ["a"]
