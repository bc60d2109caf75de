"""Hooks (retries, missing packages, routing, completeness), tasks, merges of states and outputs."""

import pytest
from pyspark.sql import functions as F

from voxloom.operators import joins, models, quota, tasks
from voxloom.sources import readers


def test_retries_and_missing_packages(spark, tmp_path):
    marker = str(tmp_path / "calls")

    def flaky():
        def model(pdf):
            with open(marker, "a") as f:
                f.write("x")
            if len(open(marker).read()) < 3:
                raise OSError("busy")
            return [1.0] * len(pdf)

        return model

    def absent():
        import no_such_package  # noqa: F401

    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, x double").coalesce(1)
    got = models.scored(df, "k", ["x"], flaky, "y", retries=3, wait=0.01).collect()
    assert [r["y"] for r in got] == [1.0, 1.0] and all(r["error"] is None and r["seconds"] > 0 for r in got)
    got = models.scored(df, "k", ["x"], absent, "y").collect()
    assert all(r["y"] is None and r["error"].startswith("skipped") for r in got)


def test_routes_and_reuse(spark):
    df = spark.createDataFrame([(1, "zh"), (2, "en"), (3, None), (4, "fr")], "k int, lang string")
    by = lambda name: lambda d: d.select("k", F.lit(name).alias("m"))
    assert {r["k"]: r["m"] for r in models.routed(df, "lang", {"zh": by("one"), "fr": by("two")}, by("rest")).collect()} == {1: "one", 2: "rest", 3: "rest", 4: "two"}
    cache = spark.createDataFrame([("a", "m1", 1), ("b", "m2", 1), ("c", None, 1)], "p string, model string, v int")
    assert [r["p"] for r in models.reusable(cache, {"model": "m1", "v": 1}).collect()] == ["a"] and [r["p"] for r in models.reusable(cache, {"model": None}).collect()] == ["c"]
    hit = F.col("k") > 1
    assert models.complete(df, hit).count() == 4 and models.complete(df.limit(0), hit).count() == 0
    for bad in (models.complete(df, F.col("k") > 9), models.complete(df, hit, require_all=True)):
        with pytest.raises(Exception, match="incomplete"):
            bad.collect()
    p = models.similarities(spark.createDataFrame([("a", "b")], "x string, y string"), spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0])], "path string, embedding array<double>"), "x", "y", provenance={"metric": "cosine", "version": 2}).first()
    assert (p["similarity"], p["metric"], p["version"]) == (1.0, "cosine", 2)


def test_tasks(spark):
    t = tasks.task_list(spark, 203, {"scenario": {"a": 1.0, "b": 3.0}, "length": {"s": 1.0}}, {"z": 1.0}, 0.15).collect()
    assert sorted(r["task_id"] for r in t) == list(range(203)) and sum(r["scenario"] == "z" for r in t) == 30 and sum(r["task_id"] < 30 and r["scenario"] == "z" for r in t) < 20
    rows = tasks.avoiding(spark.range(300).withColumnRenamed("id", "task_id"), "e", list("abcdef"), 3, per=100).orderBy("task_id").collect()
    e = [r["e"] for r in rows]
    assert all(e[i] not in e[max(i - i % 100, i - 3) : i] for i in range(300)) and set(e) == set("abcdef")
    few = [r["e"] for r in tasks.avoiding(spark.range(10).withColumnRenamed("id", "task_id"), "e", ["a", "b"], 2).orderBy("task_id").collect()]
    assert few in (["a", "b"] * 5, ["b", "a"] * 5)
    df = spark.createDataFrame([(30.0, 100), (-1.0, 0), (30.0, 3)], "d double, cap int")
    assert [r[0] for r in df.where("cap <> 3").select(quota.tasks_for(F.col("d"), 1.5, 4.0, 2, F.col("cap"))).collect()] == [14, 0]
    with pytest.raises(Exception, match="beyond the capacity"):
        df.select(quota.tasks_for(F.col("d"), 1.5, 4.0, 2, F.col("cap"))).collect()


def test_merges(spark):
    old, new = spark.createDataFrame([("a", "failed", 2), ("b", "done", None)], "k string, status string, attempts int"), spark.createDataFrame([("a", "done"), ("c", None)], "k string, status string")
    assert {r["k"]: (r["status"], r["attempts"]) for r in joins.attempted(old, new, "k").collect()} == {"a": ("done", 3), "b": ("done", 0), "c": (None, 1)}
    a, b = spark.createDataFrame([("x", 2, "p"), ("y", 1, "q")], "id string, seq int, t string"), spark.createDataFrame([("x", 1)], "id string, seq int")
    assert {r["id"]: (r["seq"], r["t"]) for r in joins.merged([a, b], "id", "seq").collect()} == {"x": (1, None), "y": (1, "q")}
    one, two = joins.split_by(a.withColumn("f", F.when(F.col("id") == "x", True)), F.col("f"))
    assert one.count() == 1 and two.count() == 1
    twice = joins.counted_once({"m": a.select("id"), "n": b.select("id").unionByName(b.select("id")), "o": a.limit(0).select("id")}, "id").collect()
    assert [tuple(r) for r in twice] == [("x", ["m", "n"])]
    whole, lacking = joins.inventory(spark.createDataFrame([("u", "/a"), ("v", "/b")], "k string, wav string"), spark.createDataFrame([("u", "hi")], "k string, t string"), spark.createDataFrame([("u", "s"), ("w", "s")], "k string, spk string"), "k")
    assert [tuple(r) for r in whole.collect()] == [("u", "/a", "s", "hi")] and {tuple(r) for r in lacking.collect()} == {("v", "speaker"), ("w", "audio")}
    assert [r[0] for r in spark.createDataFrame([(1.0,), (2.0,), (None,), (0.5,)], "x double").select(joins.half_open("x", 1, 2)).collect()] == [True, False, False, False]


def test_maps_keep_the_order_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("k one\n" * 3 + "m early\n")
    (tmp_path / "b.txt").write_text("k two\n" * 5000 + "bad\n")  # the larger file is read first
    assert {r["key"]: r["value"] for r in readers.key_map(spark, str(tmp_path), "lenient").collect()} == {"k": "two", "m": "early"}
    with pytest.raises(Exception, match="two fields|repeated key"):
        readers.key_map(spark, str(tmp_path)).collect()


def test_no_speakers_raise(spark):
    paths = spark.createDataFrame([("/r/d/s/a.wav",), ("/r/b.wav",), (None,)], "p string")
    assert [tuple(r) for r in readers.speakers(paths, "p", "/r").collect()] == [("d", "s")]
    with pytest.raises(Exception, match="no speakers"):
        readers.speakers(paths, "p", "/other").collect()
