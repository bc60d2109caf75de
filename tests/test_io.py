import io
import json
import tarfile
import wave

import pytest
from pyspark.sql import functions as F

from voxloom.sources import readers, sinks
from voxloom.streaming import streams


def test_jsonl_policies(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\nnot json\n\n{"a": 2}\n')
    with pytest.raises(Exception):
        readers.jsonl(spark, str(p), "a int").collect()
    assert sorted(r[0] for r in readers.jsonl(spark, str(p), "a int", "skip").collect()) == [1, 2]
    marked = readers.jsonl(spark, str(p), "a int", "mark").cache()
    assert marked.where("_corrupt is not null").count() == 1
    assert readers.jsonl(spark, str(tmp_path / "none"), "a int", missing_ok=True).count() == 0


def test_sidecars(spark, tmp_path):
    for name, text in {"x/text_1.json": '{"status": "ok"}', "x/text_1.mos.json": '{"utmos": 3.5}', "x/text_2.json": "broken", "logs/text_3.json": "{}", "x/other.json": "{}", "x/text_4.mos.json": "nope"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    ok, bad = readers.sidecars(spark, str(tmp_path), "status string")
    assert [r["status"] for r in ok.collect()] == ["ok"] and bad.count() == 1
    mos = readers.metric_sidecars(spark, str(tmp_path), "mos", "utmos double")
    assert [r["utmos"] for r in mos.collect()] == [3.5] and readers.orphans(ok, mos).count() == 0


def test_key_map(spark, tmp_path):
    p = tmp_path / "map"
    p.write_text("a one two\nb x\n\nbad\na last\n")
    assert dict(map(tuple, readers.key_map(spark, str(p), "lenient").collect())) == {"a": "last", "b": "x"}
    with pytest.raises(Exception):
        readers.key_map(spark, str(p)).collect()


def test_manifest_and_dimension(spark, tmp_path):
    (tmp_path / "data.lst").write_text("a.tar a.jsonl 3 1.5\n")
    assert readers.shard_list(spark, str(tmp_path / "data.lst"), 2).count() == 2
    (tmp_path / "bad.lst").write_text("a.tar 3\n")
    with pytest.raises(Exception):
        readers.shard_list(spark, str(tmp_path / "bad.lst")).collect()
    (tmp_path / "d.tsv").write_text("id\tname\nx\tfirst\nx\tlast\n")
    assert readers.dimension(spark, str(tmp_path / "d.tsv"), "id", "id string, name string").first()["name"] == "last"


def test_wav_headers(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000), w.writeframes(b"\0\0" * 800)
    (tmp_path / "b.wav").write_bytes(b"no audio")
    got = {r["path"][-5]: r for r in readers.wav_headers(spark, str(tmp_path)).collect()}
    assert got["a"]["frames"] == 800 and got["a"]["sample_rate"] == 16000 and got["b"]["error"]


def test_shards_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k{i}", bytes([i]), 0.5) for i in range(7)], "o int, k string, d binary, s double")
    m = sinks.write_shards(df, "k", "o", "d", "bin", "s", 3, str(tmp_path)).orderBy("shard").collect()
    assert [r["items"] for r in m] == [3, 3, 1] and m[0]["seconds"] == 1.5
    assert sorted(p.suffix for p in tmp_path.iterdir() if p.name[0] != ".") == [".jsonl"] * 3 + [".tar"] * 3
    back = readers.tar_members(spark, str(tmp_path))
    assert {(r["key"], bytes(r["data"])) for r in back.collect()} == {(f"k{i}", bytes([i])) for i in range(7)}
    labels = readers.jsonl(spark, str(tmp_path / "*.jsonl"), "id string, duration double").withColumnRenamed("id", "key")
    assert readers.labelled(back, labels, "key").count() == 7
    with tarfile.open(m[0]["tar_path"]) as t:
        assert [x.name for x in t] == ["k0.bin", "k1.bin", "k2.bin"] and io.BytesIO(t.extractfile("k1.bin").read()).read() == b"\1"


def test_commits(spark, tmp_path):
    c = sinks.Commits(spark, str(tmp_path / "c"))
    rows = spark.createDataFrame([("w1",)], "wav string")
    assert c.promote(rows, "r1", "f") and not c.promote(rows, "r1", "f")
    rows.withColumn("round_id", F.lit("r2")).write.parquet(str(tmp_path / "c/rows/r2"))  # not committed
    assert [r["round_id"] for r in c.rows("wav string").collect()] == ["r1"]
    with pytest.raises(ValueError):
        c.promote(rows, "r1", "other")


def test_small_sinks(spark, tmp_path):
    sinks.write_report({"b": 1, "a": "ä"}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": "ä", "b": 1}
    df = spark.createDataFrame([(1, "x", None), (2, None, "bad")], "b int, _a string, error string")
    assert sinks.public(df).columns == ["b", "error"]
    ok, err = sinks.split_errors(df)
    assert ok.count() == 1 and err.count() == 1
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).count() == 2
    t = sinks.tombstoned(spark.createDataFrame([("a", "ok"), ("b", "ok")], "k string, status string"), spark.createDataFrame([("b", "cer")], "k string, reason string"), "k")
    assert {(r["k"], r["status"]) for r in t.collect()} == {("a", "ok"), ("b", "rejected")}


def test_stream_keeps_state(spark, tmp_path):
    schema = "id string, text string, seq long, scenario string, subscene string, emotion string, age_tier string, length_type string, lang_type string"
    src, out = tmp_path / "in", tmp_path / "out"
    row = lambda i, t: (str(i), t, i, "s", None, None, None, None, None)
    spark.createDataFrame([row(1, "今天我们去公园放风筝吧"), row(2, "另外一句完全不同的话在这")], schema).write.parquet(str(src))
    stream = lambda: streams.near_duplicates(spark.readStream.schema(schema).parquet(str(src)), "id", "text", "seq")
    assert streams.drained(stream(), str(out)).count() == 2
    spark.createDataFrame([row(3, "今天我们去公园放风筝啦"), row(4, "第三句话说的是别的事情哦")], schema).write.mode("append").parquet(str(src))
    assert {r["k"] for r in streams.drained(stream(), str(out)).collect()} == {"1", "2", "4"}  # resumed: 3 is near 1


def test_rows_without_files_are_skipped(spark, tmp_path):
    (tmp_path / "a b.txt").write_text("x")
    rows = spark.createDataFrame([(str(tmp_path / "a b.txt"), 1), (str(tmp_path / "c.txt"), 2), (None, 3)], "path string, i int")
    assert [r["i"] for r in readers.present(rows, "path", spark, str(tmp_path)).collect()] == [1]
