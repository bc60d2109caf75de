"""Contracts of records, lists and plans, paths, evaluations made anew."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from voxloom.operators import joins, records, stats
from voxloom.plans.metrics import FILLERS

SIG = "struct<size: bigint, mtime_ns: bigint>"
SCHEMA = f"i int, status string, gen_text string, text_id string, model string, model_signature map<string, string>, generation_config map<string, double>, cloned_audio string, ref_audio string, schema_version int, cloned_audio_signature {SIG}, ref_audio_signature {SIG}, plan_id string, round_id string, task_id string, speaker_key string, wav string, wav_rate int, wav_frames bigint, wav_signature {SIG}, ref_signature {SIG}"
GOOD = dict(status="generated", gen_text="x", text_id="t", model="m", model_signature={"a": "b"}, generation_config={"s": 1.0}, cloned_audio="/w/a.wav", ref_audio="/r/b.wav", schema_version=3, cloned_audio_signature=(1, 2), ref_audio_signature=(3, 4), plan_id="p", round_id="r", task_id="k", speaker_key="s", wav="/w/a.wav", wav_rate=16000, wav_frames=5, wav_signature=(1, 2), ref_signature=(3, 4))
BENT = [
    ({}, None), ({"status": None}, "status"), ({"status": "failed"}, "status"), ({"gen_text": ""}, "missing gen_text"), ({"text_id": None}, "missing text_id"), ({"model_signature": {}}, "missing model_signature"), ({"generation_config": None}, "missing generation_config"),
    ({"cloned_audio": "/w/c.wav"}, "cloned_audio path mismatch"), ({"cloned_audio": None}, "cloned_audio path mismatch"), ({"wav": None}, "cloned WAV missing"), ({"ref_signature": None}, "reference audio missing"), ({"ref_audio": ""}, "reference audio missing"), ({"wav_rate": None}, "cloned WAV is unreadable"),
    ({"wav_rate": 24000}, "cloned WAV rate or length"), ({"wav_frames": 0}, "cloned WAV rate or length"), ({"wav_signature": (9, 2)}, "cloned audio signature mismatch"), ({"schema_version": 2, "ref_audio_signature": None}, "reference audio signature mismatch"),
    ({"speaker_key": ""}, "missing speaker_key"), ({"schema_version": 2, "plan_id": None}, None), ({"schema_version": None, "wav_signature": (9, 9)}, None), ({"schema_version": 1, "task_id": None}, None), ({"schema_version": 4}, "unsupported schema_version"),
]


def _clones(spark):
    return spark.createDataFrame([(i, *(GOOD | x).values()) for i, (x, _) in enumerate(BENT)], SCHEMA)


def test_clone_rules(spark):
    got = {r["i"]: r["e"] for r in _clones(spark).select("i", records.clone_error().alias("e")).collect()}
    assert [got[i] for i in range(len(BENT))] == [e for _, e in BENT]


def test_policies_and_projections(spark):
    df = _clones(spark)
    ok, bad = records.checked(df, records.clone_error(), "warn")
    assert ok.count() == sum(e is None for _, e in BENT) and bad.count() == sum(e is not None for _, e in BENT) and "error" not in ok.columns
    assert {tuple(r) for r in records.clone_items(ok).collect()} == {("/w/a.wav", "/w/a.json")}
    assert {tuple(r) for r in records.clone_pairs(ok).collect()} == {("/w/a.wav", "/r/b.wav", "/w/a.json")}
    with pytest.raises(Exception, match="invalid record"):
        records.checked(df, records.clone_error())[0].collect()
    with pytest.raises(ValueError):
        records.checked(df, records.clone_error(), "quiet")


def test_lists_and_plans(spark):
    lines = spark.createDataFrame([(1, "/a/x"), (2, " /a/x "), (3, "a/x"), (4, "/b/x"), (5, "/a/../b"), (6, "/a/y"), (7, ""), (8, None)], "line int, path string")
    have = spark.createDataFrame([("/a/x",), (None,)], "path string")
    got = {r["line"]: r["error"] for r in records.list_errors(lines, have, "/a/").collect()}
    assert got == {1: None, 2: "repeated", 3: "not absolute", 4: "outside the root", 5: "outside the root", 6: "not in the inventory"}
    tasks = spark.createDataFrame([(1, "p", "t1", "o/1"), (2, "q", "t2", "o/2"), (3, "p", "t1", "o/3"), (4, "p", "t4", "o/1"), (5, "p", "t5", "../o"), (6, "p", None, "o/6"), (7, "p", "t7", "a..b/c")], "line int, plan_id string, task_id string, expected_output_relpath string")
    got = {r["line"]: r["error"] for r in records.plan_errors(tasks, "p", fields=("plan_id", "task_id", "expected_output_relpath")).collect()}
    assert got == {1: None, 2: "plan_id mismatch", 3: "duplicate task_id", 4: "duplicate output path", 5: "unsafe output path", 6: "missing task_id", 7: None}
    assert records.plan_errors(tasks.limit(0), "p", fields=("plan_id",)).count() == 0
    path = spark.createDataFrame([("a/b",), ("/a",)], "p string")
    assert path.where("p = 'a/b'").select(records.output_path("/r/", "p")).first()[0] == "/r/a/b"
    with pytest.raises(Exception, match="unsafe path"):
        path.select(records.output_path("/r", "p")).collect()


def test_mismatched_fields(spark):
    one = spark.createDataFrame([("complete", 2, True)], "stage string, count int, done boolean")
    want = {"stage": "complete", "count": 3, "done": True, "root": "/r"}
    assert {r["field"]: (r["value"], r["expected"]) for r in records.mismatched(one, want).collect()} == {"count": ("2", "3"), "root": (None, "/r")}
    assert records.mismatched(one.limit(0), want).count() == 4


def test_dialects(spark):
    rows = [
        ("/d/audio/childmandarin/c1/f.x.wav", "", ("childmandarin", "c1", "f.x")), ("/d/audio/other/c1/f.wav", "", None), ("/d/Chinese_English/WAV/G9/f.wav", "", ("chineseenglishchildren", "chineseenglishchildren_G9", "f")), ("/King-ASR-EN-Kid/Speaker07/f.wav", "/King-ASR-612/", ("kingasr612", "kingasr612_07", "f")),
        ("/King-ASR-EN-Kid/Speaker07/f.wav", "", ("king-asr-725", "king-asr-725_Speaker07", "f")), ("/King-ASR-EN-Kid/none/f.wav", "", None), ("/speechocean762/WAVE/SPEAKER3049/f.WAV", None, ("speechocean762", "speechocean762_3049", "f")), ("/BAAI/dev/014/f.wav", "", ("childmandarin", "childmandarin_014", "f")),
        ("/BAAI/dev/7/f.wav", "", ("childmandarin", "childmandarin_007", "f")), ("/BAAI/dev/abc/f.wav", "", None), ("/BAAI/dev/12345/f.wav", "", ("childmandarin", "childmandarin_12345", "f")), ("/plain/f.wav", "", None), ("", "", None), (None, None, None),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(rows)], "i int, ref string, cloned string")
    got = {r["i"]: r["s"] and tuple(r["s"]) for r in df.select("i", records.speaker_of("ref", "cloned").alias("s")).collect()}
    assert [got[i] for i in range(len(rows))] == [w for *_, w in rows]
    t = spark.createDataFrame([("k" * 20,), (None,), ("",)], "task string").select(records.copy_target("/o", F.lit("d"), F.lit("s"), F.lit("r"), F.lit("/c/text_1.wav"), F.col("task")))
    assert [r[0] for r in t.collect()] == ["/o/d/s/r_clone_" + "k" * 16 + ".wav"] + ["/o/d/s/r_clone_text_1.wav"] * 2


def test_fingerprint_of_rules():
    rules = {"b": [1, "é"], "a": None}
    assert records.fingerprint(rules) == records.fingerprint(dict(reversed(rules.items()))) == hashlib.sha256(json.dumps({"a": None, "b": [1, "é"]}, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert records.fingerprint(rules) != records.fingerprint(rules | {"a": 0})


EVAL = "i int, gen_text string, asr_hypo string, ref_normalized string, hypo_normalized string, cer double, substitutions int, insertions int, deletions int, reference_chars int, reference_normalization_context struct<language: string, lang_type: string>"


def test_evaluations_are_made_anew(spark):
    good = ("我有二十个。", "我有30个", "我有⟦NUM:20⟧个", "我有⟦NUM:30⟧个", 1 / 11, 1, 0, 0, 11, ("zh", None))
    bent = [(good, None), ((*good[:1], None, *good[2:]), "missing text"), ((*good[:2], "我有20个", *good[3:]), "reference form"), ((*good[:3], "x", *good[4:]), "hypothesis form"), ((*good[:4], None, *good[5:]), "missing number"), ((*good[:4], float("nan"), *good[5:]), "missing number"), ((*good[:8], 12, good[9]), "reference length"), ((*good[:4], 0.2, *good[5:]), "rate"), ((*good[:5], 2, *good[6:]), "operations")]
    df = spark.createDataFrame([(i, *r) for i, (r, _) in enumerate(bent)], EVAL)
    got = {r["i"]: r["error"] for r in records.validated(df, "i").collect()}
    assert [got[i] for i in range(len(bent))] == [e for _, e in bent]
    new = records.migrated(df, "i").where("i = 0").first()
    assert (new["ref_normalized"], new["substitutions"], new["insertions"], new["deletions"], new["reference_chars"], new["tag_language"]) == ("我有⟦NUM:20⟧个", 1, 0, 0, 11, "zh")
    assert records.migrated(df, "i").count() == len(bent) - 1


def test_languages_and_first_finite(spark):
    df = spark.createDataFrame([("en_mostly",), ("cn_mostly",), ("frequent_mix",), ("ru",), ("xx",), ("",), (None,)], "x string")
    assert [tuple(r) for r in df.select(joins.folded_language("x"), joins.cloning_language("x")).collect()] == [("en", "en"), ("zh", "zh"), ("zh", "zh"), ("ru", "ru"), ("xx", "zh"), ("unknown", "zh"), ("unknown", "zh")]
    rows = [("a", 2, 0.5), ("a", 1, float("nan")), ("a", 3, 0.9), ("b", None, 0.1), ("b", 9, 0.2), ("c", 1, None), ("d", 1, 0.3), ("d", 1, 0.4)]
    got = {r["k"]: (r["rows"], r["v"]) for r in joins.first_finite(spark.createDataFrame(rows, "k string, at int, v double"), "k", "v", "at").collect()}
    assert got == {"a": (3, 0.5), "b": (2, 0.2), "c": (1, None), "d": (2, 0.4)}


def test_patterns_and_cold_tags(spark):
    rows = [(i, f"嗯那个故事{i % 7}[sigh]" if i % 2 else f"今天很好{i}。") for i in range(100)] + [(None, "嗯"), (200, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "seq int, text string, value string")
    got = {(r["family"], r["value"]): r["n"] for r in stats.hot_patterns(df, "text", "seq", {"filler": FILLERS}).collect()}
    assert got == {("opening", "嗯那个故"): 50, ("opening", "今天很好"): 50, ("tag", "sigh"): 50, ("filler", "嗯"): 50, ("filler", "那个"): 50}
    assert stats.hot_patterns(df.limit(20), "text", "seq", {}).count() == 0
    assert stats.cold_tags(df, "text", "seq", ("sigh", "laughter")).count() == 0  # 50 tagged rows aren't more than 50
    more = df.unionByName(spark.createDataFrame([(300 + i, "[sigh]" + "[laughter]" * (i < 1), "") for i in range(9)], df.schema))
    assert {(r["tag"], r["n"]) for r in stats.cold_tags(more, "text", "seq", ("sigh", "laughter")).collect()} == {("laughter", 1)}
