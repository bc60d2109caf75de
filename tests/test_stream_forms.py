"""The streaming near-duplicate filter against its batch form, with forms repeated across contexts and contexts of many frames."""

import random

from voxloom.operators import dedup
from voxloom.streaming import streams

SCHEMA = "id string, text string, seq long, scenario string, subscene string, emotion string, age_tier string, length_type string, lang_type string"


def _row(i, text, context):
    return (str(i), text, i, context, None, None, None, None, None)


def _kept(spark, src, out):
    return {r["k"] for r in streams.drained(streams.near_duplicates(spark.readStream.schema(SCHEMA).parquet(str(src)), "id", "text", "seq"), str(out)).collect()}


def test_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(3)
    base = ["".join(rnd.choices("甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉", k=14)) for _ in range(40)]
    rows = []
    for i in range(300):
        s = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            s[rnd.randrange(len(s))] = rnd.choice("天地玄黄")
        rows.append(_row(i, rnd.choice(["！！", None, ""]) if i % 50 == 0 else "".join(s), rnd.choice("xyz")))
    rnd.shuffle(rows)
    src = tmp_path / "in"
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(3).write.parquet(str(src))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # a context comes in many frames
    try:
        got = _kept(spark, src, tmp_path / "out")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {r["id"] for r in dedup.incremental(df, "id", "text", "seq", retry=False).collect()}


def test_stream_remembers_forms_of_other_contexts(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    spark.createDataFrame([_row(2, "今天我们去公园放风筝吧", "s"), _row(1, "今天我们去公园放风筝吧！", "t"), _row(3, "！！", "s")], SCHEMA).write.parquet(str(src))
    assert _kept(spark, src, out) == {"1", "3"}
    spark.createDataFrame([_row(4, "今天我们去公园放风筝吧", "u"), _row(5, "！！", "s"), _row(6, "完全不同的一句话在这里", "u")], SCHEMA).write.mode("append").parquet(str(src))
    assert _kept(spark, src, out) == {"1", "3", "5", "6"}


def _in_order(rows):
    """The filter over all rows one after the other."""
    seen, kept, out = set(), {}, set()
    for k, f, q, c in sorted(rows, key=lambda r: r[2]):
        if not f:
            out.add(k)
        elif f not in seen:
            s = dedup.shingle_set(f)
            if not any(dedup.near(f, g, s, u) for g, u in kept.get(c, [])):
                seen.add(f)
                kept.setdefault(c, []).append((f, s))
                out.add(k)
    return out


def test_batch_equals_one_pass_in_order(spark):
    rnd = random.Random(5)
    base = ["".join(rnd.choices("甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉", k=rnd.randrange(6, 16))) for _ in range(14)]
    forms = []
    for _ in range(60):
        s = list(rnd.choice(base))
        for _ in range(rnd.randrange(5)):
            s[rnd.randrange(len(s))] = rnd.choice("天地玄黄")
        forms.append("".join(s))
    rows = [(str(i), rnd.choice([*forms, ""]) if i % 40 else "", i, rnd.choice("vwxyz")) for i in range(400)]  # forms in many contexts
    df = spark.createDataFrame([(k, f, q, c, None, None, None, None, None) for k, f, q, c in rows], SCHEMA)
    got = [r["id"] for r in dedup.incremental(df, "id", "text", "seq").collect()]
    assert len(got) == len(set(got)) and set(got) == _in_order(rows)
    assert set(got) != {r["id"] for r in dedup.incremental(df, "id", "text", "seq", retry=False).collect()}
    assert dedup.incremental(df.limit(0), "id", "text", "seq").count() == 0
