"""Queries over record contracts, lists, plans and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import records as r
from ..session import spread, table
from .registry import query

POOL = "llm_children_100k_asr_complete"

# A clone record of every clip with a similarity: its text from the evaluation, its reference from the inventory, its file from the MOS table.
_CLONES = """(SELECT CASE WHEN isnan(s.similarity) THEN 'failed' ELSE 'generated' END AS status, e.gen_text, e.text_id, s.model_dir AS model, cardinality(s.model_signature) AS model_signature, s.speed AS speed,
s.cloned_audio, s.ref_audio, s.score_version + 1 AS schema_version, s.dataset AS plan_id, s.language AS round_id, e.stage AS task_id, f.speaker_key AS speaker_key, m.wav AS wav, f.sample_rate - 8000 AS wav_rate, f.frames AS wav_frames, f.ref IS NOT NULL AS ref_there, s.cloned_audio_signature.size % 97 = 0 AS resized
FROM (SELECT cloned_audio, any_value(similarity) AS similarity, any_value(model_dir) AS model_dir, any_value(model_signature) AS model_signature, any_value(speed) AS speed, any_value(ref_audio) AS ref_audio, any_value(score_version) AS score_version, any_value(dataset) AS dataset,
any_value(language) AS language, any_value(cloned_audio_signature) AS cloned_audio_signature FROM sim WHERE cloned_audio IS NOT NULL GROUP BY 1 HAVING count(*) = 1) s
LEFT JOIN (SELECT wav, min(gen_text) AS gen_text, min(text_id) AS text_id, min(stage) AS stage FROM eval GROUP BY 1) e ON e.wav = s.cloned_audio LEFT JOIN (SELECT DISTINCT cloned_audio AS wav FROM mos) m ON m.wav = s.cloned_audio
LEFT JOIN (SELECT ref_audio AS ref, min(speaker_key) AS speaker_key, min(sample_rate) AS sample_rate, min(frames) AS frames FROM reference_audio GROUP BY 1) f ON f.ref = s.ref_audio)"""
_CLONE_ERROR = """CASE WHEN status <> 'generated' THEN 'status' WHEN coalesce(gen_text, '') = '' THEN 'missing gen_text' WHEN coalesce(text_id, '') = '' THEN 'missing text_id' WHEN coalesce(model, '') = '' THEN 'missing model'
WHEN coalesce(model_signature, 0) = 0 THEN 'missing model_signature' WHEN speed IS NULL THEN 'missing generation_config' WHEN wav IS NULL THEN 'cloned WAV missing' WHEN coalesce(ref_audio, '') = '' OR NOT ref_there THEN 'reference audio missing'
WHEN wav_rate IS NULL THEN 'cloned WAV is unreadable' WHEN wav_rate <> 16000 OR coalesce(wav_frames, 0) <= 0 THEN 'cloned WAV rate or length' WHEN schema_version IN (2, 3) AND resized THEN 'cloned audio signature mismatch'
WHEN schema_version = 3 AND coalesce(plan_id, '') = '' THEN 'missing plan_id' WHEN schema_version = 3 AND coalesce(round_id, '') = '' THEN 'missing round_id' WHEN schema_version = 3 AND coalesce(task_id, '') = '' THEN 'missing task_id'
WHEN schema_version = 3 AND coalesce(speaker_key, '') = '' THEN 'missing speaker_key' END"""


def _clones(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sim", "cloned_audio", "similarity", "model_dir", "model_signature", "speed", "ref_audio", "score_version", "dataset", "language", "cloned_audio_signature", "ref_audio_signature").where("cloned_audio is not null")
    cols = [c for c in s.columns if c != "cloned_audio"]
    s = s.groupBy("cloned_audio").agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in cols]).where("_n = 1").drop("_n")
    e = table(spark, d, "eval", "wav", "gen_text", "text_id", "stage").groupBy(F.col("wav").alias("cloned_audio")).agg(F.min("gen_text").alias("gen_text"), F.min("text_id").alias("text_id"), F.min("stage").alias("task_id"))
    m = table(spark, d, "mos", F.col("cloned_audio")).distinct().withColumn("wav", F.col("cloned_audio"))
    f = table(spark, d, "reference_audio", "ref_audio", "speaker_key", "sample_rate", "frames").groupBy("ref_audio").agg(F.min("speaker_key").alias("speaker_key"), F.min("sample_rate").alias("sample_rate"), F.min("frames").alias("wav_frames"), F.lit(True).alias("_there"))
    j = s.join(e, "cloned_audio", "left").join(m, "cloned_audio", "left").join(f, "ref_audio", "left")
    sig = F.col("cloned_audio_signature")
    return j.select(
        F.when(F.isnan("similarity"), "failed").otherwise("generated").alias("status"), "gen_text", "text_id", F.col("model_dir").alias("model"), "model_signature", F.when(F.col("speed").isNotNull(), F.create_map(F.lit("speed"), F.col("speed"))).alias("generation_config"),
        "cloned_audio", "ref_audio", (F.col("score_version") + 1).alias("schema_version"), sig.alias("cloned_audio_signature"), "ref_audio_signature", F.col("dataset").alias("plan_id"), F.col("language").alias("round_id"), "task_id", "speaker_key", "wav", (F.col("sample_rate") - 8000).alias("wav_rate"), "wav_frames",
        F.when(sig["size"] % 97 == 0, F.struct((sig["size"] + 1).alias("size"), sig["mtime_ns"].alias("mtime_ns"))).otherwise(sig).alias("wav_signature"), F.when(F.col("_there"), F.col("ref_audio_signature")).alias("ref_signature"),
    )


@query(f"SELECT coalesce({_CLONE_ERROR}, 'ok') AS error, count(*) AS n FROM {_CLONES} GROUP BY 1")
def clone_contract(spark: SparkSession, d: str) -> DataFrame:
    """First violated rule of each clone record (F4). The tables hold no clone sidecars, so records are put together from those that there are."""
    return _clones(spark, d).groupBy(F.coalesce(r.clone_error(), F.lit("ok")).alias("error")).agg(F.count("*").alias("n"))


@query(f"SELECT wav, ref_audio, regexp_replace(wav, '\\.wav$', '.json') AS sidecar FROM {_CLONES} WHERE {_CLONE_ERROR} IS NULL")
def clone_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Valid clones with their references."""
    return r.clone_pairs(r.checked(_clones(spark, d), r.clone_error(), "skip")[0])


@query("""WITH l AS (SELECT row_number() OVER (ORDER BY wav, arrived_at) AS line, CASE WHEN hash_no % 50 = 0 THEN substr(wav, 2) WHEN hash_no % 50 = 1 THEN '/other' || wav WHEN hash_no % 50 = 2 THEN wav || '/../x' ELSE wav END AS path
FROM (SELECT wav, arrived_at, ('0x' || substr(md5(wav), 1, 8))::BIGINT AS hash_no FROM eval WHERE wav IS NOT NULL)), f AS (SELECT path, min(line) AS first FROM l GROUP BY 1)
SELECT coalesce(CASE WHEN NOT starts_with(path, '/') THEN 'not absolute' WHEN NOT starts_with(path, '/corpus/cloned/') OR contains(path, '/../') THEN 'outside the root' WHEN line > first THEN 'repeated' WHEN NOT EXISTS (SELECT 1 FROM mos WHERE cloned_audio = path) THEN 'not in the inventory' END, 'ok') AS error, count(*) AS n
FROM l JOIN f USING (path) GROUP BY 1""")
def list_contract(spark: SparkSession, d: str) -> DataFrame:
    """First violated rule of each entry of an ordered list of clips (C7, F23); some entries are bent on purpose."""
    h = F.conv(F.substring(F.md5("wav"), 1, 8), 16, 10).cast("bigint") % 50
    path = F.when(h == 0, F.expr("substring(wav, 2)")).when(h == 1, F.concat(F.lit("/other"), "wav")).when(h == 2, F.concat("wav", F.lit("/../x"))).otherwise(F.col("wav"))
    rows = table(spark, d, "eval", "wav", "arrived_at").where("wav is not null").select(path.alias("path"), F.struct("wav", "arrived_at", F.monotonically_increasing_id().alias("i")).alias("line"))
    return r.list_errors(rows, table(spark, d, "mos", F.col("cloned_audio").alias("path")), "/corpus/cloned").groupBy(F.coalesce("error", F.lit("ok")).alias("error")).agg(F.count("*").alias("n"))


@query(f"""WITH t AS (SELECT seq AS line, coalesce(scenario, 'plan') AS plan_id, emotion AS round_id, id AS task_id, age_tier AS speaker_key, text AS gen_text, language, CASE WHEN seq % 200 = 7 THEN '../' || id WHEN seq % 200 = 9 THEN '/abs/' || id ELSE subscene || '/' || id END AS path FROM {POOL}),
a AS (SELECT task_id, min(line) AS first FROM t GROUP BY 1), b AS (SELECT path, min(line) AS first_path FROM t GROUP BY 1)
SELECT coalesce(CASE WHEN round_id IS NULL THEN 'missing round_id' WHEN task_id IS NULL THEN 'missing task_id' WHEN speaker_key IS NULL THEN 'missing speaker_key' WHEN gen_text IS NULL THEN 'missing gen_text' WHEN language IS NULL THEN 'missing language' WHEN path IS NULL THEN 'missing expected_output_relpath'
WHEN plan_id = 'play' THEN 'plan_id mismatch' WHEN line > first THEN 'duplicate task_id' WHEN line > first_path THEN 'duplicate output path' WHEN starts_with(path, '/') OR starts_with(path, '../') THEN 'unsafe output path' END, 'ok') AS error, count(*) AS n
FROM t LEFT JOIN a USING (task_id) LEFT JOIN b USING (path) GROUP BY 1""")
def plan_contract(spark: SparkSession, d: str) -> DataFrame:
    """First violated rule of each task of a plan (C8, F30); the pool stands in for the plan, some paths are bent on purpose."""
    p = table(spark, d, POOL, "seq", "scenario", "emotion", "id", "age_tier", "text", "language", "subscene")
    path = F.when(F.col("seq") % 200 == 7, F.concat(F.lit("../"), "id")).when(F.col("seq") % 200 == 9, F.concat(F.lit("/abs/"), "id")).otherwise(F.concat("subscene", F.lit("/"), "id"))
    tasks = p.select(F.col("seq").alias("line"), F.when(F.coalesce("scenario", F.lit("")) == "play", "other").otherwise("plan").alias("plan_id"), F.col("emotion").alias("round_id"), F.col("id").alias("task_id"), F.col("age_tier").alias("speaker_key"), F.col("text").alias("gen_text"), "language", path.alias("expected_output_relpath"))
    fields = ("plan_id", "round_id", "task_id", "speaker_key", "gen_text", "language", "expected_output_relpath")
    return r.plan_errors(tasks, "plan", fields=fields).groupBy(F.coalesce("error", F.lit("ok")).alias("error")).agg(F.count("*").alias("n"))


_LAYOUTS = "CASE n % 7 WHEN 0 THEN '/a/audio/childmandarin/spk' || n || '/' || utt_id || '.wav' WHEN 1 THEN '/a/Chinese_English_Children/WAV/G' || n || '/' || utt_id || '.wav' WHEN 2 THEN '/a/King-ASR-EN-Kid/SPEAKER' || n || '/' || utt_id || '.WAV' WHEN 3 THEN '/a/speechocean762/WAVE/SPEAKER' || n || '/' || utt_id || '.x.wav' WHEN 4 THEN '/a/BAAI/dev/' || n || '/' || utt_id || '.wav' WHEN 5 THEN '/a/BAAI/dev/x/' || utt_id || '.wav' ELSE ref_audio END"


@query(f"""WITH n AS (SELECT DISTINCT utt_id, ref_audio, regexp_extract(utt_id, '(\\d+)$', 1)::BIGINT AS n FROM reference_audio WHERE utt_id IS NOT NULL AND ref_audio IS NOT NULL)
SELECT ref_audio, CASE n % 7 WHEN 0 THEN 'childmandarin' WHEN 1 THEN 'chineseenglishchildren' WHEN 2 THEN CASE WHEN n % 2 = 0 THEN 'kingasr612' ELSE 'king-asr-725' END WHEN 3 THEN 'speechocean762' WHEN 4 THEN 'childmandarin' END AS dataset,
CASE n % 7 WHEN 0 THEN 'spk' || n WHEN 1 THEN 'chineseenglishchildren_G' || n WHEN 2 THEN CASE WHEN n % 2 = 0 THEN 'kingasr612_' || n ELSE 'king-asr-725_SPEAKER' || n END WHEN 3 THEN 'speechocean762_' || n WHEN 4 THEN 'childmandarin_' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END END AS speaker,
CASE WHEN n % 7 < 5 THEN '/to/' || dataset || '/' || speaker || '/' || utt_id || CASE WHEN n % 7 = 3 THEN '.x' ELSE '' END || '_clone_' || CASE WHEN n % 3 = 0 THEN 'text_' || n ELSE substr(md5(utt_id), 1, 16) END || '.wav' END AS target FROM n""")
def path_dialects(spark: SparkSession, d: str) -> DataFrame:
    """Dataset and speaker of references in each layout, and where a clone of theirs is copied (F26, P9); the layouts are made from the inventory's names."""
    n = F.regexp_extract("utt_id", r"(\d+)$", 1).cast("bigint")
    rows = table(spark, d, "reference_audio", "utt_id", "ref_audio").dropna().distinct().withColumn("n", n)
    rows = rows.withColumn("path", F.expr(_LAYOUTS)).withColumn("cloned", F.when(F.col("n") % 2 == 0, "/c/King-ASR-612/x").otherwise("/c/x"))
    s = rows.withColumn("s", r.speaker_of("path", "cloned"))
    wav, task = F.concat(F.lit("/c/text_"), F.col("n").cast("string"), F.lit(".wav")), F.when(F.col("n") % 3 != 0, F.md5("utt_id"))
    return s.select("ref_audio", "s.dataset", "s.speaker", r.copy_target("/to", F.col("s.dataset"), F.col("s.speaker"), F.col("s.stem"), wav, task).alias("target"))


@query()
def eval_validity(spark: SparkSession, d: str) -> DataFrame:
    """Every stored evaluation against one made anew from its texts: a histogram of the first difference."""
    cols = ["wav", "gen_text", "asr_hypo", "ref_normalized", "hypo_normalized", "cer", "substitutions", "insertions", "deletions", "reference_chars", "reference_normalization_context"]
    return r.validated(spread(table(spark, d, "eval", *cols))).groupBy(F.coalesce("error", F.lit("ok")).alias("error")).agg(F.count("*").alias("n"))


@query()
def eval_items(spark: SparkSession, d: str) -> DataFrame:
    """The current rules' record of every clip with a hypothesis (H9, P10)."""
    return r.migrated(spread(table(spark, d, "eval", "wav", "gen_text", "asr_hypo", "reference_normalization_context")))
