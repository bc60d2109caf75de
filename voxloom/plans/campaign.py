"""Queries over speakers, durations, quotas and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import ordering as o
from ..operators import quota as q
from ..session import table
from .metrics import _CER, _COSINES, _MOS, _SIM, cer, cosines, mos, sim
from .registry import query

_POOL = "llm_children_100k_asr_complete"
_REF = "(SELECT DISTINCT speaker_key, utt_id, ref_audio, ref_text, frames, sample_rate FROM reference_audio WHERE speaker_key IS NOT NULL)"
_SECS = "CASE WHEN frames > 0 AND sample_rate > 0 THEN frames / sample_rate END"


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "reference_audio", "speaker_key", "utt_id", "ref_audio", "ref_text", "frames", "sample_rate").where("speaker_key is not null").distinct()


@query(f"""WITH r AS (SELECT speaker_key, sample_rate, sum(frames)::HUGEINT AS f, count(*) AS n FROM {_REF} WHERE frames > 0 AND sample_rate > 0 GROUP BY 1, 2)
SELECT speaker_key, sum(f * (7056000 // sample_rate))::DOUBLE AS numerator, 7056000 AS denominator, sum(f * (7056000 // sample_rate))::DOUBLE / 7056000 AS seconds, sum(n)::BIGINT AS files,
greatest(0, 60 * 7056000 - sum(f * (7056000 // sample_rate)))::DOUBLE AS deficit, sum(f * (7056000 // sample_rate)) >= 60 * 7056000 AS meets FROM r GROUP BY 1""")
def speaker_deficit(spark: SparkSession, d: str) -> DataFrame:
    """Exact duration per speaker over mixed sample rates, deficit to 60 s."""
    return q.exact_durations(_refs(spark, d), "speaker_key", 60).select("speaker_key", F.col("numerator").cast("double").alias("numerator"), F.col("denominator"), "seconds", "files", F.col("deficit").cast("double").alias("deficit"), "meets")


_REF_SECS = f"(SELECT ref_audio, max({_SECS}) AS x FROM {_REF} GROUP BY 1)"
_CLIP = f"""(SELECT c.wav AS wav, split_part(c.wav, '/', 4) || '/' || split_part(c.wav, '/', 5) AS speaker_key, coalesce(x / p.speed, 0) AS x, s.similarity > 0.8 AND e.cer < 0.1 AS ok, s.similarity > 0.8 AND e.cer < 0.1 AND p.rows = 1 AND m.utmos >= 3 AS strict
FROM (SELECT DISTINCT cloned_audio AS wav FROM sim WHERE cloned_audio IS NOT NULL) c LEFT JOIN {_SIM} s USING (wav) LEFT JOIN {_CER} e USING (wav) LEFT JOIN {_MOS} m USING (wav)
LEFT JOIN (SELECT cloned_audio AS wav, count(*) AS rows, min(ref_audio) AS ref_audio, min(speed) FILTER (speed > 0) AS speed FROM sim GROUP BY 1) p USING (wav) LEFT JOIN {_REF_SECS} r ON r.ref_audio = p.ref_audio)"""


def _part(name: str, sql: str) -> str:
    return f"LEFT JOIN (SELECT speaker_key, count(*) AS n, round(sum(x), 9) AS s FROM {sql} GROUP BY 1) {name} USING (speaker_key)"


_FLAVOURS = ("original", "generated", "accepted", "strict")


@query(f"""SELECT speaker_key, {', '.join(f'coalesce({k}.n, 0) AS {k}, coalesce({k}.s, 0) AS {k}_seconds' for k in _FLAVOURS)} FROM (SELECT DISTINCT speaker_key FROM {_REF})
{_part('original', f"(SELECT speaker_key, coalesce({_SECS}, 0) AS x FROM {_REF})")} {_part('generated', _CLIP)} {_part('accepted', f'(SELECT * FROM {_CLIP} WHERE ok)')} {_part('strict', f'(SELECT * FROM {_CLIP} WHERE strict)')}""")
def speaker_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Files and seconds per speaker in four inventories (original, generated, accepted, strictly accepted: without repeated rows, of a good mean opinion), zeros for absent ones (A13). A clip's length isn't in the tables: its reference's over its speed."""
    refs = _refs(spark, d)
    x = F.when((F.col("frames") > 0) & (F.col("sample_rate") > 0), F.col("frames") / F.col("sample_rate"))
    own = refs.groupBy("ref_audio").agg(F.max(x).alias("x"))
    clips = table(spark, d, "sim", F.col("cloned_audio").alias("wav"), "ref_audio", "speed").where("wav is not null").groupBy("wav").agg(F.count("*").alias("rows"), F.min("ref_audio").alias("ref_audio"), F.min(F.when(F.col("speed") > 0, F.col("speed"))).alias("speed"))
    j = clips.join(sim(spark, d), "wav", "left").join(cer(spark, d), "wav", "left").join(mos(spark, d), "wav", "left").join(own, "ref_audio", "left")
    ok = F.coalesce((F.col("similarity") > 0.8) & (F.col("cer") < 0.1), F.lit(False))
    j = j.select(F.concat_ws("/", F.split("wav", "/")[3], F.split("wav", "/")[4]).alias("speaker_key"), F.coalesce(F.col("x") / F.col("speed"), F.lit(0.0)).alias("x"), ok.alias("ok"), (ok & (F.col("rows") == 1) & F.coalesce(F.col("utmos") >= 3, F.lit(False))).alias("strict"))
    return q.inventories(refs.select("speaker_key", F.coalesce(x, F.lit(0.0)).alias("x")), j, "speaker_key", "x", {"generated": F.lit(True), "accepted": F.col("ok"), "strict": F.col("strict")})


_RANK = "ref_text IS NULL OR ref_text = '', coalesce(NOT (x BETWEEN 3 AND 15), true), coalesce(abs(x - 7), 1e9), sha256(speaker_key || chr(0) || utt_id || chr(0) || ref_audio)"


@query(f"SELECT speaker_key, utt_id, row_number() OVER (PARTITION BY speaker_key ORDER BY {_RANK}) AS rank FROM (SELECT *, {_SECS} AS x FROM {_REF})")
def reference_rank(spark: SparkSession, d: str) -> DataFrame:
    """References per speaker: with text, of 3 to 15 seconds, nearest to 7, then by stable hash."""
    x = F.when((F.col("frames") > 0) & (F.col("sample_rate") > 0), F.col("frames") / F.col("sample_rate"))
    by = [F.col("ref_text").isNull() | (F.col("ref_text") == ""), F.coalesce(~x.between(3, 15), F.lit(True)), F.coalesce(F.abs(x - 7), F.lit(1e9)), o.stable_hash("speaker_key", "utt_id", "ref_audio")]
    return _refs(spark, d).select("speaker_key", "utt_id", F.row_number().over(W.partitionBy("speaker_key").orderBy(*by)).alias("rank"))


_HIST = f"SELECT ref_audio, count(*) FILTER (isfinite(similarity)) AS n, count(*) FILTER (similarity > 0.8 AND isfinite(similarity)) AS p, max(similarity) FILTER (isfinite(similarity)) AS b, avg(similarity) FILTER (isfinite(similarity)) AS m FROM {_COSINES} GROUP BY 1"


@query(f"""WITH h AS ({_HIST}), r AS (SELECT speaker_key, ref_audio, coalesce(n, 0) AS n, coalesce(p, 0) AS p, row_number() OVER (PARTITION BY speaker_key ORDER BY round(coalesce(p / nullif(n, 0), 0), 9) DESC, coalesce(p, 0) DESC, coalesce(b, -1) DESC, round(coalesce(m, -1), 9) DESC, ref_audio) AS rank FROM (SELECT DISTINCT speaker_key, ref_audio FROM {_REF}) LEFT JOIN h USING (ref_audio)),
f AS (SELECT *, max(p > 0) OVER (PARTITION BY speaker_key) AS anyp, max(n > 0) OVER (PARTITION BY speaker_key) AS anyo, count(*) FILTER (p > 0) OVER (PARTITION BY speaker_key ORDER BY rank) AS kp, count(*) FILTER (n > 0) OVER (PARTITION BY speaker_key ORDER BY rank) AS ko FROM r)
SELECT speaker_key, ref_audio, rank FROM f WHERE CASE WHEN anyp THEN p > 0 AND kp <= 3 WHEN anyo THEN n > 0 AND ko <= 3 ELSE true END""")
def reference_history_rank(spark: SparkSession, d: str) -> DataFrame:
    """Best passed references per speaker, else the best observed, else all."""
    x = F.when(~F.isnan("similarity"), F.col("similarity"))
    h = cosines(spark, d, "ref_audio").groupBy("ref_audio").agg(F.count(x).alias("n"), F.count_if(x > 0.8).alias("p"), F.max(x).alias("b"), F.avg(x).alias("m"))
    return q.top_references(_refs(spark, d).select("speaker_key", "ref_audio").distinct(), h, 3)


@query("SELECT speaker_key, max(ordinal) + 1 AS next_ordinal FROM (SELECT speaker_key, (regexp_extract(utt_id, '(\\d+)$', 1))::BIGINT AS ordinal FROM reference_audio WHERE speaker_key IS NOT NULL) GROUP BY 1")
def next_ordinal(spark: SparkSession, d: str) -> DataFrame:
    """Next ordinal per speaker."""
    n = F.regexp_extract("utt_id", r"(\d+)$", 1).cast("bigint")
    return table(spark, d, "reference_audio", "speaker_key", "utt_id").where("speaker_key is not null").groupBy("speaker_key").agg((F.max(n) + 1).alias("next_ordinal"))


@query("SELECT user_id, event_id, before FROM (SELECT user_id, event_id, coalesce(sum(round(value * 100)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM events) WHERE before < 10000")
def running_quota(spark: SparkSession, d: str) -> DataFrame:
    """Tasks in order until a quota is credited."""
    df = table(spark, d, "events", "user_id", "event_id", "ts", "value").withColumn("c", F.round(F.col("value") * 100).cast("bigint"))
    return q.until_quota(df, "user_id", ["ts", "event_id"], "c", 10000).select("user_id", "event_id", "before")


@query("""WITH w AS (SELECT c_mktsegment AS k, count(*) AS n FROM customer GROUP BY 1), x AS (SELECT k, n * 1000 / sum(n) OVER () AS x FROM w), f AS (SELECT k, floor(x)::BIGINT AS f, row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, k DESC) AS r FROM x)
SELECT k AS c_mktsegment, f + (r <= 1000 - (SELECT sum(f) FROM f))::INT AS target FROM f""")
def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    """Largest-remainder allocation, ties by key descending."""
    w = table(spark, d, "customer", "c_mktsegment").groupBy("c_mktsegment").agg(F.count("*").alias("w"))
    return o.largest_remainder(w, "c_mktsegment", "w", 1000)


@query(f"SELECT wav, cer, row_number() OVER (ORDER BY cer DESC NULLS LAST, wav) AS rn FROM {_CER}")
def detail_ranking(spark: SparkSession, d: str) -> DataFrame:
    """All clips by descending CER with their global row number, without a global window."""
    return o.numbered(cer(spark, d), "cer", "rn", descending=True, tie="wav")


@query(f"SELECT wav, cer FROM {_CER} WHERE cer IS NOT NULL ORDER BY cer DESC, wav LIMIT 20")
def worst_20(spark: SparkSession, d: str) -> DataFrame:
    """The twenty worst clips."""
    return cer(spark, d).where("cer is not null").orderBy(F.desc("cer"), "wav").limit(20)


@query("SELECT wav FROM (SELECT DISTINCT wav FROM eval WHERE wav IS NOT NULL) ORDER BY sha256('42' || chr(0) || wav) LIMIT 50")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Sample of fifty by seeded hash, the same in every table."""
    return q.hash_sample(table(spark, d, "eval", "wav").dropna().distinct(), "wav", 50, 42)


_IV = "CASE WHEN similarity >= 0 AND similarity < 0.5 THEN 0 WHEN similarity >= 0.5 AND similarity < 0.8 THEN 1 WHEN similarity >= 0.8 AND similarity < 1.0 THEN 2 END"


@query(f"SELECT interval, wav FROM (SELECT {_IV} AS interval, wav, row_number() OVER (PARTITION BY {_IV} ORDER BY sha256('7' || chr(0) || wav)) AS r FROM {_SIM}) WHERE interval IS NOT NULL AND r <= 10")
def interval_sample(spark: SparkSession, d: str) -> DataFrame:
    """Ten clips of each similarity interval (W9). A top-k is kept per slice before slices meet, so no interval is sorted in one task."""
    from ..operators.joins import intervals

    df = sim(spark, d).withColumn("interval", intervals("similarity", [0.0, 0.5, 0.8, 1.0])).where("interval is not null")
    return q.top_per_group(df, ["interval"], [o.stable_hash(F.lit("7"), "wav")], 10, salt="wav").select("interval", "wav")


@query("SELECT seq, id FROM llm_children_100k_asr_complete WHERE seq IS NOT NULL ORDER BY seq LIMIT 300")
def truncated(spark: SparkSession, d: str) -> DataFrame:
    """The first rows up to a target."""
    return table(spark, d, _POOL, "seq", "id").orderBy("seq").limit(300)


def _walk_sql(texts: str, last: int) -> str:
    """The walk of every speaker over a pool of `texts`, ordinals 0 to last: steps one by one until one has no common divisor with the pool."""
    h = lambda name, mod: f"((('0x' || substr(sha256('{name}' || chr(0) || speaker_key), 1, 12))::UBIGINT::HUGEINT * 281474976710656 + ('0x' || substr(sha256('{name}' || chr(0) || speaker_key), 13, 12))::UBIGINT::HUGEINT) % ({mod}))::BIGINT"
    return f"""WITH RECURSIVE t AS (SELECT ({texts})::BIGINT AS t), s AS (SELECT speaker_key, count(*) AS refs FROM (SELECT DISTINCT speaker_key, ref_audio FROM {_REF}) GROUP BY 1),
g(speaker_key, refs, t, off, step) AS (SELECT speaker_key, refs, t, CASE WHEN t = 1 THEN 0 ELSE {h('text-offset', 't')} END, CASE WHEN t = 1 THEN 1 ELSE 1 + {h('text-step', 'greatest(t - 1, 1)')} END FROM s, t
UNION ALL SELECT speaker_key, refs, t, off, 1 + step % (t - 1) FROM g WHERE gcd(step, t) <> 1),
w AS (SELECT speaker_key, k AS ordinal, k % refs AS ref_index, (off + k % refs + (k // refs) * step) % t AS text_index FROM g, (SELECT unnest(range({last + 1})) AS k) WHERE gcd(step, t) = 1)"""


def _walked(spark: SparkSession, d: str, texts: int, last: int) -> DataFrame:
    s = _refs(spark, d).groupBy("speaker_key").agg(F.countDistinct("ref_audio").alias("refs"))
    return q.walk(s.withColumn("ordinal", F.explode(F.sequence(F.lit(0), F.lit(last)))), "speaker_key", "refs", "ordinal", texts).select("speaker_key", "ordinal", "ref_index", "text_index")


_TEXTS = f"SELECT count(DISTINCT id) FROM {_POOL}"


def _pool_size(spark: SparkSession, d: str) -> int:
    return table(spark, d, _POOL, "id").agg(F.countDistinct("id")).first()[0]


@query(_walk_sql(_TEXTS, 30) + " SELECT * FROM w")
def walk_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic walk of each speaker over its references and the texts of the pool, whatever its size."""
    return _walked(spark, d, _pool_size(spark, d), 30)


@query(_walk_sql("100", 30) + " SELECT * FROM w")
def walk_composite(spark: SparkSession, d: str) -> DataFrame:
    """The walk over a hundred texts: steps that share a factor with the pool go on to the next (M6)."""
    return _walked(spark, d, 100, 30)


@query(_walk_sql("100", 30) + f""", u AS (SELECT DISTINCT speaker_key, text_index FROM w JOIN (SELECT DISTINCT seq % 100 AS x, speaker FROM (SELECT seq, speaker_key AS speaker FROM {_POOL} p JOIN (SELECT DISTINCT speaker_key FROM {_REF}) r ON p.task_id % 50 = length(r.speaker_key))) h ON h.x = w.text_index AND h.speaker = w.speaker_key)
SELECT speaker_key, ordinal, text_index, row_number() OVER (PARTITION BY speaker_key ORDER BY ordinal) AS rank FROM w ANTI JOIN u USING (speaker_key, text_index)""")
def unused_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The walk without the (speaker, text) pairs of an earlier plan, ranked again (J10). The earlier plan is made of the pool's tasks."""
    speakers = _refs(spark, d).select("speaker_key").distinct()
    used = table(spark, d, _POOL, "seq", "task_id").join(speakers, F.col("task_id") % 50 == F.length("speaker_key")).select("speaker_key", (F.col("seq") % 100).alias("text_index")).distinct()
    left = _walked(spark, d, 100, 30).join(used, ["speaker_key", "text_index"], "left_anti")
    return left.select("speaker_key", "ordinal", "text_index", F.row_number().over(W.partitionBy("speaker_key").orderBy("ordinal")).alias("rank"))


@query(f"""WITH r AS (SELECT speaker_key, sum(frames::DOUBLE / sample_rate) AS s FROM {_REF} WHERE frames > 0 AND sample_rate > 0 GROUP BY 1)
SELECT speaker_key, CASE WHEN s >= 60 THEN 0 ELSE ceil(round((60 - s) * 1.5 / 4.0, 9))::BIGINT + 2 END AS tasks FROM r""")
def planned_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Tasks that a deficit needs, with a multiplier and a reserve."""
    r = _refs(spark, d).where("frames > 0 and sample_rate > 0").groupBy("speaker_key").agg(F.sum(F.col("frames").cast("double") / F.col("sample_rate")).alias("s"))
    return r.select("speaker_key", q.tasks_for(60 - F.col("s"), 1.5, 4.0, 2).alias("tasks"))


@query()
def diverse_sample(spark: SparkSession, d: str) -> DataFrame:
    """Per speaker clips picked to show unseen values of their dimensions."""
    df = table(spark, d, "sim", "ref_audio", "cloned_audio", "language", "dataset", "speed").where("ref_audio is not null and cloned_audio is not null").distinct()
    return q.diverse(df.withColumn("pace", F.round("speed", 1)), "ref_audio", "cloned_audio", ["language", "dataset", "pace"], 5)


@query()
def quota_accept(spark: SparkSession, d: str) -> DataFrame:
    """Candidates accepted while they fill the largest shortfalls."""
    df = table(spark, d, _POOL, "seq", "age_tier", "length_type", "lang_type")
    return q.shortfall_accept(df, "seq", {"age_tier": {"preschool": 40, "early_elem": 30, "upper_elem": 30}, "length_type": {"short": 50, "long": 50}}, 100)
