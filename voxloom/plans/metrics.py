"""Queries over the metric tables: statistics, joins, selection, contracts (A*, J*, F1-F3, U*, D4-D7, C*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as j
from ..operators import ordering as o
from ..functions import text as t
from ..operators import stats as s
from ..session import table
from .quality import _DEDUP
from .registry import query

_DIST = """round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, min(x) AS min, max(x) AS max, """ + ", ".join(f"round(quantile_cont(x, {p}), 6) AS p{round(p * 100)}" for p in s.LEVELS)
_FIN = "CASE WHEN isfinite({0}) THEN {0} END"
_FOLD = "replace(lower(trim(dataset)), '-', '_')"


def _folded() -> F.Column:
    return F.regexp_replace(F.lower(F.trim("dataset")), "-", "_")


def _best(t: str, key: str, c: str) -> str:
    """One row per clip: the latest usable score, then the larger."""
    return f"(SELECT {key} AS wav, max(CASE WHEN isfinite({c}) THEN struct_pack(a := arrived_at, v := {c}) END).v AS {c} FROM {t} WHERE {key} IS NOT NULL GROUP BY 1)"


def _latest(df: DataFrame, key: str, c: str) -> DataFrame:
    x = s.finite(c)
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("wav")).agg(F.max(F.when(x.isNotNull(), F.struct(F.col("arrived_at").alias("a"), x.alias("v")))).alias("b")).select("wav", F.col("b.v").alias(c))


def cer(spark: SparkSession, d: str) -> DataFrame:
    return _latest(table(spark, d, "eval", "wav", "cer", "arrived_at"), "wav", "cer")


def cosines(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The similarity table with all scores on the cosine scale: version 1 rows hold (cosine + 1) / 2."""
    df = table(spark, d, "sim", "similarity", "score_version", *cols)
    return df.withColumn("similarity", F.when(F.col("score_version") == 1, 2 * F.col("similarity") - 1).otherwise(F.col("similarity"))).drop("score_version")


def sim(spark: SparkSession, d: str) -> DataFrame:
    return _latest(cosines(spark, d, "cloned_audio", "arrived_at"), "cloned_audio", "similarity")


def mos(spark: SparkSession, d: str) -> DataFrame:
    return _latest(table(spark, d, "mos", "cloned_audio", "utmos", "arrived_at"), "cloned_audio", "utmos")


_CER, _MOS = _best("eval", "wav", "cer"), _best("mos", "cloned_audio", "utmos")
_COSINES = "(SELECT * REPLACE (CASE WHEN score_version = 1 THEN 2 * similarity - 1 ELSE similarity END AS similarity) FROM sim)"
_SIM = _best(_COSINES, "cloned_audio", "similarity")
_ROOT = "split_part(wav, '/', 4)"


@query(f"""WITH p AS (SELECT {_ROOT} AS dataset, cer AS x FROM {_CER} c JOIN {_SIM} s USING (wav) WHERE cer < 0.1 AND similarity > 0.8)
SELECT dataset, count(x) AS n, 0 AS failed, {_DIST} FROM p GROUP BY 1""")
def flagship_funnel(spark: SparkSession, d: str) -> DataFrame:
    """The strict joint selection and the distribution of what passes, by dataset."""
    pool = cer(spark, d).join(sim(spark, d), "wav")
    kept = j.threshold(pool, cer_below=0.1, sim_above=0.8).withColumn("dataset", j.dataset_of("wav", "/corpus/cloned"))
    return s.distribution(kept, "cer", ["dataset"])


@query(f"""SELECT 'joint' AS list, wav FROM {_CER} c JOIN {_SIM} s USING (wav) WHERE cer < 0.1 AND similarity > 0.8
UNION ALL SELECT 'cer', wav FROM {_CER} c JOIN {_SIM} s USING (wav) WHERE cer < 0.1 UNION ALL SELECT 'sim', wav FROM {_CER} c JOIN {_SIM} s USING (wav) WHERE similarity > 0.8""")
def selection_lists(spark: SparkSession, d: str) -> DataFrame:
    """Joint, CER-only and similarity-only lists from one join (F2)."""
    pool = cer(spark, d).join(sim(spark, d), "wav")
    lists = F.array_compact(F.array(F.when((F.col("cer") < 0.1) & (F.col("similarity") > 0.8), "joint"), F.when(F.col("cer") < 0.1, "cer"), F.when(F.col("similarity") > 0.8, "sim")))
    return pool.select(F.explode(lists).alias("list"), "wav")


@query(f"""SELECT CASE WHEN cer IS NULL OR similarity IS NULL THEN 'KEEP' WHEN cer < 0.1 AND similarity > 0.8 THEN 'COPY' WHEN cer >= 0.05 THEN 'DELETE' ELSE 'KEEP' END AS action, count(*) AS n
FROM {_CER} c FULL JOIN {_SIM} s USING (wav) GROUP BY 1""")
def classify_action(spark: SparkSession, d: str) -> DataFrame:
    """Three-way classification of every clip."""
    pool = cer(spark, d).join(sim(spark, d), "wav", "full")
    return pool.groupBy(j.action("cer", "similarity", 0.1, 0.8, 0.05).alias("action")).agg(F.count("*").alias("n"))


@query(f"""SELECT wav, cer, similarity, utmos, m.speed AS speed FROM {_CER} c FULL JOIN {_SIM} s USING (wav) FULL JOIN
(SELECT a.wav AS wav, a.utmos, b.speed FROM {_MOS} a JOIN (SELECT cloned_audio AS wav, max(CASE WHEN speed <> 0 THEN speed END) AS speed FROM mos GROUP BY 1) b USING (wav)) m USING (wav)""")
def metric_outer(spark: SparkSession, d: str) -> DataFrame:
    """CER, similarity and MOS in a three-way outer join; a speed of 0 counts as missing."""
    speed = table(spark, d, "mos", "cloned_audio", "speed").where("cloned_audio is not null").groupBy(F.col("cloned_audio").alias("wav")).agg(F.max(j.falsy("speed")).alias("speed"))
    return j.outer3(cer(spark, d), sim(spark, d), mos(spark, d).join(speed, "wav"), "wav").select("wav", "cer", "similarity", "utmos", "speed")


@query(f"SELECT {_FOLD} AS dataset, count(x) AS n, count(*) - count(x) AS failed, {_DIST} FROM (SELECT *, {_FIN.format('cer')} AS x FROM eval) GROUP BY 1 HAVING count(*) >= 100")
def cer_by_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Distribution per dataset, groups of 100 and more (A1, A2, A4)."""
    df = table(spark, d, "eval", "dataset", "cer").withColumn("dataset", _folded())
    return s.distribution(df, "cer", ["dataset"]).where("n + failed >= 100")


@query(f"""SELECT CASE WHEN language = 'en_mostly' THEN 'en' WHEN language IN ('cn_mostly', 'frequent_mix') THEN 'zh' ELSE coalesce(nullif(language, ''), 'unknown') END AS language, count(x) AS n, count(*) - count(x) AS failed, {_DIST}
FROM (SELECT *, {_FIN.format('similarity')} AS x FROM {_COSINES}) GROUP BY 1 HAVING count(*) >= 100""")
def similarity_by_language(spark: SparkSession, d: str) -> DataFrame:
    """Similarity per folded language, version 1 scores on the cosine scale."""
    df = cosines(spark, d, "language").withColumn("language", j.folded_language("language"))
    return s.distribution(df, "similarity", ["language"]).where("n + failed >= 100")


_BINS = """WITH v AS (SELECT {fin} AS x FROM {t}), l AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
h AS (SELECT least(floor((x - lo) / ((hi - lo) / 20)), 19)::INT AS bin, count(*) AS n FROM v, l WHERE x IS NOT NULL GROUP BY 1)
SELECT b.bin::INT AS bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS low, round(lo + b.bin * ((hi - lo) / 20) + (hi - lo) / 20, 6) AS high, round(lo + b.bin * ((hi - lo) / 20) + (hi - lo) / 20 / 2, 6) AS center, coalesce(n, 0) AS n
FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN l LEFT JOIN h ON h.bin = b.bin"""


@query(_BINS.format(fin=_FIN.format("utmos"), t="mos"))
def histogram_20(spark: SparkSession, d: str) -> DataFrame:
    """Histogram of 20 bins (A3)."""
    return s.histogram(table(spark, d, "mos", "utmos"), "utmos")


@query(f"""WITH p AS (SELECT cer, similarity, utmos FROM {_CER} c JOIN {_SIM} s USING (wav) JOIN {_MOS} m USING (wav) WHERE cer IS NOT NULL AND similarity IS NOT NULL AND utmos IS NOT NULL)
SELECT count(*) AS n, round(corr(cer, similarity), 6) AS cer_similarity, round(corr(cer, utmos), 6) AS cer_utmos, round(corr(similarity, utmos), 6) AS similarity_utmos FROM p""")
def metric_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Pearson correlations over clips with all three scores (A5)."""
    full = cer(spark, d).join(sim(spark, d), "wav").join(mos(spark, d), "wav")
    return s.correlation(full, [("cer", "similarity"), ("cer", "utmos"), ("similarity", "utmos")])


@query("""SELECT sum(substitutions + insertions + deletions) AS operations, sum(reference_chars) AS characters, round(coalesce(sum(substitutions + insertions + deletions) / sum(reference_chars), 0) * 100, 6) AS weighted,
round(coalesce(avg(cer), 0) * 100, 6) AS mean, round(coalesce(median(cer), 0) * 100, 6) AS median, round(coalesce(max(cer), 0) * 100, 6) AS worst, round(coalesce(min(cer), 0) * 100, 6) AS best FROM eval WHERE isfinite(cer) AND reference_chars > 0""")
def cer_summary(spark: SparkSession, d: str) -> DataFrame:
    """Weighted and mean CER."""
    df = table(spark, d, "eval", "cer", "substitutions", "insertions", "deletions", "reference_chars").where(s.finite("cer").isNotNull() & (F.col("reference_chars") > 0))
    ops, r = F.sum(F.col("substitutions") + F.col("insertions") + F.col("deletions")), lambda c: F.round(F.coalesce(c, F.lit(0.0)) * 100, 6)
    return df.agg(ops.alias("operations"), F.sum("reference_chars").alias("characters"), r(F.try_divide(ops, F.sum("reference_chars"))).alias("weighted"), r(F.avg("cer")).alias("mean"), r(F.max("cer")).alias("worst"), r(F.min("cer")).alias("best")).crossJoin(F.broadcast(s.median(df, "cer"))).select("operations", "characters", "weighted", "mean", r(F.col("_median")).alias("median"), "worst", "best")


_GROUP = f"SELECT {_FOLD} AS dataset, sum(substitutions + insertions + deletions) AS operations, sum(reference_chars) AS units, round(sum(substitutions + insertions + deletions) / sum(reference_chars) * 100, 3) AS rate FROM eval WHERE reference_chars > 0 AND cer IS NOT NULL GROUP BY 1"


def _rates(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "eval", "dataset", "cer", "substitutions", "insertions", "deletions", "reference_chars").where("reference_chars > 0 and cer is not null").withColumn("dataset", _folded())
    return s.error_rate(df, ["dataset"], F.col("substitutions") + F.col("insertions") + F.col("deletions"), F.col("reference_chars"))


@query(_GROUP)
def error_rate_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Weighted error rate per group."""
    return _rates(spark, d)


@query(f"WITH g AS ({_GROUP}) SELECT coalesce(dataset, '') AS dataset, rate FROM g UNION ALL SELECT 'macro', round(avg(rate), 3) FROM g HAVING count(*) > 1")
def error_rate_macro(spark: SparkSession, d: str) -> DataFrame:
    """Macro average of the rounded group rates, only with more than one group."""
    return s.with_macro(_rates(spark, d).withColumn("dataset", F.coalesce("dataset", F.lit(""))), "dataset", "rate", 3)


@query(f"WITH g AS ({_GROUP}) SELECT count(*) FILTER (rate <= 5) AS upto5, count(*) FILTER (rate <= 10) AS upto10, count(*) FILTER (rate <= 20) AS upto20, count(*) AS groups FROM g")
def threshold_counts(spark: SparkSession, d: str) -> DataFrame:
    """Groups up to 5, 10 and 20 percent."""
    return _rates(spark, d).agg(*[F.count_if(F.col("rate") <= k).alias(f"upto{k}") for k in (5, 10, 20)], F.count("*").alias("groups"))


@query(f"WITH g AS (SELECT coalesce(language, '') AS language, avg(utmos) AS utmos FROM mos WHERE isfinite(utmos) GROUP BY 1) SELECT language, round(utmos, 6) AS utmos FROM g UNION ALL SELECT 'macro', round(avg(utmos), 6) FROM g HAVING count(*) > 1")
def mos_macro(spark: SparkSession, d: str) -> DataFrame:
    """Mean per language and the mean of the unrounded means."""
    g = table(spark, d, "mos", "language", "utmos").where(s.finite("utmos").isNotNull()).groupBy(F.coalesce("language", F.lit("")).alias("language")).agg(F.avg("utmos").alias("utmos"))
    return s.with_macro(g, "language", "utmos", 6, before_rounding=True)


@query("SELECT sha256(string_agg(wav, chr(10) ORDER BY wav) || chr(10)) AS fingerprint, count(*) AS n FROM (SELECT DISTINCT wav FROM eval WHERE wav IS NOT NULL)")
def list_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprint of an ordered list."""
    return s.list_fingerprint(table(spark, d, "eval", "wav").dropna().distinct(), "wav")


@query("""WITH h AS (SELECT sha256(wav) AS h FROM (SELECT DISTINCT wav FROM eval WHERE wav IS NOT NULL)), p AS (SELECT substr(h, 1, 2) AS s, sha256(string_agg(h, '' ORDER BY h)) AS p, count(*) AS c FROM h GROUP BY 1),
q AS (SELECT substr(s, 1, 1) AS s, sha256(string_agg(p, '' ORDER BY s)) AS p, sum(c) AS c FROM p GROUP BY 1)
SELECT sha256(string_agg(p, '' ORDER BY s)) AS fingerprint, sum(c)::BIGINT AS n FROM q""")
def tree_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Order-free fingerprint that no single task has to hold (A20 at scale)."""
    return s.tree_fingerprint(table(spark, d, "eval", "wav").dropna().distinct(), "wav")


@query("""WITH l AS (SELECT seq, scenario AS v FROM llm_children_100k_asr_complete ORDER BY seq DESC LIMIT 800), c AS (SELECT v AS value, count(*) AS n, min(seq) AS f FROM l WHERE v IS NOT NULL GROUP BY 1 ORDER BY n DESC, f LIMIT 8)
SELECT value, n FROM c WHERE n >= greatest(3, floor((SELECT count(*) FROM l) * 0.0125))""")
def hot_values(spark: SparkSession, d: str) -> DataFrame:
    """Frequent values among the last 800 rows."""
    return s.hot(table(spark, d, "llm_children_100k_asr_complete", "seq", "scenario"), "scenario", "seq", 800, 0.0125, 8)


# The tables of frequent patterns.
FILLERS = ("嗯", "那个", "就是", "啊", "呃", "哎呀", "为什么", "wait", "okay", "no no", "very very")
OBJECTS = (
    "妈妈", "爸爸", "故事", "phone", "number", "玩具", "作业", "magic", "spell", "不公平", "回家", "睡觉", "小熊", "古诗", "唐诗", "诗人", "拼音", "生字", "造句", "作文", "单词", "English", "math", "加法", "乘法", "口诀", "恐龙",
    "老师", "同桌", "黑板", "实验", "磁铁", "影子", "垃圾分类", "跳绳", "篮球", "唱歌", "画画", "键盘", "机器人", "值日", "小明", "小红", "小刚", "阅读材料", "庆历四年", "Read after me", "已知rt", "Tom has", "how many", "相向而行", "岳阳楼",
    "我想", "我要", "我不", "能不能", "为什么", "然后就是", "i want", "i don't", "can we", "mom can",
)
PHRASES = (
    "阅读材料", "read after me", "question:", "已知rt", "庆历四年", "床前明月光", "how many apples", "相向而行", "庆历四年春", "学而时习之", "repeat after me", "小明有", "妈妈你看", "我觉得", "嗯那个", "不对不对",
    "我想", "我要", "我不", "能不能", "i want", "i don't", "因为所以", "但是如果", "先帝", "子曰",
)
_L = lambda words: "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


@query(f"""WITH l AS (SELECT seq, text, lower(text) AS low, {_DEDUP} AS form FROM (SELECT seq, coalesce(text, '') AS text FROM llm_children_100k_asr_complete WHERE seq IS NOT NULL ORDER BY seq DESC LIMIT 800)),
e AS (SELECT 'opening' AS family, left(form, 4) AS value, seq, 0 AS k FROM l WHERE length(form) >= 3 UNION ALL SELECT 'tag', unnest(t), seq, unnest(range(len(t))) FROM (SELECT seq, regexp_extract_all(text, '\\[([^\\]]+)\\]', 1) AS t FROM l)
UNION ALL SELECT 'filler', w, seq, k FROM l, (SELECT unnest({_L(FILLERS)}) AS w, unnest(range({len(FILLERS)})) AS k) WHERE contains(low, lower(w)) UNION ALL SELECT 'object', w, seq, k FROM l, (SELECT unnest({_L(OBJECTS)}) AS w, unnest(range({len(OBJECTS)})) AS k) WHERE contains(low, lower(w))
UNION ALL SELECT 'phrase', w, seq, k FROM l, (SELECT unnest({_L(PHRASES)}) AS w, unnest(range({len(PHRASES)})) AS k) WHERE contains(low, w)),
c AS (SELECT family, value, count(*) AS n, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, min((seq, k))) AS r FROM e GROUP BY 1, 2),
p AS (SELECT unnest(['opening', 'tag', 'filler', 'object', 'phrase']) AS family, unnest([0.0125, 0.04, 0.03, 0.025, 0.015]) AS share, unnest([8, 5, 8, 8, 6]) AS most)
SELECT family, value, n FROM c JOIN p USING (family) WHERE r <= most AND n >= greatest(3, floor(share * (SELECT count(*) FROM l)))""")
def hot_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Frequent openings, tags, fillers, objects and phrases among the last 800 rows."""
    return s.hot_patterns(table(spark, d, "llm_children_100k_asr_complete", "seq", "text"), "text", "seq", {"filler": FILLERS, "object": OBJECTS, "phrase": PHRASES})


@query(f"""WITH l AS (SELECT text FROM llm_children_100k_asr_complete WHERE seq IS NOT NULL ORDER BY seq DESC LIMIT 5000), n AS (SELECT count(*) FILTER (contains(text, '[')) AS tagged FROM l),
c AS (SELECT unnest(regexp_extract_all(text, '\\[([^\\]]+)\\]', 1)) AS tag FROM l), a AS (SELECT unnest({_L(t.TAGS)}) AS tag)
SELECT a.tag AS tag, count(c.tag) AS n FROM a LEFT JOIN c USING (tag), n WHERE tagged > 50 GROUP BY a.tag, tagged HAVING count(c.tag) < greatest(2, tagged // 50)""")
def cold_tags(spark: SparkSession, d: str) -> DataFrame:
    """Known tags that the last 5000 rows hardly use."""
    return s.cold_tags(table(spark, d, "llm_children_100k_asr_complete", "seq", "text"), "text", "seq", t.TAGS)


@query("SELECT ref_audio, count(*) AS items, count(*) FILTER (x > 0.8) AS passes, round(count(*) FILTER (x > 0.8) / count(*), 6) AS pass_rate, max(x) AS best, round(avg(x), 6) AS mean FROM (SELECT ref_audio, CASE WHEN isfinite(similarity) THEN similarity END AS x FROM (SELECT ref_audio, CASE WHEN score_version = 1 THEN 2 * similarity - 1 ELSE similarity END AS similarity FROM sim)) GROUP BY 1")
def reference_passes(spark: SparkSession, d: str) -> DataFrame:
    """Pass statistics per reference; partial sums are combined before the shuffle, so a hot reference is no hot task."""
    return s.pass_rates(cosines(spark, d, "ref_audio"), "ref_audio", "similarity", 0.8)


@query("SELECT count(*) AS clips, count(DISTINCT ref_audio) AS refs, round(sum(speed), 6) AS total_speed, round(sum(similarity * speed) / sum(speed), 6) AS weighted FROM sim WHERE isfinite(similarity) AND speed > 0")
def plan_totals(spark: SparkSession, d: str) -> DataFrame:
    """Sums, distinct counts and a ratio of sums."""
    df = table(spark, d, "sim", "ref_audio", "similarity", "speed").where(s.finite("similarity").isNotNull() & (F.col("speed") > 0))
    return df.agg(F.count("*").alias("clips"), F.countDistinct("ref_audio").alias("refs"), F.round(F.sum("speed"), 6).alias("total_speed"), F.round(F.sum(F.col("similarity") * F.col("speed")) / F.sum("speed"), 6).alias("weighted"))


@query("WITH m AS (SELECT substr(evaluated_at, 1, 10) AS day, count(*) AS n FROM eval WHERE evaluated_at IS NOT NULL GROUP BY 1 ORDER BY n DESC, day LIMIT 1) SELECT day, n FROM m")
def common_day(spark: SparkSession, d: str) -> DataFrame:
    """Most common evaluation day, ties to the first."""
    day = F.regexp_extract(F.substring("evaluated_at", 1, 2000), r"^\d{4}-\d{2}-\d{2}", 0)
    return table(spark, d, "eval", "evaluated_at").where("evaluated_at is not null").groupBy(day.alias("day")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "day").limit(1)


@query("SELECT count(*) AS n FROM eval WHERE substr(evaluated_at, 1, 10) = (SELECT substr(evaluated_at, 1, 10) FROM eval WHERE evaluated_at IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")
def current_run(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the most common run (F31); the mode is one row and is broadcast."""
    rows = table(spark, d, "eval", "evaluated_at").withColumn("day", F.substring("evaluated_at", 1, 10))
    return rows.join(F.broadcast(common_day(spark, d).select("day")), "day", "left_semi").agg(F.count("*").alias("n"))


@query("""SELECT wav, 'extra' AS side FROM (SELECT wav FROM eval WHERE wav IS NOT NULL EXCEPT SELECT cloned_audio FROM mos) UNION ALL SELECT cloned_audio, 'missing' FROM (SELECT cloned_audio FROM mos WHERE cloned_audio IS NOT NULL EXCEPT SELECT wav FROM eval)""")
def coverage_extra_missing(spark: SparkSession, d: str) -> DataFrame:
    """Keys of one side only."""
    return j.coverage(table(spark, d, "eval", "wav").dropna(), table(spark, d, "mos", F.col("cloned_audio").alias("wav")).dropna(), "wav")


@query("""SELECT (SELECT count(*) FROM (SELECT wav FROM eval INTERSECT SELECT cloned_audio FROM sim)) AS both, (SELECT count(*) FROM (SELECT wav FROM eval UNION SELECT cloned_audio FROM sim)) AS either,
(SELECT count(*) FROM (SELECT wav FROM eval EXCEPT SELECT cloned_audio FROM sim)) AS only_eval, (SELECT count(*) FROM (SELECT cloned_audio FROM mos EXCEPT SELECT cloned_audio FROM sim)) = 0 AS mos_in_sim""")
def key_sets(spark: SparkSession, d: str) -> DataFrame:
    """Intersection, union, difference and subset test of key sets."""
    a, b, c = table(spark, d, "eval", "wav"), table(spark, d, "sim", F.col("cloned_audio").alias("wav")), table(spark, d, "mos", F.col("cloned_audio").alias("wav"))
    n = lambda df, name: df.agg(F.count("*").alias(name))
    out = n(a.intersect(b), "both").crossJoin(n(a.union(b).distinct(), "either")).crossJoin(n(a.subtract(b), "only_eval"))
    return out.crossJoin(n(c.subtract(b), "_m").select((F.col("_m") == 0).alias("mos_in_sim")))


@query("SELECT DISTINCT name FROM (SELECT 'dataset:' || dataset AS name FROM eval WHERE dataset IS NOT NULL UNION ALL SELECT 'language:' || language FROM sim WHERE language IS NOT NULL)")
def dimension_names(spark: SparkSession, d: str) -> DataFrame:
    """Union of dimension values."""
    a = table(spark, d, "eval", "dataset").dropna().select(F.concat(F.lit("dataset:"), "dataset").alias("name"))
    return a.unionByName(table(spark, d, "sim", "language").dropna().select(F.concat(F.lit("language:"), "language").alias("name"))).distinct()


_REFS = "(SELECT ref_audio, min(speaker_key) AS speaker_key FROM reference_audio WHERE ref_audio IS NOT NULL GROUP BY 1)"


@query(f"SELECT coalesce(speaker_key, '') AS speaker_key, count(*) AS clips, count(*) FILTER (similarity > 0.8) AS passes FROM sim LEFT JOIN {_REFS} r USING (ref_audio) GROUP BY 1")
def clips_per_speaker(spark: SparkSession, d: str) -> DataFrame:
    """References looked up for every clip (J7, J8, J14). Clips are counted per reference first, so that the join moves a row per reference, however hot one is."""
    refs = table(spark, d, "reference_audio", "ref_audio", "speaker_key").where("ref_audio is not null").groupBy("ref_audio").agg(F.min("speaker_key").alias("speaker_key"))
    per = table(spark, d, "sim", "ref_audio", "similarity").groupBy("ref_audio").agg(F.count("*").alias("clips"), F.count_if(F.col("similarity") > 0.8).alias("passes"))
    return per.join(refs, "ref_audio", "left").groupBy(F.coalesce("speaker_key", F.lit("")).alias("speaker_key")).agg(F.sum("clips").alias("clips"), F.sum("passes").alias("passes"))


@query("SELECT count(*) AS unknown FROM (SELECT DISTINCT ref_audio FROM sim WHERE ref_audio IS NOT NULL) s ANTI JOIN reference_audio r USING (ref_audio)")
def unknown_references(spark: SparkSession, d: str) -> DataFrame:
    """References that the inventory lacks (J8's error case)."""
    return table(spark, d, "sim", "ref_audio").dropna().distinct().join(table(spark, d, "reference_audio", "ref_audio"), "ref_audio", "left_anti").agg(F.count("*").alias("unknown"))


@query(f"SELECT wav, coalesce(s.ok, false) AS sim_pass, coalesce(c.ok, false) AS cer_pass, CASE WHEN s.ok AND c.ok THEN 'accept' ELSE 'reject' END AS action, CASE WHEN s.ok IS NULL OR NOT s.ok THEN 'sim' WHEN c.ok IS NULL OR NOT c.ok THEN 'cer' END AS stage FROM (SELECT wav, coalesce(similarity > 0.8, false) AS ok FROM {_SIM}) s FULL JOIN (SELECT wav, coalesce(cer < 0.1, false) AS ok FROM {_CER}) c USING (wav)")
def acceptance(spark: SparkSession, d: str) -> DataFrame:
    """Accept or reject with the failing stage."""
    a = sim(spark, d).select("wav", F.coalesce(F.col("similarity") > 0.8, F.lit(False)).alias("s")).join(cer(spark, d).select("wav", F.coalesce(F.col("cer") < 0.1, F.lit(False)).alias("c")), "wav", "full")
    a = a.select("wav", F.coalesce("s", F.lit(False)).alias("sim_pass"), F.coalesce("c", F.lit(False)).alias("cer_pass"))
    return a.select("*", F.when(F.col("sim_pass") & F.col("cer_pass"), "accept").otherwise("reject").alias("action"), F.when(~F.col("sim_pass"), "sim").when(~F.col("cer_pass"), "cer").alias("stage"))


@query(f"SELECT CASE WHEN similarity < 0 THEN NULL WHEN similarity < 0.5 THEN 0 WHEN similarity < 0.7 THEN 1 WHEN similarity < 0.8 THEN 2 WHEN similarity < 0.9 THEN 3 WHEN similarity < 1.0 THEN 4 END AS interval, count(*) AS n FROM {_SIM} GROUP BY 1")
def interval_counts(spark: SparkSession, d: str) -> DataFrame:
    """Clips per similarity interval; negatives and exactly 1.0 lie in none."""
    return sim(spark, d).groupBy(j.intervals("similarity", [0.0, 0.5, 0.7, 0.8, 0.9, 1.0]).alias("interval")).agg(F.count("*").alias("n"))


_KEYS = "coalesce({0}::VARCHAR, chr(0))"
_EQ = ["similarity_metric", "score_version", "ref_audio", "dataset", "language", "speed"]


@query(f"""WITH g AS (SELECT cloned_audio, count(*) AS rows, max(CASE WHEN NOT isnan(similarity) THEN similarity END) - min(CASE WHEN NOT isnan(similarity) THEN similarity END) AS spread, count(CASE WHEN NOT isnan(similarity) THEN 1 END) AS scored,
{' OR '.join(f"min({_KEYS.format(c)}) <> max({_KEYS.format(c)})" for c in _EQ)} AS column_conflict FROM sim GROUP BY 1 HAVING count(*) > 1)
SELECT cloned_audio, rows, coalesce(spread > 1e-6, false) AS value_conflict, scored > 0 AND scored < rows AS null_conflict, column_conflict FROM g WHERE coalesce(spread > 1e-6, false) OR (scored > 0 AND scored < rows) OR column_conflict""")
def similarity_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Repeated clips whose rows disagree beyond 1e-6."""
    return j.conflicts(table(spark, d, "sim", "cloned_audio", "similarity", *_EQ), "cloned_audio", "similarity", _EQ, 1e-6)


@query("SELECT wav, rows, coalesce(spread > 1e-12, false) AS value_conflict, scored > 0 AND scored < rows AS null_conflict, false AS column_conflict FROM (SELECT wav, count(*) AS rows, max(cer) - min(cer) AS spread, count(cer) AS scored FROM eval GROUP BY 1 HAVING count(*) > 1) WHERE coalesce(spread > 1e-12, false) OR (scored > 0 AND scored < rows)")
def cer_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Repeated CER rows off by more than 1e-12."""
    return j.conflicts(table(spark, d, "eval", "wav", "cer"), "wav", "cer", [], 1e-12)


@query("SELECT id, count(*) AS rows FROM llm_children_100k_asr_complete GROUP BY 1 HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Identities that stand more than once."""
    return j.duplicated(table(spark, d, "llm_children_100k_asr_complete", "id"), "id")


@query("""SELECT cloned_audio AS wav, count(*) AS rows, arg_min(similarity, (coalesce(epoch_us(arrived_at), 9223372036854775807), -similarity)) FILTER (isfinite(similarity)) AS similarity FROM sim GROUP BY 1""")
def first_of_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """One row per clip: the first finite score to arrive, then the larger; null where no row has one."""
    return j.first_finite(table(spark, d, "sim", F.col("cloned_audio").alias("wav"), "similarity", "arrived_at"), "wav", "similarity", "arrived_at")


@query("""SELECT coalesce(CASE WHEN cloned_audio IS NULL THEN 'no audio' END, CASE WHEN similarity_metric IS DISTINCT FROM 'cosine' THEN 'metric' END, CASE WHEN score_version IS DISTINCT FROM 2 THEN 'version' END,
CASE WHEN len(similarity_range) <> 2 OR similarity_range[1] <> -1.0 OR similarity_range[2] <> 1.0 THEN 'range' END, CASE WHEN isnan(similarity) THEN 'not finite' END, CASE WHEN similarity < -1 OR similarity > 1 THEN 'out of range' END,
CASE WHEN cloned_audio_signature IS NULL THEN 'no signature' END, 'ok') AS error, count(*) AS n FROM sim GROUP BY 1""")
def similarity_contract(spark: SparkSession, d: str) -> DataFrame:
    """First violated rule of each similarity record."""
    from ..operators.contracts import first_error

    e = first_error([
        (F.col("cloned_audio").isNull(), "no audio"), (~F.col("similarity_metric").eqNullSafe("cosine"), "metric"), (~F.col("score_version").eqNullSafe(2), "version"),
        ((F.size("similarity_range") != 2) | (F.col("similarity_range")[0] != -1.0) | (F.col("similarity_range")[1] != 1.0), "range"), (F.isnan("similarity"), "not finite"),
        ((F.col("similarity") < -1) | (F.col("similarity") > 1), "out of range"), (F.col("cloned_audio_signature").isNull(), "no signature"),
    ])
    df = table(spark, d, "sim", "cloned_audio", "similarity_metric", "score_version", "similarity_range", "similarity", "cloned_audio_signature")
    return df.groupBy(F.coalesce(e, F.lit("ok")).alias("error")).agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT model_dir) AS models, count(DISTINCT model_signature::VARCHAR) AS signatures, count(DISTINCT similarity_metric) AS metrics, count(DISTINCT model_dir) = 1 AND count(DISTINCT model_signature::VARCHAR) = 1 AS single FROM sim")
def single_model(spark: SparkSession, d: str) -> DataFrame:
    """Whether one model made all scores; signature maps are compared as sorted entries."""
    df = table(spark, d, "sim", "model_dir", "model_signature", "similarity_metric").withColumn("sig", F.to_json(F.array_sort(F.map_entries("model_signature"))))
    return df.agg(F.countDistinct("model_dir").alias("models"), F.countDistinct("sig").alias("signatures"), F.countDistinct("similarity_metric").alias("metrics")).withColumn("single", (F.col("models") == 1) & (F.col("signatures") == 1))


@query("""SELECT count(*) AS rows, count(*) FILTER (valid) AS valid FROM (SELECT coalesce(eval_schema_version = 4 AND stage = 'complete' AND cer_metric = 'char_error_rate' AND cer_score_version = 4 AND normalization_profile = 'safe_tn' AND normalization_version = 4
AND length(normalization_fingerprint) = 64 AND asr_model_fingerprint IS NOT NULL AND asr_decode_fingerprint IS NOT NULL AND isfinite(cer) AND cer >= 0, false) AS valid FROM eval)""")
def cer_contract(spark: SparkSession, d: str) -> DataFrame:
    """Rows that meet the CER row contract (C4)."""
    from ..operators.contracts import CER_CONTRACT, meets

    df = table(spark, d, "eval", *CER_CONTRACT["equal"], *CER_CONTRACT["present"], "cer")
    return df.agg(F.count("*").alias("rows"), F.count_if(meets(CER_CONTRACT)).alias("valid"))


@query("SELECT count(*) FILTER (asr_hypo IS NOT NULL AND cer IS NULL) AS reusable, count(*) FILTER (asr_hypo IS NULL) AS missing, count(*) FILTER (abs(cer - (substitutions + insertions + deletions)::DOUBLE / reference_chars) > 1e-12) AS stale FROM eval WHERE reference_chars IS NULL OR reference_chars > 0")
def cer_recomputed(spark: SparkSession, d: str) -> DataFrame:
    """Stored rates against their own counts, reusable hypotheses."""
    df = table(spark, d, "eval", "asr_hypo", "cer", "substitutions", "insertions", "deletions", "reference_chars").where("reference_chars is null or reference_chars > 0")
    again = (F.col("substitutions") + F.col("insertions") + F.col("deletions")).cast("double") / F.col("reference_chars")
    return df.agg(F.count_if(F.col("asr_hypo").isNotNull() & F.col("cer").isNull()).alias("reusable"), F.count_if(F.col("asr_hypo").isNull()).alias("missing"), F.count_if(F.abs(F.col("cer") - again) > 1e-12).alias("stale"))


@query("SELECT speaker_key, substr(sha256('seed' || chr(0) || speaker_key), 1, 24) AS h, (('0x' || substr(sha256(speaker_key), 1, 16))::UBIGINT % 7)::INT AS worker FROM (SELECT DISTINCT speaker_key FROM reference_audio WHERE speaker_key IS NOT NULL)")
def hash_partition(spark: SparkSession, d: str) -> DataFrame:
    """Stable hashes and the worker of each speaker."""
    return table(spark, d, "reference_audio", "speaker_key").dropna().distinct().select("speaker_key", o.stable_hash(F.lit("seed"), "speaker_key", length=24).alias("h"), o.hash_worker("speaker_key", 7).alias("worker"))


def _json(c: str) -> str:
    """A text as JSON has it: backslash, quote and control characters escaped."""
    out = f"replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
    for code in range(1, 32):
        short = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}.get(code, f"u{code:04x}")
        out = f"replace({out}, chr({code}), '\\{short}')"
    return f"coalesce('\"' || {out} || '\"', 'null')"


@query(f"""SELECT id, 'gen_' || substr(md5('{{"emotion": ' || {_json('emotion')} || ', "text": ' || {_json('text')} || '}}'), 1, 16) AS text_id FROM (SELECT DISTINCT id, emotion, text FROM llm_children_100k_asr_complete WHERE id IS NOT NULL)""")
def text_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids from the MD5 of a canonical JSON, of every distinct text (C12). The reference's fields: generated_text_ids, adult_text_ids."""
    from ..operators.contracts import canonical_json

    df = table(spark, d, "llm_children_100k_asr_complete", "id", "emotion", "text").where("id is not null").distinct()
    return df.select("id", F.concat(F.lit("gen_"), F.substring(F.md5(canonical_json(["emotion", "text"])), 1, 16)).alias("text_id"))


def _object(fields: dict[str, str]) -> str:
    return "'{' || " + " || ', ' || ".join(f"'\"{k}\": ' || {v}" for k, v in sorted(fields.items())) + " || '}'"


_IDS = {"text": _json("text"), "lang_type": _json("lang_type"), "scenario": _json("nullif(scenario, '')"), "task_id": "coalesce(task_id::VARCHAR, 'null')"}


@query(f"SELECT seq, id, 'gen_' || substr(md5({_object(_IDS | {'length_type': _json('length_type'), 'subscene': _json('subscene')})}), 1, 16) AS text_id FROM llm_children_100k_asr_complete")
def generated_text_ids(spark: SparkSession, d: str) -> DataFrame:
    """The id that each row of the pool gets from its text, types, scene and task; every row, a stored id beside it (C12). A null counts as a field that holds null."""
    from ..operators.contracts import generated_ids

    return generated_ids(table(spark, d, "llm_children_100k_asr_complete", "seq", "id", "text", "lang_type", "length_type", "scenario", "subscene", "task_id")).select("seq", "id", "text_id")


@query(f"""SELECT seq, id, 'adult_' || substr(md5({_object(_IDS | {'scenario': _json('scenario'), 'age_tier': "'\"adult\"'"})}), 1, 16) AS text_id FROM llm_children_100k_asr_complete""")
def adult_text_ids(spark: SparkSession, d: str) -> DataFrame:
    """The same with the adult generator's fields (H20), over every row as if it were that generator's."""
    from ..operators.contracts import adult_ids

    return adult_ids(table(spark, d, "llm_children_100k_asr_complete", "seq", "id", "text", "lang_type", "scenario", "task_id")).select("seq", "id", "text_id")


@query(f"SELECT dataset_of_path AS dataset, count(*) AS n, count(*) FILTER (moved LIKE '/archive/%') AS moved, count(*) FILTER (dataset_of_path = named) AS agree FROM (SELECT CASE WHEN starts_with(wav, '/corpus/cloned/') THEN split_part(wav, '/', 4) ELSE 'unknown' END AS dataset_of_path, CASE WHEN starts_with(wav, '/corpus') THEN '/archive' || substr(wav, 8) ELSE wav END AS moved, {_FOLD} AS named FROM eval) GROUP BY 1")
def path_columns(spark: SparkSession, d: str) -> DataFrame:
    """Dataset from path and rewritten path prefixes."""
    df = table(spark, d, "eval", "wav", "dataset").select(j.dataset_of("wav", "/corpus/cloned").alias("p"), j.rewritten("wav", "/corpus", "/archive").alias("moved"), _folded().alias("named"))
    return df.groupBy(F.col("p").alias("dataset")).agg(F.count("*").alias("n"), F.count_if(F.col("moved").startswith("/archive/")).alias("moved"), F.count_if(F.col("p") == F.col("named")).alias("agree"))


@query("SELECT wav, coalesce(a.utmos, b.scoreq) AS best_mos, coalesce(a.speed, b.speed) AS speed FROM (SELECT cloned_audio AS wav, max(utmos) FILTER (isfinite(utmos)) AS utmos, max(speed) AS speed FROM mos WHERE arrived_at >= TIMESTAMP '2026-04-05' GROUP BY 1) a FULL JOIN (SELECT cloned_audio AS wav, max(scoreq) AS scoreq, max(speed) AS speed FROM mos WHERE arrived_at < TIMESTAMP '2026-04-05' GROUP BY 1) b USING (wav)")
def metric_upsert(spark: SparkSession, d: str) -> DataFrame:
    """New metric fields merged over old ones by key."""
    df = table(spark, d, "mos", "cloned_audio", "utmos", "scoreq", "speed", "arrived_at").withColumnRenamed("cloned_audio", "wav")
    new = df.where("arrived_at >= timestamp_ntz '2026-04-05'").groupBy("wav").agg(F.max(s.finite("utmos")).alias("best_mos"), F.max("speed").alias("speed"))
    old = df.where("arrived_at < timestamp_ntz '2026-04-05'").groupBy("wav").agg(F.max("scoreq").alias("best_mos"), F.max("speed").alias("speed"))
    return j.upsert(old, new, "wav")
