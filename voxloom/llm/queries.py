"""Queries pN_... of this subpackage over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import folded, table

POOL = "llm_children_100k_asr_complete"
SCORES = (("eval", "wav", "cer"), ("sim", "cloned_audio", "similarity"), ("mos", "cloned_audio", "utmos"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from .repetition import repetitive

    return repetitive(table(spark, d, POOL, "seq", "text"), "seq", "text")


def p2_lines(spark: SparkSession, d: str) -> DataFrame:
    from .repetition import clean_lines

    return clean_lines(table(spark, d, POOL, "seq", "text"), "seq", "text")


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    from .repetition import clean_lines

    return clean_lines(table(spark, d, POOL, "seq", "text"), "seq", "text").select("seq", F.col("n_letters").cast("bigint").alias("n_letters"), F.round("repeated_share", 6).alias("repeated_share"))


def _sampler(spark: SparkSession, d: str):
    from .quota import Sampler

    f = ("age_tier", "length_type", "lang_type")
    return Sampler(table(spark, d, POOL, "id", *f), table(spark, d, "sample_targets"), "id", f)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _sampler(spark, d).unmet()


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return _sampler(spark, d).report()


def p6_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sampler(spark, d).sample()


def _near(spark: SparkSession, d: str):
    from .neardup import NearDuplicates

    return NearDuplicates(table(spark, d, POOL, "id", "text", "seq"), "id", "text", "seq")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).pairs().select("id_a", "id_b")


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).groups()


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from .tokens import encode

    return encode(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def _mix(spark: SparkSession, d: str):
    from .mixing import CORPUS, Mix

    return Mix(table(spark, d, "documents", "doc_id", "text", "source", "lang", "scenario"), table(spark, d, "mix_targets"), marginals=(CORPUS, CORPUS))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).fill().where("not reached").select("source")


def p9_sample(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).sample()


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).report()


def p9_marginals(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).marginals()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from .language import wrong_labels

    return wrong_labels(table(spark, d, POOL, "seq", "text", "language"), "seq", "text", "language")


def p3_languages(spark: SparkSession, d: str) -> DataFrame:
    from .language import languages

    return languages(table(spark, d, POOL, "seq", "text", "language"), "seq", "text", "language")


def p3_segments(spark: SparkSession, d: str) -> DataFrame:
    from .language import segments

    return segments(table(spark, d, POOL, "seq", "text", "language"), "seq", "text", "language")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from .lookalike import lookalikes

    return lookalikes(table(spark, d, "eval", "wav", "gen_text", "asr_hypo"), "wav", "gen_text", "asr_hypo")


def p4_unified(spark: SparkSession, d: str) -> DataFrame:
    from .lookalike import unified

    return unified(table(spark, d, "eval", "wav", "gen_text", "asr_hypo"), "wav", "gen_text", "asr_hypo")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    """metric, dataset, day, value of the three score tables; version 1 similarities put on -1..1."""
    s = F.when(F.col("score_version") == 1, F.col("similarity") * 2 - 1).otherwise(F.col("similarity"))
    day = F.date_format("arrived_at", "yyyy-MM-dd")
    parts = [
        table(spark, d, "eval", "dataset", "arrived_at", "cer").select(F.lit("cer").alias("metric"), folded("dataset").alias("dataset"), day.alias("day"), F.col("cer").alias("value")),
        table(spark, d, "sim", "dataset", "arrived_at", "similarity", "score_version").select(F.lit("similarity").alias("metric"), folded("dataset").alias("dataset"), day.alias("day"), s.alias("value")),
        table(spark, d, "mos", "dataset", "arrived_at", "utmos").select(F.lit("utmos").alias("metric"), folded("dataset").alias("dataset"), day.alias("day"), F.col("utmos").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p5_daily(spark: SparkSession, d: str) -> DataFrame:
    from .quantiles import daily

    return daily(_scores(spark, d), "value", {"metric": F.col("metric"), "dataset": F.col("dataset")}, F.col("day"))


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    from .quantiles import percentiles

    return percentiles(p5_daily(spark, d), ["metric", "dataset"])


def p5_held(spark: SparkSession, d: str) -> DataFrame:
    """Every answer of p5_percentiles against the exact ranks of its value: held if the asked rank is within rank_error of them."""
    got = p5_percentiles(spark, d).withColumn("dataset", F.coalesce("dataset", F.lit("")))
    rows = _scores(spark, d).where("value is not null and not isnan(value)").select("metric", F.coalesce("dataset", F.lit("")).alias("dataset"), F.col("value").alias("v"))
    ranks = rows.join(got, ["metric", "dataset"]).groupBy("metric", "dataset", "q", "n", "rank_error").agg(F.count_if(F.col("v") < F.col("value")).alias("less"), F.count_if(F.col("v") <= F.col("value")).alias("upto"))
    ask = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n")))
    return ranks.select("metric", "dataset", "q", "n", ((ask >= F.col("less") + 1 - F.col("rank_error")) & (ask <= F.col("upto") + F.col("rank_error"))).alias("held"))


def _clips(spark: SparkSession, d: str) -> DataFrame:
    from .ranking import clip_scores

    return clip_scores(table(spark, d, "eval", "wav", "cer", "arrived_at"), table(spark, d, "sim", "cloned_audio", "similarity", "score_version", "arrived_at"), table(spark, d, "mos", "cloned_audio", "utmos", "arrived_at"))


def p1_ranking(spark: SparkSession, d: str) -> DataFrame:
    from .common import written
    from .ranking import rank_items

    return rank_items(written(_clips(spark, d)), "wav", {"cer": -1, "similarity": 1, "utmos": 1})


def p1_ranks(spark: SparkSession, d: str) -> DataFrame:
    from .common import written
    from .ranking import average_ranks

    return average_ranks(written(_clips(spark, d)), "wav", ["cer", "similarity", "utmos"])


def p1_loadings(spark: SparkSession, d: str) -> DataFrame:
    from .common import written
    from .ranking import loadings

    return loadings(written(_clips(spark, d)), "wav", {"cer": -1, "similarity": 1, "utmos": 1}).select("score", F.round("loading", 5).alias("loading"))


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    from .encoding import restored

    return restored(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_restored(spark, d).where("found").select("doc_id")


QUERIES = {f.__name__: f for f in (p1_ranking, p1_ranks, p1_loadings, p2_found, p2_shares, p2_lines, p3_found, p3_languages, p3_segments, p4_found, p4_unified, p5_percentiles, p5_daily, p5_held, p6_found, p6_report, p6_sample, p7_found, p7_groups, p8_ids, p9_found, p9_sample, p9_report, p9_marginals, p10_found, p10_restored)}
