"""Queries over generation tasks and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import tasks as tk
from ..session import spread, table
from .registry import query

# Shares of the default task list.
LENGTHS = {"ultra_short": 0.20, "short": 0.30, "medium": 0.25, "long": 0.18, "very_long": 0.07}
MIXES = {"pure_cn": 0.28, "pure_en": 0.18, "cn_mostly": 0.24, "en_mostly": 0.10, "frequent_mix": 0.20}


@query()
def task_list(spark: SparkSession, d: str) -> DataFrame:
    """Weighted tasks with rotating subscenes, one per ten rows of the pool."""
    n = table(spark, d, "llm_children_100k_asr_complete", "seq").count() // 10
    t = tk.task_list(spark, n, {"scenario": {"school": 1.0, "play": 0.6, "learning": 1.3}, "length_type": LENGTHS, "lang_type": MIXES}, {"stress_numbers": 1.0})
    return tk.rotated(t, "scenario", {"school": ["morning", "lunch", "home"], "play": ["yard", "room"], "learning": ["words", "sums"]})


@query("SELECT (SELECT count(*) // 10 FROM llm_children_100k_asr_complete) AS tasks, floor((SELECT count(*) // 10 FROM llm_children_100k_asr_complete) * 0.15)::BIGINT AS stress, 0::BIGINT AS repeated")
def task_quota(spark: SparkSession, d: str) -> DataFrame:
    """Tasks, those of the stress scenarios (their quota is allotted first), and tasks whose emotion one of the two before has."""
    n = table(spark, d, "llm_children_100k_asr_complete", "seq").count() // 10
    t = tk.avoiding(tk.task_list(spark, n, {"scenario": {"school": 1.0, "play": 0.6}}, {"stress_numbers": 1.0, "stress_whisper_shout": 1.0}), "emotion", ["calm", "excited", "happy", "sad", "shy"], 2)
    w = W.partitionBy(F.floor(F.col("task_id") / 100_000)).orderBy("task_id")
    again = F.coalesce((F.col("emotion") == F.lag("emotion", 1).over(w)) | (F.col("emotion") == F.lag("emotion", 2).over(w)), F.lit(False))
    return t.select("scenario", again.alias("again")).agg(F.count("*").alias("tasks"), F.count_if(F.col("scenario").startswith("stress")).alias("stress"), F.count_if("again").alias("repeated"))


@query()
def normalization_audit(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the safe normal form over all documents."""
    return tk.audit(spread(table(spark, d, "documents", "doc_id", "text").where("text is not null")), "doc_id", "text")[0]


@query()
def normalization_examples(spark: SparkSession, d: str) -> DataFrame:
    """Documents per kind of token, three at most."""
    return tk.audit(spread(table(spark, d, "documents", "doc_id", "text").where("text is not null")), "doc_id", "text")[1].withColumn("key", F.col("key").cast("bigint"))
