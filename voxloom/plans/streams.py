"""Queries that run as streams to completion and must equal their batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming import streams as st
from .registry import query


def _folder(spark: SparkSession) -> str:
    return shared_folder(spark, "stream")


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    return st.source(spark, d, name, spark.read.parquet(f"{d}/{name}.parquet").schema)


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts of the event stream; complete mode, so that open windows come too."""
    ev = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = st.drained(st.event_windows(ev), _folder(spark), "complete")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("""WITH e AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS start FROM events), m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS upto FROM events)
SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e, m WHERE start + INTERVAL 1 HOUR <= date_trunc('millisecond', upto) GROUP BY ALL""")
def stream_closed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts in append mode: a window comes once the watermark has passed it, and its state is dropped then."""
    ev = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = st.drained(st.event_windows(ev), _folder(spark))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("SELECT replace(lower(trim(dataset)), '-', '_') AS dataset, sum(substitutions + insertions + deletions)::BIGINT AS operations, sum(reference_chars)::BIGINT AS characters FROM eval WHERE cer IS NOT NULL AND reference_chars > 0 GROUP BY 1")
def stream_error_rate(spark: SparkSession, d: str) -> DataFrame:
    """Running sums of the evaluation stream."""
    return st.drained(st.running_error_rate(_stream(spark, d, "eval")), _folder(spark), "complete")


@query()
def stream_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Incremental near-duplicate filter with state per context (D3); a form that was dropped as near isn't tried again in another context, which only the batch form does."""
    return st.drained(st.near_duplicates(_stream(spark, d, "llm_children_100k_asr_complete"), "id", "text", "seq"), _folder(spark))


@query("WITH s AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS end, count(*) AS n FROM g GROUP BY user_id, k")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users with a gap of half an hour."""
    ev = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = st.drained(st.sessions(ev), _folder(spark), "complete")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")
