"""Structured Streaming: running error rates, windowed counts, near-duplicate filtering with state (A7, D3, watermarks)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as t
from ..operators.dedup import CONTEXT, context_key, near, shingle_set


def source(spark: SparkSession, sf_dir: str, name: str, schema) -> DataFrame:
    """A table's Parquet files as a stream; one file or a folder of part files."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(p).isDirectory():
        return reader.parquet(f"{sf_dir}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums per window and type under a watermark."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    agg = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return agg.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user, closed by a gap."""
    agg = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return agg.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def running_error_rate(evals: DataFrame) -> DataFrame:
    """Mergeable sums of operations and characters per dataset (update or complete mode)."""
    ok = evals.where("cer is not null and reference_chars > 0")
    return ok.groupBy(F.regexp_replace(F.lower(F.trim("dataset")), "-", "_").alias("dataset")).agg(F.sum(F.col("substitutions") + F.col("insertions") + F.col("deletions")).alias("operations"), F.sum("reference_chars").alias("characters"))


def first_forms(rows: DataFrame) -> DataFrame:
    """Rows (k, q, c, f) whose form f no row before them had, in any context; of those that come together the one of least q. State: the forms."""

    def least(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple] = {}
        for pdf in frames:
            for k, q, c, f in pdf[["k", "q", "c", "f"]].itertuples(index=False):
                if f not in best or q < best[f][1]:
                    best[f] = (k, q, c, f)
        yield pd.DataFrame(list(best.values()), columns=["k", "q", "c", "f"])

    # dropDuplicates keeps any row of those that come together, so only one of each form may reach it
    return rows.repartition("f").mapInPandas(least, rows.schema).dropDuplicates(["f"])


def near_duplicates(texts: DataFrame, key: str, text: str, seq: str, most_kept: int | None = None) -> DataFrame:
    """Rows that pass the incremental near-duplicate filter: the first of each form over all contexts, then, inside a context, those near none that was kept (its kept forms are the state). Rows of empty form all pass.

    Rows that come together are decided in order of seq, so a run over all rows at once gives what dedup.incremental gives; later rows are decided after all that came
    before. most_kept bounds the state to the last kept forms of a context; None keeps all.
    """
    rows = texts.select(F.col(key).cast("string").alias("k"), F.col(seq).cast("bigint").alias("q"), context_key(*CONTEXT).alias("c"), F.coalesce(t.dedup_form(text), F.lit("")).alias("f"))

    def step(_: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = [(f, shingle_set(f)) for f in (state.get[0] if state.exists else [])]
        out = []
        for k, q, f in pd.concat(list(frames)).sort_values("q")[["k", "q", "f"]].itertuples(index=False):  # a context comes in many frames, in no order
            s = shingle_set(f)
            if any(near(f, g, s, u) for g, u in kept):
                continue
            kept.append((f, s))
            out.append((k, q))
        forms = [f for f, _ in kept]
        state.update((forms[-most_kept:] if most_kept else forms,))
        yield pd.DataFrame(out, columns=["k", "q"])

    passed = first_forms(rows.where("f <> ''")).groupBy("c").applyInPandasWithState(step, "k string, q bigint", "forms array<string>", "append", GroupStateTimeout.NoTimeout)
    return passed.unionByName(rows.where("f = ''").select("k", "q"))


def drained(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now and gives its result. State and output lie in folder, which executors share, so the run survives lost executors and can be resumed."""
    spark = stream.sparkSession
    out, last = f"{folder}/out", {}
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def keep(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{epoch}")
        last["epoch"] = epoch

    q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/{last['epoch']}") if last else spark.createDataFrame([], stream.schema)
