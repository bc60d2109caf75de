"""Sinks (K1-K13): committed writes, error side outputs, shards, promotion by commit rows."""

from __future__ import annotations

import io
import json
import os
import tarfile
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import chunked


def write_report(record: dict, path: str) -> None:
    """A report of one record as a local JSON file: written beside, synced, renamed."""
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(record, f, ensure_ascii=False, sort_keys=True, indent=2)
        f.flush()
        os.fsync(f.fileno())
    os.replace(tmp, path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with keys in sorted order; the job's commit makes them visible at once. mode 'append' adds to what is there."""
    df.select(*sorted(df.columns)).write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_details(df: DataFrame, footer: DataFrame, path: str) -> None:
    """TSV details with a footer of its own beside them."""
    df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{path}/details")
    footer.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{path}/summary")


def public(df: DataFrame) -> DataFrame:
    """Columns that don't start with an underscore."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, key rows with one)."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def write_shards(df: DataFrame, key: str, order: str, data: str, ext: str, seconds: str, size: int, root: str) -> DataFrame:
    """Packs rows into tar files of `size` rows with a label file each, in order, and returns the manifest shard, tar_path, label_path, items, seconds.

    Shards are written by executors under temporary names beside their place and moved there, so a repeated task leaves one file; root is a
    folder that all executors share, of any file system that Arrow knows (a path or an address). Rows without data are errors of the
    manifest's caller and are left out before numbering.
    """
    rows = chunked(df.where(F.col(data).isNotNull()), order, size, "shard").select("shard", F.col(order).alias("o"), F.col(key).cast("string").alias("k"), F.col(data).alias("d"), F.col(seconds).cast("double").alias("s"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(root)
        pdf = pdf.sort_values("o")
        shard = int(pdf["shard"].iloc[0])
        name, temporary = f"{folder.rstrip('/')}/shard-{shard:06d}", f"{folder.rstrip('/')}/_{uuid.uuid4().hex}"
        with system.open_output_stream(f"{temporary}.tar") as f, tarfile.open(fileobj=f, mode="w|") as tar:
            for k, d in zip(pdf["k"], pdf["d"]):
                info = tarfile.TarInfo(f"{k}.{ext}")
                info.size = len(d)
                tar.addfile(info, io.BytesIO(d))
        with system.open_output_stream(f"{temporary}.jsonl") as f:
            f.write("".join(json.dumps({"id": k, "duration": s}) + "\n" for k, s in zip(pdf["k"], pdf["s"])).encode())
        for kind in ("tar", "jsonl"):
            system.move(f"{temporary}.{kind}", f"{name}.{kind}")
        shown = f"{root.rstrip('/')}/shard-{shard:06d}"
        return pd.DataFrame([(shard, f"{shown}.tar", f"{shown}.jsonl", len(pdf), round(float(pdf["s"].sum()), 3))], columns=["shard", "tar_path", "label_path", "items", "seconds"])

    return rows.groupBy("shard").applyInPandas(run, "shard bigint, tar_path string, label_path string, items bigint, seconds double")


class Commits:
    """Promotion in two steps: rows of a round are appended, a commit row makes them visible; rows of uncommitted rounds are never read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def promote(self, rows: DataFrame, round_id: str, fingerprint: str) -> bool:
        """Appends a round and commits it. A committed round with the same fingerprint is left as it is (False), with another one it is an error."""
        done = [r[0] for r in self._commits().where(F.col("round_id") == round_id).select("fingerprint").collect()]
        if done:
            if done != [fingerprint]:
                raise ValueError(f"{round_id} is committed with other content")
            return False
        rows.withColumn("round_id", F.lit(round_id)).write.mode("overwrite").parquet(f"{self.root}/rows/{round_id}")
        self.spark.createDataFrame([(round_id, fingerprint)], "round_id string, fingerprint string").coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return True

    def _commits(self) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], "round_id string, fingerprint string")
        return self.spark.read.schema("round_id string, fingerprint string").parquet(f"{self.root}/commits")

    def rows(self, schema: str) -> DataFrame:
        """Rows of the committed rounds."""
        return self.spark.read.schema(schema + ", round_id string").parquet(f"{self.root}/rows/*").join(F.broadcast(self._commits().select("round_id")), "round_id", "left_semi")


def tombstoned(rows: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """rows with status 'rejected' and a reason where rejected (key, reason) names them; nothing is deleted."""
    r = rejected.select(key, F.col("reason").alias("_reason"))
    return rows.join(r, key, "left").withColumn("status", F.when(F.col("_reason").isNotNull(), "rejected").otherwise(F.col("status"))).withColumnRenamed("_reason", "reject_reason")
