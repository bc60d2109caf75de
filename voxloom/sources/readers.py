"""Readers of the corpus files (S1-S20): JSONL under three policies, sidecar trees, key-value maps, manifests, WAV headers, tar shards."""

from __future__ import annotations

import re
import struct
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

#: Folders that a tree scan leaves out, and the endings of metric sidecars. Fixed values of the layout.
PRUNED = ("logs", "__pycache__", "eval_sim_embedding_cache")
METRIC_ENDINGS = (".eval.json", ".sim.json", ".mos.json")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def jsonl(spark: SparkSession, path: str, schema: str | T.StructType, policy: str = "fail", missing_ok: bool = False) -> DataFrame:
    """JSON lines with a fixed schema. Blank lines don't count.

    policy: 'fail' raises on a malformed line as it is read, 'mark' keeps it with its text in _corrupt, 'skip' drops it. A missing file
    is an empty table if missing_ok.
    """
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], st)
    if policy == "mark":
        return spark.read.schema(T.StructType([*st.fields, T.StructField("_corrupt", T.StringType())])).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return spark.read.schema(st).option("mode", {"fail": "FAILFAST", "skip": "DROPMALFORMED"}[policy]).json(path)


def records(df: DataFrame, kind: str, column: str = "record_type") -> DataFrame:
    """The rows of one kind of a file that mixes header and body records."""
    return df.where(F.col(column) == kind).drop(column)


def tree(spark: SparkSession, root: str, glob: str, ending: str | None = None) -> DataFrame:
    """path, text of all files below a root that match, without pruned folders; one row per file."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("wholetext", True).text(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    for p in PRUNED:
        df = df.where(~F.col("path").contains(f"/{p}/"))
    return df.where(F.col("path").endswith(ending)) if ending else df


def sidecars(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of the clone sidecars text_*.json: wav (the path's stem), and the parsed record. A file that is no JSON object is an error row."""
    raw = tree(spark, root, "text_*.json")
    for e in METRIC_ENDINGS:
        raw = raw.where(~F.col("path").endswith(e))
    d = raw.withColumn("wav", F.regexp_replace("path", r"\.json$", ".wav")).withColumn("r", F.from_json("text", schema, {"mode": "PERMISSIVE"}))
    ok = F.try_parse_json("text").isNotNull() & F.trim("text").startswith("{")
    return d.where(ok).select("wav", "r.*"), d.where(~ok).select("wav", F.lit("no JSON object").alias("error"))


def metric_sidecars(spark: SparkSession, root: str, metric: str, schema: str) -> DataFrame:
    """Sidecars of one metric (eval, sim, mos); broken ones are left out."""
    raw = tree(spark, root, f"*.{metric}.json").where(F.try_parse_json("text").isNotNull())
    return raw.select(F.regexp_replace("path", rf"\.{metric}\.json$", ".wav").alias("wav"), F.from_json("text", schema).alias("r")).select("wav", "r.*")


def orphans(have: DataFrame, want: DataFrame, key: str = "wav") -> DataFrame:
    """Files without their counterpart."""
    return have.join(want, key, "left_anti")


def key_map(spark: SparkSession, path: str, policy: str = "strict") -> DataFrame:
    """key, value of lines of two fields. strict: a bad line or a repeated key raises; lenient: bad lines are left out, the last line of a key wins."""
    # lines in the order of files, blocks and places; partitions alone don't follow it, files are packed by size
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    raw = spark.read.text(path).select("value", at.alias("no")).where(F.trim("value") != "")
    d = raw.select("no", F.regexp_extract("value", r"^\s*(\S+)\s+(.*\S)\s*$", 1).alias("key"), F.regexp_extract("value", r"^\s*(\S+)\s+(.*\S)\s*$", 2).alias("v"))
    if policy == "lenient":
        return d.where(F.col("key") != "").groupBy("key").agg(F.max_by("v", "no").alias("value"))
    n = F.count("*").over(W.partitionBy("key"))
    fail = F.when(F.col("key") == "", F.raise_error(F.lit("a line without two fields"))).when(n > 1, F.raise_error(F.concat(F.lit("repeated key "), F.col("key"))))
    return d.withColumn("bad", fail.cast("boolean")).where(F.col("bad").isNull()).select("key", F.col("v").alias("value"))


def shard_list(spark: SparkSession, path: str, repeat: int = 1) -> DataFrame:
    """tar_path, label_path, num_items, num_seconds of a manifest of four fields a line; other lines raise. Rows come `repeat` times."""
    parts = F.split(F.trim("value"), r"\s+")
    d = spark.read.text(path).where(F.trim("value") != "").select(parts.alias("p"))
    d = d.where(F.when(F.size("p") != 4, F.raise_error(F.concat(F.lit("not four fields: "), F.array_join("p", " "))).cast("boolean")).otherwise(True))
    d = d.select(F.col("p")[0].alias("tar_path"), F.col("p")[1].alias("label_path"), F.col("p")[2].cast("bigint").alias("num_items"), F.col("p")[3].cast("double").alias("num_seconds"))
    return d.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(repeat)))).drop("_") if repeat > 1 else d


def dimension(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """TSV with a header; the last line of a key wins."""
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    d = spark.read.schema(schema).option("header", True).option("sep", "\t").csv(path).withColumn("_no", at)
    rest = [c for c in d.columns if c not in (key, "_no")]
    return d.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, "_no").alias(c) for c in rest])


def probe(value: str | Column, field: str, first: int = 2000) -> Column:
    """A text field of a JSON document, looked for in its first characters only."""
    c = F.col(value) if isinstance(value, str) else value
    return F.nullif(F.regexp_extract(F.substring(c, 1, first), rf'"{field}"\s*:\s*"([^"]*)"', 1), F.lit(""))


def speakers(paths: DataFrame, column: str, root: str) -> DataFrame:
    """dataset, speaker of every path below a root; none at all raises as the result is read."""
    rest = F.split(F.substring(F.col(column), len(root.rstrip("/")) + 2, 1 << 30), "/")
    found = paths.where(F.col(column).startswith(root.rstrip("/") + "/") & (F.size(rest) >= 3)).select(F.get(rest, 0).alias("dataset"), F.get(rest, 1).alias("speaker")).distinct()
    none = F.raise_error(F.lit(f"no speakers below {root}")).cast("string")
    return found.unionByName(found.agg(F.count("*").alias("n")).where("n = 0").select(none.alias("dataset"), F.lit("").alias("speaker")))


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Paths of the files below a root: a listing only, no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path")


def _opened(path: str):
    """A file of any file system that Arrow knows, to be read where one likes."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "file:///", path))
    return system.open_input_file(name)


def wav_header(f) -> tuple[int, int]:
    """(frames, sample rate) of an open RIFF file: its chunks are skipped through, samples aren't read."""
    size = f.size()
    head = f.read(12)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:] != b"WAVE":
        raise ValueError("no WAV file")
    rate, frame = 0, 0
    while f.tell() + 8 <= size:
        name, length = struct.unpack("<4sI", f.read(8))
        if name == b"fmt ":
            _, channels, rate, _, _, bits = struct.unpack("<HHIIHH", f.read(16))
            frame = channels * ((bits + 7) // 8)
            f.seek(f.tell() + length - 16 + length % 2)
        elif name == b"data":
            if not frame:
                raise ValueError("samples before their format")
            return min(length, size - f.tell()) // frame, rate
        else:
            f.seek(f.tell() + length + length % 2)
    raise ValueError("no samples")


def wav_headers(spark: SparkSession, root: str, glob: str = "*.wav") -> DataFrame:
    """path, frames, sample_rate, error of WAV files; only headers are read, a broken or empty file has an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                try:
                    with _opened(path) as f:
                        n, r = wav_header(f)
                    out.append((path, n, r, None if n > 0 and r > 0 else "no frames"))
                except (ValueError, OSError, struct.error) as e:
                    out.append((path, None, None, str(e) or "broken"))
            yield pd.DataFrame(out, columns=["path", "frames", "sample_rate", "error"]).astype({"frames": "Int64", "sample_rate": "Int64"})

    return _files(spark, root, glob).mapInPandas(run, "path string, frames bigint, sample_rate bigint, error string")


def tar_members(spark: SparkSession, root: str, glob: str = "*.tar", held: int = 64 << 20) -> DataFrame:
    """shard, key, ext, data of the members of tar shards, one task per shard; members come in the shard's order. A shard is streamed: at most `held` bytes of members are in memory at a time (or one member)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                rows, size = [], 0
                with _opened(path) as f, tarfile.open(fileobj=f, mode="r|") as tar:
                    for m in tar:
                        if m.isfile():
                            rows.append((path, *m.name.rpartition(".")[::2], tar.extractfile(m).read()))
                            size += m.size
                        if size >= held:
                            yield pd.DataFrame(rows, columns=["shard", "key", "ext", "data"])
                            rows, size = [], 0
                yield pd.DataFrame(rows, columns=["shard", "key", "ext", "data"])

    return _files(spark, root, glob).mapInPandas(run, "shard string, key string, ext string, data binary")


def present(rows: DataFrame, column: str, spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Rows whose file is there: a join with a listing of the root, so that no row opens a file."""
    listed = _files(spark, root, glob).select(F.regexp_replace("path", "^file:/*", "/").alias(column))
    return rows.join(listed, column, "left_semi")


def shuffled_shards(shards: DataFrame, url: str, epoch: int, rank: int = 0, ranks: int = 1) -> DataFrame:
    """Shards of one rank in the order of an epoch, by hash of address and epoch."""
    h = F.xxhash64(F.col(url), F.lit(epoch))
    return shards.withColumn("_h", h).where(F.pmod(F.xxhash64(F.col(url)), F.lit(ranks)) == rank).orderBy("_h").drop("_h")


def labelled(samples: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """samples with their labels; a sample without one raises as it is read."""
    d = samples.join(labels.withColumn("_has", F.lit(True)), key, "left")
    return d.where(F.when(F.col("_has").isNull(), F.raise_error(F.concat(F.lit("no label for "), F.col(key))).cast("boolean")).otherwise(True)).drop("_has")
