"""Global row numbers without one global window, and what builds on them: batches, shards, round robin."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T


PER_RANGE = 200_000  # rows that one range is meant to hold
RANGES = (16, 4096)
SLICES = 64  # of a value that most rows share


def _cuts(df: DataFrame, by: str, buckets: int | None) -> tuple[list[float], set[float]]:
    """Approximate quantiles of a column and the values that fill more than one range."""
    n = buckets or max(RANGES[0], min(RANGES[1], df.count() // PER_RANGE))
    q = [x + 0.0 for x in df.approxQuantile(by, [k / n for k in range(1, n)], 0.25 / n)]
    return sorted(set(q)), {x for x in q if q.count(x) > 1}


def numbered(df: DataFrame, by: str, name: str = "rn", buckets: int | None = None, descending: bool = False, tie: str | list[str] | None = None) -> DataFrame:
    """Row numbers from 1 in the order of column `by` (numeric), ties by the columns `tie`. Nulls come last.

    Rows are cut into ranges at approximate quantiles (as many as the rows need, PER_RANGE each); each range is numbered by itself and
    offset by the sizes of the ranges before. A value that fills more than a range (and the nulls) is cut further, by its ties: at
    SLICES quantiles of a sample of their order, so that no task sorts all rows of a tie. What reaches the driver are cuts and counts.
    """
    ties = [tie] if isinstance(tie, str) else list(tie or [])
    cuts, heavy = _cuts(df, by, buckets)
    x = F.col(by).cast("double") + F.lit(0.0)
    edges = [float("-inf"), *(cuts or [0.0]), float("inf")]
    rows = Bucketizer(splits=edges, inputCol="_x", outputCol="_q", handleInvalid="keep").transform(df.withColumn("_x", x))
    bucket = F.least(F.col("_q").cast("int"), F.lit(len(edges) - 2))
    # even numbers: ranges, odd ones: a heavy value, which is the least of its range
    at = F.when(F.col("_x").isin(*heavy), bucket * 2 - 1).otherwise(bucket * 2) if heavy else bucket * 2
    last = 2 * len(edges)
    rows = rows.withColumn("_b", F.when(F.col("_x").isNull() | F.isnan("_x"), last).otherwise(last - 1 - at if descending else at))
    order: list[Column] = [F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()] + [F.col(t) for t in ties]
    hot = [*sorted({last} | {(last - 1 - k if descending else k) for k in range(1, last, 2)})] if ties else []
    rows = rows.withColumn("_s", F.lit(0))
    if hot:
        sample = rows.where(F.col("_b").isin(*hot)).select("_b", F.struct(*ties).alias("_t"))
        few = sample.groupBy("_b").agg(F.count("*").alias("n")).collect()  # at most as many as there are ranges
        big = {r["_b"]: r["n"] for r in few if r["n"] > PER_RANGE}
        if big:
            marks = []
            for b, n in big.items():
                some = sample.where(F.col("_b") == b).select("_t").orderBy(F.xxhash64("_t")).limit(SLICES * 64).select("_t").collect()  # a bounded sample: only where to cut
                got = sorted(tuple(r["_t"]) for r in some)
                marks += [(b, *got[k * len(got) // SLICES]) for k in range(1, SLICES)]
            kinds = df.select(*ties).schema
            table = df.sparkSession.createDataFrame(marks, T.StructType([T.StructField("_b", T.IntegerType()), *[T.StructField(f"_t{k}", f.dataType) for k, f in enumerate(kinds)]]))
            table = table.groupBy("_b").agg(F.array_sort(F.collect_list(F.struct(*[f"_t{k}" for k in range(len(ties))]))).alias("_cuts"))
            below = lambda c: F.struct(*[F.col(t).alias(f"_t{k}") for k, t in enumerate(ties)]) >= c
            rows = rows.drop("_s").join(F.broadcast(table), "_b", "left").withColumn("_s", F.coalesce(F.size(F.filter("_cuts", below)), F.lit(0))).withColumn("_s", F.greatest("_s", F.lit(0))).drop("_cuts")
    sizes = rows.groupBy("_b", "_s").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_b", "_s", F.coalesce(F.sum("_n").over(W.orderBy("_b", "_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    placed = rows.withColumn("_r", F.row_number().over(W.partitionBy("_b", "_s").orderBy(*order))).join(F.broadcast(offsets), ["_b", "_s"])
    return placed.withColumn(name, (F.col("_r") + F.col("_o")).cast("bigint")).drop("_b", "_s", "_r", "_o", "_x", "_q")


def chunked(df: DataFrame, by: str, size: int, name: str = "chunk", **kw) -> DataFrame:
    """Consecutive chunks of `size` rows."""
    return numbered(df, by, "_rn", **kw).withColumn(name, F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn")


def round_robin(df: DataFrame, by: str, n: int, name: str = "worker", **kw) -> DataFrame:
    return numbered(df, by, "_rn", **kw).withColumn(name, F.pmod(F.col("_rn") - 1, F.lit(n)).cast("int")).drop("_rn")


def contiguous(df: DataFrame, by: str, n: int, name: str = "slice", **kw) -> DataFrame:
    """n consecutive slices of ceil(rows / n) rows (the last ones may be short or missing)."""
    rows = numbered(df, by, "_rn", **kw)
    each = df.agg(F.ceil(F.count("*") / n).alias("_each"))
    return rows.crossJoin(F.broadcast(each)).withColumn(name, F.floor((F.col("_rn") - 1) / F.col("_each")).cast("int")).drop("_rn", "_each")


def shard_manifest(df: DataFrame, by: str, seconds: str, size: int, ok: Column | None = None) -> DataFrame:
    """shard, items, seconds of shards of `size` rows in order. With ok only rows that meet it fill shards (K9)."""
    return chunked(df if ok is None else df.where(F.coalesce(ok, F.lit(False))), by, size, "shard").groupBy("shard").agg(F.count("*").alias("items"), F.round(F.sum(seconds), 3).alias("seconds"))


def hash_worker(key: str | Column, n: int) -> Column:
    """Worker of a key: the first eight bytes of its SHA-256, big endian, modulo n."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.sha2(k, 256), 1, 16), 16, 10).cast("decimal(20,0)") % n).cast("int")


def stable_hash(*parts: str | Column, length: int = 64) -> Column:
    """Prefix of the SHA-256 of NUL-joined parts."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.substring(F.sha2(F.concat_ws("\0", *cols), 256), 1, length)


def largest_remainder(weights: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """key, target: floors of the exact shares, one more for the largest fractions; ties by key, descending. weights has a row per category."""
    exact = weights.crossJoin(F.broadcast(weights.agg(F.sum(weight).alias("_w")))).withColumn("_x", F.col(weight) * total / F.col("_w")).withColumn("_f", F.floor("_x"))
    rest = exact.agg((F.lit(total) - F.sum("_f")).alias("_rest"))
    placed = exact.crossJoin(F.broadcast(rest)).withColumn("_r", F.row_number().over(W.orderBy(F.desc(F.round(F.col("_x") - F.col("_f"), 9)), F.desc(key))))
    return placed.select(key, (F.col("_f") + (F.col("_r") <= F.col("_rest")).cast("int")).cast("bigint").alias("target"))
