"""Batches for training and nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import vectors as v
from .ordering import numbered


PER_STREAM = 1_000_000  # rows that one stream of batches is meant to hold


def _streams(df: DataFrame, parts: int | None) -> int:
    """Number of streams: one per PER_STREAM rows, as a loader has workers; one for a table of fewer rows."""
    return parts or -(-df.count() // PER_STREAM) or 1


def _in_turn(rows: DataFrame, keep: list[str], kind: str, step: Callable[[], Callable[[Any, float], int]], group: list[str], order: list[str], length: str, out: str) -> DataFrame:
    """Numbers the rows of each group in order: step() gives a fresh function(key, length) -> number, in constant memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, number = None, step()
        for pdf in batches:
            got = []
            for *g, k, x in pdf[[*group, keep[0], length]].itertuples(index=False):
                if g != now:
                    now, number = g, step()
                got.append(number(k, x))
            yield pdf[keep].assign(**{out: got})

    return rows.repartition(*group).sortWithinPartitions(*group, *order).select(*dict.fromkeys([*keep, *group, length, *order])).mapInPandas(run, kind)


def bucketed(df: DataFrame, key: str, length: str, order: str, low: float, high: float, buckets: int, budget: float, most: int, drop_last: bool = False, parts: int | None = None) -> DataFrame:
    """key, bucket, part, batch: in order, a bucket's open batch is emitted as soon as its longest row times one more row reaches the budget, or it has `most` rows. Rows outside [low, high] are dropped; with drop_last also the batch that is open at the end.

    Batches are formed in `parts` streams of every bucket, as the workers of a loader form them (by default one per PER_STREAM rows), so a
    bucket with most rows isn't one task.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.withColumn("bucket", v.bucket(F.col(length), low, high, buckets)).where("bucket is not null").withColumn("part", F.pmod(F.xxhash64(key), F.lit(_streams(df, parts))).cast("int"))

    def step() -> Callable[[Any, float], int]:
        longest, n, batch = 0.0, 0, 0

        def number(_: Any, x: float) -> int:
            nonlocal longest, n, batch
            longest, n, mine = max(longest, x), n + 1, batch
            if longest * (n + 1) >= budget or n >= most:
                longest, n, batch = 0.0, 0, batch + 1
            return mine

        return number

    got = _in_turn(rows, [key, "bucket", "part"], f"`{key}` {kind}, bucket int, part int, batch int", step, ["bucket", "part"], [order, key], length, "batch")
    if not drop_last:
        return got
    sizes = got.join(df.select(key, length), key).groupBy("bucket", "part", "batch").agg(F.count("*").alias("_n"), F.max(length).alias("_x"))
    return got.join(sizes.where((F.col("_x") * (F.col("_n") + 1) >= budget) | (F.col("_n") >= most)).select("bucket", "part", "batch"), ["bucket", "part", "batch"], "left_semi").select(key, "bucket", "part", "batch")


def _next_fit(budget: float, alone: bool) -> Callable[[], Callable[[Any, float], int]]:
    def step() -> Callable[[Any, float], int]:
        used, n = 0.0, 0

        def number(_: Any, x: float) -> int:
            nonlocal used, n
            if used + x > budget and (used or not alone):
                used, n = 0.0, n + 1
            used += x
            return n

        return number

    return step


def packed(df: DataFrame, key: str, length: str, order: str, budget: float, parts: int | None = None) -> DataFrame:
    """key, part, pack: next-fit packing in order; rows above the budget are dropped. The rows are cut into `parts` streams first (by default one per PER_STREAM rows)."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.where(F.col(length) <= budget).withColumn("part", F.pmod(F.xxhash64(key), F.lit(_streams(df, parts))).cast("int"))
    return _in_turn(rows, [key, "part"], f"`{key}` {kind}, part int, pack int", _next_fit(budget, False), ["part"], [order, key], length, "pack")


def positions(packs: DataFrame, key: str, length: str, pack: list[str], order: str) -> DataFrame:
    """Rows of packs with document (its number in the pack, from 0) and start (where its tokens begin in the pack)."""
    w = W.partitionBy(*pack).orderBy(order, key)
    return packs.withColumn("document", F.row_number().over(w) - 1).withColumn("start", F.coalesce(F.sum(length).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def clustered(df: DataFrame, key: str, length: str, budget: float, ranges: int | None = None) -> DataFrame:
    """key, range, cluster: by descending length, next fit under the budget; a row above it stands alone. Ranges of length (by default one per PER_STREAM rows) are packed side by side."""
    kind = df.schema[key].dataType.simpleString()
    n = numbered(df.where(F.col(length).isNotNull()), length, "rn", descending=True, tie=key)
    whole = df.agg(F.greatest(F.lit(1), F.ceil(F.count(length) / _streams(df, ranges))).alias("each"))
    rows = n.crossJoin(F.broadcast(whole)).withColumn("range", F.floor((F.col("rn") - 1) / F.col("each")).cast("int"))
    return _in_turn(rows, [key, "range"], f"`{key}` {kind}, range int, cluster int", _next_fit(budget, True), ["range"], ["rn"], length, "cluster")


def padded(df: DataFrame, batch: str, ids: str, pad: int, ignore: int) -> DataFrame:
    """df with ids padded to the longest of the batch, labels and mask."""
    n = F.max(F.size(ids)).over(W.partitionBy(batch))
    d = df.withColumn("_m", n - F.size(ids))
    fill = lambda x: F.concat(F.col(ids), F.array_repeat(F.lit(x), F.col("_m")))
    return d.withColumn("labels", fill(ignore)).withColumn("mask", F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.col("_m")))).withColumn("ids", fill(pad)).drop("_m")


BLOCK = 20_000  # rows, and queries, of a block of the product


def nearest(df: DataFrame, key: str, vec: str, group: str, k: int, every: int = 20) -> DataFrame:
    """query_id, vec_id, cosine: the k nearest of the group of every row whose key is divisible by `every`, against all rows.

    Blocks of rows meet blocks of queries of their group (BLOCK of either at most, on average); each pair of blocks is one matrix product
    in one task, which hands on k rows a query. So no pair but the k best of a block is ever shuffled.
    """
    ids = df.schema[key].dataType.simpleString()
    d = df.select(F.col(key).alias("vec_id"), F.col(group).alias("g"), F.transform(vec, lambda x: x.cast("double")).alias("v"))
    size = d.where("g is not null").groupBy(F.col("g").alias("_g")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rows"), F.greatest(F.lit(1), F.ceil(F.count_if(F.col("vec_id") % every == 0) / BLOCK)).cast("int").alias("queries"))
    d = d.join(size, F.col("g") == F.col("_g")).drop("_g")
    of = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    rows = d.select("g", "vec_id", "v", of("rows").alias("r"), F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("q"))
    asks = d.where(F.col("vec_id") % every == 0).select(F.col("g").alias("ag"), F.col("vec_id").alias("query_id"), F.col("v").alias("w"), of("queries").alias("aq"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("ar"))

    def best(asked: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(asked) and len(have):
            a, b = np.array(asked["w"].tolist()), np.array(have["v"].tolist())
            na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
            keys = have["vec_id"].to_numpy()
            for at in range(0, len(a), 256):
                scale = na[at : at + 256, None] * nb[None, :]
                cos = np.divide(a[at : at + 256] @ b.T, scale, out=np.full(scale.shape, np.nan), where=scale > 0).round(6)
                for i, q in enumerate(asked["query_id"].to_numpy()[at : at + 256]):
                    order = np.lexsort((keys, -cos[i]))
                    for j in order[: k + 1]:
                        if keys[j] != q:
                            out.append((q, keys[j], None if np.isnan(cos[i, j]) else float(cos[i, j])))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "cosine"])

    met = asks.groupBy("ag", "aq", "ar").cogroup(rows.groupBy("g", "q", "r")).applyInPandas(best, f"query_id {ids}, vec_id {ids}, cosine double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return met.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")
