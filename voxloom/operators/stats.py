"""Distributions, error-rate summaries and grouped statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import written

LEVELS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def finite(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


MAP_BYTES = 8 << 30  # of input, up to which one map of counted values a group is made
CUTS = 200


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables that a plan reads, by the planner's own figures; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def percentiles_by_ranges(df: DataFrame, value: str, by: list[str], levels: tuple[float, ...]) -> DataFrame:
    """by, _p: exact interpolated percentiles of each group (nulls left out), in two passes without a map of all values.

    Approximate quantiles cut each group into CUTS ranges, whose counts tell which of them hold the ranks that are asked for; only the rows
    of those are counted by value and summed up, range by range. So a task holds the distinct values of one range, whatever the size
    of a group and however many rows share a value.
    """
    keys = [f"_g{k}" for k in range(len(by))] or ["_g"]
    rows = df.where(F.col(value).isNotNull()).select(*([F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("_g")]), F.col(value).cast("double").alias("_v"))
    cuts = rows.groupBy(*keys).agg(F.approx_percentile("_v", [k / CUTS for k in range(1, CUTS)], 10_000).alias("_c"), F.count("*").alias("_n"))
    r, c = rows.alias("r"), cuts.alias("c")
    placed = r.join(c, reduce(lambda x, y: x & y, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])).select(*[F.col(f"r.{k}").alias(k) for k in keys], "_v", "_n", F.size(F.filter("_c", lambda x: x < F.col("_v"))).alias("_b"))
    counted = placed.groupBy(*keys, "_b").agg(F.count("*").alias("_m"), F.first("_n").alias("_n"))
    before = F.coalesce(F.sum("_m").over(W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # CUTS rows a group
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(F.lit(p) * (F.col("_n") - 1)), F.ceil(F.lit(p) * (F.col("_n") - 1))) for p in levels])))
    asked = counted.withColumn("_o", before).withColumn("_r", F.filter(ranks, lambda x: (x >= F.col("_o")) & (x < F.col("_o") + F.col("_m")))).where(F.size("_r") > 0)
    a, p = asked.alias("a"), placed.alias("p")
    on = reduce(lambda x, y: x & y, [F.col(f"p.{k}").eqNullSafe(F.col(f"a.{k}")) for k in (*keys, "_b")])
    kept = p.join(a, on).select(*[F.col(f"p.{k}").alias(k) for k in (*keys, "_b")], "_v", F.col("a._o").alias("_o"), F.col("a._r").alias("_r"), F.col("a._n").alias("_n"))
    values = kept.groupBy(*keys, "_b", "_v").agg(F.count("*").alias("_m"), F.first("_o").alias("_o"), F.first("_r").alias("_r"), F.first("_n").alias("_n"))
    at = F.col("_o") + F.coalesce(F.sum("_m").over(W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hits = values.withColumn("_at", at).select(*keys, "_v", "_n", F.explode(F.filter("_r", lambda x: (x >= F.col("_at")) & (x < F.col("_at") + F.col("_m")))).alias("_k"))
    found = hits.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_f"), F.first("_n").alias("_n"))

    def level(p: float) -> Column:
        x = F.lit(p) * (F.col("_n") - 1)
        low, high = F.element_at("_f", F.floor(x)), F.element_at("_f", F.ceil(x))
        return F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return found.select(*keys, F.array(*map(level, levels)).alias("_p"))


def distribution(df: DataFrame, value: str, by: list[str] | None = None, levels: tuple[float, ...] = LEVELS, digits: int = 6, map_bytes: int = MAP_BYTES) -> DataFrame:
    """count, failed (null or not finite), mean, population deviation, min, max and interpolated percentiles, all exact.

    Up to map_bytes of input the percentiles come from one map of counted values a group, in the same aggregation; beyond, where such a map
    could outgrow a task, from percentiles_by_ranges. Both give the same values.
    """
    by = by or []
    x = finite(value)
    r = lambda c, name: F.round(c, digits).alias(name)
    aggs = [F.count(x).alias("n"), F.count_if(x.isNull()).alias("failed"), r(F.avg(x), "mean"), r(F.stddev_pop(x), "std"), F.min(x).alias("min"), F.max(x).alias("max")]
    out = [*by, "n", "failed", "mean", "std", "min", "max", *[r(F.col("_p")[k], f"p{round(p * 100)}") for k, p in enumerate(levels)]]
    if input_bytes(df) <= map_bytes:
        return df.groupBy(*by).agg(*aggs, F.percentile(x, F.array(*map(F.lit, levels))).alias("_p")).select(*out)
    df = written(df.select(*by, x.alias("_x"))).withColumnRenamed("_x", value)
    got = percentiles_by_ranges(df, value, by, levels)
    whole = df.groupBy(*by).agg(*aggs)
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{k}")) for k, c in enumerate(by)]) if by else F.lit(True)
    return whole.join(got, on, "left").select(*out)


def median(df: DataFrame, value: str, map_bytes: int = MAP_BYTES) -> DataFrame:
    """One row, _median: the exact median of the values that aren't null; null without any."""
    if input_bytes(df) <= map_bytes:
        return df.agg(F.percentile(value, 0.5).alias("_median"))
    return percentiles_by_ranges(df, value, [], (0.5,)).agg(F.max(F.col("_p")[0]).alias("_median"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over the range, the last one closed; a single value is widened by half on each side. bin, low, high, center, n, empty bins too."""
    x = df.select(finite(value).alias("x")).where("x is not null")
    lim = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lim = lim.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")).where("lo is not null")
    width = (F.col("hi") - F.col("lo")) / bins
    hit = x.crossJoin(F.broadcast(lim)).select(F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    all_bins = lim.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    low = F.col("lo") + F.col("bin") * width
    return all_bins.join(F.broadcast(hit), "bin", "left").select("bin", F.round(low, 6).alias("low"), F.round(low + width, 6).alias("high"), F.round(low + width / 2, 6).alias("center"), F.coalesce("n", F.lit(0)).alias("n"))


def correlation(df: DataFrame, pairs: list[tuple[str, str]], least: int = 3) -> DataFrame:
    """Pearson correlation of each pair over the rows that are complete in all columns; null below `least` rows or without variance."""
    cols = sorted({c for p in pairs for c in p})
    full = df.select(*[finite(c).alias(c) for c in cols]).dropna()
    aggs = [F.count("*").alias("n")]
    for a, b in pairs:
        ok = (F.count("*") >= least) & (F.var_pop(a) > 0) & (F.var_pop(b) > 0)
        aggs.append(F.when(ok, F.round(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), 6)).alias(f"{a}_{b}"))
    return full.agg(*aggs)


def error_rate(df: DataFrame, by: list[str], ops: Column, size: Column, digits: int = 3) -> DataFrame:
    """Weighted rate in percent (operations over reference units) per group."""
    return df.groupBy(*by).agg(F.sum(ops).alias("operations"), F.sum(size).alias("units"), F.round(F.try_divide(F.sum(ops), F.sum(size)) * 100, digits).alias("rate"))


def with_macro(rates: DataFrame, label: str, rate: str, digits: int, before_rounding: bool = False) -> DataFrame:
    """rates with an overall row 'macro': the mean over groups of the rounded rates (of the unrounded ones with before_rounding), only if there is more than one group."""
    value = F.col(rate) if before_rounding else F.round(rate, digits)
    macro = rates.agg(F.count("*").alias("_n"), F.avg(value).alias(rate)).where("_n > 1").select(F.lit("macro").alias(label), F.round(rate, digits).alias(rate))
    return rates.select(label, F.round(rate, digits).alias(rate)).unionByName(macro)


def list_fingerprint(df: DataFrame, value: str) -> DataFrame:
    """fingerprint, n: SHA-256 over the sorted values, one a line. Such a hash runs over the list in order, so one task reads it, sorted on disk if need be, in constant memory; tree_fingerprint needs no single task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, n = hashlib.sha256(), 0
        for b in batches:
            n += b.num_rows
            h.update("".join(f"{x}\n" for x in b.column(0).to_pylist()).encode())
        yield pa.RecordBatch.from_arrays([pa.array([h.hexdigest()]), pa.array([n], pa.int64())], names=["fingerprint", "n"])

    one = df.where(F.col(value).isNotNull()).select(F.col(value).cast("string").alias("v")).repartition(1).sortWithinPartitions("v").mapInArrow(run, "fingerprint string, n bigint")
    # an empty table has no task that could say so
    return one.agg(F.coalesce(F.max("fingerprint"), F.sha2(F.lit("").cast("binary"), 256)).alias("fingerprint"), F.coalesce(F.max("n"), F.lit(0)).alias("n"))


LEAF = 4096  # values that a leaf of a fingerprint's tree is meant to hold


def tree_fingerprint(df: DataFrame, value: str) -> DataFrame:
    """Order-free fingerprint of any size: values are hashed; a leaf of the tree is the sorted hashes that begin with the same hex digits (two at least, as many more as leaves of LEAF values need), hashed; a node is the hash of its up to sixteen children in order, up to the root."""
    h = F.sha2(F.col(value).cast("string"), 256)
    rows = df.where(F.col(value).isNotNull()).select(h.alias("h"))
    n, digits = rows.count(), 2
    while n > LEAF * 16**digits:
        digits += 1
    nodes = rows.groupBy(F.substring("h", 1, digits).alias("s")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("p"), F.count("*").alias("c"))
    joined = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "p"))), lambda x: x["p"]), ""), 256).alias("p")
    for k in range(digits - 1, 0, -1):
        nodes = nodes.groupBy(F.substring("s", 1, k).alias("s")).agg(joined, F.sum("c").alias("c"))
    return nodes.agg(joined.alias("fingerprint"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"))


def hot(df: DataFrame, value: str, seq: str, window: int, share: float, limit: int) -> DataFrame:
    """Values of the last `window` rows that occur at least max(3, share of them) times: the `limit` most frequent, ties by first occurrence."""
    last = df.orderBy(F.desc(seq)).limit(window)
    n = last.agg(F.count("*").alias("_n"))
    counts = last.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"), F.min(seq).alias("_first")).orderBy(F.desc("n"), "_first").limit(limit)
    return counts.crossJoin(F.broadcast(n)).where(F.col("n") >= F.greatest(F.lit(3), F.floor(F.col("_n") * share))).select("value", "n")


def hot_patterns(df: DataFrame, text: str, seq: str, words: dict[str, tuple[str, ...]], window: int = 800, least: int = 40, limits: dict[str, tuple[float, int]] | None = None) -> DataFrame:
    """family, value, n of the patterns of the last `window` rows: openings (four characters of the form for duplicate checks), tags, and the word lists given (a row counts a word once).

    limits: per family the share of rows and the number of values; of the most frequent values (ties: the first seen) those of at least
    max(3, share of rows) rows are hot. Fewer than `least` rows in all have none. The window is `window` rows, wherever they lie.
    """
    from ..functions import text as t

    limits = limits or {"opening": (0.0125, 8), "tag": (0.04, 5), "filler": (0.03, 8), "object": (0.025, 8), "phrase": (0.015, 6)}
    last = df.where(F.col(seq).isNotNull()).orderBy(F.desc(seq)).limit(window).select(F.col(seq).alias("q"), F.coalesce(text, F.lit("")).alias("t"))
    n = last.agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    form, low = t.dedup_form("t"), F.lower("t")
    entry = lambda family, value, k: F.struct(F.lit(family).alias("family"), value.alias("value"), k.alias("k"))
    found = [F.when(F.char_length(form) >= 3, F.array(entry("opening", F.substring(form, 1, 4), F.lit(0))))]
    found.append(F.transform(F.regexp_extract_all("t", F.lit(r"\[([^\]]+)\]"), F.lit(1)), lambda x, i: entry("tag", x, i)))
    for family, names in words.items():
        found.append(F.array_compact(F.array(*[F.when(low.contains(w.lower()), entry(family, F.lit(w), F.lit(i))) for i, w in enumerate(names)])))
    none = F.array().cast("array<struct<family:string,value:string,k:int>>")
    each = last.select("q", F.explode(F.flatten(F.array(*[F.coalesce(x, none) for x in found]))).alias("e")).select("q", "e.*")
    counted = each.groupBy("family", "value").agg(F.count("*").alias("n"), F.min(F.struct("q", "k")).alias("first"))
    ranked = counted.withColumn("r", F.row_number().over(W.partitionBy("family").orderBy(F.desc("n"), "first")))  # of at most `window` rows
    rules = df.sparkSession.createDataFrame([(k, float(a), b) for k, (a, b) in limits.items()], "family string, share double, most int")
    return ranked.join(F.broadcast(rules), "family").crossJoin(F.broadcast(n)).where((F.col("r") <= F.col("most")) & (F.col("n") >= F.greatest(F.lit(3), F.floor(F.col("share") * F.col("_n"))))).select("family", "value", "n")


def cold_tags(df: DataFrame, text: str, seq: str, names: tuple[str, ...], window: int = 5000, least: int = 50) -> DataFrame:
    """tag, n of the known tags that fewer than max(2, a fiftieth of the tagged rows) of the last rows hold; none where no more than `least` rows are tagged."""
    last = df.where(F.col(seq).isNotNull()).orderBy(F.desc(seq)).limit(window).select(F.col(text).alias("t"))
    tagged = last.agg(F.count_if(F.col("t").contains("[")).alias("_n")).where(F.col("_n") > least)
    counts = last.select(F.explode(F.regexp_extract_all("t", F.lit(r"\[([^\]]+)\]"), F.lit(1))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    known = df.sparkSession.createDataFrame([(x,) for x in names], "tag string")
    out = known.join(F.broadcast(counts), "tag", "left").select("tag", F.coalesce("n", F.lit(0)).alias("n"))
    return out.crossJoin(F.broadcast(tagged)).where(F.col("n") < F.greatest(F.lit(2), F.expr("_n div 50"))).select("tag", "n")


def pass_rates(df: DataFrame, key: str, score: str, least: float) -> DataFrame:
    """Per reference: items, passes (strictly above), pass rate, max and mean score."""
    x = finite(score)
    return df.groupBy(key).agg(F.count("*").alias("items"), F.count_if(x > least).alias("passes"), F.round(F.count_if(x > least) / F.count("*"), 6).alias("pass_rate"), F.max(x).alias("best"), F.round(F.avg(x), 6).alias("mean"))
