"""Problem 1: one ranking from several differently scaled scores.

Each score becomes its average rank among all its values (ties share the mean), scaled to mean 0 and variance 1 and turned so that
more is better. One pass sums the products of all pairs of scores into their correlation matrix (over the items that have both);
its first eigenvector gives the loadings. Every loading takes the sign of its declared direction: a score that hardly correlates with
the others has a small loading of either sign, by chance, and must not count against the direction it was declared to have. Items are
ordered by their projection. Ranks don't change with range, shape or any monotone rescaling, so no score counts more for its spread.

Ranks are found without one global window. Approximate quantiles of all scores (one job) cut their values into ranges; a value that is a
cut several times over is a heavy tie and makes a range of its own. Counts per range give offsets. A row of a heavy tie has its
rank by arithmetic; all others are ranked inside their range, whose number follows the number of rows (PER_RANGE). Only cuts and
counts of ranges reach the driver.

A missing score (no row, null, NaN, infinite) counts as the middle (0) in the projection; an item without any score is ranked with
projection 0. A constant score has no weight. Items of equal projection share a position. Repeated rows: the caller gives one
value per item (clip_scores takes the latest row, then the larger value); of a repeated key the largest rank counts. Rows of a null
key take no part. Empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

PER_RANGE = 200_000  # rows that one range is meant to hold
RANGES = (16, 4096)  # least and most ranges of a score
CUT_ERROR = 0.25  # of a range


def sane(c: Column) -> Column:
    """A finite value or null."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


class Ranges:
    """Cuts of the values of one score. Ranges are numbered upwards: 2 i + 1 is cut i where it is a heavy tie (else empty), 2 i the open interval below cut i, joined with it where it isn't."""

    def __init__(self, cuts: list[float]):
        self.cuts = sorted(set(cuts))
        self.heavy = {c for c in self.cuts if cuts.count(c) > 1}

    def of(self, value: Column) -> Column:
        """Range of a value: binary search as nested conditions, logarithmic in the number of cuts."""

        def node(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(2 * lo)
            mid = (lo + hi) // 2
            cut = F.lit(self.cuts[mid])
            return F.when(value < cut, node(lo, mid)).when(value == cut, F.lit(2 * mid + 1) if self.cuts[mid] in self.heavy else node(mid + 1, hi)).otherwise(node(mid + 1, hi))

        return node(0, len(self.cuts))


def _cut(df: DataFrame, scores: list[str], rows: int) -> dict[str, list[float]]:
    """Approximate quantiles of all scores, in one job."""
    n = max(RANGES[0], min(RANGES[1], rows // PER_RANGE))
    got = df.approxQuantile(scores, [k / n for k in range(1, n)], CUT_ERROR / n) if rows else [[] for _ in scores]
    return {s: [x + 0.0 for x in q] for s, q in zip(scores, got)}


def _bucket(df: DataFrame, name: str, ranges: dict[str, Ranges]) -> Column:
    """Range of (name, value). Few cuts are searched inside the expression; many by an Arrow-batched binary search."""
    if max((len(r.cuts) for r in ranges.values()), default=0) <= 64:
        return reduce(lambda got, s: F.when(F.col(name) == s, ranges[s].of(F.col("value"))).otherwise(got), ranges, F.lit(0)).cast("int")
    tables = {s: (np.array(r.cuts), np.array([c in r.heavy for c in r.cuts] + [False])) for s, r in ranges.items()}

    @F.pandas_udf("int")
    def search(names: pd.Series, values: pd.Series) -> pd.Series:
        out = np.zeros(len(values), np.int32)
        for s, (cuts, heavy) in tables.items():
            mine = (names == s).to_numpy()
            x = values.to_numpy()[mine]
            lo, hi = np.searchsorted(cuts, x, "left"), np.searchsorted(cuts, x, "right")
            out[mine] = np.where((hi > lo) & heavy[lo], 2 * lo + 1, 2 * hi)
        return pd.Series(out)

    return search(F.col(name), F.col("value"))


def ranked(df: DataFrame, key: str, scores: list[str], method: str = "average") -> DataFrame:
    """key and r_<score>: the rank (1 = least; ties share their mean, or with method "min" their first) of each value among the non-null values of its score; null stays null."""
    wide = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), *[(sane(F.col(s).cast("double")) + 0.0).alias(s) for s in scores])
    cuts = _cut(wide, scores, wide.count())
    ranges = {s: Ranges(c) for s, c in cuts.items()}
    each = F.array(*[F.struct(F.lit(s).alias("name"), F.col(s).alias("value")) for s in scores])
    long = wide.select("_key", F.explode(each).alias("e")).select("_key", "e.*")
    long = long.withColumn("bucket", F.when(F.col("value").isNotNull(), _bucket(long, "name", ranges)))
    counts: dict[str, list[tuple[int, int]]] = {s: [] for s in scores}
    for s, b, n in long.where("value is not null").groupBy("name", "bucket").agg(F.count("*")).collect():  # scores x 2 x ranges at most
        counts[s].append((b, n))
    offsets, heavy = [], []
    for s in scores:
        before = 0
        for b, n in sorted(counts[s]):
            offsets.append((s, b, before))
            if b % 2:
                heavy.append((s, b, before + (1 if method == "min" else (n + 1) / 2)))
            before += n
    spark = df.sparkSession
    tied = F.broadcast(spark.createDataFrame([(s, b, float(r)) for s, b, r in heavy], "name string, bucket int, rank double"))
    start = F.broadcast(spark.createDataFrame(offsets, "name string, bucket int, before bigint"))
    plain = long.where("value is null or bucket % 2 = 1").join(tied, ["name", "bucket"], "left").select("_key", "name", "rank")
    by = W.partitionBy("name", "bucket").orderBy("value")
    rank = F.rank().over(by) if method == "min" else F.rank().over(by) + (F.count("*").over(by.rangeBetween(W.currentRow, W.currentRow)) - 1) / 2
    rest = long.where("bucket % 2 = 0").withColumn("rank", rank).join(start, ["name", "bucket"]).select("_key", "name", (F.col("before") + F.col("rank")).cast("double").alias("rank"))
    return plain.unionByName(rest).groupBy(F.col("_key").alias(key)).agg(*[F.max(F.when(F.col("name") == s, F.col("rank"))).alias(f"r_{s}") for s in scores])


def average_ranks(df: DataFrame, key: str, scores: list[str]) -> DataFrame:
    """key and r_<score>: the average rank (1 = least) of each value among the non-null values of its score; null stays null."""
    return ranked(df, key, scores)


def principal(ranks: DataFrame, scores: dict[str, int]) -> tuple[dict[str, float], dict[str, tuple[float, float]], np.ndarray]:
    """Loadings by score (none negative: turned to the declared directions), (mean, deviation) of the turned ranks, and their correlation matrix. scores: name -> direction (1: more is better, -1: less is)."""
    names = list(scores)
    x = {s: F.col(f"r_{s}") * scores[s] for s in names}
    aggs = []
    for i, a in enumerate(names):
        aggs += [F.avg(x[a]).alias(f"m{i}"), F.stddev_pop(x[a]).alias(f"d{i}")]
        for j in range(i):
            b = names[j]
            ok = x[a].isNotNull() & x[b].isNotNull()
            aggs += [F.covar_pop(x[a], x[b]).alias(f"c{j}_{i}"), F.stddev_pop(F.when(ok, x[a])).alias(f"a{j}_{i}"), F.stddev_pop(F.when(ok, x[b])).alias(f"b{j}_{i}")]
    got = ranks.agg(*aggs).first().asDict()
    corr = np.eye(len(names))
    for i in range(len(names)):
        for j in range(i):
            d = (got[f"a{j}_{i}"] or 0) * (got[f"b{j}_{i}"] or 0)
            corr[i, j] = corr[j, i] = (got[f"c{j}_{i}"] or 0) / d if d > 0 else 0.0
    live = [i for i in range(len(names)) if (got[f"d{i}"] or 0) > 0]
    load = np.zeros(len(names))
    if live:
        # the ranks are turned already, so the declared directions all point up
        load[live] = np.abs(np.linalg.eigh(corr[np.ix_(live, live)])[1][:, -1])
    return dict(zip(names, map(float, load))), {s: (got[f"m{i}"] or 0.0, got[f"d{i}"] or 0.0) for i, s in enumerate(names)}, corr


def loadings(df: DataFrame, key: str, scores: dict[str, int]) -> DataFrame:
    """score, direction, loading of each score, and its correlations (of turned ranks) with all of them, by the order of the scores."""
    load, _, corr = principal(ranked(df, key, list(scores)), scores)
    rows = [(s, d, load[s], [float(c) for c in corr[i]]) for i, (s, d) in enumerate(scores.items())]
    return df.sparkSession.createDataFrame(rows, "score string, direction int, loading double, correlations array<double>").coalesce(1)


def rank_items(df: DataFrame, key: str, scores: dict[str, int]) -> DataFrame:
    """key, r_<score>, projection and position (1 = best; equal projections share one) of every key of df."""
    ranks = written(ranked(df, key, list(scores)))
    load, moments, _ = principal(ranks, scores)
    parts = [F.coalesce((F.col(f"r_{s}") * scores[s] - moments[s][0]) / moments[s][1] * load[s], F.lit(0.0)) for s in scores if moments[s][1] > 0]
    p = reduce(lambda a, b: a + b, parts, F.lit(0.0))
    scored = written(ranks.withColumn("projection", F.round(p, 9) + 0.0))
    placed = ranked(scored.select(key, (-F.col("projection")).alias("up")), key, ["up"], "min")
    return scored.join(placed, key).select(key, *[f"r_{s}" for s in scores], "projection", F.col("r_up").cast("bigint").alias("position"))


def clip_scores(cer: DataFrame, sim: DataFrame, mos: DataFrame) -> DataFrame:
    """wav, cer, similarity (version 1 put on -1..1), utmos of every clip in any of the three tables: of the rows with a usable value the last to arrive, then the largest value; null if there is none. One shuffle for all three."""
    s = F.when(F.col("score_version") == 1, F.col("similarity") * 2 - 1).otherwise(F.col("similarity"))
    parts = [df.select(F.col(k).alias("wav"), F.lit(name).alias("name"), F.col("arrived_at").alias("t"), sane(v).alias("v")) for df, k, name, v in ((cer, "wav", "cer", F.col("cer")), (sim, "cloned_audio", "similarity", s), (mos, "cloned_audio", "utmos", F.col("utmos")))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("wav is not null")
    best = lambda name: F.max(F.when((F.col("name") == name) & F.col("v").isNotNull(), F.struct(F.col("t").isNotNull().alias("o"), "t", "v")))["v"].alias(name)
    return rows.groupBy("wav").agg(*[best(n) for n in ("cer", "similarity", "utmos")])
