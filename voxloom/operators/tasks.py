"""Generation tasks, refill and audits (A19, G1-G4, W14, W15), as data processing: weighted draws by hash, quotas by largest remainder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import normalize
from .ordering import numbered


def uniform(seed: int, *parts: str | Column) -> Column:
    """Number in [0, 1) from the hash of seed and parts; the same everywhere."""
    cols = [F.lit(p) if isinstance(p, (int, float)) else F.col(p) if isinstance(p, str) else p for p in parts]
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def drawn(u: Column, weights: dict[str, float]) -> Column:
    """Value of a weighted distribution at u, by cumulative weights."""
    total = sum(weights.values()) or 1.0
    out = F.lit(list(weights)[-1])
    for k, c in reversed(list(zip(weights, accumulate(weights.values())))[:-1]):
        out = F.when(u < c / total, k).otherwise(out)
    return out


def task_list(spark: SparkSession, n: int, dims: dict[str, dict[str, float]], stress: dict[str, float] | None = None, stress_ratio: float = 0.15, first: str = "scenario", seed: int = 0) -> DataFrame:
    """n tasks: task_id and a weighted draw of every dimension. The stress scenarios get their quota first: exactly floor(n x stress_ratio) tasks take their first dimension from them; then tasks are numbered in the order of a hash, so that they stand anywhere."""
    base = spark.range(n).select(F.col("id").alias("_i"))
    cols = {k: drawn(uniform(seed, "_i", F.lit(k)), w) for k, w in dims.items()}
    if stress:
        cols[first] = F.when(F.col("_i") < int(n * stress_ratio), drawn(uniform(seed, "_i", F.lit("which")), stress)).otherwise(cols[first])
    rows = base.select("_i", uniform(seed, "_i", F.lit("place")).alias("_u"), *[c.alias(k) for k, c in cols.items()])
    return numbered(rows, "_u", "_n", tie="_i").select((F.col("_n") - 1).alias("task_id"), *cols)


def avoiding(tasks: DataFrame, name: str, values: list[str], last: int, seed: int = 0, per: int = 100_000) -> DataFrame:
    """tasks with name: one of the values for each task in turn, none of those that the `last` tasks before have (W15). Runs of `per` tasks are drawn side by side, each starting afresh, as generating workers do; with no more than `last` values the oldest may come again."""
    order = sorted(values)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tasks.schema)
    rows = tasks.withColumn("_run", F.floor(F.col("task_id") / per)).withColumn("_u", uniform(seed, "task_id", F.lit(name)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, recent = None, []
        for pdf in batches:
            got = []
            for r, u in zip(pdf["_run"], pdf["_u"]):
                if r != now:
                    now, recent = r, []
                free = [v for v in order if v not in recent] or [recent[0]]
                pick = free[int(u * len(free))]
                recent = [*recent, pick][-last:] if last else []
                got.append(pick)
            yield pdf.drop(columns=["_run", "_u"]).assign(**{name: got})

    return rows.repartition("_run").sortWithinPartitions("_run", "task_id").mapInPandas(run, f"{kinds}, `{name}` string")


def rotated(tasks: DataFrame, by: str, pool: dict[str, list[str]], name: str = "subscene") -> DataFrame:
    """The values of a pool in rotation within each group, from an offset by hash; consecutive tasks of a group never share a value if its pool has two."""
    sizes = F.create_map(*[x for k, v in pool.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    rn = F.row_number().over(W.partitionBy(by).orderBy("task_id")) - 1
    vals = F.coalesce(sizes[F.col(by)], F.array(F.lit("")))
    at = F.pmod(rn + F.pmod(F.xxhash64(by), F.lit(1000)), F.size(vals)).cast("int")
    return tasks.withColumn(name, vals[at])


def refill(have: DataFrame, target: int, make: Callable[[int, int], DataFrame], accept: Callable[[DataFrame, DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame], rounds: int = 8, stalls: int = 2, over: float = 1.3) -> DataFrame:
    """Rounds of make(round, n) and accept(new, have) until the target is reached, `stalls` rounds added nothing, or rounds are used up. cut writes what is there after each round, so the plan doesn't grow."""
    n, idle = have.count(), 0
    for k in range(rounds):
        if n >= target or idle >= stalls:
            break
        have = cut(have.unionByName(accept(make(k, round((target - n) * over)), have)))
        now = have.count()
        idle, n = (idle + 1 if now == n else 0), now
    return have


def audit(df: DataFrame, key: str, text: str, examples: int = 3) -> tuple[DataFrame, DataFrame]:
    """(counters, examples) of the safe normal form over a corpus: rows, changed, empty, unstable, and rows per kind of token; up to `examples` keys per kind, the least."""
    d = df.select(F.col(key).alias("key"), F.col(text).alias("raw"), normalize.normalized_safe(text).alias("once"))
    d = d.withColumn("twice", normalize.normalized_safe("once")).withColumn("kinds", F.array_distinct(F.regexp_extract_all("once", F.lit("⟦([A-Z]+):"), F.lit(1))))
    counters = d.agg(F.count("*").alias("rows"), F.count_if(F.col("raw") != F.col("once")).alias("changed"), F.count_if((F.col("once") == "") & (F.col("raw") != "")).alias("empty"), F.count_if(F.col("once") != F.col("twice")).alias("unstable"))
    kinds = d.select("key", F.explode("kinds").alias("kind"))
    r = F.row_number().over(W.partitionBy("kind").orderBy("key"))
    return counters, kinds.withColumn("r", r).where(F.col("r") <= examples).select("kind", "key")
