"""Problem 6: a sample that matches target proportions of categories, by hierarchical top-down allocation.

The categories form a tree (the first field at the top). The sample size is handed down from the root: every node splits its
quota over its children in proportion to their targets, at least their minima, at most what the pool holds. What a leaf can't
fill goes first to its siblings, then to its cousins, then up. Rows are drawn at each leaf by the dense rank of a permutation of their
ids. The rank is found in two steps, so that a leaf with a third of all rows doesn't end in one task: counts per slice of the
permutation give offsets, and only within a slice rows are ordered.

Two allocations are made over the same tree: the quotas of the sample, which sum to its size, and the claims, in which every target
asks for its whole need (rounded up, minima included). A target is met if the draw by its claim brings as many rows as it needs.

Targets that are repeated (after trimming, lower-casing and reading - as _) count once, with the larger share and minimum; those with a null
field are left out. Rows with a null key or a null in one of the fields fill nothing; repeated keys count once (the least fields, where they differ);
empty pools give an empty sample and every target with a need as unmet. Only counts per target (as many as there are targets) and
per slice reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import folded

SLICES = 64


def need(per_10000: int, least: int, size: int) -> int:
    """The larger of the minimum and the target share of the size, rounded up."""
    return max(least, -(-per_10000 * size // 10000))


def _split(total: int, wants: list[float], low: list[int], high: list[int]) -> list[int]:
    """Splits total over children in proportion to wants, within bounds where they allow it; largest remainders first."""
    got = [min(a, b) for a, b in zip(low, high)]
    rest = total - sum(got)
    while rest > 0 and any(g < h for g, h in zip(got, high)):
        open_ = [k for k, (g, h) in enumerate(zip(got, high)) if g < h]
        lack = [max(0.0, total * wants[k] / (sum(wants) or 1) - got[k]) for k in open_]
        if not sum(lack):
            lack = [float(wants[k]) or 1e-9 for k in open_]
        exact = [min(rest * x / sum(lack), high[k] - got[k]) for k, x in zip(open_, lack)]
        give = [int(x) for x in exact]
        spare = min(rest - sum(give), max(1, round(sum(exact)) - sum(give)))
        for j in sorted(range(len(open_)), key=lambda j: (-(exact[j] - give[j]), j)):
            if spare > 0 and got[open_[j]] + give[j] < high[open_[j]]:
                give[j] += 1
                spare -= 1
        if not sum(give):
            break
        for k, g in zip(open_, give):
            got[k] += g
        rest = total - sum(got)
    return got


def allocate(targets: list[tuple[tuple[str, ...], int, int]], have: dict[tuple[str, ...], int], size: int) -> dict[tuple[str, ...], int]:
    """Quota of each leaf. targets: (path, share per 10,000, minimum). Unmet quota stays with siblings before it moves to cousins: a node's cap is the sum of its leaves' rows."""

    def go(prefix: tuple[str, ...], total: int) -> dict[tuple[str, ...], int]:
        own = [t for t in targets if t[0][: len(prefix)] == prefix]
        if len(own) == 1 and own[0][0] == prefix:
            return {prefix: min(total, have.get(prefix, 0))}
        kids = list(dict.fromkeys(t[0][: len(prefix) + 1] for t in own))
        parts = [[t for t in own if t[0][: len(k)] == k] for k in kids]
        high = [sum(have.get(t[0], 0) for t in p) for p in parts]
        low = [sum(min(t[2], have.get(t[0], 0)) for t in p) for p in parts]
        out: dict[tuple[str, ...], int] = {}
        for k, n in zip(kids, _split(min(total, sum(high)), [sum(t[1] for t in p) for p in parts], low, high)):
            out |= go(k, n)
        return out

    return go((), size) if targets else {}


class Sampler:
    """One pool against one table of targets."""

    def __init__(self, pool: DataFrame, targets: DataFrame, key: str, fields: tuple[str, ...], share: str = "target_per_10000", least: str = "min_rows", every: int = 5, seed: int = 0):
        self.fields, self.key, self.targets = fields, key, targets
        cols = [folded(f).alias(f"_c{k}") for k, f in enumerate(fields)]
        self.pool = pool.select(F.col(key).alias("_k"), *cols).where("_k is not null").groupBy("_k").agg(F.min(F.struct(*[f"_c{k}" for k in range(len(fields))])).alias("_f")).select("_k", "_f.*")
        ranked = self.pool.withColumn("_h", F.xxhash64(F.lit(seed), F.col("_k").cast("string")))
        self.rows = ranked.withColumn("_slice", F.pmod(F.shiftright("_h", 40), F.lit(SLICES)).cast("int"))
        counts = self.rows.groupBy(*[f"_c{k}" for k in range(len(fields))], "_slice").agg(F.count("*").alias("n"))
        self.leaf_slices: dict[tuple[str, ...], dict[int, int]] = {}
        self.ids = 0
        rows = targets.select(*[folded(f) for f in fields], F.col(share).cast("int"), F.col(least).cast("int")).collect()  # as many as there are categories
        once: dict[tuple[str, ...], tuple[int, int]] = {}
        for r in rows:
            path, (a, b) = tuple(r[: len(fields)]), once.get(tuple(r[: len(fields)]), (0, 0))
            if None not in path:
                once[path] = max(a, r[len(fields)] or 0), max(b, r[len(fields) + 1] or 0)
        self.plan = [(path, s, m) for path, (s, m) in once.items()]
        named = {p[0] for p in self.plan}
        # rows outside the targets are summed up before they come: the driver gets at most (targets + 1) x SLICES counts
        cells = self.rows.sparkSession.createDataFrame([(*x, True) for x in sorted(named)], ", ".join(f"_c{k} string" for k in range(len(fields))) + ", _in boolean")
        known = counts.join(F.broadcast(cells), [f"_c{k}" for k in range(len(fields))], "left")
        kept = [F.when(F.col("_in"), F.col(f"_c{k}")).alias(f"_c{k}") for k in range(len(fields))]
        for *leaf, s, n in known.select(*kept, "_slice", "n").groupBy(*[f"_c{k}" for k in range(len(fields))], "_slice").agg(F.sum("n")).collect():
            self.ids += n
            if None not in leaf:
                self.leaf_slices.setdefault(tuple(leaf), {})[s] = n
        self.size = self.ids // every
        self.have = {k: sum(v.values()) for k, v in self.leaf_slices.items()}
        self.quota = allocate(self.plan, self.have, self.size)
        needs = [(p, need(s, m, self.size), 0) for p, s, m in self.plan]
        self.claims = allocate(needs, self.have, sum(n for _, n, _ in needs))

    def _drawn(self, quota: dict[tuple[str, ...], int]) -> DataFrame:
        """The rows of each leaf whose dense rank in the permutation is within its quota."""
        spark, names = self.targets.sparkSession, [f"_c{k}" for k in range(len(self.fields))]
        take = []
        for leaf, n in quota.items():
            before = 0
            for s in sorted(self.leaf_slices.get(leaf, {})):
                if before >= n:
                    break
                take.append((*leaf, s, n - before))
                before += self.leaf_slices[leaf][s]
        cut = spark.createDataFrame(take, ", ".join(f"{c} string" for c in names) + ", _slice int, _most int")
        w = W.partitionBy(*names, "_slice").orderBy("_h", "_k")
        return self.rows.join(F.broadcast(cut), [*names, "_slice"]).withColumn("_r", F.dense_rank().over(w)).where("_r <= _most")

    def _counted(self, quota: dict[tuple[str, ...], int], name: str) -> DataFrame:
        """Rows drawn per leaf."""
        leaf = [f"_c{k}" for k in range(len(self.fields))]
        return self._drawn(quota).groupBy(*leaf).agg(F.count("*").alias(name))

    def _named(self) -> DataFrame:
        """The targets as they are spelled, beside their folded fields."""
        return self.targets.select(*self.fields, *[folded(f).alias(f"_c{k}") for k, f in enumerate(self.fields)])

    def _asked(self) -> DataFrame:
        rows = [(*p, need(s, m, self.size), self.have.get(p, 0), self.quota.get(p, 0), self.claims.get(p, 0)) for p, s, m in self.plan]
        return self.targets.sparkSession.createDataFrame(rows, ", ".join(f"_c{k} string" for k in range(len(self.fields))) + ", need bigint, available bigint, quota bigint, claim bigint").coalesce(1)

    def unmet(self) -> DataFrame:
        """The targets, as they are spelled, for which the draw by their claims brings fewer rows than they need."""
        leaf = [f"_c{k}" for k in range(len(self.fields))]
        short = self._asked().join(F.broadcast(self._counted(self.claims, "got")), leaf, "left").where(F.coalesce("got", F.lit(0)) < F.col("need"))
        return self._named().join(F.broadcast(short.select(*leaf)), leaf, "left_semi").select(*self.fields)

    def report(self) -> DataFrame:
        """Each target as it is spelled: its need, the rows that there are, the quota of the sample, the rows drawn for it, and whether the draw by its claim meets the need. Quota beyond the need came from siblings or cousins that can't be filled."""
        leaf = [f"_c{k}" for k in range(len(self.fields))]
        got = self._asked().join(F.broadcast(self._counted(self.claims, "got")), leaf, "left").join(F.broadcast(self._counted(self.quota, "drawn")), leaf, "left")
        return self._named().join(F.broadcast(got), leaf).select(*self.fields, "need", "available", "quota", F.coalesce("drawn", F.lit(0)).alias("drawn"), (F.coalesce("got", F.lit(0)) >= F.col("need")).alias("met"))

    def sample(self) -> DataFrame:
        """The drawn keys with their (folded) fields."""
        return self._drawn(self.quota).select(F.col("_k").alias(self.key), *[F.col(f"_c{k}").alias(f) for k, f in enumerate(self.fields)])
