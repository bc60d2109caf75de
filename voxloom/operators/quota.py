"""Durations, quotas, rankings and samples of a campaign."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: A multiple of the usual sample rates (8, 11.025, 12, 16, 22.05, 24, 32, 44.1, 48, 96, 88.2, 192 kHz).
SCALE = 7_056_000


def exact_durations(df: DataFrame, key: str, target_seconds: int, scale: int = SCALE) -> DataFrame:
    """numerator / denominator (exact seconds), files, deficit (in the same unit) and meets per key. Frames are summed per rate first; rates that don't divide the scale raise."""
    ok = df.where("frames > 0 and sample_rate > 0")
    per = ok.groupBy(key, "sample_rate").agg(F.sum(F.col("frames").cast("decimal(38,0)")).alias("f"), F.count("*").alias("n"))
    factor = F.when(F.pmod(F.lit(scale), F.col("sample_rate")) == 0, F.expr(f"{scale} div sample_rate").cast("decimal(12,0)")).otherwise(F.raise_error(F.concat(F.lit("sample rate does not divide the scale: "), F.col("sample_rate").cast("string"))).cast("decimal(12,0)"))
    num = F.sum((F.col("f").cast("decimal(25,0)") * factor).cast("decimal(38,0)"))
    out = per.groupBy(key).agg(num.alias("numerator"), F.sum("n").alias("files"))
    goal = F.lit(target_seconds * scale).cast("decimal(38,0)")
    return out.select(key, "numerator", F.lit(scale).alias("denominator"), (F.col("numerator").cast("double") / scale).alias("seconds"), "files", F.greatest(F.lit(0).cast("decimal(38,0)"), goal - F.col("numerator")).alias("deficit"), (F.col("numerator") >= goal).alias("meets"))


def inventories(original: DataFrame, clips: DataFrame, key: str, seconds: str, flavours: dict[str, Column], digits: int = 9) -> DataFrame:
    """Files and seconds per speaker of the original inventory and of each flavour of the clips (a condition each), all flavours in one pass; zeros where a speaker has none, clips of unknown speakers are left out."""
    own = original.groupBy(key).agg(F.count("*").alias("original"), F.round(F.sum(seconds), digits).alias("original_seconds"))
    aggs = [x for k, c in flavours.items() for x in (F.count_if(c).alias(k), F.round(F.sum(F.when(c, F.col(seconds)).otherwise(F.lit(0.0))), digits).alias(f"{k}_seconds"))]
    out = own.join(clips.groupBy(key).agg(*aggs), key, "left")
    return out.fillna(0, [c for c in out.columns if c != key])


def top_references(refs: DataFrame, history: DataFrame, limit: int) -> DataFrame:
    """speaker_key, ref_audio, rank: the best passed references, else the best observed ones, else all. history: ref_audio, n, p(asses), b(est), m(ean)."""
    j = refs.join(history, "ref_audio", "left")
    n, p = F.coalesce("n", F.lit(0)), F.coalesce("p", F.lit(0))
    by = [F.desc(F.round(F.coalesce(F.try_divide("p", "n"), F.lit(0.0)), 9)), F.desc(p), F.desc(F.coalesce("b", F.lit(-1.0))), F.desc(F.round(F.coalesce("m", F.lit(-1.0)), 9)), F.asc("ref_audio")]
    w = W.partitionBy("speaker_key")
    r = j.withColumn("rank", F.row_number().over(w.orderBy(*by))).withColumn("anyp", F.max(p > 0).over(w)).withColumn("anyo", F.max(n > 0).over(w))
    upto = w.orderBy("rank")
    r = r.withColumn("kp", F.count_if(p > 0).over(upto)).withColumn("ko", F.count_if(n > 0).over(upto))
    return r.where(F.when(F.col("anyp"), (p > 0) & (F.col("kp") <= limit)).when(F.col("anyo"), (n > 0) & (F.col("ko") <= limit)).otherwise(True)).select("speaker_key", "ref_audio", "rank")


def until_quota(df: DataFrame, key: str, order: list[str], amount: str, quota: float) -> DataFrame:
    """Rows in order while less than the quota was credited before them; `before` is what was."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(amount).over(w), F.lit(0))).where(F.col("before") < quota)


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n keys of the least seeded hash (a distributed top-k)."""
    return df.orderBy(F.sha2(F.concat_ws("\0", F.lit(str(seed)), key), 256)).limit(n)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, salt: str, salts: int = 32) -> DataFrame:
    """The first n rows of every group, in two steps: per slice of the group, then of what the slices kept."""
    d = df.withColumn("_s", F.pmod(F.xxhash64(salt), F.lit(salts)))
    part = d.withColumn("_r", F.row_number().over(W.partitionBy(*group, "_s").orderBy(*order))).where(F.col("_r") <= n)
    return part.withColumn("_r", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= n).drop("_s", "_r")


def _primes(n: int) -> list[int]:
    """Prime factors."""
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + ([n] if n > 1 else [])


def text_walk(key: str | Column, texts: int) -> tuple[Column, Column]:
    """Offset and step of a speaker's walk over a pool of texts, by the first 24 hex digits of seeded SHA-256 hashes. The step has no common factor with the size of the pool (the next one up, around, that has none), so the walk visits every text."""
    if texts < 1:
        raise ValueError("no texts to walk over")
    if texts == 1:
        return F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    k = F.col(key) if isinstance(key, str) else key

    def hashed(name: str, modulus: int) -> Column:
        # 24 hex digits in two halves, so that nothing exceeds a long decimal
        h = F.sha2(F.concat_ws("\0", F.lit(name), k), 256)
        high, low = (F.conv(F.substring(h, at, 12), 16, 10).cast("decimal(20,0)") % modulus for at in (1, 13))
        return ((high * ((1 << 48) % modulus) + low) % modulus).cast("bigint")

    first, factors = hashed("text-step", texts - 1), _primes(texts)
    # among so many neighbours one is free of all prime factors: no 64 in a row aren't, for a product of up to 15 primes
    steps = F.transform(F.sequence(F.lit(0), F.lit(min(64, texts - 1))), lambda i: 1 + (first + i) % (texts - 1))
    free = F.filter(steps, lambda s: F.forall(F.array(*map(F.lit, factors)), lambda p: s % p != 0))
    return hashed("text-offset", texts), F.element_at(free, 1).cast("bigint")


def walk(tasks: DataFrame, key: str, refs: str, ordinal: str, texts: int) -> DataFrame:
    """tasks with ref_index and text_index: references in turn, and for each turn over them (cycle) the speaker's step through the texts."""
    offset, step = text_walk(key, texts)
    o, n = F.col(ordinal).cast("bigint"), F.col(refs).cast("bigint")
    d = tasks.withColumn("ref_index", o % n).withColumn("_cycle", F.floor(o / n).cast("bigint")).withColumn("_o", offset).withColumn("_s", step)
    return d.withColumn("text_index", (F.col("_o") + F.col("ref_index") + F.pmod(F.col("_cycle"), F.lit(texts)) * F.col("_s")) % texts).drop("_cycle", "_o", "_s")


def tasks_for(deficit: Column, multiplier: float, seconds_each: float, reserve: int, capacity: Column | None = None) -> Column:
    """Planned tasks of a deficit in seconds; none if there is none. Where they exceed the capacity (pairs of references and texts that are left) the result fails as it is read."""
    n = F.when(deficit <= 0, 0).otherwise(F.ceil(F.round(deficit * multiplier / seconds_each, 9)) + reserve).cast("bigint")
    if capacity is None:
        return n
    return F.when(n > capacity, F.raise_error(F.concat(F.lit("tasks beyond the capacity: "), n.cast("string"), F.lit(" of "), capacity.cast("string"))).cast("bigint")).otherwise(n)


def weighted_choice(df: DataFrame, key: str, weight: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, with chances in proportion to weight: the least -ln(u) / weight, u by hash of the key."""
    u = (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)) + 1) / F.lit(float((1 << 40) + 1))
    return df.where(F.col(weight) > 0).orderBy(-F.log(u) / F.col(weight), key).limit(n)


def diverse(df: DataFrame, group: str, item: str, dims: list[str], n: int, seed: int = 0) -> DataFrame:
    """group, item, pick: n items of each group, one after the other, each the one with most values not yet shown; ties by seeded hash.

    A first pass keeps, in slices, the n items of least hash for every combination of values: no others can be picked.
    """
    h = F.sha2(F.concat_ws("\0", F.lit(str(seed)), item), 256)
    cells = top_per_group(df.select(group, item, *dims, h.alias("_h")), [group, *dims], [F.col("_h")], n, item)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("_h").itertuples(index=False))
        at = [pdf.columns.get_loc(d) for d in dims]
        shown: list[set] = [set() for _ in dims]
        out = []
        while rows and len(out) < n:
            best = max(range(len(rows)), key=lambda k: (sum(rows[k][a] not in s for a, s in zip(at, shown)), -k))
            r = rows.pop(best)
            for a, s in zip(at, shown):
                s.add(r[a])
            out.append((r[pdf.columns.get_loc(group)], r[pdf.columns.get_loc(item)], len(out) + 1))
        return pd.DataFrame(out, columns=[group, item, "pick"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (group, item))
    return cells.groupBy(group).applyInPandas(pick, f"{kinds}, pick int")


def shortfall_accept(df: DataFrame, key: str, targets: dict[str, dict[str, int]], n: int) -> DataFrame:
    """key, pick: n rows, each in turn the one whose values lack most; ties by key.

    Only values count, so a first pass keeps the n least keys of every combination of values; the rest is a sequence over combinations.
    """
    dims = list(targets)
    top = top_per_group(df.select(key, *[F.when(F.col(c).isin(*targets[c]), F.col(c)).alias(c) for c in dims]).where(F.col(key).isNotNull()), dims, [F.col(key)], n, key)

    def accept(pdf: pd.DataFrame) -> pd.DataFrame:
        queues = {k: sorted(g[key]) for k, g in pdf.groupby(dims, dropna=False)}
        queues = {tuple(None if pd.isna(x) else x for x in k): v for k, v in queues.items()}
        left = {c: dict(targets[c]) for c in dims}
        out = []
        while queues and len(out) < n:
            best = min(queues, key=lambda k: (-sum(left[c].get(v, 0) for c, v in zip(dims, k)), queues[k][0]))
            out.append((queues[best].pop(0), len(out) + 1))
            for c, v in zip(dims, best):
                if v is not None:
                    left[c][v] -= 1
            if not queues[best]:
                del queues[best]
        return pd.DataFrame(out, columns=[key, "pick"])

    return top.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(accept, f"`{key}` {df.schema[key].dataType.simpleString()}, pick int")
