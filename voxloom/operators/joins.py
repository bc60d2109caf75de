"""Joins, set operations and selection over metric tables (J*, F1-F3, F23-F27, U*, D4-D7, K12, G7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def first_finite(df: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """key, rows and, of the finite values of each key, the first to arrive (no time counts as the last), then the larger; null if there is none."""
    x = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), F.col(value))
    first = F.min(F.when(x.isNotNull(), F.struct(F.col(at).isNull().alias("u"), F.col(at).alias("t"), (-x).alias("v"))))
    return df.groupBy(key).agg(F.count("*").alias("rows"), first.alias("_f")).select(key, "rows", (-F.col("_f.v")).alias(value))


def folded_language(c: str | Column) -> Column:
    """Language of a label: mixed kinds by what they mostly are, null and empty as unknown."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "en_mostly", "en").when(c.isin("cn_mostly", "frequent_mix"), "zh").otherwise(F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown")))


# Languages that texts are spoken in.
SPOKEN = ("zh", "en", "ja", "de", "fr", "es", "ko", "ar", "ru", "pt", "it")


def cloning_language(c: str | Column, known: tuple[str, ...] = SPOKEN) -> Column:
    """Language to speak in: the folded label where it is one of the known codes, else zh."""
    folded = folded_language(c)
    return F.when(folded.isin(*known), folded).otherwise("zh")


def conflicts(df: DataFrame, key: str, value: str, equal: list[str], tolerance: float) -> DataFrame:
    """Keys whose rows disagree: a value off by more than the tolerance, null beside a value, or different columns in `equal`."""
    x = F.when(~F.isnan(value), F.col(value))
    aggs = [F.count("*").alias("rows"), (F.max(x) - F.min(x)).alias("spread"), F.count(x).alias("scored")]
    differ = F.lit(False)
    for k, c in enumerate(equal):
        text = F.coalesce(F.col(c).cast("string"), F.lit("\0"))
        aggs.append((F.min(text) != F.max(text)).alias(f"_d{k}"))
        differ = differ | F.col(f"_d{k}")
    got = df.groupBy(key).agg(*aggs).where("rows > 1")
    return got.select(key, "rows", F.coalesce(F.col("spread") > tolerance, F.lit(False)).alias("value_conflict"), ((F.col("scored") > 0) & (F.col("scored") < F.col("rows"))).alias("null_conflict"), differ.alias("column_conflict")).where("value_conflict or null_conflict or column_conflict")


def outer3(a: DataFrame, b: DataFrame, c: DataFrame, key: str) -> DataFrame:
    """Full outer join of three tables on one key; the sides are shuffled on it once each."""
    return a.join(b, key, "full").join(c, key, "full")


def falsy(c: str) -> Column:
    """The value unless it is an empty text or zero."""
    return F.when((F.col(c).cast("string") != "") & (F.coalesce(F.col(c).cast("double"), F.lit(1.0)) != 0), F.col(c))


def threshold(pool: DataFrame, cer_below: float | None = None, sim_above: float | None = None) -> DataFrame:
    """Strict selection: cer below and similarity above; equality and missing scores fail."""
    ok = F.lit(True)
    if cer_below is not None:
        ok = ok & (F.col("cer") < cer_below)
    if sim_above is not None:
        ok = ok & (F.col("similarity") > sim_above)
    return pool.where(ok)


def action(cer: str, sim: str, copy_below: float, sim_above: float, delete_from: float) -> Column:
    """COPY where both pass, else DELETE from a CER on, else KEEP; missing scores keep."""
    return F.when(F.col(cer).isNull() | F.col(sim).isNull(), "KEEP").when((F.col(cer) < copy_below) & (F.col(sim) > sim_above), "COPY").when(F.col(cer) >= delete_from, "DELETE").otherwise("KEEP")


def coverage(have: DataFrame, want: DataFrame, key: str) -> DataFrame:
    """key and side ('extra' or 'missing') of the keys that only one table has."""
    a, b = have.select(key).distinct(), want.select(key).distinct()
    return a.join(b, key, "left_anti").select(key, F.lit("extra").alias("side")).unionByName(b.join(a, key, "left_anti").select(key, F.lit("missing").alias("side")))


def intervals(value: str, edges: list[float]) -> Column:
    """Index of the interval [low, high) that holds the value; null outside (1.0 too, if it is the last edge)."""
    out = None
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        cond = (F.col(value) >= lo) & (F.col(value) < hi)
        out = F.when(cond, k) if out is None else out.when(cond, k)
    return out


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Full outer merge, new non-null values win."""
    cols = [c for c in old.columns if c != key]
    o, n = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in cols]), new.select(key, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != key])
    both = o.join(n, key, "full")
    return both.select(key, *[F.coalesce(f"_n_{c}", f"_o_{c}").alias(c) if c in new.columns else F.col(f"_o_{c}").alias(c) for c in cols])


def dataset_of(path: str | Column, root: str) -> Column:
    """First part of the path below the root; 'unknown' outside."""
    p = F.col(path) if isinstance(path, str) else path
    return F.when(p.startswith(root.rstrip("/") + "/"), F.split(F.substring(p, len(root.rstrip("/")) + 2, 1 << 30), "/")[0]).otherwise("unknown")


def rewritten(path: str, old: str, new: str) -> Column:
    """Path with its prefix replaced."""
    return F.when(F.col(path).startswith(old), F.concat(F.lit(new), F.substring(F.col(path), len(old) + 1, 1 << 30))).otherwise(F.col(path))


def duplicated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def merged(parts: list[DataFrame], key: str, order: str) -> DataFrame:
    """Outputs of several workers as one table, each key once: its first row (U5, K4, P7). Columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    cols = [c for c in out.columns if c != key]
    return out.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("_m")).select(key, "_m.*")


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition and all others (also those of which it isn't known)."""
    ok = F.coalesce(condition, F.lit(False))
    return df.where(ok), df.where(~ok)


def attempted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Task states after new results: a new status replaces the old one and counts one attempt more, tasks without a result stay (G7, H24). old: key, status, attempts; new: key, status."""
    n = new.select(key, F.col("status").alias("_new"), F.lit(True).alias("_hit"))
    return old.join(n, key, "full").select(key, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("status")).alias("status"), (F.coalesce("attempts", F.lit(0)) + F.when(F.col("_hit"), 1).otherwise(0)).cast("bigint").alias("attempts"))


def counted_once(parts: dict[str, DataFrame], path: str) -> DataFrame:
    """path, parts: the paths that more than one inventory counts (D7); an inventory may name a path more than once."""
    out = None
    for name, df in parts.items():
        d = df.where(F.col(path).isNotNull()).select(path, F.lit(name).alias("_part")).distinct()
        out = d if out is None else out.unionByName(d)
    return out.groupBy(path).agg(F.array_sort(F.collect_list("_part")).alias("parts")).where(F.size("parts") > 1)


def half_open(value: str, low: float, high: float) -> Column:
    """low <= value < high; a missing value isn't."""
    return F.coalesce((F.col(value) >= low) & (F.col(value) < high), F.lit(False))


def inventory(audio: DataFrame, texts: DataFrame, speakers: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(audio with its speaker and text, where there is one; keys that only one of audio and speakers has, with the side that lacks them)."""
    whole = audio.join(speakers, key).join(texts, key, "left")
    a, s = audio.select(key).distinct(), speakers.select(key).distinct()
    lacking = a.join(s, key, "left_anti").select(key, F.lit("speaker").alias("missing")).unionByName(s.join(a, key, "left_anti").select(key, F.lit("audio").alias("missing")))
    return whole, lacking
