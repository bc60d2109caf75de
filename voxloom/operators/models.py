"""Model hooks (H1, H3, H5, G6): a scorer is a plug-in over Arrow batches; what it returns are ordinary columns."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine


def scored(df: DataFrame, key: str, inputs: list[str], load: Callable[[], Callable[[pd.DataFrame], list]], out: str, kind: str = "double", name: str = "model", retries: int = 0, wait: float = 0.5) -> DataFrame:
    """key, out, error, model, seconds: the model is loaded once per task and called per batch.

    A failed batch is called again up to `retries` times, after wait, 2 wait, 4 wait ... seconds (G6); then its rows are tried one by one,
    and a row that fails has a null and the error. A model whose package is missing is skipped: all its rows have a null and the
    reason (H3). seconds is a row's even share of its batch's time (H14).
    """
    cols = [key, *inputs]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            model, gone = load(), None
        except ImportError as e:
            model, gone = None, f"skipped: {e}"

        def called(pdf: pd.DataFrame) -> list:
            for k in range(retries + 1):
                try:
                    return list(model(pdf))
                except Exception:  # noqa: BLE001 - any failure of a plug-in
                    if k == retries:
                        raise
                    time.sleep(wait * 2**k)
            return []

        for pdf in frames:
            began = time.perf_counter()
            if gone:
                got, errors = [None] * len(pdf), [gone] * len(pdf)
            else:
                try:
                    got, errors = called(pdf), [None] * len(pdf)
                except Exception:  # noqa: BLE001 - the rows tell which
                    got, errors = [], []
                    for k in range(len(pdf)):
                        try:
                            got.append(list(model(pdf.iloc[k : k + 1]))[0])
                            errors.append(None)
                        except Exception as e:  # noqa: BLE001
                            got.append(None)
                            errors.append(f"{type(e).__name__}: {e}")
            each = (time.perf_counter() - began) / max(1, len(pdf))
            yield pd.DataFrame({key: pdf[key], out: pd.Series(got, index=pdf.index, dtype=object), "error": errors, "model": name, "seconds": each})

    return df.select(*cols).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, `{out}` {kind}, error string, model string, seconds double")


def routed(df: DataFrame, column: str, routes: dict[str, Callable[[DataFrame], DataFrame]], other: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows scored by the route of their value (a language, say), those without one by `other` (H11). Routes return equal columns."""
    out = other(df.where(F.col(column).isNull() | ~F.col(column).isin(*routes)))
    for value, route in routes.items():
        out = out.unionByName(route(df.where(F.col(column) == value)))
    return out


def missing_only(df: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that the cache doesn't have under the same keys (path, size, time, fingerprint)."""
    return df.join(cache.select(*keys).distinct(), keys, "left_anti")


def reusable(cache: DataFrame, same: dict[str, object]) -> DataFrame:
    """Cached rows that another model, signature or version didn't make (H2, H5); a null fits nothing but a null."""
    ok = F.lit(True)
    for c, v in same.items():
        ok = ok & F.col(c).eqNullSafe(F.lit(v))
    return cache.where(ok)


def complete(df: DataFrame, hit: Column, require_all: bool = False) -> DataFrame:
    """df, failing as it is read where no row is a hit, or, with require_all, where one isn't (H6). hit: a condition. Counts are one row, that is broadcast."""
    n = df.agg(F.count_if(F.coalesce(hit, F.lit(False))).alias("_hits"), F.count("*").alias("_all"))
    bad = (F.col("_all") > 0) & ((F.col("_hits") == 0) | (F.lit(require_all) & (F.col("_hits") < F.col("_all"))))
    said = F.concat(F.lit("incomplete: "), F.col("_hits").cast("string"), F.lit(" of "), F.col("_all").cast("string"))
    return df.crossJoin(F.broadcast(n)).where(F.when(bad, F.raise_error(said).cast("boolean")).otherwise(True)).drop("_hits", "_all")


def similarities(pairs: DataFrame, audio: DataFrame, one: str, two: str, key: str = "path", vec: str = "embedding", provenance: dict[str, object] | None = None) -> DataFrame:
    """pairs with similarity and provenance columns (metric, version, model): every distinct audio is embedded once (audio: key, vec) and joined twice (H1)."""
    a, b = audio.select(F.col(key).alias(one), F.col(vec).alias("_a")), audio.select(F.col(key).alias(two), F.col(vec).alias("_b"))
    return pairs.join(a, one, "left").join(b, two, "left").withColumn("similarity", cosine(F.col("_a"), F.col("_b"))).drop("_a", "_b").withColumns({k: F.lit(v) for k, v in (provenance or {}).items()})


def multiplexed(parts: list[tuple[DataFrame, float]], key: str) -> DataFrame:
    """Rows of several sources in one order in which, at every point, sources stand in proportion to their weights.

    Inside a source rows get ranks by the hash of their key; a row's place is its rank over its source's weight. Places only order:
    write them range-partitioned to keep the mix without a single task.
    """
    from .ordering import numbered

    out = None
    for k, (df, w) in enumerate(parts):
        h = F.md5(F.col(key).cast("string"))
        # the first twelve hex digits as a number make ranges; the whole hash orders inside them
        d = df.withColumn("_m", h).withColumn("_h", F.conv(F.substring(h, 1, 12), 16, 10).cast("double"))
        d = numbered(d, "_h", "_n", tie=["_m", key]).withColumn("source_no", F.lit(k)).withColumn("place", (F.col("_n") - 0.5) / w).drop("_n", "_h", "_m")
        out = d if out is None else out.unionByName(d)
    return out


def masked(df: DataFrame, key: str, tokens: str, prompt: tuple[float, float], ratio: tuple[float, float], mask_id: int, ignore: int = -100, seed: int = 0) -> DataFrame:
    """key, inputs, labels: a prompt of a random share is left alone, a random share of the rest is masked; labels are kept on masked places only (B9). Random numbers come from the hash of seed, key and place."""
    u = lambda *x: (F.pmod(F.xxhash64(F.lit(seed), F.col(key), *x), F.lit(1 << 32)) / F.lit(float(1 << 32)))
    n = F.floor(F.size(tokens) * (u(F.lit("p")) * (prompt[1] - prompt[0]) + prompt[0]))
    d = df.withColumn("_n", n).withColumn("_r", u(F.lit("r")) * (ratio[1] - ratio[0]) + ratio[0])
    hit = F.transform(tokens, lambda x, i: (i >= F.col("_n")) & (u(F.lit("m"), i) < F.col("_r")))
    d = d.withColumn("_hit", hit)
    return d.select(key, F.zip_with(tokens, "_hit", lambda x, m: F.when(m, mask_id).otherwise(x)).alias("inputs"), F.zip_with(tokens, "_hit", lambda x, m: F.when(m, x).otherwise(ignore)).alias("labels"))
