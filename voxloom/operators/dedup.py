"""Deduplication of generated texts (D1-D3) and pair similarity."""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..session import written

CONTEXT = ("scenario", "subscene", "emotion", "age_tier", "length_type", "lang_type")


def exact(df: DataFrame, text: str, seq: str, mode: str = "fixed") -> DataFrame:
    """First row of each text and of each bare form.

    fixed: a row stays if no earlier row has its text or its bare form. reference: both hashes share one set, in which a text that is its
    own bare form meets itself and is dropped, as are texts that equal an earlier row's bare form. Rows that are dropped leave no hashes
    behind; since every key of a dropped row was there before, the least seq of each key decides.
    """
    d = df.withColumn("_a", F.md5(text)).withColumn("_b", F.md5(t.bare_form(text)))
    if mode == "reference":
        keys = d.select(seq, F.explode(F.array("_a", "_b")).alias("_h")).groupBy("_h").agg(F.min(seq).alias("_first"))
        ok = d.where("_a <> _b")
        a, b = keys.select(F.col("_h").alias("_a"), F.col("_first").alias("_fa")), keys.select(F.col("_h").alias("_b"), F.col("_first").alias("_fb"))
        return ok.join(a, "_a").join(b, "_b").where((F.col(seq) == F.col("_fa")) & (F.col(seq) == F.col("_fb"))).select(*df.columns)
    # equal texts have equal bare forms, so the first of a bare form is the first of its text too
    d = d.withColumn("_b", F.coalesce("_b", F.lit("")))
    return _firsts(d, "_b", seq).select(*df.columns)


def _firsts(d: DataFrame, by: str, seq: str) -> DataFrame:
    """Rows of the least seq of each key. The least is found by partial aggregation and joined back on key and seq, so a key that most rows share is no hot task."""
    return d.join(d.groupBy(by).agg(F.min(seq).alias(seq)), [by, seq], "left_semi")


def context_key(*cols: str) -> F.Column:
    return F.concat_ws("\1", *[F.coalesce(c, F.lit("")) for c in cols])


COUNTERS = 1 << 13


def similar_pairs(df: DataFrame, key: str, text: str, context: tuple[str, ...], least: float) -> DataFrame:
    """Pairs of one context whose sets of character pairs and Latin words have a Jaccard similarity of at least `least`: key_a, key_b, similarity.

    Candidates meet in a rare element: with elements ordered by frequency, two sets of similarity s share one among the first
    n - ceil(s n) + 1 of each. Frequencies come from COUNTERS hashed counters over all rows (one row, that is broadcast whatever the
    data); they only set an order. Candidates also meet by size band: sizes of similar sets differ by less than 1 / s, so a row meets its
    own band and the one below. So no context is paired with itself as a whole, and an element that many rows share is in few prefixes.
    """
    toks = t.let(t.bare_form(text), lambda bare: F.array_distinct(F.concat(t.grams(bare, 2), F.regexp_extract_all(bare, F.lit("[a-zA-Z]+"), F.lit(0)))))
    rows = df.select(F.col(key).alias("k"), context_key(*context).alias("c"), F.transform(toks, lambda x: F.xxhash64(x)).alias("s")).where(F.size("s") > 0)
    rows = written(rows)
    slot = lambda x: F.pmod(x, F.lit(COUNTERS)).cast("int")
    counts = rows.select(F.explode("s").alias("e")).groupBy(slot(F.col("e")).alias("i")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(COUNTERS).select(F.col("id").cast("int").alias("i")).join(counts, "i", "left").select(F.struct("i", F.least(F.coalesce("n", F.lit(0)), F.lit((1 << 31) - 1)).cast("int").alias("n")).alias("z"))
    table = every.agg(F.transform(F.array_sort(F.collect_list("z")), lambda z: z["n"]).alias("_f"))  # one row of COUNTERS counts, read by place
    by_rarity = F.transform(F.array_sort(F.transform("s", lambda x: F.struct(F.get("_f", slot(x)).alias("n"), x.alias("x")))), lambda z: z["x"])
    prefix = F.slice("o", F.lit(1), (F.size("s") - F.ceil(F.size("s") * least).cast("int") + 1))
    band = F.floor(F.log(F.size("s").cast("double")) / math.log(1 / least) + 1e-9).cast("int")
    post = written(rows.crossJoin(F.broadcast(table)).select("k", "c", "s", by_rarity.alias("o")).select("k", "c", F.explode(prefix).alias("e"), F.size("s").alias("n"), band.alias("b")))
    a = post.select(F.col("k").alias("ka"), "c", "e", F.col("n").alias("na"), F.explode(F.array(F.col("b"), F.col("b") - 1)).alias("b"))
    b = post.select(F.col("k").alias("kb"), "c", "e", F.col("n").alias("nb"), "b")
    fits = (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("kb") < F.col("ka")))
    cand = a.join(b, ["c", "e", "b"]).where(fits & (F.col("nb") >= F.col("na") * least)).select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b")).distinct()
    sa, sb = rows.select(F.col("k").alias("key_a"), F.col("s").alias("sa")), rows.select(F.col("k").alias("key_b"), F.col("s").alias("sb"))
    return cand.join(sa, "key_a").join(sb, "key_b").select("key_a", "key_b", t.jaccard(F.col("sa"), F.col("sb")).alias("similarity")).where(F.col("similarity") >= least)


def greedy(df: DataFrame, key: str, text: str, seq: str, context: tuple[str, ...] = CONTEXT, least: float = 0.88) -> DataFrame:
    """Semantic deduplication, first wins: a row is dropped if a kept earlier row of its context is similar. Equal seq: the smaller key is earlier.

    Decided in rounds over the edges of similar_pairs, without any group in one task: rows that no undecided earlier row is similar to
    are kept, the rows similar to those are dropped, and both leave with their edges, until no edge is left. Returns the kept keys;
    rows with an empty bare form are kept.
    """
    pairs = similar_pairs(df, key, text, context, least)
    order = df.select(F.col(key).alias("k"), F.struct(F.col(seq).alias("q"), F.col(key).alias("k")).alias("o"))
    p = pairs.join(order.withColumnsRenamed({"k": "key_a", "o": "oa"}), "key_a").join(order.withColumnsRenamed({"k": "key_b", "o": "ob"}), "key_b")
    first = F.col("oa") < F.col("ob")
    edges = written(p.select(F.when(first, F.col("key_a")).otherwise(F.col("key_b")).alias("early"), F.when(first, F.col("key_b")).otherwise(F.col("key_a")).alias("late")))
    dropped = None
    while not edges.isEmpty():
        roots = edges.select("early").distinct().join(edges.select(F.col("late").alias("early")).distinct(), "early", "left_anti")
        gone = written(edges.join(roots, "early", "left_semi").select(F.col("late").alias("gone")).distinct())
        edges = written(edges.join(gone.withColumnRenamed("gone", "early"), "early", "left_anti").join(gone.withColumnRenamed("gone", "late"), "late", "left_anti"))
        dropped = gone if dropped is None else dropped.unionByName(gone)
    kept = df.select(key)
    return kept if dropped is None else kept.join(dropped.withColumnRenamed("gone", key), key, "left_anti")


def near(a: str, b: str, sa: set, sb: set, ratio: float = 0.52) -> bool:
    """The incremental test: lengths within 55 percent, shingles overlapping by 12, matching characters by `ratio` (its upper bounds first)."""
    if abs(len(a) - len(b)) > 0.55 * max(len(a), len(b), 1):
        return False
    if sa and sb and len(sa & sb) < 0.12 * len(sa | sb):
        return False
    m = difflib.SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= ratio and m.quick_ratio() >= ratio and m.ratio() >= ratio


def shingle_set(s: str) -> set[str]:
    return set(s) if len(s) <= 6 else {s[i : i + 3] for i in range(len(s) - 2)}


class Kept:
    """The kept forms of a context, found by their shingles: a form that shares none with another can't be near it."""

    def __init__(self) -> None:
        self.forms: list[tuple[str, set[str]]] = []
        self.by: dict[str, list[int]] = {}

    def near(self, f: str, s: set[str], ratio: float) -> bool:
        seen = {i for x in s for i in self.by.get(x, ())}
        return any(near(f, *self.forms[i][:1], s, self.forms[i][1], ratio) for i in sorted(seen))

    def add(self, f: str, s: set[str]) -> None:
        for x in s:
            self.by.setdefault(x, []).append(len(self.forms))
        self.forms.append((f, s))


def incremental(df: DataFrame, key: str, text: str, seq: str, context: tuple[str, ...] = CONTEXT, ratio: float = 0.52, retry: bool = True) -> DataFrame:
    """Keys kept by the order-dependent near-duplicate filter: a row is dropped if its form was kept before, in any context, or if it is near a form kept before in its own context. Empty forms are kept.

    Inside a context the filter is a sequence by definition (one pass per context, in order, in the memory of its kept forms, which are
    found by shingles). Contexts depend on each other only through forms that stand in several of them: all contexts are decided side by
    side; where a form was dropped as near in one, its next row in another is tried, and the contexts that this touches are decided
    again, until nothing changes. retry=False leaves that out: only the first row of each form is tried.
    """
    rows = df.select(F.col(key).alias("k"), F.col(seq).alias("q"), context_key(*context).alias("c"), F.coalesce(t.dedup_form(text), F.lit("")).alias("f"))
    kind = df.schema[key].dataType.simpleString()
    full = rows.where("f <> ''")
    # one row per form and context: what is near for the first is near for all, and what is kept drops all others
    each = full.groupBy("c", "f").agg(F.min(F.struct("q", "k")).alias("m")).select("m.k", "m.q", "c", "f")
    many = each.groupBy("f").agg(F.count("*").alias("n")).where("n > 1").select("f")
    schema = f"k {kind}, f string, c string, kept boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, kept = None, Kept()
        for pdf in batches:
            out = []
            for k, c, f in zip(pdf["k"], pdf["c"], pdf["f"]):
                if c != now:
                    now, kept = c, Kept()
                s = shingle_set(f)
                ok = not kept.near(f, s, ratio)
                if ok:
                    kept.add(f, s)
                out.append((k, f, c, ok))
            yield pd.DataFrame(out, columns=["k", "f", "c", "kept"])

    def decided(tried: DataFrame) -> DataFrame:
        return written(tried.repartition("c").sortWithinPartitions("c", "q", "k").select("k", "c", "f").mapInPandas(run, schema))

    first = each.groupBy("f").agg(F.min(F.struct("q", "k", "c")).alias("m")).select("f", F.col("m.c").alias("c"))
    tried = written(each.join(first, ["f", "c"], "left_semi"))
    got = decided(tried)
    while retry:
        # of the forms in several contexts: rows up to the first kept one are tried
        state = each.join(many, "f", "left_semi").join(got.select("f", "c", "kept"), ["f", "c"], "left")
        upto = state.groupBy("f").agg(F.min(F.when(F.col("kept"), F.struct("q", "k"))).alias("stop"), F.max(F.when(F.col("kept").isNotNull(), F.struct("q", "k"))).alias("seen"))
        next_ = state.where("kept is null").groupBy("f").agg(F.min(F.struct("q", "k")).alias("next"))
        wish = state.join(upto, "f").join(next_, "f", "left").where(
            F.when(F.col("stop").isNotNull(), F.struct("q", "k") <= F.col("stop")).otherwise(F.col("kept").isNotNull() | (F.struct("q", "k") == F.col("next")))
        ).select("k", "q", "c", "f")
        alone = each.join(many, "f", "left_anti").select("k", "q", "c", "f")
        now = written(wish.unionByName(alone))
        changed = written(now.join(tried, ["f", "c"], "left_anti").select("c").unionByName(tried.join(now, ["f", "c"], "left_anti").select("c")).distinct())
        if changed.isEmpty():
            break
        again = decided(now.join(changed, "c", "left_semi"))
        got = written(got.join(changed, "c", "left_anti").unionByName(again))
        tried = now
    return got.where("kept").select(F.col("k").alias(key)).unionByName(rows.where("f = ''").select(F.col("k").alias(key)))
