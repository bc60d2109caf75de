"""Problem 9: mixing sources to target weights, by iterative proportional fitting.

Tokens are counted per cell of source, language and topic. The cells' weights (mean copies per document) are raked to the source
targets (target share x the tokens of all documents), and to language and topic marginals, in turns that end with the sources; a cell's
weight never exceeds the cap of its source. The last step of a turn gives each source its target (what capped cells leave goes to the
others of the source), so language and topic come as near to their marginals as sources and caps let them; marginals() sets the reached
shares beside those asked for. A source falls short if, after raking, its weighted tokens are less than its target: all its cells stand
at the cap then. What it leaves isn't given to others, whose shares of the budget would then be wrong; it is reported as unfilled.

Documents are drawn with calibrated probabilities, systematically: the whole part of the weight as sure copies, and one more wherever
the cumulated rests, in the order of the documents' sizes within a source, pass a whole number. So the drawn tokens of a source differ
from its weighted ones by about one document, where independent draws would differ by the root of their number. Positions are offsets of
size classes, cells and SALTS slices plus a rank inside them: no source is sorted in one task.

Sources are compared after trimming, lower-casing and reading - as _; each id counts once; null ids, and sources that no target
names, are not mixed (their tokens still count into the total); null and empty texts have no tokens. If marginals name some labels of
an axis, the others are one label, other, on that axis. No label is dropped or folded otherwise: up to DRIVER_CELLS cells the driver rakes
them (as arrays), beyond that the same steps run over the table of cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import folded, written
from .tokens import VOCABULARY, count_tokens

DRIVER_CELLS = 200_000
SALTS = 16
ROUNDS = 60
CLOSE = 1e-9  # relative difference that counts as reached
CORPUS = "corpus"  # a marginal: the token shares of the whole corpus
Cell = tuple[str, str, str]


def _to_source(s: np.ndarray, n: np.ndarray, w: np.ndarray, want: np.ndarray, cap: np.ndarray) -> None:
    """Scales the weights of each source to its wanted tokens; what capped cells leave goes to its other cells, until it fits."""
    left, free, top = want.copy(), np.ones(len(w), bool), cap[s]
    while free.any():
        mass = np.bincount(s, n * w * free, len(want))
        f = np.divide(left, mass, out=np.zeros_like(left), where=mass > 0)[s]
        full = free & (w * f >= top)
        # sources without a full cell fit as they are scaled now; the others hand on what their full cells leave
        fits = free & (np.bincount(s, full, len(want)) == 0)[s]
        w[fits] *= f[fits]
        w[full] = top[full]
        left = np.maximum(left - np.bincount(s, n * w * full, len(want)), 0)
        free &= ~full & ~fits


def rake(cells: dict[Cell, int], share: dict[str, float], cap: dict[str, float], total: int, marginals: tuple[dict[str, float] | None, dict[str, float] | None] = (None, None), rounds: int = ROUNDS) -> dict[Cell, float]:
    """Copies per document of each cell. marginals: shares by language and by topic; None keeps those that the targets imply under equal weights inside a source."""
    keys = [k for k, n in cells.items() if n > 0 and k[0] in share]
    if not keys:
        return {}
    n = np.array([cells[k] for k in keys], float)
    names = [sorted({k[axis] for k in keys}) for axis in range(3)]
    place = [{x: i for i, x in enumerate(v)} for v in names]
    codes = [np.array([place[axis][k[axis]] for k in keys]) for axis in range(3)]
    s = codes[0]
    want, most = np.array([share[x] * total for x in names[0]]), np.array([cap[x] for x in names[0]], float)
    own = np.bincount(s, n, len(want))
    reach = np.minimum(want, most * own)
    w = (reach / own)[s]
    goals = []
    for axis, given in zip((1, 2), marginals):
        size = len(names[axis])
        goals.append((codes[axis], size, np.bincount(codes[axis], n * w, size) if given is None else np.array([given.get(x, 0.0) for x in names[axis]]) * reach.sum()))
    for _ in range(rounds):
        worst = 0.0
        for code, size, goal in goals:
            mass = np.bincount(code, n * w, size)
            f = np.divide(goal, mass, out=np.ones(size), where=mass > 0)
            worst = max(worst, float(np.abs(f - 1).max()))
            w = np.minimum(w * f[code], most[s])
        _to_source(s, n, w, want, most)
        if worst < CLOSE:
            break
    return dict(zip(keys, map(float, w)))


def rake_table(cells: DataFrame, share: dict[str, float], cap: dict[str, float], total: int, marginals: tuple = (None, None), rounds: int = ROUNDS) -> DataFrame:
    """rake() over a table of cells (_s, _l, _t, n) of any size: _s, _l, _t, n, _w. marginals: per axis None, or a table (label, share). Only one number a round and the rows of the sources reach the driver."""
    spark = cells.sparkSession
    plan = spark.createDataFrame([(s, float(share[s] * total), float(cap[s])) for s in share], "_s string, want double, top double")  # as many as there are targets
    c = cells.where("n > 0").join(F.broadcast(plan), "_s")
    own = c.groupBy("_s", "want", "top").agg(F.sum("n").alias("own")).select("_s", F.least("want", F.col("top") * F.col("own")).alias("reach"), "own")
    reach = sum(r["reach"] for r in own.collect())  # as many as there are targets
    c = written(c.join(F.broadcast(own), "_s").select("_s", "_l", "_t", "n", "want", "top", (F.col("reach") / F.col("own")).alias("_w")))
    goals = []
    for axis, given in zip(("_l", "_t"), marginals):
        goal = c.groupBy(axis).agg(F.sum(F.col("n") * F.col("_w")).alias("goal")) if given is None else given.select(F.col("label").alias(axis), (F.col("share") * reach).alias("goal"))
        goals.append((axis, written(goal)))
    for _ in range(rounds):
        worst = 0.0
        for axis, goal in goals:
            f = c.groupBy(axis).agg(F.sum(F.col("n") * F.col("_w")).alias("mass")).join(goal, axis, "left").select(axis, F.when(F.col("mass") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("mass")).otherwise(F.lit(1.0)).alias("f"))
            f = written(f)
            worst = max(worst, f.agg(F.max(F.abs(F.col("f") - 1))).first()[0] or 0.0)
            c = c.join(f, axis).withColumn("_w", F.least(F.col("_w") * F.col("f"), "top")).drop("f")
        c = written(c.withColumn("free", F.lit(True)).withColumn("left", F.col("want")))
        while True:
            mass = F.broadcast(c.where("free").groupBy("_s").agg(F.sum(F.col("n") * F.col("_w")).alias("mass")))  # as many as there are targets
            step = c.join(mass, "_s", "left").withColumn("f", F.when(F.col("mass") > 0, F.col("left") / F.col("mass")).otherwise(F.lit(0.0))).withColumn("full", F.col("free") & (F.col("_w") * F.col("f") >= F.col("top")))
            gone = F.broadcast(step.groupBy("_s").agg(F.sum(F.when(F.col("full"), F.col("n") * F.col("top")).otherwise(F.lit(0.0))).alias("gone"), F.count_if("full").alias("fulls")))
            step = step.join(gone, "_s")
            w = F.when(F.col("full"), F.col("top")).when(F.col("free") & (F.col("fulls") == 0), F.col("_w") * F.col("f")).otherwise(F.col("_w"))
            c = written(step.select("_s", "_l", "_t", "n", "want", "top", w.alias("_w"), (F.col("free") & ~F.col("full") & (F.col("fulls") > 0)).alias("free"), F.greatest(F.lit(0.0), F.col("left") - F.col("gone")).alias("left")))
            if c.where("free").isEmpty():
                break
        c = c.drop("free", "left")
        if worst < CLOSE:
            break
    return c.select("_s", "_l", "_t", "n", "_w")


def _shares(table: DataFrame, axis: str, mass: Column, name: str) -> DataFrame:
    """The share of each label of an axis."""
    per = table.groupBy(F.col(axis).alias("label")).agg(F.sum(mass).alias("m"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("m").alias("all")))).select("label", F.when(F.col("all") > 0, F.col("m") / F.col("all")).otherwise(F.lit(0.0)).alias(name))


class Mix:
    """One corpus against one table of targets (source, target_share, max_repeats)."""

    def __init__(self, df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", language: str = "lang", topic: str = "scenario", vocabulary: str = VOCABULARY, marginals=(None, None), seed: int = 0):
        """marginals: shares by language and by topic; CORPUS takes those of the whole corpus, None leaves them to the source targets (one factor per source)."""
        self.key, self.seed, self.targets, self.given = key, seed, targets, [self._with_rest(m) if isinstance(m, dict) else m for m in marginals]
        label = lambda c: F.coalesce(F.regexp_extract(folded(c), "^[^_]*", 0), F.lit(""))
        rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), folded(source).alias("_s"), label(language).alias("_l"), F.coalesce(folded(topic), F.lit("")).alias("_t"), F.col(text).alias("_x"))
        counted = count_tokens(rows, "_k", "_x", vocabulary, "_n", ("_s", "_l", "_t")).groupBy("_k").agg(F.min(F.struct("_s", "_l", "_t", "_n")).alias("_d"))
        spark = df.sparkSession
        plan = targets.where(F.col("source").isNotNull()).select(folded("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("double")).collect()  # as many as there are sources
        self.share, self.cap = {s: a or 0.0 for s, a, _ in plan}, {s: c or 0.0 for s, _, c in plan}
        known = F.when(F.col("_d._s").isin(list(self.share)), F.col("_d._s"))
        axis = lambda c, m: F.when(F.col(f"_d.{c}").isin(list(m)), F.col(f"_d.{c}")).otherwise(F.lit("other")) if isinstance(m, dict) else F.col(f"_d.{c}")
        self.docs = written(counted.select("_k", known.alias("_s"), axis("_l", self.given[0]).alias("_l"), axis("_t", self.given[1]).alias("_t"), F.col("_d._n").alias("_n")))
        self.cells = written(self.docs.groupBy("_s", "_l", "_t").agg(F.sum("_n").alias("n")))
        self.tokens = {s: n for s, n in self.cells.groupBy("_s").agg(F.sum("n")).collect()}  # as many as there are targets, and one
        self.total = sum(self.tokens.values())
        self.wide = self.cells.count() > DRIVER_CELLS
        if self.wide:
            asked = tuple(_shares(self.cells, c, F.col("n"), "share") if m == CORPUS else self._frame(m) if m else None for c, m in zip(("_l", "_t"), self.given))
            self.table = written(rake_table(self.cells, self.share, self.cap, self.total, asked))
            self.weights = None
        else:
            cells = {(s, l_, t): n for s, l_, t, n in self.cells.collect()}
            asked = tuple(self._of_corpus(cells, k) if m == CORPUS else m for k, m in zip((1, 2), self.given))
            self.weights = rake(cells, self.share, self.cap, self.total, asked)
            self.table = F.broadcast(spark.createDataFrame([(*k, cells[k], w) for k, w in self.weights.items()], "_s string, _l string, _t string, n bigint, _w double"))  # DRIVER_CELLS rows at most
        self.reached = {s: m for s, m in self.table.groupBy("_s").agg(F.sum(F.col("n") * F.col("_w"))).collect()}

    @staticmethod
    def _with_rest(given: dict[str, float]) -> dict[str, float]:
        """The given shares, with what they leave of 1 as the share of 'other', the label of all that they don't name."""
        return given | {"other": given.get("other", 0.0) + max(0.0, 1.0 - sum(given.values()))}

    def _frame(self, given: dict[str, float]) -> DataFrame:
        return self.targets.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], "label string, share double")

    def _of_corpus(self, cells: dict, axis: int) -> dict[str, float]:
        out: dict[str, float] = {}
        for k, n in cells.items():
            out[k[axis]] = out.get(k[axis], 0.0) + (n / self.total if self.total else 0.0)
        return out

    def marginals(self) -> DataFrame:
        """Each label of each axis: the corpus's share of tokens, the share asked for (null if none was), that of the mix by its weights."""
        parts = []
        for c, name, m in zip(("_l", "_t"), ("language", "topic"), self.given):
            have = _shares(self.cells, c, F.col("n"), "corpus_share").join(_shares(self.table, c, F.col("n") * F.col("_w"), "reached_share"), "label", "full")
            if isinstance(m, dict):
                have = have.join(F.broadcast(self._frame(m).withColumnRenamed("share", "asked_share")), "label", "full")
            else:
                have = have.withColumn("asked_share", F.col("corpus_share") if m == CORPUS else F.lit(None).cast("double"))
            parts.append(have.select(F.lit(name).alias("axis"), "label", *[F.coalesce(x, F.lit(0.0)).alias(x) for x in ("corpus_share", "reached_share")], (F.coalesce("asked_share", F.lit(0.0)) if m else F.col("asked_share")).alias("asked_share")))
        return parts[0].unionByName(parts[1]).select("axis", "label", "corpus_share", "asked_share", "reached_share")

    def sample(self) -> DataFrame:
        """key, source, tokens and copies (at least 1) of the drawn documents."""
        cell, unit = ["_s", "_l", "_t"], float(1 << 40)
        rows = self.docs.where("_n > 0").join(self.table.select(*cell, "_w"), cell).withColumn("_f", F.col("_w") - F.floor("_w"))
        rows = rows.withColumn("_b", F.floor(F.log2("_n") * 8).cast("int")).withColumn("_h", F.xxhash64(F.lit(self.seed), "_k")).withColumn("_salt", F.pmod("_h", F.lit(SALTS)).cast("int"))
        group = ["_s", "_b", "_l", "_t", "_salt"]
        sums = rows.groupBy(*group).agg(F.sum("_f").alias("_m"))
        before = lambda w: F.coalesce(F.sum("_m").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
        classes = sums.groupBy("_s", "_b").agg(F.sum("_m").alias("_m")).select("_s", "_b", before(W.partitionBy("_s").orderBy("_b")).alias("_o1"))
        offsets = sums.select(*group, before(W.partitionBy("_s", "_b").orderBy("_l", "_t", "_salt")).alias("_o2")).join(F.broadcast(classes), ["_s", "_b"])  # sources x size classes
        start = F.pmod(F.xxhash64(F.lit(self.seed), "_s"), F.lit(1 << 40)) / F.lit(unit)
        rank = F.row_number().over(W.partitionBy(*group).orderBy("_n", "_h", "_k"))
        placed = rows.withColumn("_r", rank).join(offsets, group).withColumn("_at", start + F.col("_o1") + F.col("_o2") + F.col("_r") * F.col("_f"))
        extra = (F.floor(F.round("_at", 6)) > F.floor(F.round(F.col("_at") - F.col("_f"), 6))).cast("int")
        copies = (F.floor("_w") + extra).cast("int").alias("copies")
        return placed.select(F.col("_k").alias(self.key), F.col("_s").alias("source"), F.col("_n").alias("tokens"), copies).where("copies > 0")

    def _short(self, s: str) -> bool:
        """Whether raking left the source below its target. Where the two agree up to rounding, the products themselves are compared."""
        want, got = self.share[s] * self.total, self.reached.get(s, 0.0)
        if abs(got - want) > CLOSE * want:
            return got < want
        return self.cap[s] * self.tokens.get(s, 0) < want

    def fill(self) -> DataFrame:
        """Each target source: its tokens, target tokens, the tokens that its raked weights reach, and whether they are enough."""
        rows = [(s, self.tokens.get(s, 0), self.share[s] * self.total, float(self.reached.get(s, 0.0)), not self._short(s)) for s in self.share]
        got = self.targets.sparkSession.createDataFrame(rows, "_s string, tokens bigint, target_tokens double, raked_tokens double, reached boolean").coalesce(1)
        return self.targets.select("source", "target_share", "max_repeats", folded("source").alias("_s")).join(F.broadcast(got), "_s").drop("_s")

    def report(self) -> DataFrame:
        """fill() beside what was drawn: documents, copies, tokens, their share of the budget (to be compared with target_share) and of the mix, and the tokens that the source can't fill."""
        drawn = self.sample().groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("drawn_tokens"))
        out = self.fill().withColumn("_s", folded("source")).join(F.broadcast(drawn), "_s", "left").drop("_s").fillna(0, ["documents", "copies", "drawn_tokens"])
        whole = out.agg(F.sum("drawn_tokens").alias("_all"))
        part = lambda whole: F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(F.lit(0.0))
        out = out.crossJoin(F.broadcast(whole)).withColumn("budget_share", part(F.lit(float(self.total)))).withColumn("actual_share", part(F.col("_all"))).drop("_all")
        return out.withColumn("unfilled_tokens", F.when(F.col("reached"), 0.0).otherwise(F.col("target_tokens") - F.col("raked_tokens")))
