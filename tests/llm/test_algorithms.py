"""Ranking, percentiles, quota sampling, near-duplicates, mixing against brute force on small inputs."""

import bisect
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import mixing, neardup, quantiles, quota, ranking
from voxloom.llm.common import letters, units

# ---- problem 1


def test_average_ranks(spark):
    rnd = random.Random(1)
    rows = [(str(i), rnd.choice([0.0, 0.0, 0.0, None, float("nan"), rnd.random()]), rnd.choice([None, -1.0, 2.0])) for i in range(500)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k string, a double, b double, rank string")
    got = {r["k"]: r for r in ranking.average_ranks(df, "k", ["a", "b"]).collect()}
    assert len(got) == 500
    for c, name in ((1, "a"), (2, "b")):
        vals = sorted(r[c] for r in rows if r[c] is not None and not math.isnan(r[c]))
        for r in rows:
            x = r[c]
            if x is None or math.isnan(x):
                assert got[r[0]][f"r_{name}"] is None
            else:
                lo, hi = bisect.bisect_left(vals, x), bisect.bisect_right(vals, x)
                assert got[r[0]][f"r_{name}"] == (lo + 1 + hi) / 2


def test_ranking_ignores_scale_and_follows_directions(spark):
    rnd = random.Random(2)
    q = [rnd.random() for _ in range(300)]
    rows = [(str(i), 1 - x + rnd.random() / 5, 1000 * (x + rnd.random() / 5), x + rnd.random() / 5) for i, x in enumerate(q)]
    df = spark.createDataFrame(rows, "k string, cer double, sim double, mos double")
    dirs = {"cer": -1, "sim": 1, "mos": 1}
    pos = {r["k"]: r["position"] for r in ranking.rank_items(df, "k", dirs).collect()}
    bent = df.withColumn("sim", F.exp(F.col("sim") / 500)).withColumn("cer", F.col("cer") * 1e6)
    assert pos == {r["k"]: r["position"] for r in ranking.rank_items(bent, "k", dirs).collect()}
    best = sorted(range(300), key=lambda i: pos[str(i)])[:30]
    assert sum(q[i] for i in best) / 30 > 0.85
    load, _, corr = ranking.principal(ranking.average_ranks(df, "k", list(dirs)), dirs)
    assert min(load.values()) > 0 and corr.shape == (3, 3)


def test_ranking_edge_cases(spark):
    empty = spark.createDataFrame([], "k string, a double, b double")
    assert ranking.rank_items(empty, "k", {"a": 1, "b": 1}).count() == 0
    df = spark.createDataFrame([("x", 1.0, None), ("y", 1.0, None), ("z", None, None)], "k string, a double, b double")
    assert {r["position"] for r in ranking.rank_items(df, "k", {"a": 1, "b": 1}).collect()} == {1}  # constant scores: all tie


def test_clip_scores_take_the_latest_usable_row(spark):
    a = spark.createDataFrame([("w", 1, 0.1), ("w", 2, 0.2), ("w", 3, float("nan")), ("v", 1, None), (None, 1, 0.3)], "wav string, arrived_at int, cer double")
    b = spark.createDataFrame([("w", 1, 0.5, 1), ("u", 1, 0.5, 2), ("u", 1, 0.6, 2)], "cloned_audio string, arrived_at int, similarity double, score_version int")
    c = spark.createDataFrame([("t", None, 3.0), ("t", 1, 2.0)], "cloned_audio string, arrived_at int, utmos double")
    got = {r["wav"]: tuple(r)[1:] for r in ranking.clip_scores(a, b, c).collect()}
    assert got == {"w": (0.2, 0.0, None), "v": (None, None, None), "u": (None, 0.6, None), "t": (None, None, 2.0)}


@pytest.mark.parametrize("ranges", [(2, 2), (16, 16), (200, 200)])
def test_ranks_by_any_number_of_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(ranking, "RANGES", ranges)
    rnd = random.Random(12)
    rows = [(i, rnd.choice([0.0, -0.0, 0.0, 5.0, None, rnd.random(), float("inf")])) for i in range(900)] + [(None, 0.5)]
    df = spark.createDataFrame(rows, "k int, a double")
    vals = sorted(x + 0.0 for k, x in rows if k is not None and x is not None and x < 9)
    for method in ("average", "min"):
        got = {r["k"]: r["r_a"] for r in ranking.ranked(df, "k", ["a"], method).collect()}
        for k, x in rows[:-1]:
            lo, hi = (bisect.bisect_left(vals, x), bisect.bisect_right(vals, x)) if x is not None and x < 9 else (None, None)
            assert got.pop(k) == (None if lo is None else lo + 1 if method == "min" else (lo + 1 + hi) / 2)
        assert not got


def test_no_loading_points_against_its_direction(spark):
    rnd = random.Random(13)
    rows = [(i, rnd.random(), (q := rnd.random()), q + rnd.random() / 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, noise double, a double, b double")
    for d in (1, -1):
        dirs = {"noise": d, "a": 1, "b": 1}
        load = {r["score"]: r["loading"] for r in ranking.loadings(df, "k", dirs).collect()}
        assert 0 <= load["noise"] < 0.2 and load["a"] == pytest.approx(load["b"], abs=0.05) and sum(v * v for v in load.values()) == pytest.approx(1)
    bare = ranking.loadings(df.select("k", "a", (-F.col("b")).alias("b")), "k", {"a": 1, "b": -1}).collect()
    assert [r["loading"] for r in bare] == pytest.approx([2**-0.5] * 2)


# ---- problem 5


@pytest.mark.parametrize("n", [0, 1, 10, 5000])
def test_summary_bound(n):
    rnd = random.Random(n)
    vals = [rnd.choice([0.0, rnd.random(), rnd.gauss(0, 9)]) for _ in range(n)]
    s = quantiles.Summary(32, 4)
    for k in range(0, n, 77):
        part = quantiles.Summary(32, 4)
        part.add(np.array(vals[k : k + 77]))
        s.merge(*part.row())
    assert s.n == n
    order = sorted(vals)
    for q, v in zip(quantiles.LEVELS, s.quantiles(quantiles.LEVELS) if n else ()):
        ask = max(1, math.ceil(q * n))
        assert bisect.bisect_left(order, v) + 1 - s.error() <= ask <= bisect.bisect_right(order, v) + s.error()
    assert n < 32 and s.error() == 0 or n > 32 and s.error() < 0.2 * n


def test_size_keeps_an_asked_error():
    rnd = np.random.default_rng(5)
    for epsilon in (0.05, 0.01, 0.003):
        n = 60_000
        size = quantiles.size_for(epsilon, n)
        s = quantiles.Summary(size)
        for part in np.array_split(rnd.normal(size=n), 37):
            one = quantiles.Summary(size)
            one.add(part)
            s.merge(*one.row())
        assert s.error() <= epsilon * n and size < n
    assert quantiles.size_for(0.01, 10) <= 64


def test_daily_partials_join(spark):
    rows = [("a" if i % 3 else None, f"d{i % 5}", float(i)) for i in range(3000)] + [("a", "d0", None), ("a", "d0", float("nan")), ("b", "d0", float("inf"))]
    df = spark.createDataFrame(rows, "g string, d string, value double").repartition(6)
    day = quantiles.daily(df, "value", {"g": F.col("g")}, F.col("d"))
    assert {(r["g"], r["day"]) for r in day.collect()} == {(g, f"d{k}") for g in ("a", None) for k in range(5)}
    got = {(r["g"], r["q"]): r for r in quantiles.percentiles(day, ["g"]).collect()}
    assert got["a", 0.5]["n"] == 2000 and abs(got["a", 0.5]["value"] - 1500) < 1500 * 0.05
    assert quantiles.percentiles(day.limit(0), ["g"]).count() == 0


# ---- problem 6


def test_allocation_moves_to_siblings_then_cousins():
    t = [(("a", "x"), 2500, 1), (("a", "y"), 2500, 1), (("b", "x"), 2500, 1), (("b", "y"), 2500, 1)]
    assert quota.allocate(t, {k: 100 for k, _, _ in t}, 40) == {k: 10 for k, _, _ in t}
    short = quota.allocate(t, {("a", "x"): 2, ("a", "y"): 100, ("b", "x"): 100, ("b", "y"): 100}, 40)
    assert short == {("a", "x"): 2, ("a", "y"): 18, ("b", "x"): 10, ("b", "y"): 10}  # the sibling first
    cousins = quota.allocate(t, {("a", "x"): 2, ("a", "y"): 3, ("b", "x"): 100, ("b", "y"): 100}, 40)
    assert cousins[("a", "y")] == 3 and cousins[("b", "x")] + cousins[("b", "y")] == 35
    assert quota.allocate([], {}, 5) == {} and sum(quota.allocate(t, {}, 5).values()) == 0


def test_sampler(spark):
    rnd = random.Random(3)
    rows = [(f"i{k}", rnd.choice(["A ", "a", "b"]), rnd.choice(["x-y", "X_Y"]), k) for k in range(1000)]
    rows += [rows[0], (None, "a", "x_y", 1), ("i9999", None, "x_y", 2), ("i9998", "other", "x_y", 2)]
    pool = spark.createDataFrame(rows, "id string, f string, g string, need int")
    targets = spark.createDataFrame([("a", "x_y", 4000, 1), ("b", "x_y", 5900, 1), ("c", "x_y", 100, 3)], "f string, g string, target_per_10000 int, min_rows int")
    s = quota.Sampler(pool, targets, "id", ("f", "g"))
    assert s.size == 1002 // 5
    drawn = s.sample().collect()
    assert len(drawn) == s.size and len({r["id"] for r in drawn}) == s.size and {r["f"] for r in drawn} == {"a", "b"}
    rep = {r["f"]: r for r in s.report().collect()}
    assert not rep["c"]["met"] and rep["c"]["need"] == 3 and rep["a"]["drawn"] + rep["b"]["drawn"] == s.size
    none = quota.Sampler(pool.limit(0), targets, "id", ("f", "g"))
    assert none.sample().count() == 0 and none.report().where("met").count() == 0


# ---- problem 7


def _brute(rows, least=30):
    sets = {k: {s[i : i + 3] for i in range(len(s) - 2)} for k, t in rows if t and units(t) >= least and (s := letters(t))}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}


def test_near_duplicates_lose_no_link(spark, monkeypatch):
    rnd = random.Random(7)
    alphabet = "一二三四五六七八九十天地玄黄宇宙洪荒日月盈昃"
    base = ["".join(rnd.choices(alphabet, k=rnd.randrange(30, 90))) for _ in range(12)]
    rows = []
    for i in range(150):
        s = list(rnd.choice(base))
        for _ in range(rnd.randrange(0, 14)):
            at = rnd.randrange(len(s))
            s[at : at + rnd.randrange(2)] = rnd.choice(alphabet)
        rows.append((f"k{i:03d}", "".join(s), i))
    rows += [("k000", rows[0][1], 900), ("z1", None, 1), ("z2", "", 2), ("z3", "短", 3), (None, rows[0][1], 4), ("copy", "[sigh]" + rows[1][1] + "！", 5), ("long", "长" * 20000 + base[0], 6)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id string, text string, seq int, keys string")
    want = _brute(dict((k, t) for k, t, _ in rows if k).items())
    assert len(want) > 100
    n = neardup.NearDuplicates(df, "id", "text", "seq")
    assert {(r["id_a"], r["id_b"]) for r in n.pairs().collect()} == want
    groups = {r["id"]: r["group_id"] for r in n.groups().collect()}
    parent = {k: k for k in groups}
    for _ in range(len(groups)):
        for a, b in want:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert groups == parent
    assert neardup.NearDuplicates(df.limit(0), "id", "text").pairs().count() == 0


def test_shingles_are_exact():
    a, b = neardup.shingles("Ab c1!"), neardup.shingles("abc1")
    assert (a == b).all() and len(a) == 2 and len(neardup.shingles("ab")) == 0
    x = neardup.shingles("".join(map(chr, range(0x4E00, 0x4E50))))
    assert 0 < np.bitwise_count(neardup.bitmap(x)).sum() <= len(x)


def test_hot_elements_are_split(spark):
    # tiles of one element, split over slices, give the same pairs
    rows = [(f"k{i}", "共同的开头文字" * 5 + "".join(random.Random(i).choices("甲乙丙丁戊己庚辛", k=20)), i) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, text string, seq int")
    n = neardup.NearDuplicates(df, "id", "text", "seq")
    assert {(r["id_a"], r["id_b"]) for r in n.pairs().collect()} == _brute([(k, t) for k, t, _ in rows])
    counts = spark.sparkContext.broadcast(neardup.frequencies(n.classes) * 10_000)  # every element counts as hot
    again = neardup._verified(neardup._candidates(neardup._postings(n.classes, counts, 1, 2), 1, 2), n.classes, 1, 2)
    assert {tuple(sorted(r[:2])) for r in again.collect()} == {tuple(sorted(r[:2])) for r in n.links.collect()}


def test_copies_are_paired_by_slices(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SLICE", 7)
    rows = [(f"k{i:02d}", "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少" * 2, i) for i in range(40)]
    n = neardup.NearDuplicates(spark.createDataFrame(rows, "id string, text string, seq int"), "id", "text", "seq")
    got = [(r["id_a"], r["id_b"]) for r in n.pairs().collect()]
    assert sorted(got) == sorted(itertools.combinations([k for k, _, _ in rows], 2))
    assert {(r["group_id"], r["copies"], r["links"]) for r in n.groups().collect()} == {("k00", 40, 0)}


def test_components_of_long_chains(spark):
    rnd = random.Random(14)
    names = rnd.sample(range(1000), 300)
    edges = list(zip(names[:200], names[1:200])) + list(zip(names[200:], names[201:]))
    got = {r["did"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: min(part) for part in (names[:200], names[200:]) for x in part}


# ---- problem 9


def test_rake_reaches_sources_and_marginals():
    cells = {("a", "en", "t"): 100, ("a", "zh", "t"): 100, ("b", "en", "u"): 50, ("b", "zh", "t"): 50}
    w = mixing.rake(cells, {"a": 0.5, "b": 0.5}, {"a": 9, "b": 9}, 300, ({"en": 0.6, "zh": 0.4}, None))
    tok = lambda f: sum(n * w[k] for k, n in cells.items() if f(k))
    assert tok(lambda k: k[0] == "a") == pytest.approx(150) and tok(lambda k: k[0] == "b") == pytest.approx(150)
    assert tok(lambda k: k[1] == "en") == pytest.approx(180, rel=1e-3)
    capped = mixing.rake(cells, {"a": 0.5, "b": 0.5}, {"a": 9, "b": 1}, 300)
    assert sum(n * capped[k] for k, n in cells.items() if k[0] == "b") == pytest.approx(100)


def test_mix(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(["red", "green", "house"], k=rnd.randrange(1, 40))), rnd.choice(["big", "BIG ", "mid-one"]) if i % 10 else "small", rnd.choice(["en", None]), None) for i in range(400)]
    rows += [(1000, None, "small", "en", None), (1001, "", None, None, None), (1002, "alone text", None, None, None), (rows[5][0], *rows[5][1:])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, source string, lang string, scenario string, tokens int")
    targets = spark.createDataFrame([("big", 0.3, 2), ("mid_one", 0.3, 2), ("small", 0.3, 2), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    m = mixing.Mix(df, targets)
    fill = {r["source"]: r for r in m.fill().collect()}
    assert not fill["small"]["reached"] and not fill["absent"]["reached"] and fill["big"]["reached"] and fill["absent"]["tokens"] == 0
    got = m.sample().collect()
    assert len({r["doc_id"] for r in got}) == len(got) and max(r["copies"] for r in got) <= 2
    rep = {r["source"]: r for r in m.report().collect()}
    assert rep["small"]["drawn_tokens"] == 2 * fill["small"]["tokens"] and abs(rep["big"]["drawn_tokens"] / fill["big"]["target_tokens"] - 1) < 0.25
    assert mixing.Mix(df.limit(0), targets).sample().count() == 0
