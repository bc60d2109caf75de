"""Marginals of the mix: weights differ inside a source, sources are exact under caps, reached shares are reported."""

import random

import pytest

from voxloom.llm import mixing


def test_sources_are_exact_when_cells_are_capped():
    cells = {("a", "en", "t"): 960, ("a", "zh", "t"): 10, ("b", "en", "t"): 500, ("b", "zh", "t"): 500}
    share, cap = {"a": 0.6, "b": 0.4}, {"a": 1.2, "b": 5}
    w = mixing.rake(cells, share, cap, 1970, ({"en": 0.5, "zh": 0.5}, None))
    for s, want in (("a", min(0.6 * 1970, 1.2 * 970)), ("b", 0.4 * 1970)):
        assert sum(n * w[k] for k, n in cells.items() if k[0] == s) == pytest.approx(want)
    assert all(x <= cap[k[0]] + 1e-9 for k, x in w.items())


def test_corpus_marginals_move_weights_inside_a_source(spark):
    text = "red green house " * 4
    rows = [(i, text, "a" if i < 200 else "b", "en" if i % 4 or i >= 200 else "zh", "x" if i % 3 else "y") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, scenario string")
    targets = spark.createDataFrame([("a", 0.2, 5), ("b", 0.8, 5)], "source string, target_share double, max_repeats int")
    m = mixing.Mix(df, targets, marginals=(mixing.CORPUS, mixing.CORPUS))
    assert len({round(w, 9) for k, w in m.weights.items() if k[0] == "a"}) > 1
    got = {(r["axis"], r["label"]): r for r in m.marginals().collect()}
    assert got["language", "zh"]["asked_share"] == pytest.approx(0.125) and got["language", "zh"]["reached_share"] == pytest.approx(0.125, rel=1e-6)
    plain = {(r["axis"], r["label"]): r for r in mixing.Mix(df, targets).marginals().collect()}
    assert plain["language", "zh"]["reached_share"] == pytest.approx(0.05) and plain["language", "zh"]["asked_share"] is None
    assert mixing.Mix(df.limit(0), targets, marginals=(mixing.CORPUS, mixing.CORPUS)).sample().count() == 0


def test_named_labels_keep_the_rest_as_other(spark):
    langs = ["en"] * 60 + ["fr"] * 20 + ["de"] * 20
    df = spark.createDataFrame([(i, "red green house", "a", x, None) for i, x in enumerate(langs)], "doc_id bigint, text string, source string, lang string, scenario string")
    targets = spark.createDataFrame([("a", 1.0, 9)], "source string, target_share double, max_repeats int")
    m = mixing.Mix(df, targets, marginals=({"fr": 0.5}, None))
    got = {r["label"]: r["reached_share"] for r in m.marginals().collect() if r["axis"] == "language"}
    assert got == pytest.approx({"fr": 0.5, "other": 0.5}) and all(w > 0 for w in m.weights.values())


def _corpus(spark, n=900, seed=11):
    rnd = random.Random(seed)
    rows = [(i, " ".join(["red"] * rnd.choice([3, 5, 8, 20, 60])), rnd.choice(["a", "A ", "b", "small", "extra"]) if i % 40 else "small", rnd.choice(["en", "zh", "fr"]), rnd.choice("xyz")) for i in range(n)]
    rows = [r if r[2] != "small" or r[0] % 40 == 0 else (*r[:2], "b", *r[3:]) for r in rows] + [(n, None, "a", None, None), (n + 1, "", None, "en", "x"), (None, "red", "a", "en", "x")]
    targets = spark.createDataFrame([("a", 0.3, 3), ("b", 0.4, 3), ("small", 0.2, 2), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, scenario string"), targets


def test_reachable_sources_meet_their_share_of_the_budget(spark):
    docs, targets = _corpus(spark)
    rep = {r["source"]: r for r in mixing.Mix(docs, targets, marginals=(mixing.CORPUS, mixing.CORPUS)).report().collect()}
    assert not rep["small"]["reached"] and not rep["none"]["reached"] and rep["small"]["copies"] == 2 * rep["small"]["documents"]
    for s in "ab":
        assert rep[s]["reached"] and abs(rep[s]["budget_share"] / rep[s]["target_share"] - 1) < 0.02 and rep[s]["unfilled_tokens"] == 0
    assert sum(r["actual_share"] for r in rep.values()) == pytest.approx(1) and rep["small"]["unfilled_tokens"] == pytest.approx(rep["small"]["target_tokens"] - rep["small"]["drawn_tokens"])


def test_any_number_of_cells_gives_the_same_weights(spark, monkeypatch):
    docs, targets = _corpus(spark, 120)
    for given in ((mixing.CORPUS, None), ({"en": 0.6}, None)):
        few = mixing.Mix(docs, targets, marginals=given)
        monkeypatch.setattr(mixing, "DRIVER_CELLS", 0)
        monkeypatch.setattr(mixing, "ROUNDS", 4)
        wide = mixing.Mix(docs, targets, marginals=given)
        monkeypatch.undo()
        assert wide.wide and not few.wide
        cells = {(r["_s"], r["_l"], r["_t"]): r["n"] for r in few.cells.collect()}
        asked = tuple(few._of_corpus(cells, k) if m == mixing.CORPUS else m for k, m in zip((1, 2), few.given))
        want = mixing.rake(cells, few.share, few.cap, few.total, asked)
        got = {tuple(r[:3]): r["_w"] for r in wide.table.collect()}
        assert got == pytest.approx(want, rel=1e-2) and wide.reached == pytest.approx(few.reached)
        assert {r["source"] for r in wide.fill().where("not reached").collect()} == {"small", "none"}


def test_cases_depend_on_the_raking(spark, monkeypatch):
    docs, targets = _corpus(spark)
    true = mixing.rake
    for bend, want in ((lambda k, w: w * 50, {"none"}), (lambda k, w: w / 2, {"a", "b", "small", "none"})):
        monkeypatch.setattr(mixing, "rake", lambda *a, **k: {c: bend(c, w) for c, w in true(*a, **k).items()})
        assert {r["source"] for r in mixing.Mix(docs, targets).fill().where("not reached").collect()} == want
