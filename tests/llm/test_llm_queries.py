"""The queries of this subpackage on the smallest tables, against SQL where there is some."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from oracle import SF, database, same  # noqa: E402

from voxloom.llm import lookalike  # noqa: E402
from voxloom.llm.oracles import ORACLES  # noqa: E402
from voxloom.llm.queries import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    same(spark, database(), QUERIES[name], ORACLES[name])


def _rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_ranking(spark):
    rows = _rows(spark, "p1_ranking")
    clips = database().execute("select count(*) from (select wav from eval union select cloned_audio from sim union select cloned_audio from mos) where wav is not null").fetchone()[0]
    assert len(rows) == len({r["wav"] for r in rows}) == clips
    by = sorted(rows, key=lambda r: -r["projection"])
    assert [r["position"] for r in by] == [1 + sum(x["projection"] > r["projection"] for x in rows) for r in by]


def test_lines_and_languages(spark):
    con, pool = database(), "llm_children_100k_asr_complete"
    n = con.execute(f"select count(*) from {pool}").fetchone()[0]
    lines = _rows(spark, "p2_lines")
    assert len(lines) == n and all(0 <= r["loss_share"] <= 1 and sum(r["failed"].values()) <= r["n_lines"] for r in lines) and {r["seq"] for r in _rows(spark, "p2_found")} <= {r["seq"] for r in lines if r["rejected"]}
    langs = {r["seq"]: r for r in _rows(spark, "p3_languages")}
    parts = {}
    for r in _rows(spark, "p3_segments"):
        parts.setdefault(r["seq"], {}).setdefault(r["lang"], []).append(r["units"])
    assert len(langs) == n and all(0 <= r["confidence"] <= 1 for r in langs.values())
    assert all(r["main"] is None and k not in parts or sum(parts[k][r["main"]]) == max(map(sum, parts[k].values())) for k, r in langs.items())
    found = {(r["seq"], r["language"]) for r in _rows(spark, "p3_found")}
    assert found == {(k, r["main"]) for k, r in langs.items() if r["main"] and r["label"] != r["main"]}


def test_unified(spark):
    n, differ = database().execute("select count(*), count(distinct case when gen_text <> asr_hypo then wav end) from eval").fetchone()
    rows = _rows(spark, "p4_unified")
    assert len(rows) == n and len(_rows(spark, "p4_found")) <= differ and all(lookalike.unify(r["gen_text"]) == r["gen_text"] for r in rows)


def test_percentiles(spark):
    days, whole = _rows(spark, "p5_daily"), _rows(spark, "p5_percentiles")
    n = {}
    for r in days:
        n[r["metric"], r["dataset"]] = n.get((r["metric"], r["dataset"]), 0) + r["n"]
    assert {(r["metric"], r["dataset"]): r["n"] for r in whole} == n
    for k in n:
        values = [r["value"] for r in sorted(whole, key=lambda r: r["q"]) if (r["metric"], r["dataset"]) == k]
        assert values == sorted(values) and len(values) == 9


def test_sample_follows_targets(spark):
    report, rows = _rows(spark, "p6_report"), _rows(spark, "p6_sample")
    ids = database().execute("select count(distinct id) from llm_children_100k_asr_complete").fetchone()[0]
    assert len(rows) == len({r["id"] for r in rows}) == sum(r["drawn"] for r in report)
    short = {tuple(r)[:3] for r in report if not r["met"]}
    assert short == {tuple(r) for r in _rows(spark, "p6_found")}
    assert all(r["drawn"] == min(r["quota"], r["available"]) and (r["met"] or r["drawn"] == r["available"]) for r in report)
    least = {tuple(r[:3]): r[3] for r in database().execute("select age_tier, length_type, lang_type, min_rows from sample_targets").fetchall()}
    assert all(r["drawn"] >= min(least[tuple(r)[:3]], r["available"]) for r in report)
    assert len(rows) == max(ids // 5, sum(min(least[tuple(r)[:3]], r["available"]) for r in report))  # minima come before the size


def test_groups(spark):
    group = {r["id"]: r["group_id"] for r in _rows(spark, "p7_groups")}
    pairs = [tuple(r) for r in _rows(spark, "p7_found")]
    assert all(group[a] == group[b] for a, b in pairs) and len({x for p in pairs for x in p}) == sum(1 for k, g in group.items() if sum(h == g for h in group.values()) > 1)


def test_ids_and_mix(spark):
    n, ids = database().execute("select count(*), count(distinct doc_id) from documents").fetchone()
    tokens = {r["doc_id"]: len(r["ids"]) for r in _rows(spark, "p8_ids")}
    assert len(_rows(spark, "p8_ids")) == n and len(tokens) == ids
    mix, report = _rows(spark, "p9_sample"), {r["source"]: r for r in _rows(spark, "p9_report")}
    caps = {r["source"]: r["max_repeats"] for r in report.values()}
    assert all(r["tokens"] == tokens[r["doc_id"]] and 1 <= r["copies"] <= caps[r["source"]] for r in mix)
    longest = {}
    for r in mix:
        longest[r["source"]] = max(longest.get(r["source"], 0), r["tokens"])
    for s, r in report.items():
        if r["reached"]:  # within two per cent or two of the longest documents
            assert abs(r["drawn_tokens"] - r["target_tokens"]) <= max(0.02 * r["target_tokens"], 2 * longest[s])
        else:
            assert r["drawn_tokens"] == r["tokens"] * r["max_repeats"]
    assert {s for s, r in report.items() if not r["reached"]} == {r["source"] for r in _rows(spark, "p9_found")}
    assert all(abs(sum(r["reached_share"] for r in _rows(spark, "p9_marginals") if r["axis"] == a) - 1) < 1e-9 for a in ("language", "topic"))


def test_restored(spark):
    rows = _rows(spark, "p10_restored")
    texts = dict(database().execute("select doc_id, text from documents").fetchall())
    assert len(rows) == len(texts) and all(r["restored"] is None or r["restored"] != texts[r["doc_id"]] for r in rows)
    assert {r["doc_id"] for r in rows if r["found"]} == {r["doc_id"] for r in _rows(spark, "p10_found")}
    assert all(r["found"] for r in rows if "\ufffd" in (texts[r["doc_id"]] or ""))
