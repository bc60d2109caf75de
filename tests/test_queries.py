"""Every registered query of the core on the smallest tables, against its SQL where it has one."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from oracle import SF, database, same  # noqa: E402

from voxloom.plans import catalog  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, con, name):
    same(spark, con, catalog.QUERIES[name], catalog.ORACLES[name])


# What must hold of the queries that SQL can't express.
POOL, DOCS, SCORED = "(select count(*) from llm_children_100k_asr_complete)", "(select count(*) from documents)", "(select count(*) from eval where asr_hypo is not null)"
SIZES = {"normalized_texts": POOL, "truncated_texts": POOL, "error_rate_texts": POOL, "text_tn": POOL, "generated_text_ids": POOL, "adult_text_ids": POOL, "estimated_durations": POOL, "html_forms": DOCS, "cer_operations": SCORED, "wer_operations": SCORED, "eval_items": SCORED, "masked_rows": "(select count(*) from embeddings)", "task_list": f"{POOL} // 10", "quota_accept": "100"}
HOLDS = {
    "cer_operations": lambda r: min(r["s"], r["i"], r["d"]) >= 0 and r["s"] + r["d"] <= r["n"] and (r["cer"] is None or abs(r["cer"] * r["n"] - r["s"] - r["i"] - r["d"]) < 1e-9),
    "wer_operations": lambda r: min(r["s"], r["i"], r["d"]) >= 0 and r["s"] + r["d"] <= r["n"],
    "eval_items": lambda r: r["reference_chars"] == len(r["ref_normalized"]) or not r["ref_normalized"],
    "masked_rows": lambda r: len(r["inputs"]) == len(r["labels"]) and all(y == -100 or x == -1 for x, y in zip(r["inputs"], r["labels"])),
    "diverse_sample": lambda r: 1 <= r["pick"] <= 5,
    "quota_accept": lambda r: 1 <= r["pick"] <= 100,
    "estimated_durations": lambda r: r["weight"] is None or r["weight"] >= 0 and r["seconds"] >= 0,
    "normalized_texts": lambda r: r["strict"] is None or r["strict"] == r["strict"].strip(),
    "text_chunks": lambda r: r["chunk"].strip() == r["chunk"] != "",
    "generated_text_ids": lambda r: r["text_id"].startswith("gen_") and len(r["text_id"]) == 20,
    "adult_text_ids": lambda r: r["text_id"].startswith("adult_") and len(r["text_id"]) == 22,
    "normalization_examples": lambda r: r["kind"].isupper(),
    "normalization_audit": lambda r: r["rows"] >= r["changed"] >= r["empty"] and r["unstable"] == 0,
    "filtered_texts": lambda r: bool(r["text_tn"]) and r["n_tags"] >= 0,
    "eval_validity": lambda r: r["n"] > 0,
    "parsed_instructs": lambda r: not (r["instruct"] and r["error"]),
    "error_rate_texts": lambda r: r["by_character"] is None or " " not in r["by_character"][1::2].replace(" ", ""),
}
UNIQUE = {"dedup_semantic": ["id"], "dedup_incremental": ["seq"], "stream_near_duplicates": ["k", "q"], "quota_accept": ["seq"], "diverse_sample": ["ref_audio", "pick"], "text_chunks": ["doc_id", "pos"], "task_list": ["task_id"], "filtered_texts": ["seq"]}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_invariants(spark, con, name):
    rows = catalog.QUERIES[name](spark, SF).collect()
    assert rows
    if name in SIZES:
        assert len(rows) == con.execute(f"select {SIZES[name]}").fetchone()[0]
    if name in UNIQUE:
        assert len({tuple(r[c] for c in UNIQUE[name]) for r in rows}) == len(rows)
    assert all(map(HOLDS.get(name, lambda r: True), rows))


def test_every_query_without_sql_has_an_invariant():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) <= set(SIZES) | set(HOLDS) | set(UNIQUE)


def test_dedup_keeps_a_subset(spark, con):
    kept = {r["seq"] for r in catalog.QUERIES["dedup_incremental"](spark, SF).collect()}
    exact = {r[0] for r in con.execute(catalog.ORACLES["dedup_exact"]).fetchall()}
    assert kept and len(kept - exact) <= len(kept) * 0.02  # a form that was dropped as near may come from a later row
    stream = {r["q"] for r in catalog.QUERIES["stream_near_duplicates"](spark, SF).collect()}
    assert len(stream ^ kept) <= 0.05 * len(kept)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns and set(e.oracle_sql()) <= set(e.queries())
