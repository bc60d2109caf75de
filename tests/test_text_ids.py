"""Text ids of generated and adult texts against Python's json and hashlib, every row."""

import hashlib
import json
import os

import pytest

from voxloom.operators import contracts
from voxloom.plans import catalog

SF = "/root/testdata/sf0.01"
POOL = "llm_children_100k_asr_complete"


def _id(prefix, identity):
    return prefix + hashlib.md5(json.dumps(identity, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:16]


def _generated(r):
    return _id("gen_", {"text": r["text"], "lang_type": r["lang_type"], "length_type": r["length_type"], "scenario": r["scenario"] or None, "subscene": r["subscene"], "task_id": r["task_id"]})


def _adult(r):
    return _id("adult_", {"text": r["text"], "lang_type": r["lang_type"], "scenario": r["scenario"], "task_id": r["task_id"], "age_tier": "adult"})


def test_ids_of_hard_texts(spark):
    texts = [None, "", 'say "hi" \\ now', "行一\n行二\t\r\b\f", "".join(map(chr, range(32))), "\x7f\x85  é 😀 \\n", "\\\n\\\\\n\""]
    rows = [(i, x, "zh", "short", ["a", "", None][i % 3], None, [None, 7, -(1 << 60)][i % 3]) for i, x in enumerate(texts)]
    rows += [(100, "same", "zh", "short", "a", "b", 1), (101, "same", "zh", "short", "a", "b", 2)]
    df = spark.createDataFrame(rows, "seq int, text string, lang_type string, length_type string, scenario string, subscene string, task_id bigint")
    want = {r["seq"]: r for r in df.collect()}
    got, adult = contracts.generated_ids(df).collect(), contracts.adult_ids(df).collect()
    assert {r["seq"]: r["text_id"] for r in got} == {k: _generated(r) for k, r in want.items()} and len({r["text_id"] for r in got}) == len(rows)
    assert {r["seq"]: r["text_id"] for r in adult} == {k: _adult(r) for k, r in want.items()}
    with pytest.raises(Exception, match="no canonical JSON"):
        df.selectExpr("1.5D AS x").select(contracts.canonical_json(["x"])).collect()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name, one", [("generated_text_ids", _generated), ("adult_text_ids", _adult)])
def test_every_row_has_its_id(spark, name, one):
    pool = {r["seq"]: r for r in spark.read.parquet(f"{SF}/{POOL}.parquet").collect()}
    got = {r["seq"]: r for r in catalog.QUERIES[name](spark, SF).collect()}
    assert got.keys() == pool.keys() and all(got[k]["text_id"] == one(r) and got[k]["id"] == r["id"] for k, r in pool.items())
