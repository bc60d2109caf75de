"""Voice prompts count however their source is spelled."""

from voxloom.plans import catalog


def test_respelled_sources(spark, tmp_path):
    spelled = ["voice_design_prompts", "VOICE_DESIGN_PROMPTS", "voice-design-prompts", " voice_design_prompts ", "other", None]
    spark.createDataFrame([(i, "Voice: male, indian accent", s) for i, s in enumerate(spelled)], "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.QUERIES["parsed_instructs"](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {0, 1, 2, 3} and len({tuple(r)[1:] for r in got}) == 1
