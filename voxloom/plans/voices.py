"""Queries over instructions, languages, hooks and training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import voices as vo
from ..operators import models as m
from ..operators import quality as q
from ..session import spread, table
from .quality import _COMPLETE, _FITS, _PHONETIC, _TAGS, _strip, _s
from .registry import query

POOL = "llm_children_100k_asr_complete"


# Codes and names of the languages of the tables.
LANGUAGES = (("zh", "Chinese"), ("en", "English"), ("es", "Spanish"), ("fr", "French"), ("de", "German"), ("ja", "Japanese"), ("ko", "Korean"))


@query(f"""WITH l(id, name) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in LANGUAGES)})
SELECT value, coalesce((SELECT id FROM l WHERE id = value), (SELECT min(id) FROM l WHERE lower(name) = lower(value))) AS resolved, n FROM (SELECT language AS value, count(*) AS n FROM {POOL} GROUP BY 1)""")
def resolve_names(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the pool by code, else by name without case, else null."""
    dim = spark.createDataFrame(LANGUAGES, "language_id string, language_name string")
    vals = table(spark, d, POOL, "language").groupBy(F.col("language").alias("value")).agg(F.count("*").alias("n"))
    return vo.resolved(vals, "value", dim).select("value", "resolved", "n")


@query()
def parsed_instructs(spark: SparkSession, d: str) -> DataFrame:
    """Voice instructions read from the texts of the voice prompts, however their source is spelled."""
    df = table(spark, d, "documents", "doc_id", "text", "source").where(F.regexp_replace(F.lower(F.trim("source")), "-", "_") == "voice_design_prompts")
    raw = F.regexp_extract("text", r"(?m)^[^:\n]{0,20}: ((?:[a-z -]+, )+[a-z -]+)", 1)
    return df.select("doc_id", vo.parsed_instruct(raw, vo.has_han("text")).alias("i")).select("doc_id", "i.*")


@query()
def truncated_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut to their length type (X11)."""
    return spread(table(spark, d, POOL, "seq", "text", "length_type")).select("seq", vo.truncated("text", "length_type").alias("text"))


_W = r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{3000}-\x{303f}]"


@query(f"SELECT seq, {_strip(f'''regexp_replace(regexp_replace(regexp_replace(text, {_s(f'({_W}){chr(92)}s+')}, {_s(chr(92) + '1')}, 'g'), {_s(f'{chr(92)}s+({_W})')}, {_s(chr(92) + '1')}, 'g'), {_s(chr(92) + 's+')}, ' ', 'g')''')} AS text FROM {POOL}")
def cjk_spaces(spark: SparkSession, d: str) -> DataFrame:
    """Blanks beside Chinese and Japanese characters removed."""
    return table(spark, d, POOL, "seq", "text").select("seq", vo.cjk_spaces("text").alias("text"))


@query()
def error_rate_texts(spark: SparkSession, d: str) -> DataFrame:
    """Forms for error rates by language, by character and in Cantonese."""
    lang = F.regexp_extract(F.lower(F.trim("language")), "^[a-z]{2}", 0)
    return spread(table(spark, d, POOL, "seq", "text", F.nullif(lang, F.lit("")).alias("language"))).select("seq", vo.error_rate_forms("text", "language").alias("f")).select("seq", "f.*")


@query()
def text_tn(spark: SparkSession, d: str) -> DataFrame:
    """The normalized transcript of every text: its tags spoken, then the safe form; null where nothing is left."""
    return spread(q.with_text_tn(table(spark, d, POOL, "seq", "text", "language", "lang_type"))).select("seq", "text_tn")


@query()
def filtered_texts(spark: SparkSession, d: str) -> DataFrame:
    """The composite filter's rows as they are handed on, with their transcripts."""
    df = table(spark, d, POOL, "seq", "text", "lang_type", "length_type", "scenario", "subscene", "age_tier", "language")
    return q.with_text_tn(q.passed(df)).select("seq", "text", "text_tn", "n_tags", "issues", "length_mismatch")


_U = f"(len(regexp_extract_all(regexp_replace(text, {_s(t.ANY_TAG)}, '', 'g'), {_s(t.HAN)})) + len(regexp_extract_all(regexp_replace(text, {_s(t.ANY_TAG)}, '', 'g'), '[A-Za-z]+')))"


_ADULT = f"""SELECT seq, len({_TAGS}) AS n_tags FROM (SELECT * REPLACE ({_strip('text')} AS text, coalesce(length_type, 'medium') AS length_type) FROM {POOL}) WHERE text <> '' AND NOT ({' OR '.join(f'contains(lower(text), {_s(x)})' for x in q.ADULT_MARKERS)})
AND NOT ({' OR '.join(f'contains(text, {_s(x)})' for x in q.CHILD_WORDS)}) AND lang_type IN ({', '.join(map(_s, t.LANG_TYPES))}) AND {_FITS} AND {_COMPLETE} AND NOT {_PHONETIC} AND len({_TAGS}) <= 4
AND {_U} BETWEEN 0.35 * CASE length_type {' '.join(f"WHEN '{k}' THEN {v[0]}" for k, v in q.ADULT_BOUNDS.items())} ELSE 0 END AND 1.5 * CASE length_type {' '.join(f"WHEN '{k}' THEN {v[1]}" for k, v in q.ADULT_BOUNDS.items())} ELSE 9999 END + 10"""


@query(_ADULT)
def adult_filter(spark: SparkSession, d: str) -> DataFrame:
    """The filter variant for adult texts: other bounds, no child words."""
    return q.adult(table(spark, d, POOL, "seq", "text", "lang_type", "length_type")).select("seq", F.size(t.tags("text")).alias("n_tags"))


@query(f"SELECT a.n AS passed, b.n - a.n AS rejected FROM (SELECT count(*) AS n FROM ({_ADULT})) a, (SELECT count(*) AS n FROM {POOL}) b")
def adult_counts(spark: SparkSession, d: str) -> DataFrame:
    """Texts that the variant for adult texts passes and rejects."""
    df = table(spark, d, POOL, "seq", "text", "lang_type", "length_type")
    return q.adult(df).agg(F.count("*").alias("passed")).crossJoin(F.broadcast(df.agg(F.count("*").alias("_n")))).select("passed", (F.col("_n") - F.col("passed")).alias("rejected"))


_LANG = "regexp_extract(replace(lower(trim(lang)), '-', '_'), '^[^_]*', 0)"


@query(f"""WITH s AS (SELECT doc_id, CASE {_LANG} WHEN 'en' THEN 0 WHEN 'zh' THEN 1 END AS source_no FROM documents WHERE {_LANG} IN ('en', 'zh')),
r AS (SELECT *, row_number() OVER (PARTITION BY source_no ORDER BY md5(doc_id::VARCHAR), doc_id) AS n FROM s)
SELECT doc_id, source_no, round((n - 0.5) / CASE source_no WHEN 0 THEN 0.7 ELSE 0.3 END, 6) AS place FROM r""")
def multiplexed(spark: SparkSession, d: str) -> DataFrame:
    """Two sources, however their language is spelled, in one weighted order; every row keeps its place."""
    lang = F.regexp_extract(F.regexp_replace(F.lower(F.trim("lang")), "-", "_"), "^[^_]*", 0)
    df = table(spark, d, "documents", "doc_id", "lang").withColumn("lang", lang)
    return m.multiplexed([(df.where("lang = 'en'").select("doc_id"), 0.7), (df.where("lang = 'zh'").select("doc_id"), 0.3)], "doc_id").select("doc_id", "source_no", F.round("place", 6).alias("place"))


@query()
def masked_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows with a prompt and a masked rest."""
    df = table(spark, d, "embeddings", "vec_id", "embedding").select("vec_id", F.transform("embedding", lambda x: F.floor(x * 100).cast("int")).alias("ids"))
    return m.masked(df, "vec_id", "ids", (0.0, 0.3), (0.2, 0.8), -1)


@query("SELECT e.vec_id AS query_id, round(list_cosine_similarity(e.embedding::DOUBLE[], f.embedding::DOUBLE[]), 6) AS similarity FROM embeddings e LEFT JOIN embeddings f ON f.vec_id = e.vec_id + 1")
def pair_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct vector embedded once, pairs joined to it twice (H1, H2)."""
    df = table(spark, d, "embeddings", "vec_id", "embedding")
    pairs = df.select(F.col("vec_id").alias("query_id"), (F.col("vec_id") + 1).alias("other"))
    return m.similarities(pairs, df, "query_id", "other", "vec_id").select("query_id", F.round("similarity", 6).alias("similarity"))


@query("SELECT seq, length(text)::DOUBLE AS score, NULL AS error FROM llm_children_100k_asr_complete")
def hooked_scores(spark: SparkSession, d: str) -> DataFrame:
    """A plug-in model over the pool; a test double that counts characters."""
    return m.scored(table(spark, d, POOL, "seq", "text"), "seq", ["text"], lambda: lambda pdf: [float(len(x)) for x in pdf["text"]], "score").select("seq", "score", "error")
