"""Queries over texts: rules of the quality filter, tag statistics, normalized forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import quality as q
from ..session import table
from .registry import query

POOL = "llm_children_100k_asr_complete"


def _s(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, {_s(f'^{t.WS}+|{t.WS}+$')}, '', 'g')"


def _bare(c: str) -> str:
    return f"regexp_replace({c}, {_s(t.ANY_TAG)}, '', 'g')"


def _n(c: str, p: str) -> str:
    return f"len(regexp_extract_all({c}, {_s(p)}))"


_TAGS = f"regexp_extract_all(text, {_s(t.VALID_TAG)}, 1)"
_HAN = _n(_bare("text"), t.HAN)
_WORDS = _n(_bare("text"), "[a-zA-Z]+")
_JOINED = _n(_bare("text"), "[A-Za-z]+(?:['-][A-Za-z]+)?")
_LO = "CASE length_type " + " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in t.LENGTH_BOUNDS.items()) + " ELSE 0 END"
_HI = "CASE length_type " + " ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in t.LENGTH_BOUNDS.items()) + " ELSE 999 END"
_FITS = f"""coalesce(CASE WHEN {_HAN} + {_JOINED} = 0 THEN false WHEN lang_type = 'pure_cn' THEN {_HAN} > 0 AND {_JOINED} = 0
WHEN lang_type = 'pure_en' THEN {_JOINED} > 0 AND {_HAN} = 0
WHEN lang_type = 'cn_mostly' THEN {_HAN} > 0 AND {_HAN} / ({_HAN} + {_JOINED}) >= 0.55
WHEN lang_type = 'en_mostly' THEN {_JOINED} > 0 AND {_JOINED} / ({_HAN} + {_JOINED}) >= 0.55
WHEN lang_type = 'frequent_mix' THEN {_HAN} > 0 AND {_JOINED} > 0 AND least({_HAN}, {_JOINED}) / ({_HAN} + {_JOINED}) >= 0.20 END, false)"""
_LOW = _strip(f"regexp_replace(lower({_strip(_bare('text'))}), {_s(t.CLOSERS)}, '')")
_COMPLETE = f"""({_strip(_bare('text'))} <> '' AND NOT (regexp_matches({_strip(_bare('text'))}, {_s(t.OPEN_END)})
OR {' OR '.join(f"ends_with({_LOW}, {_s(x)})" for x in t.UNFINISHED)} OR {' OR '.join(f"regexp_matches({_LOW}, {_s(p)})" for p in t.TRAILS)}))"""
_PHONETIC = f"({_strip(_bare('text'))} <> '' AND ({' OR '.join(f'regexp_matches({_bare('text')}, {_s(p)})' for p in t.PHONETIC)}))"
_CORRECTED = f"""regexp_replace(regexp_replace(regexp_replace(text, '[.]{{3,}}', '，', 'g'), '…+', '，', 'g'), '，{{2,}}', '，', 'g')"""
_CORRECTED = f"regexp_replace({_CORRECTED}, {_s(f'{t.WS}*{t.VALID_TAG}{t.WS}*')}, '[\\1] ', 'g')"
_CORRECTED = f"regexp_replace({_CORRECTED}, {_s(t.VALID_TAG + ' ([，。？！,.?!])')}, '[\\1]\\2', 'g')"
_CORRECTED = _strip(f"regexp_replace({_CORRECTED}, '  +', ' ', 'g')")
_DEDUP = f"""regexp_replace(regexp_replace(lower({_bare('text')}), '\\d+', '<num>', 'g'), {_s(rf"({t.WS}|[，。？！,.?!、；;：:\"“”‘’'\-—…~～()（）\[\]])+")}, '', 'g')"""
_MARKED = f"(regexp_matches({_bare('%s')}, {_s(t.CHILD_MARKERS)}) OR regexp_matches({_bare('%s')}, {_s(t.CHILD_PARTICLES)}))"
_READING = f"(coalesce(scenario, '') IN ({', '.join(map(_s, q.READING_SCENARIOS))}) OR {' OR '.join(f'contains(coalesce(subscene, {_s('')}), {_s(h)})' for h in q.READING_HINTS)})"
_UNITS = f"({_HAN} + {_WORDS})"
_SEVERE = f"""({_LO} > 0 AND ({_UNITS} < greatest(1, floor({_LO} * CASE WHEN {_READING} THEN 0.25 ELSE 0.35 END))
OR {_UNITS} > floor({_HI} * CASE WHEN {_READING} AND length_type IN ('medium', 'long', 'very_long') THEN 4.5 ELSE 3.0 END) + CASE WHEN {_READING} AND length_type IN ('medium', 'long', 'very_long') THEN 14 ELSE 10 END))"""
_BASE = "CASE length_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in t.LENGTH_MIN_TAGS.items()) + " ELSE 1 END"
_MIN_TAGS = f"""CASE WHEN {_READING} THEN CASE WHEN length_type IN ('medium', 'long', 'very_long') THEN 0 ELSE least({_BASE}, 1) END
WHEN scenario IN ({', '.join(map(_s, q.TAG_SCENARIOS))}) AND length_type <> 'ultra_short' THEN greatest({_BASE}, 1) ELSE {_BASE} END"""
_ISSUES = f"""((regexp_extract(text, {_s('^' + t.VALID_TAG)}, 1) NOT IN ('', {', '.join(map(_s, t.START_TAGS))}))::INT + {_n('substr(text, 1, 12)', r'\[laughter\]')}
+ {' + '.join(f"(list_contains({_TAGS}, '{a}') AND list_contains({_TAGS}, '{b}'))::INT" for a, b in t.TAG_CONFLICTS)}
+ {' + '.join(f"(len(list_distinct(list_filter({_TAGS}, lambda x: starts_with(x, '{f}')))) >= 3)::INT" for f in ('surprise-', 'question-'))})"""


@query(f"SELECT seq, {_HAN} AS han, {_WORDS} AS words, {_UNITS} AS units, {_UNITS} BETWEEN {_LO} AND {_HI} AS fits_length, {_FITS} AS fits_language FROM {POOL}")
def text_units(spark: SparkSession, d: str) -> DataFrame:
    """Units and the length and language predicates."""
    df = table(spark, d, POOL, "seq", "text", "length_type", "lang_type")
    return df.select("seq", t.han_count("text").alias("han"), t.word_count("text").alias("words"), t.speech_units("text").alias("units"), t.fits_length("text", "length_type").alias("fits_length"), t.fits_language("text", "lang_type").alias("fits_language"))


@query(f"""SELECT seq, len({_TAGS}) AS n_tags, len(list_filter(regexp_extract_all(text, '\\[([^\\]]+)\\]', 1), lambda x: x NOT IN ({', '.join(map(_s, t.TAGS))}))) AS n_unknown,
coalesce(list_max(list_transform(list_distinct({_TAGS}), lambda x: len(list_filter({_TAGS}, lambda y: y = x)))), 0) > 2 AS repeated, {_ISSUES} AS issues FROM {POOL}""")
def tag_rules(spark: SparkSession, d: str) -> DataFrame:
    """Tag validity, count, repetition, placement and conflicts."""
    df = table(spark, d, POOL, "seq", "text")
    return df.select("seq", F.size(t.tags("text")).alias("n_tags"), F.size(t.unknown_tags("text")).alias("n_unknown"), t.repeated_tag("text").alias("repeated"), (t.start_issues("text") + t.conflict_issues("text")).alias("issues"))


@query(f"SELECT seq, {_COMPLETE} AS complete, {_PHONETIC} AS phonetic, {_MARKED.replace('%s', 'text')} AS child, {_SEVERE} AS severe FROM {POOL}")
def utterance_rules(spark: SparkSession, d: str) -> DataFrame:
    """Completeness, phonetic markup, child markers, severe length mismatch."""
    df = table(spark, d, POOL, "seq", "text", "length_type", "scenario", "subscene")
    return df.select("seq", t.is_complete("text").alias("complete"), t.phonetic_markup("text").alias("phonetic"), t.child_markers("text").alias("child"), q.severe_length("text", "length_type", q.is_reading("scenario", "subscene")).alias("severe"))


@query(f"SELECT seq, {_CORRECTED} AS corrected, {_DEDUP} AS dedup_form FROM {POOL}")
def text_forms(spark: SparkSession, d: str) -> DataFrame:
    """Tag autocorrection and the form for duplicate checks."""
    return table(spark, d, POOL, "seq", "text").select("seq", t.autocorrected("text").alias("corrected"), t.dedup_form("text").alias("dedup_form"))


_REASON = f"""CASE WHEN coalesce({_strip('text')}, '') = '' THEN 'empty'
WHEN {' OR '.join(f'contains(lower(text), {_s(m)})' for m in q.BAD_MARKERS)} THEN 'bad_marker'
WHEN coalesce(lang_type, '') NOT IN ({', '.join(map(_s, t.LANG_TYPES))}) THEN 'lang_type'
WHEN NOT {_FITS} THEN 'language_content'
WHEN len(list_filter(regexp_extract_all(text, '\\[([^\\]]+)\\]', 1), lambda x: x NOT IN ({', '.join(map(_s, t.TAGS))}))) > 0 THEN 'invalid_tags'
WHEN NOT {_COMPLETE} THEN 'incomplete_asr' WHEN {_PHONETIC} THEN 'pinyin_phonetic' WHEN len({_TAGS}) > 4 THEN 'too_many_tags'
WHEN coalesce(list_max(list_transform(list_distinct({_TAGS}), lambda x: len(list_filter({_TAGS}, lambda y: y = x)))), 0) > 2 THEN 'repeat_tag'
WHEN {_SEVERE} THEN 'severe_length' WHEN len({_TAGS}) < {_MIN_TAGS} THEN 'too_few_tags'
WHEN coalesce(age_tier, '') = 'preschool' AND NOT {_MARKED.replace('%s', _CORRECTED)} THEN 'preschool_markers'
WHEN NOT regexp_matches(regexp_replace(regexp_replace(text, {_s(t.VALID_TAG)}, 'a', 'g'), '&[#A-Za-z0-9]+;', ' ', 'g'), '[\\p{{L}}\\p{{M}}\\p{{N}}%¥$€£°]') THEN 'no_text_tn'
WHEN {_ISSUES} > CASE WHEN {_READING} THEN 6 ELSE 5 END THEN 'validation_issues' ELSE 'pass' END"""
_TRIMMED = f"(SELECT * REPLACE ({_strip('text')} AS text, coalesce(length_type, 'medium') AS length_type) FROM {POOL})"


@query(f"SELECT {_REASON} AS reason, count(*) AS n FROM {_TRIMMED} GROUP BY 1")
def reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Histogram of the first failing rule."""
    return q.rejected(_pool(spark, d)).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"SELECT seq, {_CORRECTED} AS text, len({_TAGS}) AS n_tags, {_ISSUES} AS issues, NOT ({_UNITS} BETWEEN {_LO} AND {_HI}) AS length_mismatch FROM {_TRIMMED} WHERE {_REASON} = 'pass'")
def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    """The composite filter: rows that pass every rule, autocorrected and annotated."""
    return q.passed(_pool(spark, d)).select("seq", "text", "n_tags", "issues", "length_mismatch")


def _pool(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, POOL, "seq", "text", "lang_type", "length_type", "scenario", "subscene", "age_tier")


@query(f"""WITH x AS (SELECT coalesce(length_type, '') AS length_type, {_TAGS} AS tags FROM {POOL})
SELECT length_type, count(*) AS texts, count(*) FILTER (len(tags) > 0) AS tagged, round(count(*) FILTER (len(tags) > 0) / count(*), 6) AS coverage, round(avg(len(tags)), 6) AS per_text FROM x GROUP BY 1""")
def tag_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Tag coverage by length type."""
    n = F.size(t.tags("text"))
    df = table(spark, d, POOL, "text", "length_type").select(F.coalesce("length_type", F.lit("")).alias("length_type"), n.alias("n"))
    return df.groupBy("length_type").agg(F.count("*").alias("texts"), F.count_if(F.col("n") > 0).alias("tagged"), F.round(F.count_if(F.col("n") > 0) / F.count("*"), 6).alias("coverage"), F.round(F.avg("n"), 6).alias("per_text"))


@query(f"SELECT unnest({_TAGS}) AS tag, count(*) AS n FROM {POOL} GROUP BY 1")
def tag_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Distribution of tags."""
    return table(spark, d, POOL, "text").select(F.explode(t.tags("text")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


_FAMILY = "CASE emotion WHEN 'excited' THEN ['surprise-wa', 'laughter', 'surprise-yo'] WHEN 'happy' THEN ['laughter', 'surprise-wa', 'confirmation-en'] WHEN 'bored' THEN ['sigh'] ELSE [] END"


@query(f"""WITH x AS (SELECT emotion, unnest({_TAGS}) AS tag FROM {POOL} WHERE emotion IN ('excited', 'happy', 'bored'))
SELECT emotion, count(*) AS n_tags, count(*) FILTER (list_contains({_FAMILY}, tag)) AS matched, round(count(*) FILTER (list_contains({_FAMILY}, tag)) / count(*), 6) AS alignment FROM x GROUP BY 1""")
def emotion_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Share of an emotion's tags that its profile names (A15); profiles are a parameter."""
    return q.alignment(table(spark, d, POOL, "emotion", "text"), {"excited": ["surprise-wa", "laughter", "surprise-yo"], "happy": ["laughter", "surprise-wa", "confirmation-en"], "bored": ["sigh"]})


@query(f"SELECT coalesce(lang_type, '') AS lang_type, count(*) AS n, count(*) FILTER (NOT {_FITS}) AS mismatched FROM {POOL} GROUP BY 1")
def language_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Declared against actual language mix."""
    df = table(spark, d, POOL, "text", "lang_type").select(F.coalesce("lang_type", F.lit("")).alias("lang_type"), (~t.fits_language("text", "lang_type")).alias("off"))
    return df.groupBy("lang_type").agg(F.count("*").alias("n"), F.count_if("off").alias("mismatched"))


@query(f"""SELECT CASE WHEN grouping(age_tier) = 0 THEN 'age_tier' WHEN grouping(lang_type) = 0 THEN 'lang_type' WHEN grouping(length_type) = 0 THEN 'length_type' WHEN grouping(emotion) = 0 THEN 'emotion' ELSE 'scenario' END AS dimension,
coalesce(age_tier, lang_type, length_type, emotion, scenario, '') AS value, count(*) AS n FROM {POOL} GROUP BY GROUPING SETS ((age_tier), (lang_type), (length_type), (emotion), (scenario))""")
def qa_groups(spark: SparkSession, d: str) -> DataFrame:
    """Group counts of the QA report in one pass."""
    dims = ["age_tier", "lang_type", "length_type", "emotion", "scenario"]
    return q.group_counts(table(spark, d, POOL, *dims), dims)


_WARN = f"""WITH x AS (SELECT count(*) AS n, count(*) FILTER (NOT {_FITS}) / count(*) AS mismatch, count(*) FILTER (NOT ({_UNITS} BETWEEN {_LO} AND {_HI})) / count(*) AS lengths,
count(*) FILTER (len({_TAGS}) = 0) / count(*) AS untagged FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM {POOL}))
SELECT n, round(mismatch, 6) AS mismatch, round(lengths, 6) AS lengths, round(untagged, 6) AS untagged,
array_to_string(list_filter([CASE WHEN mismatch > 0.005 THEN 'language mismatch' END, CASE WHEN lengths > 0.01 THEN 'length mismatch' END, CASE WHEN untagged > 0.2 THEN 'few tags' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM x"""


@query(_WARN)
def qa_warnings(spark: SparkSession, d: str) -> DataFrame:
    """Rates of the QA report and its warnings above 0.5, 1 and 20 percent."""
    return q.warnings(table(spark, d, POOL, "text", "lang_type", "length_type"))


_SEEN = "regexp_replace(coalesce(text, ''), '\\[[^\\]]+\\]', ' ', 'g')"
_L, _K = f"lower({_strip('coalesce(language, %s)' % _s(''))})", f"lower({_strip('coalesce(lang_type, %s)' % _s(''))})"
_CJKP, _KINDS = _s(r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}\x{3040}-\x{30ff}]"), "('pure_en', 'pure_zh', 'pure_cn', 'cn_mostly', 'frequent_mix')"


@query(f"""SELECT seq, CASE WHEN {_L} IN ('en', 'eng') THEN 'en' WHEN {_L} IN ('zh', 'zho', 'cmn', 'cn') THEN 'zh' WHEN {_K} = 'pure_en' THEN 'en' WHEN {_K} IN {_KINDS} THEN 'zh'
WHEN regexp_matches({_SEEN}, {_CJKP}) THEN 'zh' WHEN regexp_matches({_SEEN}, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS tag_language,
CASE WHEN {_L} IN ('en', 'eng', 'zh', 'zho', 'cmn', 'cn') THEN 'language' WHEN {_K} IN {_KINDS} THEN 'lang_type' WHEN regexp_matches({_SEEN}, {_CJKP}) THEN 'text_cjk_fallback' WHEN regexp_matches({_SEEN}, '[A-Za-z]') THEN 'text_latin_fallback' ELSE 'unknown' END AS source FROM {POOL}""")
def tag_context(spark: SparkSession, d: str) -> DataFrame:
    """Language in which tags are spoken, with its source."""
    value, source = t.tag_language("text", "language", "lang_type")
    return table(spark, d, POOL, "seq", "text", "language", "lang_type").select("seq", value.alias("tag_language"), source.alias("source"))


def _say(words: dict[str, str]) -> str:
    out = "text"
    for k, v in words.items():
        out = f"replace({out}, '[{k}]', {_s(f' {v} ' if v else ' ')})"
    return out


@query(f"SELECT seq, {_strip(f'''regexp_replace(regexp_replace(CASE WHEN lang_type = {_s('pure_en')} THEN {_say(t.SPOKEN_EN)} ELSE {_say(t.SPOKEN_ZH)} END, {_s('[[]([A-Za-z0-9_-]+)[]]')}, {_s(' ⟦TAG:' + chr(92) + '1⟧ ')}, {_s('g')}), {_s(t.WS + '+')}, {_s(' ')}, {_s('g')})''')} AS spoken FROM {POOL}")
def spoken_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags as spoken words."""
    lang = F.when(F.col("lang_type") == "pure_en", "en").otherwise("zh")
    return table(spark, d, POOL, "seq", "text", "lang_type").select("seq", t.spoken_tags("text", lang).alias("spoken"))


@query(rf"""SELECT wav, {_strip(r"regexp_replace(lower(regexp_replace(gen_text, '[^\p{L}\p{M}\p{N}''\s]', '', 'g')), '\s+', ' ', 'g')")} AS words,
{_strip(f"regexp_replace(regexp_replace(gen_text, {_s(rf'[^\p{{L}}\p{{M}}\p{{N}}]|{t.WS}')}, '', 'g'), '(.)', '{chr(92)}1 ', 'g')")} AS characters,
{_strip("regexp_replace(regexp_replace(lower(translate(gen_text, '‘’', '''''')), '[^a-z0-9'']', ' ', 'g'), ' +', ' ', 'g')")} AS plain FROM eval""")
def error_rate_forms(spark: SparkSession, d: str) -> DataFrame:
    """Forms that word and character error rates compare."""
    return table(spark, d, "eval", "wav", "gen_text").select("wav", t.tts_text("gen_text").alias("words"), t.spaced_characters("gen_text").alias("characters"), t.plain_words("gen_text").alias("plain"))


_ST = _strip("text")


@query(rf"""SELECT seq, CASE WHEN {_ST} = '' THEN {_ST} WHEN regexp_matches({_ST}, '[.。!！?？…;；:：,，、)）\]】"”''’]$') THEN {_ST} WHEN regexp_matches({_ST}, {_s(t.HAN + '$')}) THEN {_ST} || '。' ELSE {_ST} || '.' END AS closed FROM {POOL}""")
def closing_mark(spark: SparkSession, d: str) -> DataFrame:
    """Missing closing punctuation added."""
    return table(spark, d, POOL, "seq", "text").select("seq", t.closed("text").alias("closed"))


_JOIN = f"translate(regexp_replace(concat_ws(' ', {_strip('coalesce(scenario, %s)' % _s(''))}, {_strip('coalesce(text, %s)' % _s(''))}), '[\\r\\n]+', '', 'g'), '（）', '()')"
_JOIN = f"regexp_replace({_JOIN}, '[ \\t]+', ' ', 'g')"
_JOIN = f"regexp_replace({_JOIN}, {_s(f'({t.HAN}) +')}, '\\1', 'g')"


@query(f"SELECT doc_id, {_strip(f'regexp_replace({_JOIN}, {_s(f' +({t.HAN})')}, {_s(chr(92) + '1')}, {_s('g')})')} AS combined FROM documents")
def combined_text(spark: SparkSession, d: str) -> DataFrame:
    """Reference and target text in one line."""
    return table(spark, d, "documents", "doc_id", "scenario", "text").select("doc_id", t.combined("scenario", "text").alias("combined"))


@query(f"SELECT seq, len(regexp_extract_all(text, {_s(t.ANY_TAG)})) AS tags, len(list_filter(regexp_split_to_array(text, {_s(t.ANY_TAG)}), lambda x: {_strip('x')} <> '')) AS segments FROM {POOL}")
def tag_split(spark: SparkSession, d: str) -> DataFrame:
    """Segments between tags."""
    df = table(spark, d, POOL, "seq", "text")
    return df.select("seq", F.size(F.regexp_extract_all("text", F.lit(t.ANY_TAG), F.lit(0))).alias("tags"), F.size(F.filter(F.split("text", t.ANY_TAG), lambda x: t.strip(x) != "")).alias("segments"))
