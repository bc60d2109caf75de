"""The quality filter over generated texts: ordered rules as columns, the first failure as the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# Fixed values of the rules.
READING_SCENARIOS = ("primary_chinese", "primary_english", "primary_math", "poetry_classics")
READING_HINTS = ("读", "朗读", "跟读", "指读", "默读", "念", "诵读", "背诗", "背课文", "课文", "题干", "题目", "单词表", "Dialog", "Read", "read", "Word list", "拔高")
TAG_SCENARIOS = ("emotions", "stress_numbers", "stress_tongue_twister", "stress_emotion_shift", "stress_stutter_repair", "stress_whisper_shout")
BAD_MARKERS = ("股票", "投资", "政治", "战争", "sex", "kill", "die", "porn", "no cap", "cap,", " emo", "emo了", "绝绝子", "yyds", " um", " uh", "ugh", "soooo", "sooo ", " ummm", " uhh", " erm")
LONGER = ("medium", "long", "very_long")


def is_reading(scenario: str, subscene: str) -> Column:
    sub = F.coalesce(F.col(subscene), F.lit(""))
    hit = F.coalesce(F.col(scenario), F.lit("")).isin(*READING_SCENARIOS)
    for h in READING_HINTS:
        hit = hit | sub.contains(h)
    return hit


def severe_length(text: str, length_type: str, reading: Column) -> Column:
    """Far outside the bounds of the length type; reading matter has more room."""
    lo, hi, k = t.length_bound(length_type, 0), t.length_bound(length_type, 1), F.coalesce(F.col(length_type).isin(*LONGER), F.lit(False))
    least = F.greatest(F.lit(1), F.floor(lo * F.when(reading, 0.25).otherwise(0.35)))
    most = F.floor(hi * F.when(reading & k, 4.5).otherwise(3.0)) + F.when(reading & k, 14).otherwise(10)
    return (lo > 0) & t.let(t.speech_units(text), lambda n: (n < least) | (n > most))


def min_tags(length_type: str, scenario: str, reading: Column) -> Column:
    base = None
    for k, v in t.LENGTH_MIN_TAGS.items():
        base = F.when(F.col(length_type) == k, v) if base is None else base.when(F.col(length_type) == k, v)
    base = base.otherwise(1)
    relaxed = F.when(F.coalesce(F.col(length_type).isin(*LONGER), F.lit(False)), 0).otherwise(F.least(base, F.lit(1)))
    stress = F.coalesce(F.col(scenario).isin(*TAG_SCENARIOS) & (F.col(length_type) != "ultra_short"), F.lit(False))
    return F.when(reading, relaxed).when(stress, F.greatest(base, F.lit(1))).otherwise(base)


def no_text_tn(text: str) -> Column:
    """Whether nothing of a text is left in its transcript: tags spoken or not, it holds no letter, mark or number and no sign that counts. Entities are left out of it, as most stand for punctuation."""
    bare = F.regexp_replace(F.regexp_replace(text, t.VALID_TAG, "a"), "&[#A-Za-z0-9]+;", " ")
    return ~bare.rlike(r"[\p{L}\p{M}\p{N}%¥$€£°]")


def with_text_tn(df: DataFrame, text: str = "text", language: str = "language", lang_type: str = "lang_type") -> DataFrame:
    """df with text_tn: the tags spoken in the row's language, then the safe form; null for an empty text, for one of which nothing is left, and for one that doesn't settle."""
    from ..functions import normalize

    tn = normalize.reference_form(text, t.tag_language(text, language, lang_type)[0])
    return df.withColumn("text_tn", F.nullif(tn, F.lit("")))


def rejected(df: DataFrame) -> DataFrame:
    """df with reason: the first rule that a row fails, or pass. Cheap rules stand first; null lengths count as medium."""
    d = df.withColumn("text", t.strip("text")).withColumn("length_type", F.coalesce("length_type", F.lit("medium"))).withColumn("_reading", is_reading("scenario", "subscene"))
    reading = F.col("_reading")

    def marked(low: Column) -> Column:
        hit = F.lit(False)
        for m in BAD_MARKERS:
            hit = hit | low.contains(m)
        return hit

    bad = t.let(F.lower("text"), marked)
    reason = (
        F.when(F.coalesce("text", F.lit("")) == "", "empty")
        .when(bad, "bad_marker")
        .when(~F.coalesce(F.col("lang_type").isin(*t.LANG_TYPES), F.lit(False)), "lang_type")
        .when(~t.fits_language("text", "lang_type"), "language_content")
        .when(F.size(t.unknown_tags("text")) > 0, "invalid_tags")
        .when(~t.is_complete("text"), "incomplete_asr")
        .when(t.phonetic_markup("text"), "pinyin_phonetic")
        .when(F.size(t.tags("text")) > 4, "too_many_tags")
        .when(t.repeated_tag("text"), "repeat_tag")
        .when(severe_length("text", "length_type", reading), "severe_length")
        .when(F.size(t.tags("text")) < min_tags("length_type", "scenario", reading), "too_few_tags")
        .when((F.coalesce("age_tier", F.lit("")) == "preschool") & ~t.child_markers(t.autocorrected("text")), "preschool_markers")
        .when(no_text_tn("text"), "no_text_tn")
        .when(t.start_issues("text") + t.conflict_issues("text") > F.when(reading, 6).otherwise(5), "validation_issues")
        .otherwise("pass")
    )
    return d.withColumn("reason", reason).drop("_reading")


def passed(df: DataFrame) -> DataFrame:
    """Rows that pass, with corrected text, n_tags, issues and length_mismatch (counted before the correction)."""
    ok = rejected(df).where(F.col("reason") == "pass")
    return ok.withColumn("n_tags", F.size(t.tags("text"))).withColumn("issues", t.start_issues("text") + t.conflict_issues("text")).withColumn("length_mismatch", ~t.fits_length("text", "length_type")).withColumn("text", t.autocorrected("text"))


def alignment(df: DataFrame, profiles: dict[str, list[str]]) -> DataFrame:
    """emotion, n_tags, matched, alignment for the emotions with a profile."""
    named = F.create_map(*[x for k, v in profiles.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    rows = df.where(F.col("emotion").isin(*profiles)).select("emotion", F.explode(t.tags("text")).alias("tag"))
    hit = F.count_if(F.array_contains(named[F.col("emotion")], F.col("tag")))
    return rows.groupBy("emotion").agg(F.count("*").alias("n_tags"), hit.alias("matched"), F.round(hit / F.count("*"), 6).alias("alignment"))


def group_counts(df: DataFrame, dims: list[str]) -> DataFrame:
    """dimension, value, n: the counts of every dimension from one pass over the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(x).alias("dimension"), F.coalesce(F.col(x), F.lit("")).alias("value")) for x in dims]))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def warnings(df: DataFrame) -> DataFrame:
    d = df.withColumn("text", F.coalesce("text", F.lit("")))
    rates = d.agg(
        F.count("*").alias("n"),
        (F.count_if(~t.fits_language("text", "lang_type")) / F.count("*")).alias("mismatch"),
        (F.count_if(~t.fits_length("text", "length_type")) / F.count("*")).alias("lengths"),
        (F.count_if(F.size(t.tags("text")) == 0) / F.count("*")).alias("untagged"),
    )
    said = F.array_compact(F.array(F.when(F.col("mismatch") > 0.005, "language mismatch"), F.when(F.col("lengths") > 0.01, "length mismatch"), F.when(F.col("untagged") > 0.2, "few tags")))
    return rates.select("n", F.round("mismatch", 6).alias("mismatch"), F.round("lengths", 6).alias("lengths"), F.round("untagged", 6).alias("untagged"), F.array_join(said, "; ").alias("warnings"))


# Fixed values of the variant for adult texts.
ADULT_MARKERS = ("股票", "投资", "政治", "战争", "sex", "kill", "die", "porn", "no cap", "yyds", "绝绝子", " emo", "emo了", " um", " uh", "ugh", "soooo", "sooo ", "吃饭饭", "宝宝要", "脑斧", "灰机")
ADULT_BOUNDS = {"ultra_short": (5, 15), "short": (15, 40), "medium": (40, 100), "long": (100, 250), "very_long": (250, 500)}
CHILD_WORDS = ("饭饭", "水水", "觉觉", "要要要", "宝宝不", "明明要", "七饭")


def adult(df: DataFrame, bounds: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Rows that pass the variant for adult texts: other markers and wider bounds (0.35 of the least, 1.5 of the most plus 10 units), no child words."""
    d = df.withColumn("text", t.strip("text")).withColumn("length_type", F.coalesce("length_type", F.lit("medium")))

    def named(words: tuple[str, ...]):
        def hit(x: Column) -> Column:
            out = F.lit(False)
            for w in words:
                out = out | x.contains(w)
            return out

        return hit

    table = bounds or ADULT_BOUNDS
    lo, hi = F.lit(0), F.lit(9999)
    for k, (a, b) in table.items():
        lo, hi = F.when(F.col("length_type") == k, a).otherwise(lo), F.when(F.col("length_type") == k, b).otherwise(hi)
    ok = (F.coalesce("text", F.lit("")) != "") & ~t.let(F.lower("text"), named(ADULT_MARKERS)) & ~t.let(F.col("text"), named(CHILD_WORDS)) & F.coalesce(F.col("lang_type").isin(*t.LANG_TYPES), F.lit(False))
    ok = ok & t.fits_language("text", "lang_type") & (F.size(t.unknown_tags("text")) == 0) & t.is_complete("text") & ~t.phonetic_markup("text") & (F.size(t.tags("text")) <= 4) & ~t.repeated_tag("text")
    return d.where(ok & t.let(t.speech_units("text"), lambda n: n.between(lo * 0.35, hi * 1.5 + 10))).where(t.start_issues("text") + t.conflict_issues("text") <= 5).withColumn("text", t.autocorrected("text"))
