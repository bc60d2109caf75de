"""Voice instructions, languages and truncated texts."""

from __future__ import annotations

import difflib
import re
import unicodedata as ud

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import HAN, strip

# The items of an instruction by category, in English and in Chinese (in the same order where there are both).
ENGLISH = {
    "gender": ("male", "female"),
    "age": ("child", "teenager", "young adult", "middle-aged", "elderly"),
    "pitch": ("very low pitch", "low pitch", "moderate pitch", "high pitch", "very high pitch"),
    "style": ("whisper",),
    "accent": ("american accent", "british accent", "australian accent", "chinese accent", "canadian accent", "indian accent", "korean accent", "portuguese accent", "russian accent", "japanese accent"),
}
CHINESE = {
    "gender": ("男", "女"),
    "age": ("儿童", "少年", "青年", "中年", "老年"),
    "pitch": ("极低音调", "低音调", "中音调", "高音调", "极高音调"),
    "style": ("耳语",),
    "dialect": ("河南话", "陕西话", "四川话", "贵州话", "云南话", "桂林话", "济南话", "石家庄话", "甘肃话", "宁夏话", "青岛话", "东北话"),
}
_ITEM = {x: k for names in (ENGLISH, CHINESE) for k, items in names.items() for x in items}
_TO_ZH = {a: b for k in ENGLISH.keys() & CHINESE.keys() for a, b in zip(ENGLISH[k], CHINESE[k])}
_TO_EN = {b: a for a, b in _TO_ZH.items()}
LIMITS = {"ultra_short": 5, "short": 8, "medium": 15, "long": 25, "very_long": 40}


def instruct(raw: str | None, use_zh: bool = False) -> tuple[str | None, str | None]:
    """(instruction in one language, error). A dialect makes it Chinese, an accent English; a category holds one item."""
    items = [x.strip().lower() for x in re.split("[,，]", raw or "") if x.strip()]
    if not items:
        return None, None
    for x in items:
        if x not in _ITEM:
            near = difflib.get_close_matches(x, _ITEM, n=1, cutoff=0.6)
            return None, f"unsupported: {x}" + (f" (did you mean {near[0]}?)" if near else "")
    kinds = [_ITEM[x] for x in items]
    if {"accent", "dialect"} <= set(kinds):
        return None, "accent and dialect"
    if twice := next((k for k in kinds if kinds.count(k) > 1), None):
        return None, f"more than one {twice}"
    use_zh = "dialect" in kinds or use_zh and "accent" not in kinds
    out = [(_TO_ZH if use_zh else _TO_EN).get(x, x) for x in items]
    return ("，" if re.search("[一-鿿]", "".join(out)) else ", ").join(out), None


@F.pandas_udf(T.StructType([T.StructField("instruct", T.StringType()), T.StructField("error", T.StringType())]))
def _instruct(raw: pd.Series, zh: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([instruct(r, bool(z)) for r, z in zip(raw, zh)], columns=["instruct", "error"], dtype=object)


def parsed_instruct(raw: str | Column, use_zh: Column) -> Column:
    """struct(instruct, error)."""
    return _instruct(raw, use_zh)


def truncate(text: str | None, length_type: str | None) -> str | None:
    """Text cut to the limit of its length type (Chinese and mixed texts by character, English ones by word), ended by dots, with up to two of its tags behind."""
    if text is None:
        return None
    tags, bare = re.findall(r"\[[^\]]+\]", text), re.sub(r"\[[^\]]+\]", "", text).strip()
    han, words, most = len(re.findall("[一-鿿]", bare)), len(re.findall("[a-zA-Z]+", bare)), LIMITS.get(length_type or "", 999)
    if han + words <= most:
        return text
    if han:
        out, ends = bare[:most].rstrip("，,、 "), "….！。?!～~"
    else:
        most = {"ultra_short": 3, "short": 6}.get(length_type or "", most)
        out, ends = " ".join(re.findall(r"[a-zA-Z]+(?:'[a-zA-Z]+)?|[^a-zA-Z\s]+", bare)[:most]).rstrip(" ,"), "….!?"
    whole = out[-1:] in ends and (out[-1:] != "." or not han or out.endswith("..."))
    return (out if whole else out + "...") + "".join(tags[:2])


@F.pandas_udf(T.StringType())
def _truncate(t: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([truncate(a, b) for a, b in zip(t, k)], dtype=object)


def truncated(text: str | Column, length_type: str | Column) -> Column:
    return _truncate(text, length_type)


def cjk_spaces(c: str | Column) -> Column:
    """No blanks beside Chinese and Japanese characters, single ones elsewhere."""
    wide = r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{3000}-\x{303f}]"
    t = F.regexp_replace(F.regexp_replace(c, rf"({wide})\s+", "$1"), rf"\s+({wide})", "$1")
    return strip(F.regexp_replace(t, r"\s+", " "))


# Languages whose rates count characters, without blanks and with them as |; characters that are dropped; by language, further ones.
WITHOUT_BLANKS = ("zh", "yue", "ja")
WITH_BARS = ("ko", "th", "arb", "vi", "hi", "el")
DROPPED = "\u200b\u200c\u200e\u200f\u202a\u202c\u0656\u0657" + "".join(map(chr, range(0x64B, 0x653)))
DROPPED_IN = {"mon": "\u00ad", "khk": "\u00ad", "heb": "".join(map(chr, range(0x5B0, 0x5D0)))}
BLANKS_IN = {"tha": "\u200d"}
WITHOUT_MARKS = ("jav",)
ENTITIES = ("&lt;", "&gt;", "&nbsp")
APOSTROPHES = "‛’‘"


def evaluated(text: str, iso: str, lower: bool = True, numbers: bool = True, brackets: bool = False) -> str:
    """Form of a text for error rates in a language (X23): compatible width, lower case, brackets with a digit in them dropped (with `brackets` all), curly apostrophes inside words plain, punctuation and symbols (all but ' and -) blanks, invisible characters and the language's marks dropped, with `numbers` False also words of digits alone."""
    t = ud.normalize("NFKC", text)
    t = t.lower() if lower else t
    t = re.sub(r"\([^)]*\)", lambda m: " " if brackets or any(c.isdigit() for c in m[0]) else m[0], t)
    for e in ENTITIES:
        t = t.replace(e, "")
    t = t.replace("ٱ", "ا")
    t = "".join("'" if c in APOSTROPHES and 0 < i < len(t) - 1 and not t[i - 1].isspace() and not t[i + 1].isspace() else c for i, c in enumerate(t))
    gone, blank = DROPPED + DROPPED_IN.get(iso, ""), BLANKS_IN.get(iso, "")
    t = "".join(" " if c in blank or c not in "'-" and c not in gone and ud.category(c)[0] in "PS" else c for c in t if c not in gone)
    words = t.split()
    if not numbers:
        words = [w for w in words if not all(ud.category(c) == "Nd" for c in w)]
    t = " ".join(words)
    return "".join(c for c in ud.normalize("NFD", t) if not ud.combining(c)) if iso in WITHOUT_MARKS else t


def apart(text: str, bars: bool) -> str:
    """Characters apart; blanks dropped, or kept as |."""
    return " ".join(text.replace(" ", "|" if bars else ""))


def by_language(text: str, language: str, iso: str, simplify=None) -> str:
    """The form by which a word or character error rate of many languages is counted (X20): Chinese and Japanese as characters, six languages as characters with | for blanks, others as words. simplify: traditional to simplified Chinese, where there is a converter."""
    t = evaluated(text, iso) if language != "unknown" else text
    t = simplify(t) if simplify and language in ("zh", "yue") else t
    return (apart(t, language in WITH_BARS) if language in WITHOUT_BLANKS + WITH_BARS else t).lower().strip()


def by_character(text: str, language: str) -> str:
    """The form by which a character error rate of any language is counted (X21): no blanks beside Chinese and Japanese, | for the others, characters apart. language: an ISO 639-3 code with its script behind (eng_Latn)."""
    t = evaluated(text, language[:3])
    t = re.sub(rf"\s+(?=[{_WIDE}])|(?<=[{_WIDE}])\s+", "", t)
    return apart(re.sub(r"\s+", " ", t).strip(), True)


ZH_DIGITS = "零一二三四五六七八九"


def zh_words(n: str) -> str:
    """A whole number of up to sixteen digits in Chinese words, longer ones digit by digit."""
    n = n.lstrip("0") or "0"
    if len(n) > 16:
        return "".join(ZH_DIGITS[int(c)] for c in n)
    if n == "0":
        return ZH_DIGITS[0]
    out, gap = "", False
    groups = [n[max(0, len(n) - 4 * (k + 1)) : len(n) - 4 * k].zfill(4) for k in range(-(-len(n) // 4))]
    for k in range(len(groups) - 1, -1, -1):
        said = ""
        for digit, unit in zip(groups[k], ("千", "百", "十", "")):
            if digit == "0":
                gap = True
            else:
                said += (ZH_DIGITS[0] if gap and (out or said) else "") + ZH_DIGITS[int(digit)] + unit
                gap = False
        out += said + ("", "万", "亿", "万亿")[k] if said else ""
    return out[1:] if out.startswith("一十") else out


def cantonese(text: str, simplify=None) -> str:
    """The Cantonese form (X22): as by_language, with numbers in words."""
    t = evaluated(text, "yue")
    t = simplify(t) if simplify else t
    return apart(re.sub("[0-9]+", lambda m: zh_words(m[0]), t), False).lower().strip()


_WIDE = "\u4e00-\u9fff\u3040-\u309f\u30a0-\u30ff\u3000-\u303f"
# ISO 639-3 codes of the languages of the tables.
ISO = {"zh": "zho", "en": "eng", "es": "spa", "fr": "fra", "de": "deu", "ja": "jpn", "ko": "kor", "yue": "yue", "th": "tha", "arb": "arb", "vi": "vie", "hi": "hin", "el": "ell"}


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("by_language", "by_character", "cantonese")]))
def _rate_forms(t: pd.Series, k: pd.Series) -> pd.DataFrame:
    rows = []
    for text, lang in zip(t, k):
        lang = lang or "unknown"
        rows.append((None,) * 3 if text is None else (by_language(text, lang, ISO.get(lang, lang)), by_character(text, ISO.get(lang, lang)), cantonese(text) if lang in ("zh", "yue") else None))
    return pd.DataFrame(rows, columns=["by_language", "by_character", "cantonese"], dtype=object)


def error_rate_forms(text: str | Column, language: str | Column) -> Column:
    """struct(by_language, by_character, cantonese): the forms of a text in a language (a code of two letters, null is unknown; cantonese for Chinese only)."""
    return _rate_forms(text, language)


def resolved(df: DataFrame, column: str, dimension: DataFrame, key: str = "language_id", name: str = "language_name") -> DataFrame:
    """df with resolved: the key itself, else the key whose name is the value in lower case, else null. The dimension has a row per language."""
    ids = dimension.select(F.col(key).alias("_id"), F.lower(name).alias("_name"))
    by_id = df.join(ids.select(F.col("_id").alias(column), F.col("_id").alias("_a")).distinct(), column, "left")
    by_name = by_id.withColumn("_low", F.lower(column)).join(ids.groupBy(F.col("_name").alias("_low")).agg(F.min("_id").alias("_b")), "_low", "left")
    return by_name.withColumn("resolved", F.coalesce("_a", "_b")).drop("_a", "_b", "_low")


def display_name(c: str | Column, exceptions: dict[str, str] | None = None) -> Column:
    """Title case, but for listed names."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.initcap(col)
    for k, v in (exceptions or {}).items():
        out = F.when(col == k, v).otherwise(out)
    return out


def has_han(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(HAN)
