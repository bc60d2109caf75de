"""Text functions as Spark columns. Patterns avoid lookaround and ASCII-only classes, so that Java, RE2 and Python agree on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it.
WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
HAN = r"[\x{4e00}-\x{9fff}]"
ANY_TAG = r"\[[^\]]+\]"

# The vocabularies of the data model.
TAGS = ("laughter", "sigh", "confirmation-en", "question-en", "question-ah", "question-oh", "question-ei", "question-yi", "surprise-ah", "surprise-oh", "surprise-wa", "surprise-yo", "dissatisfaction-hnn")
START_TAGS = ("sigh", "question-ah", "question-oh", "question-ei", "question-yi", "surprise-ah", "surprise-oh", "surprise-wa")
TAG_CONFLICTS = (("laughter", "sigh"), ("laughter", "dissatisfaction-hnn"), ("surprise-wa", "sigh"), ("surprise-wa", "dissatisfaction-hnn"), ("surprise-yo", "sigh"), ("surprise-yo", "dissatisfaction-hnn"), ("confirmation-en", "sigh"), ("confirmation-en", "dissatisfaction-hnn"))
SPOKEN_ZH = {"laughter": "哈哈", "sigh": "哎", "question-ah": "啊", "question-oh": "哦", "question-ei": "诶", "question-yi": "咦", "question-en": "嗯", "surprise-ah": "啊", "surprise-oh": "哦", "surprise-wa": "哇", "surprise-yo": "哟", "dissatisfaction-hnn": "嗯", "confirmation-en": "嗯"}
SPOKEN_EN = {"laughter": "haha", "sigh": "", "question-ah": "huh", "question-oh": "oh", "question-ei": "", "question-yi": "", "question-en": "hmm", "surprise-ah": "ah", "surprise-oh": "oh", "surprise-wa": "wow", "surprise-yo": "yo", "dissatisfaction-hnn": "hmm", "confirmation-en": "uh-huh"}
LANG_TYPES = ("pure_cn", "pure_en", "cn_mostly", "en_mostly", "frequent_mix")
LENGTH_BOUNDS = {"ultra_short": (1, 5), "short": (3, 10), "medium": (8, 18), "long": (14, 30), "very_long": (22, 50)}
LENGTH_MIN_TAGS = {"ultra_short": 0, "short": 0, "medium": 1, "long": 1, "very_long": 1}

# Words and signs of the rules.
SOUND_VERBS = ("读作",)
SOUND_NOUNS = ("读音", "拼音", "注音", "谐音")
SOUND_NAMES = ("国际音标",)
SPOKEN_SIGNS = ("省略号", "顿号", "逗号", "句号", "问号", "叹号", "感叹号", "分号", "冒号", "破折号", "引号", "书名号", "括号", "斜杠", "反斜杠", "星号", "井号", "ellipsis")
TONE_VOWELS = "āáǎàēéěèīíǐìōóǒòūúǔùǖǘǚǜüÜɑḿń"
TONE_MARKS = "ˊˇˋ˙ˉ"
BULLETS = "·•※◆●□◇▲▼"
IPA_LETTERS = "əɪʊʌæɔɑɒθðʃʒŋ"
BABY_WORDS = ("饭饭", "水水", "觉觉", "手手", "脚脚", "抱抱抱", "走走走", "要要要", "不不不", "好好好", "怕怕怕", "宝宝要", "宝宝不", "宝宝想", "明明不", "明明要", "朵朵", "七饭", "回水", "脑斧", "灰机", "吃饭饭", "喝水水", "睡觉觉", "洗手手", "亲亲", "呜呜", "哼哼", "痛痛", "痒痒", "怕怕", "乖乖")
BABY_WORDS_INSIDE = ("抱抱", "走走")  # only with another character behind them
BABY_ENDINGS = ("嘛", "呀", "啦", "呢", "哦")
BABY_PHRASES = ("不要嘛", "好不好呀", "行不行呀", "人家", "妈咪", "爸爸抱")
UNFINISHED = ("还有", "可是", "因为", "如果", "要是", "我其实想", "我本来想", "等一下", "等下", "你知道", "怎么说", "wait", "because", "and then", "if", "when", "then", "you know", "i was gonna", "i'm gonna", "or maybe", "actually")
HANGING = ("可是", "如果", "要是")
SOFTENERS = ("嘛", "呀", "啊", "呢", "吧", "哦")
INTENTIONS = ("我其实想", "我本来想", "我只是想", "我还以为")
INTENDED = ("那个", "就是", "要", "去", "说", "问")
HANGING_EN = ("because", "if", "when", "then", "you know")
SUBJECTS_EN = ("i", "we", "you")
INTENTIONS_EN = ("was gonna", "were gonna", "am gonna", "or maybe")
GIVEN_UP = ("算了不说了", "不说了", "说不出来", "never mind", "whatever")
CLOSING_MARKS = "。！？!?"
PAUSE_MARKS = ",，、;；:：—-"


def any_of(*words: str) -> str:
    """Pattern of one of the words, the longest first."""
    return "(" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")"


VALID_TAG = rf"\[{any_of(*TAGS)}\]"
PHONETIC = (
    f"[{TONE_VOWELS}]",
    "[ㄅ-ㄩ]",
    "(?i)(^|[^a-zA-Z])[a-z]{1,6}[1-5]([^a-zA-Z0-9]|$)",  # a syllable with the number of its tone
    f"/[a-zA-Z{IPA_LETTERS}]+/",
    any_of(*SOUND_VERBS, *SOUND_NAMES, *(n + v for n in SOUND_NOUNS for v in "是为"), "拼音：", "拼音:"),
    any_of(*SPOKEN_SIGNS) + f"|at{WS}*sign",
    f"[{BULLETS}]",
    f"[{TONE_MARKS}]",
)
CHILD_MARKERS = any_of(*BABY_WORDS, *(f"{w}[^{w[0]}]" for w in BABY_WORDS_INSIDE))
CHILD_PARTICLES = f"{any_of(*BABY_ENDINGS)}[！。]?$|{any_of(*BABY_PHRASES)}"
OPEN_END = rf"[{PAUSE_MARKS}]{WS}*$"
CLOSERS = rf"""[{CLOSING_MARKS}"')\]）]+$"""
TRAILS = (
    f"{any_of(*HANGING)}{any_of(*SOFTENERS)}*$",
    f"{any_of(*INTENTIONS)}([，,]|{WS})*{any_of(*INTENDED)}?$",
    rf"\b{any_of(*SUBJECTS_EN)}{WS}+{any_of(*INTENTIONS_EN)}{WS}*$",
    rf"\b{any_of(*HANGING_EN)}{WS}*$",
    f"{any_of(*GIVEN_UP)}$",
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it (inside lambdas too)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: str | Column) -> Column:
    return F.regexp_replace(_c(c), f"^{WS}+|{WS}+$", "")


def untagged(c: str | Column) -> Column:
    """Text without anything in square brackets."""
    return F.regexp_replace(_c(c), ANY_TAG, "")


def tags(c: str | Column) -> Column:
    """Names of the known tags, in order."""
    return F.regexp_extract_all(_c(c), F.lit(VALID_TAG), F.lit(1))


def unknown_tags(c: str | Column) -> Column:
    """What stands in square brackets and is no known tag."""
    return F.filter(F.regexp_extract_all(_c(c), F.lit(r"\[([^\]]+)\]"), F.lit(1)), lambda x: ~x.isin(*TAGS))


def repeated_tag(c: str | Column, most: int = 2) -> Column:
    """Whether one known tag stands more than `most` times."""
    return let(tags(c), lambda t: F.exists(F.array_distinct(t), lambda x: F.size(F.filter(t, lambda y: y == x)) > most))


def start_issues(c: str | Column) -> Column:
    """Number of placement issues: a tag at the very start that may not stand there; laughter within the first three characters."""
    t = _c(c)
    first = F.regexp_extract(t, "^" + VALID_TAG, 1)
    bad_start = ((first != "") & ~first.isin(*START_TAGS)).cast("int")
    near = F.regexp_count(F.substring(t, 1, 12), F.lit(r"\[laughter\]"))
    return bad_start + near


def conflict_issues(c: str | Column) -> Column:
    """Number of contradicting tag pairs, and of families (surprise, question) with three variants or more."""

    def variants(t: Column, family: str) -> Column:
        return F.size(F.array_distinct(F.filter(t, lambda x: x.startswith(family))))

    def count(t: Column) -> Column:
        n = F.lit(0)
        for a, b in TAG_CONFLICTS:
            n = n + (F.array_contains(t, a) & F.array_contains(t, b)).cast("int")
        return n + sum((variants(t, family) >= 3).cast("int") for family in ("surprise-", "question-"))

    return let(tags(c), count)


def han_count(c: str | Column) -> Column:
    return F.regexp_count(untagged(c), F.lit(HAN))


def word_count(c: str | Column, joined: bool = False) -> Column:
    """Latin words; joined counts don't and well-known as one."""
    return F.regexp_count(untagged(c), F.lit("[A-Za-z]+(?:['-][A-Za-z]+)?" if joined else "[a-zA-Z]+"))


def speech_units(c: str | Column) -> Column:
    return let(untagged(c), lambda bare: F.regexp_count(bare, F.lit(HAN)) + F.regexp_count(bare, F.lit("[a-zA-Z]+")))


def fits_language(text: str | Column, lang_type: str | Column) -> Column:
    """Whether the mix of Chinese and English is the declared one."""
    counts = let(untagged(text), lambda bare: F.struct(F.regexp_count(bare, F.lit(HAN)).alias("h"), F.regexp_count(bare, F.lit("[A-Za-z]+(?:['-][A-Za-z]+)?")).alias("w")))

    def fits(x: Column) -> Column:
        h, w, k = x["h"], x["w"], _c(lang_type)
        n = h + w
        return (
            F.when(n == 0, False)
            .when(k == "pure_cn", (h > 0) & (w == 0))
            .when(k == "pure_en", (w > 0) & (h == 0))
            .when(k == "cn_mostly", (h > 0) & (h / n >= 0.55))
            .when(k == "en_mostly", (w > 0) & (w / n >= 0.55))
            .when(k == "frequent_mix", (h > 0) & (w > 0) & (F.least(h, w) / n >= 0.20))
        )

    return F.coalesce(let(counts, fits), F.lit(False))


def length_bound(length_type: str | Column, which: int) -> Column:
    out = None
    for k, v in LENGTH_BOUNDS.items():
        cond = _c(length_type) == k
        out = F.when(cond, v[which]) if out is None else out.when(cond, v[which])
    return out.otherwise((0, 999)[which])


def fits_length(text: str | Column, length_type: str | Column) -> Column:
    return let(speech_units(text), lambda n: n.between(length_bound(length_type, 0), length_bound(length_type, 1)))


def is_complete(c: str | Column) -> Column:
    """Whether an utterance ends as a whole one."""

    def unfinished(low: Column) -> Column:
        bad = F.lit(False)
        for t in UNFINISHED:
            bad = bad | low.endswith(t)
        for p in TRAILS:
            bad = bad | low.rlike(p)
        return bad

    def complete(bare: Column) -> Column:
        return (bare != "") & ~bare.rlike(OPEN_END) & ~let(strip(F.regexp_replace(F.lower(bare), CLOSERS, "")), unfinished)

    return let(strip(untagged(c)), complete)


def phonetic_markup(c: str | Column) -> Column:
    def found(bare: Column) -> Column:
        hit = F.lit(False)
        for p in PHONETIC:
            hit = hit | bare.rlike(p)
        return (strip(bare) != "") & hit

    return let(untagged(c), found)


def child_markers(c: str | Column) -> Column:
    return let(untagged(c), lambda bare: bare.rlike(CHILD_MARKERS) | bare.rlike(CHILD_PARTICLES))


def autocorrected(c: str | Column) -> Column:
    """Ellipses (and repeated commas) as one comma, no blank before a tag, one after it unless a mark follows, single blanks: the text is taken apart at its tags and put together again."""

    def rejoined(t: Column) -> Column:
        parts, tags_ = F.split(t, VALID_TAG), F.regexp_extract_all(t, F.lit(VALID_TAG), F.lit(0))

        def add(done: Column, i: Column) -> Column:
            then = let(strip(F.element_at(parts, i + 1)), lambda p: F.concat(F.when(p.rlike("^[，。？！,.?!]"), "").otherwise(" "), p))
            return F.concat(done, F.element_at(tags_, i), then)

        steps = F.when(F.size(tags_) > 0, F.sequence(F.lit(1), F.size(tags_))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, strip(F.element_at(parts, 1)), add)

    return strip(F.regexp_replace(let(F.regexp_replace(_c(c), "([.]{3,}|…|，)+", "，"), rejoined), "  +", " "))


def dedup_form(c: str | Column) -> Column:
    """Form for duplicate checks: no tags, numbers alike, no punctuation or white space, lower case."""
    t = F.regexp_replace(F.lower(untagged(c)), r"\d+", "<num>")
    return F.regexp_replace(t, rf"""({WS}|[，。？！,.?!、；;：:"“”‘’'\-—…~～()（）\[\]])+""", "")


def bare_form(c: str | Column) -> Column:
    """Lower case without white space, brackets and main punctuation."""
    return F.regexp_replace(F.lower(_c(c)), rf"({WS}|[\[\]，。？！,.?!])+", "")


def grams(c: str | Column, k: int) -> Column:
    """Distinct character k-grams of a text, in one pass over its characters."""
    cut = lambda ch: F.when(F.size(ch) >= k, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(ch) - (k - 1)), lambda i: F.array_join(F.slice(ch, i, k), "")))).otherwise(F.array().cast("array<string>"))
    return let(F.filter(F.split(_c(c), ""), lambda x: x != ""), cut)


def shingles(c: str | Column) -> Column:
    """Character 3-grams; of up to six characters the characters themselves."""
    return let(_c(c), lambda t: F.when(F.char_length(t) <= 6, F.array_distinct(F.filter(F.split(t, ""), lambda x: x != ""))).otherwise(grams(t, 3)))


def jaccard(a: Column, b: Column) -> Column:
    """Intersection over union of two arrays of distinct values; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(0.0))


def tag_language(text: str | Column, language: str | Column, lang_type: str | Column) -> tuple[Column, Column]:
    """Language in which tags are spoken, and where it was taken from."""
    lang, kind = F.lower(strip(F.coalesce(_c(language), F.lit("")))), F.lower(strip(F.coalesce(_c(lang_type), F.lit(""))))
    seen = F.regexp_replace(F.coalesce(_c(text), F.lit("")), ANY_TAG, " ")
    cjk, latin = seen.rlike(r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}\x{3040}-\x{30ff}]"), seen.rlike("[A-Za-z]")
    by_lang, by_kind = lang.isin("en", "eng", "zh", "zho", "cmn", "cn"), kind.isin("pure_en", "pure_zh", "pure_cn", "cn_mostly", "frequent_mix")
    value = F.when(lang.isin("en", "eng"), "en").when(by_lang, "zh").when(kind == "pure_en", "en").when(by_kind, "zh").when(cjk, "zh").when(latin, "en").otherwise("unknown")
    source = F.when(by_lang, "language").when(by_kind, "lang_type").when(cjk, "text_cjk_fallback").when(latin, "text_latin_fallback").otherwise("unknown")
    return value, source


def spoken_tags(text: str | Column, language: Column) -> Column:
    """Known tags spoken in the language, others kept as typed tokens."""

    def say(words: dict[str, str]) -> Column:
        t = _c(text)
        for k, v in words.items():
            t = F.replace(t, F.lit(f"[{k}]"), F.lit(f" {v} " if v else " "))
        return t

    t = F.when(language == "en", say(SPOKEN_EN)).when(language == "zh", say(SPOKEN_ZH)).otherwise(_c(text))
    t = F.regexp_replace(t, r"\[([A-Za-z0-9_-]+)\]", " ⟦TAG:$1⟧ ")
    return strip(F.regexp_replace(t, f"{WS}+", " "))


def tts_text(c: str | Column) -> Column:
    """Punctuation but apostrophes dropped, lower case, single blanks (as for English word error rates)."""
    return strip(F.regexp_replace(F.lower(F.regexp_replace(_c(c), r"[^\p{L}\p{M}\p{N}'\s]", "")), r"\s+", " "))


def spaced_characters(c: str | Column) -> Column:
    """Characters apart, without blanks (as for character error rates)."""
    return strip(F.regexp_replace(F.regexp_replace(_c(c), rf"[^\p{{L}}\p{{M}}\p{{N}}]|{WS}", ""), "(.)", "$1 "))


def plain_words(c: str | Column) -> Column:
    """Curly apostrophes straight, everything else than Latin letters, digits and apostrophes a blank, single blanks, lower case."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(F.translate(_c(c), "‘’", "''")), "[^a-z0-9']", " "), " +", " "))


def closed(c: str | Column) -> Column:
    """A full stop where no closing mark stands: 。 after a Chinese character, . otherwise."""
    t = strip(c)
    return F.when(t == "", t).when(t.rlike(r"""[.。!！?？…;；:：,，、)）\]】"”'’]$"""), t).when(t.rlike(HAN + "$"), F.concat(t, F.lit("。"))).otherwise(F.concat(t, F.lit(".")))


def combined(ref: str | Column, text: str | Column) -> Column:
    """Reference and target text in one line: joined by a blank, no line breaks, full-width parentheses plain, no blanks beside Chinese characters."""
    t = F.concat_ws(" ", strip(F.coalesce(_c(ref), F.lit(""))), strip(F.coalesce(_c(text), F.lit(""))))
    t = F.translate(F.regexp_replace(t, r"[\r\n]+", ""), "（）", "()")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, f"({HAN}) +", "$1")
    return strip(F.regexp_replace(t, f" +({HAN})", "$1"))
