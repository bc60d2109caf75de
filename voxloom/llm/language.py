"""Problem 3: languages of documents and of the stretches of mixed ones, by cross-parsing entropy.

For each language a suffix automaton holds labelled text. A stretch (letters of one script family inside a sentence) is parsed by
each automaton of its family (Chinese, Japanese and Korean; the four Latin ones) into longest matches; over the same letters, the
language that needs the fewest phrases wins (ties: the order of LANGUAGES). A letter that a language's text lacks costs UNSEEN
phrases, so kana and Hangul are decided by the parse like everything else. A stretch that is too short to tell leans on the stretches
of the same family beside it. The language with most units (a CJK character, a word, a run of digits) is the main one.

Training has two bounded parts. Stock phrases: short sentences counted over all rows and labels, of which STOCK_LEAST rows and a share
of STOCK_SHARE bear one label; the STOCK most frequent of each language are taken (a sample of rows misses phrases such as "Oh no",
which many rows consist of). And of each label up to TRAIN_ROWS rows with the least text hashes, TRAIN_CHARS letters at most, by
sentence, only sentences in the label's own script. Labels are wrong at times and rows are mixed, so that sample is split in two halves
that check each other: a sentence stays only if the other half's automata agree with its label. The automata are built in each worker
from those letters (at most 7 x (TRAIN_CHARS + STOCK x STOCK_CHARS), which is all that is sent).

Null, empty and unlabelled texts: no units, no language (null), confidence 0, no stretch, never reported as wrong. Labels: null,
empty or a word for "unknown" are missing; case, blanks, suffixes after - or _, ISO 639-3 codes and English names don't matter;
any other label names another language. Repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import _CJK, TAG, map_rows, spread

LANGUAGES = ("zh", "en", "es", "fr", "de", "ja", "ko")
TRAIN_ROWS = 1200
TRAIN_CHARS = 40_000
STOCK = 400
STOCK_CHARS = 40
STOCK_LEAST = 5
STOCK_SHARE = 0.7
KNOWN = 50_000  # stretches whose parse a worker remembers
LEAN = 0.15  # weight of the neighbouring stretches' phrases
UNSEEN = 2
BITS = 3  # of evidence that one phrase less gives

# ISO 639-3 codes (with their bibliographic twins) and English names; words for "unknown".
NAMES = {"zho": "zh", "chi": "zh", "cmn": "zh", "chinese": "zh", "mandarin": "zh", "eng": "en", "english": "en", "spa": "es", "spanish": "es", "fra": "fr", "fre": "fr", "french": "fr", "deu": "de", "ger": "de", "german": "de", "jpn": "ja", "japanese": "ja", "kor": "ko", "korean": "ko"}
UNKNOWN = ("", "und", "unknown", "undetermined", "undefined", "unk", "n/a", "na", "none", "null", "nan", "mis", "mul", "zxx", "?", "??", "other", "missing")

_HAN, _KANA, _HANGUL = "㐀-䶿一-鿿豈-﫿々〆\U00020000-\U0003ffff", "ぁ-ゖゝ-ゟァ-ヺー-ヿㇰ-ㇿｦ-ﾟ", "가-힣ᄀ-ᇿㄱ-ㆎ"
SENTENCE = re.compile(r"[^。．！？!?.;；\n\r…]+[。．！？!?.;；\n\r…]*|[。．！？!?.;；\n\r…]+")
STRETCH = re.compile(rf"[{_HAN}{_KANA}][{_HAN}{_KANA}\s、，,：:“”‘’「」（）()~～—\d-]*|[{_HANGUL}][{_HANGUL}\s,，\d-]*|[^\W\d_{_CJK}](?:[^{_CJK}]*[^\W_{_CJK}])?['’]?")
LETTER = re.compile(rf"[{_CJK}{_HANGUL}]|[^\W\d_{_CJK}{_HANGUL}]+|\d+")
_SCRIPTS = {"H": ("zh", "ja", "ko"), "L": ("en", "es", "fr", "de")}


def label(c: str | Column) -> Column:
    """The language that a label names: a code of LANGUAGES, null if missing, else what is left of the label."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    short = F.regexp_replace(F.regexp_extract(bare, r"^[^-_]*", 0), r"(?U)\s+$", "")
    named = F.coalesce(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])[short], short)
    return F.when(c.isNotNull() & ~bare.isin(*UNKNOWN) & ~short.isin(*UNKNOWN), named)


class Automaton:
    """Suffix automaton of a text; one table of transitions, state << 21 | character -> state."""

    def __init__(self, text: str):
        nxt: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in map(ord, text):
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        self.to = {s << 21 | c: t for s, out in enumerate(nxt) for c, t in out.items()}
        self.letters = frozenset(map(ord, text))

    def phrases(self, codes: list[int]) -> int:
        """Number of longest matches that parse the codes; a letter that the text lacks counts as UNSEEN of them."""
        if self.letters.isdisjoint(codes):
            return UNSEEN * len(codes)
        get, state, n = self.to.get, 0, 0
        for c in codes:
            t = get(state << 21 | c)
            if t is None:
                n += bool(state)
                t = get(c)
                if t is None:
                    n += UNSEEN
                    t = 0
            state = t
        return n + bool(state)


CJK_START = re.compile(f"[{_HAN}{_KANA}{_HANGUL}]")
LATIN = re.compile("[A-Za-zÀ-ɏ]")


def _by_script(stretch: str, kind: str) -> str:
    """Language of a stretch when no automaton of its family could be trained."""
    return "en" if kind == "L" else "ko" if re.match(f"[{_HANGUL}]", stretch) else "ja" if re.search(f"[{_KANA}]", stretch) else "zh"


def _codes(stretch: str, kind: str) -> list[int]:
    s = stretch.lower()
    if kind == "L":
        return [32, *(ord(c) for c in re.sub(r"[^\w'’]+|\d+", " ", s)), 32]
    return [ord(c) for c in s if c.isalpha()]


class Parser:
    """The automata of all languages."""

    def __init__(self, texts: dict[str, str]):
        self.of = {k: Automaton(t) for k, t in texts.items() if t}
        self.known: dict[str, dict[str, float]] = {}

    def costs(self, stretch: str, kind: str) -> dict[str, float]:
        """Phrases of the cross-parse by each language of the family."""
        got = self.known.get(stretch)
        if got is None:
            codes = _codes(stretch, kind)
            have = [k for k in _SCRIPTS[kind] if k in self.of]
            got = {k: float(self.of[k].phrases(codes)) for k in have} if have else {_by_script(stretch, kind): 0.0}
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[stretch] = got
        return got

    def stretches(self, text: str | None) -> list[tuple[str, str, int, float]]:
        """(text, language, units, confidence) of each stretch; neighbours of one language are joined."""
        parts: list[tuple[str, str, int, dict[str, float]]] = []
        whole: dict[str, dict[str, float]] = {"H": {}, "L": {}}  # phrases of all stretches of a family
        for sentence in SENTENCE.findall(TAG.sub(" ", text)) if text else ():
            for m in STRETCH.finditer(sentence):
                s = m[0]
                kind = "H" if CJK_START.match(s) else "L"
                if kind == "L" and not LATIN.search(s):
                    continue  # another alphabet
                cost = self.costs(s, kind)
                for x, c in cost.items():
                    whole[kind][x] = whole[kind].get(x, 0.0) + c
                parts.append((s, kind, len(LETTER.findall(s)), cost))
        out: list[tuple[str, str, int, float]] = []
        for s, kind, n, cost in parts:
            full = {x: c + LEAN * (whole[kind][x] - c) for x, c in cost.items()}
            best = min(full, key=lambda x: (full[x], LANGUAGES.index(x)))
            sure = 1 / sum(2 ** max(-60.0, -BITS * (c - full[best])) for c in full.values())
            if out and out[-1][1] == best:
                a, _, m, c = out[-1]
                out[-1] = (f"{a} {s}", best, m + n, (c * m + sure * n) / (m + n) if m + n else sure)
            else:
                out.append((s, best, n, sure))
        return out

    def main(self, text: str | None) -> tuple[str | None, float, int]:
        """Main language, confidence (its units weighed by their confidence, of all units) and number of languages."""
        units: dict[str, float] = {}
        sure: dict[str, float] = {}
        for _, lang, n, c in self.stretches(text):
            units[lang] = units.get(lang, 0) + n
            sure[lang] = sure.get(lang, 0) + n * c
        if not units or not sum(units.values()):
            return None, 0.0, 0
        best = max(units, key=lambda x: (units[x], sure[x], -LANGUAGES.index(x)))
        return best, sure[best] / sum(units.values()), len(units)


def _kind(lang: str) -> str:
    return next(k for k, v in _SCRIPTS.items() if lang in v)


# What a training text of a language must hold, and what it must not.
_SIGNS = {"zh": (f"[{_HAN}]", (f"[{_KANA}]", f"[{_HANGUL}]", "[A-Za-z]")), "ja": (f"[{_KANA}]", (f"[{_HANGUL}]", "[A-Za-z]")), "ko": (f"[{_HANGUL}]", ("[A-Za-z]",))}
_SIGNS |= {x: ("[A-Za-z]{2}", (f"[{_HAN}]", f"[{_KANA}]", f"[{_HANGUL}]")) for x in _SCRIPTS["L"]}


def _in_script(lang: Column, t: Column, alone: bool = False) -> Column:
    """Whether a text holds letters of its label's own script; alone: and none that its language doesn't use."""
    fits = F.lit(False)
    for x in LANGUAGES:
        need, bars = _SIGNS[x]
        ok = t.rlike(need)
        for bar in bars if alone else ():
            ok = ok & ~t.rlike(bar)
        fits = fits | ((lang == x) & ok)
    return fits


def stock(df: DataFrame, text: str, language: str) -> dict[str, list[str]]:
    """The most frequent short sentences of each language, by the labels of all rows that hold them."""
    bare = F.split(F.regexp_replace(F.lower(text), TAG.pattern, " "), r"[。．！？!?.;；\n\r…]+")
    each = df.where(F.col(text).isNotNull()).select(label(language).alias("l"), F.explode(bare).alias("s")).select("l", F.trim("s").alias("s"))
    counted = each.where(F.col("l").isNotNull() & F.char_length("s").between(2, STOCK_CHARS)).groupBy("s", "l").agg(F.count("*").alias("n"))
    most = counted.groupBy("s").agg(F.sum("n").alias("all"), F.max(F.struct("n", "l")).alias("top")).select("s", "all", F.col("top.n").alias("n"), F.col("top.l").alias("l"))
    sure = most.where((F.col("n") >= STOCK_LEAST) & (F.col("n") >= F.col("all") * STOCK_SHARE) & _in_script(F.col("l"), F.col("s"), alone=True))
    first = sure.withColumn("r", F.row_number().over(W.partitionBy("l").orderBy(F.desc("n"), "s"))).where(F.col("r") <= STOCK)  # cut per task before the shuffle
    out: dict[str, list[str]] = {x: [] for x in LANGUAGES}
    for x, s in sorted(map(tuple, first.select("l", "s").collect())):  # at most 7 x STOCK
        out[x].append(s)
    return out


def learn(df: DataFrame, text: str, language: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> dict[str, str]:
    """Training text of each language: stock phrases and a bounded sample of labelled rows that check each other in halves."""
    labelled = df.where(F.col(text).isNotNull()).select(label(language).alias("l"), F.col(text).alias("t"), F.xxhash64(text).alias("h")).where(_in_script(F.col("l"), F.col("t")))
    first = labelled.withColumn("r", F.row_number().over(W.partitionBy("l").orderBy("h", "t"))).where(F.col("r") <= rows)  # cut per task before the shuffle
    one: dict[str, list[str]] = {x: [] for x in LANGUAGES}
    two: dict[str, list[str]] = {x: [] for x in LANGUAGES}
    size, seen, often = dict.fromkeys(LANGUAGES, 0), set(), stock(df, text, language)
    for x, t, k in sorted(map(tuple, first.select("l", "t", "r").collect()), key=lambda r: (r[0], r[2])):  # at most 7 x rows
        need, bars = _SIGNS[x]
        if (x, t) in seen or size[x] >= chars:
            continue
        seen.add((x, t))
        for s in SENTENCE.findall(TAG.sub(" ", t)):  # a row lies in one half
            if re.search(need, s) and not any(re.search(y, s) for y in bars):
                (two if len(seen) % 2 else one)[x].append(s)
                size[x] += len(s)

    def joined(texts: list[str], kind: str, most: int) -> str:
        return "\0".join("".join(map(chr, _codes(s, kind))) for s in texts)[:most]

    def text_of(x: str, v: list[str]) -> str:
        return "\0".join(filter(None, (joined(often[x], _kind(x), STOCK * STOCK_CHARS), joined(v, _kind(x), chars))))

    def agreed(half: dict[str, list[str]], other: dict[str, list[str]]) -> dict[str, list[str]]:
        judge = Parser({x: text_of(x, v) for x, v in other.items()})
        return {x: [s for s in v if judge.main(s)[0] == x] if len(v) > 1 else v for x, v in half.items()}

    for _ in range(2):
        two = agreed(two, one)
        one = agreed(one, {x: two[x] or one[x] for x in two})
    return {x: text_of(x, one[x] + two[x]) for x in LANGUAGES}


@cache
def _parser(texts: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(texts))


def _model(df: DataFrame, text: str, language: str, trained: dict[str, str] | None):
    learned = trained if trained is not None else learn(df, text, language)
    return df.sparkSession.sparkContext.broadcast(tuple(sorted(learned.items())))


def languages(df: DataFrame, key: str, text: str, language: str, trained: dict[str, str] | None = None) -> DataFrame:
    """key, label (as named), main (language or null), confidence, n_languages of every row."""
    model = _model(df, text, language, trained)

    def make():
        p = _parser(model.value)
        return lambda k, t, named: [(k, named, *p.main(t))]

    kind = df.schema[key].dataType.simpleString()
    return map_rows(spread(df.select(key, text, label(language).alias("_named"))), make, f"`{key}` {kind}, label string, main string, confidence double, n_languages int")


def segments(df: DataFrame, key: str, text: str, language: str, trained: dict[str, str] | None = None) -> DataFrame:
    """key, pos, segment, lang, units, confidence of every stretch of every row."""
    model = _model(df, text, language, trained)

    def make():
        p = _parser(model.value)

        def row(k, t) -> Iterator[tuple]:
            for i, (s, x, n, c) in enumerate(p.stretches(t)):
                yield k, i, s, x, n, c

        return row

    kind = df.schema[key].dataType.simpleString()
    return map_rows(spread(df.select(key, text)), make, f"`{key}` {kind}, pos int, segment string, lang string, units int, confidence double")


def wrong_labels(df: DataFrame, key: str, text: str, language: str, trained: dict[str, str] | None = None) -> DataFrame:
    """key and main language of the rows whose label is missing or names another language."""
    return languages(df, key, text, language, trained).where("main is not null and (label is null or label <> main)").select(key, F.col("main").alias("language"))
