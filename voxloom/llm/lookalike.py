"""Problem 4: one consistent form of texts that look the same, by resolved script sets.

A text is first folded: width forms, presentation ligatures and styled letters, radicals and compatibility ideographs, all kinds
of space, invisible characters; accents are taken apart. Then every run of letters is resolved: each letter has the set of scripts
in which a letter of its look exists, the sets are intersected over the run, and the run is spelled in the first script of the
intersection (Latin before the others). A run whose raw scripts have nothing in common is mixed; one whose script differs from the
one it is spelled in is a whole-script confusable. Where no script fits the whole run, each letter takes its first spelling by
itself. Katakana that look like Chinese characters are spelled as kana beside unmistakable katakana, else as the character. The
choice depends on looks alone, so texts of equal look get equal forms. Accents are composed again at the end.

Case, accents, wording, traditional or simplified form, raised digits, fractions and punctuation as such stay. Null stays null,
an empty text stays empty.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, spread

# Letters of other alphabets and, below each, the Latin letter of the same look.
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮԌԚԜѴӀабеѕіјоpрсухһԁԛԝѵҽүӏ"
CYRILLIC_AS = "ABESIJKMHOPCTYXYGQWVlabesijoppcyxhdqwveyl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανοιρυσγϲϳβ"
GREEK_AS = "ABEZHIKMNOPTYXavoipuoycjß"
ARMENIAN = "ՕՍՏԼօսոհցզյգ"
ARMENIAN_AS = "OUSLounhgqjq"
CHEROKEE = "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏚᏙᏢᏞᏟᏦᏴ"
CHEROKEE_AS = "DRTiAJEWMHGZRWSVPLCKB"
LATIN = "ɡɑ"
LATIN_AS = "ga"
# Katakana and the Chinese characters of the same look; katakana and hiragana of the same look.
KATAKANA = "ロニハカタエトミチオセーノメ"
HAN = "口二八力夕工卜彡千才七一丿〆"
KATAKANA_2 = "ヘベペ"
HIRAGANA_2 = "へべぺ"
# Radicals without a decomposition, and the character of the same look.
RADICALS = "⺠⺟⻁⻄⻅⻆⻉⻋⻑⻓⻔⻘⻙⻚⻛⻜⻝⻢⻣⻤⻥⻦⻧⻨⻩⻬⻭⻮⻯⻰⺁⺇⺌⺎⺒⺓⺙⺝⺞⺪⺬⺮⺯⺰⺱⺲⺳⺶⺷⺸⺹⺺⺻⺼⻀⻂⻃⻇⻈⻊⻌⻍⻎⻏⻐⻒⻖⻗⻞⻟⻠⻡⻪⻫"
RADICALS_AS = "民母虎西见角贝车镸长门青韦页风飞食马骨鬼鱼鸟卤麦黄齐歯齿竜龙厂几小兀巳幺攵月歺疋示竹糸纟罓罒罓羊羊羊耂肀聿月艹衤覀𧢲讠足辶辶辶阝钅镸阝雨飠飠饣𩠐黾斉"

_SPACES = {c: " " for c in map(chr, range(0x3001)) if ud.category(c) == "Zs"}
_UNSEEN = {chr(c) for c in (*range(0xFE00, 0xFE10), 0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0, *range(0x180B, 0x1810))}
_STYLES = ("<wide>", "<narrow>", "<font>")


@cache
def folded(c: str) -> str:
    """Fold of one character."""
    if c in _SPACES:
        return " "
    if c in _UNSEEN or ud.category(c) == "Cf":
        return ""
    kind, _, rest = ud.decomposition(c).partition(" ")
    o = ord(c)
    if kind in _STYLES or kind == "<compat>" and (0x2E80 <= o < 0x2FE0 or 0xFB00 <= o < 0xFB07):
        return "".join(folded(chr(int(x, 16))) for x in rest.split())
    return _RADICAL.get(c, c)


_RADICAL = dict(zip(RADICALS, RADICALS_AS))

#: Spellings of a look: Latin letter -> {script: letter}; and each letter's look.
SPELLINGS: dict[str, dict[str, str]] = {}
LOOK: dict[str, str] = {}
for _script, _own, _as in (("Latn", LATIN, LATIN_AS), ("Cyrl", CYRILLIC, CYRILLIC_AS), ("Grek", GREEK, GREEK_AS), ("Armn", ARMENIAN, ARMENIAN_AS), ("Cher", CHEROKEE, CHEROKEE_AS)):
    for _a, _b in zip(_own, _as):
        SPELLINGS.setdefault(_b, {"Latn": _b}).setdefault(_script, _a)
        LOOK[_a] = _b

_HAN_OF, _HIRA_OF = dict(zip(KATAKANA, HAN)), dict(zip(KATAKANA_2, HIRAGANA_2))
_KATA_OF = {v: k for k, v in (_HAN_OF | _HIRA_OF).items()}
#: Runs of letters with their marks, and the letters of an alphabet other than Latin that make one worth resolving; runs of what katakana look like.
_OTHER = "ɑɡͰ-ϿЀ-ԯ԰-֏Ꭰ-ᏼ"
RUN = re.compile(rf"[A-Za-zªºÀ-ɏɐ-ʯ̀-ͯ{_OTHER}]+")
OTHER = re.compile(f"[{_OTHER}]")
KANA_RUN = re.compile(f"[ァ-ヺー{HAN}{HIRAGANA_2}]+")
KANA = re.compile("[ァ-ヺー]")


@cache
def script(c: str) -> str:
    o = ord(c)
    return "Cyrl" if 0x400 <= o < 0x530 else "Grek" if 0x370 <= o < 0x400 else "Armn" if 0x530 <= o < 0x590 else "Cher" if 0x13A0 <= o < 0x13FE else "Latn"


def resolve(run: str) -> tuple[str, str]:
    """A run of decomposed letters in one script, and what it was: 'single', 'mixed' or 'whole' (whole-script confusable)."""
    bases = [c for c in run if not ud.combining(c)]
    raw = {script(c) for c in bases}
    fits: set[str] | None = None
    for c in bases:
        own = set(SPELLINGS[LOOK.get(c, c)]) if LOOK.get(c, c) in SPELLINGS else {script(c)}
        fits = own if fits is None else fits & own
    to = next((s for s in ("Latn", "Cyrl", "Grek", "Armn", "Cher") if s in (fits or ())), None)
    out = []
    for c in run:
        look = LOOK.get(c, c)
        if ud.combining(c) or look not in SPELLINGS:
            out.append(c)
        else:
            out.append(SPELLINGS[look].get(to or "Latn", look))
    return "".join(out), "mixed" if len(raw) > 1 else "single" if to in raw or to is None else "whole"


def _kana(m: re.Match) -> str:
    run = m[0]
    if not KANA.search(run):
        return run
    sure = any(c not in _HAN_OF and c not in _HIRA_OF and c not in _KATA_OF for c in run)
    if sure:
        return "".join(_KATA_OF.get(c, c) for c in run)
    return "".join(_HAN_OF.get(c, _HIRA_OF.get(c, c)) for c in run)


def unify(text: str | None) -> str | None:
    """The consistent form of a text."""
    if text is None or text.isascii():
        return text
    t = ud.normalize("NFD", "".join(map(folded, text)))
    if OTHER.search(t):
        t = RUN.sub(lambda m: resolve(m[0])[0] if OTHER.search(m[0]) else m[0], t)
    t = ud.normalize("NFC", t)
    return KANA_RUN.sub(_kana, t) if KANA.search(t) else t


def unified(df: DataFrame, key: str, *texts: str) -> DataFrame:
    """key and the consistent forms of the text columns, row by row; other columns are ignored."""

    def make():
        return lambda k, *t: [(k, *map(unify, t))]

    kind = df.schema[key].dataType.simpleString()
    return map_rows(spread(df.select(key, *texts)), make, ", ".join([f"`{key}` {kind}", *[f"`{t}` string" for t in texts]]))


def lookalikes(df: DataFrame, key: str, one: str, two: str) -> DataFrame:
    """Each key once that has a row whose two texts are different strings of one consistent form. Rows with a null are no cases; rows whose texts are both plain ASCII can't be either and are left to the scan."""
    plain = r"^\p{ASCII}*$"
    rows = df.where(F.col(key).isNotNull() & (F.col(one) != F.col(two)) & ~(F.col(one).rlike(plain) & F.col(two).rlike(plain)))

    def make():
        def row(k, a, b):
            return [(k,)] if unify(a) == unify(b) else []

        return row

    kind = df.schema[key].dataType.simpleString()
    return map_rows(spread(rows.select(key, one, two)), make, f"`{key}` {kind}").distinct()
