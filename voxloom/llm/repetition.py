"""Problem 2: repetition inside a single document, by line-first cleaning.

Each document is cut into lines (at line breaks and sentence marks). Every line is tested by itself against RULES, in this order:
repetition of what the document already said, punctuation, navigation, boilerplate. Failing lines are removed, with the rule that
removed them; a document that loses too much of its text is rejected. Everything that comes out is added up over the ledger of lines:
the loss, the repeated share, and how many lines each rule removed.

Repetition of a line: the share of its windows of four consecutive letters and digits (a window belongs to the line in which it
starts) that occurred before in the same document. With a line limit r and a document limit L = (s - r) / (1 - r), every document
whose repeated share over all windows is at least s loses at least L of its windows: lines that pass add less than r of theirs.
So no document with share s escapes the cleaning, and the exact share of the rejected ones is only read off their ledgers afterwards.

Nulls and empty texts: no window, share 0, not rejected. Repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import TAG, map_rows, spread

WINDOW = 4
LINE_LIMIT = 0.2
ADDRESS = 300  # most characters of a line that is an address or a page count
SOLID = 0.3  # least share of letters and digits in a line
LINE = re.compile(r"[^\n\r。！？!?；;…]+[\n\r。！？!?；;…]*|[\n\r。！？!?；;…]+")

# Words that stand alone on a line of navigation, phrases of boilerplate.
MENU = ("home", "menu", "next", "previous", "next page", "previous page", "back", "back to top", "read more", "click here", "log in", "login", "sign in", "sign up", "search", "share", "上一页", "下一页", "上一篇", "下一篇", "返回顶部", "返回", "首页", "目录", "点击这里", "查看更多", "阅读全文", "登录", "注册", "次へ", "前へ", "もっと見る", "다음", "이전", "더 보기", "inicio", "siguiente", "anterior", "leer más", "accueil", "suivant", "précédent", "lire la suite", "startseite", "weiter", "zurück", "mehr lesen")
NOTICES = ("all rights reserved", "copyright", "terms of use", "terms of service", "privacy policy", "cookie settings", "subscribe to our", "lorem ipsum", "enable javascript", "版权所有", "未经许可", "转载请注明", "隐私政策", "无断转载", "無断転載", "著作権", "무단 전재", "저작권", "todos los derechos reservados", "política de privacidad", "tous droits réservés", "mentions légales", "alle rechte vorbehalten", "datenschutz", "impressum")

_BARS = re.compile(r"(?:\S[^|»›>]{0,20}?\s*[|»›>]\s*){2,}")
_PAGE = re.compile(r"(?i)(?:page|seite|página|第)?\s*\d+\s*(?:页|/|of|de|von|sur)\s*(?:共\s*)?\d*\s*页?")
_LINK = re.compile(r"(?i)(?:https?://|www\.)\S+|\S+@\S+\.\S+")
_NOTICE = re.compile("|".join(map(re.escape, NOTICES)), re.I)
_ALONE = frozenset(MENU)


class Line(NamedTuple):
    text: str
    windows: int
    again: int  # windows that occurred before in the document


def lines_of(text: str | None) -> tuple[int, list[Line]]:
    """Number of letters and digits, and the lines with their windows; tags don't count."""
    body = TAG.sub("", text) if text else ""
    parts = LINE.findall(body)
    own = [[c for c in p.lower() if c.isalnum()] for p in parts]
    s = "".join(c for o in own for c in o)
    last, at, seen = len(s) - WINDOW + 1, 0, set()
    out = []
    for p, o in zip(parts, own):
        windows = [s[i : i + WINDOW] for i in range(at, min(at + len(o), last))]
        before = len(seen)
        seen.update(windows)
        out.append(Line(p, len(windows), len(windows) - (len(seen) - before)))
        at += len(o)
    return len(s), out


def _repeats(line: Line, bare: str, limit: float) -> bool:
    return line.windows > 0 and line.again >= limit * line.windows


def _marks(line: Line, bare: str, limit: float) -> bool:
    """Nearly all punctuation."""
    return bool(bare) and sum(c.isalnum() for c in bare) < SOLID * len(bare)


def _navigates(line: Line, bare: str, limit: float) -> bool:
    """A menu word alone, items between bars, a page count, an address."""
    word = bare.strip(" \t|»›<>:·.-").lower()
    return word in _ALONE or bool(_BARS.match(bare)) or len(bare) <= ADDRESS and bool(_PAGE.fullmatch(bare) or _LINK.fullmatch(bare))


def _notices(line: Line, bare: str, limit: float) -> bool:
    return bool(_NOTICE.search(bare))


RULES = {"repeated": _repeats, "marks": _marks, "navigation": _navigates, "boilerplate": _notices}


def clean(lines: list[Line], line_limit: float = LINE_LIMIT) -> Iterator[tuple[Line, str | None]]:
    """Each line with the first rule that it fails, or None."""
    for line in lines:
        bare = line.text.strip()
        yield line, next((name for name, rule in RULES.items() if rule(line, bare, line_limit)), None)


def loss_limit(share: float, line_limit: float = LINE_LIMIT) -> float:
    """The share of windows that a document with the given repeated share loses at least."""
    return max(0.0, (share - line_limit) / (1 - line_limit))


def judge(text: str | None, share: float = 0.4, line_limit: float = LINE_LIMIT) -> tuple:
    """(letters, windows, repeated windows, lines, failed lines by rule, lost windows, rejected, kept text) of one document."""
    n, lines = lines_of(text)
    total = sum(x.windows for x in lines)
    failed, lost, kept = dict.fromkeys(RULES, 0), 0, []
    for line, rule in clean(lines, line_limit):
        if rule:
            failed[rule] += 1
            lost += line.windows
        else:
            kept.append(line.text)
    rejected = lost > 0 and lost >= loss_limit(share, line_limit) * total
    return n, total, sum(x.again for x in lines), len(lines), failed, lost, rejected, "".join(kept)


def clean_lines(df: DataFrame, key: str, text: str, share: float = 0.4, line_limit: float = LINE_LIMIT) -> DataFrame:
    """Line-first cleaning of every row: key, n_letters, n_windows, repeated_share, n_lines, failed (lines by rule), loss_share, rejected, cleaned. Other columns are ignored."""

    def make():
        def row(k, t):
            n, total, rep, lines, failed, lost, bad, kept = judge(t, share, line_limit)
            return [(k, n, total, rep / total if total else 0.0, lines, list(failed.items()), lost / total if total else 0.0, bad, kept)]

        return row

    kind = df.schema[key].dataType.simpleString()
    return map_rows(spread(df.select(key, text)), make, f"`{key}` {kind}, n_letters int, n_windows int, repeated_share double, n_lines int, failed map<string, int>, loss_share double, rejected boolean, cleaned string")


def repetitive(df: DataFrame, key: str, text: str, share: float = 0.4, least: int = 12) -> DataFrame:
    """Keys of the documents that the cleaning rejects, of at least `least` letters; the exact repeated share of the rejected ones must then reach `share` (others lost their text to other rules, or to lines that only just failed)."""

    def make():
        def row(k, t):
            n, total, again, _, _, _, rejected, _ = judge(t, share)
            return [(k,)] if rejected and n >= least and again / total >= share else []

        return row

    kind = df.schema[key].dataType.simpleString()
    return map_rows(spread(df.select(key, text)), make, f"`{key}` {kind}")
