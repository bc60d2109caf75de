"""Problem 10: garbled text from wrong character encodings, by character n-gram models over encode-decode chains.

Clean lines of the corpus train a smoothed model of character pairs. Every run of non-ASCII characters (with the ASCII bytes that
two-byte encodings put between them) is encoded by each encoding that may have been read wrongly and decoded by each that the text
may have been written in, up to twice; the run and its candidates are scored, each as the mean log probability of its pairs with
its neighbours, and the likeliest chain is accepted if it gains more than the margin.

Margins are validated over all documents: a first pass accepts by the least margins (BASE) and counts the gains of accepted runs that
stand in clean lines; the margins are raised until at most a share FALSE of all runs is such a gain. Whatever a higher margin accepts a
lower one has accepted too, so the second pass only looks at the documents that the first one found. Two prunings change no result: a
run that scores better than minus the margin can only be beaten by chains that end in UTF-8 (which have a margin of their own), and a
run whose characters an encoding lacks isn't encoded.

Lines are clean if they hold nothing that garbling typically leaves (controls, replacement and box characters, chains of accented
letters, rare Chinese characters). All pairs of all clean lines are counted, in HASHES x 2^COUNTERS counters (a pair counts as the
least of its counters), which is all that is broadcast beside the counts of single characters (bounded by Unicode): the size of the model
doesn't depend on that of the corpus, and no pair is left out.

A document is found if a chain is accepted for one of its runs. TESTDATA.md counts lost characters as cases too, so it is also found, outside
the margin, if it holds a replacement character (U+FFFD), or a run that decodes to UTF-8 except for lost characters; those are marked
lost. Null, empty and plain ASCII texts are no cases; restored is null where nothing changed; repeated rows each give a row.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import accumulate
from operator import concat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, spread, written

COUNTERS = 20  # bits
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BASE = (0.0, 7.5)  # least gain, natural log a pair, of chains that end in UTF-8 and of others
FALSE = 0.002
BINS = 100  # of gains, a unit
SUSPECT = -10.0  # mean log probability below which a run is tried in smaller pieces too

#: Encodings that a text may have been read in by mistake; those of one byte a character are read leniently.
SINGLE = ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250", "cp1253")
DOUBLE = ("gb18030", "big5", "cp932", "cp949", "euc_jp")
#: Encodings that it may have been written in.
WRITTEN = ("utf-8", "gb18030", "big5", "cp932", "cp949", "euc_jp")


@cache
def _bytes_of(encoding: str) -> dict[str, int]:
    """Character -> byte of a one-byte encoding; undefined bytes are the controls of the same number."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        out[c] = b
    if encoding == "cp1252":
        out |= {chr(b): b for b in range(128, 256) if chr(b) not in out}
    return out


@cache
def _as_latin(encoding: str) -> dict[int, int]:
    """For str.translate: each character to the one of its byte's number; upper characters that the encoding lacks go beyond a byte."""
    return {b: 0x100 for b in range(128, 256)} | {ord(c): b for c, b in _bytes_of(encoding).items()}


RUN = re.compile(r"[^\x00-\x7f](?:[\x40-\x7e]?[^\x00-\x7f]+)*[\x40-\x7e]?")
PIECE = re.compile(r"[\u2e80-\uffff]+|[\x80-\u2e7f]+")
CLAUSE = re.compile(r"[^。！？，、；：“”]+")
BARE = re.compile(r"[^\x00-\x7f]+")
_ASCII = re.compile(r"[\x00-\x7f]")
_ODD = re.compile(r"[\x80-\x9f�-─-◿]|[¡-¿À-ɏ€‚ƒ„†‡ˆ‰‹›œ˜™š]{2,}|[√≠∞±≤≥∂∑∏π∫Ω¬ƒ≈∆«»◊]|[Ѐ-Яѐ-ӿ][^\W\d_А-я]|[Ђ-Џђ-џ]")


def common(c: str) -> bool:
    """Han characters of the first levels of the Chinese and Japanese standards."""
    try:
        if 0xB0 <= c.encode("gb2312")[0] <= 0xD7:
            return True
    except UnicodeEncodeError:
        pass
    try:
        b = c.encode("cp932")
        return len(b) == 2 and 0x88 <= b[0] <= 0x97
    except UnicodeEncodeError:
        return False


@cache
def _strange() -> re.Pattern:
    """What a clean line doesn't hold."""
    rare = "".join(c for c in map(chr, range(0x3400, 0xA000)) if not common(c))
    return re.compile(rf"{_ODD.pattern}|[\uff66-\uff9f\ufe30-\ufe4f\u3100-\u312f\ue000-\uf8ff{rare}]")


def is_clean(line: str) -> bool:
    return line.isascii() or not _strange().search(line)


def _slots(a, b) -> list:
    """The counter of a pair of code points in each row of counters; for arrays or plain integers."""
    if isinstance(a, np.ndarray):
        x = a.astype(np.uint64) << np.uint64(21) | b.astype(np.uint64)
        return [(x * np.uint64(h) >> np.uint64(64 - COUNTERS)).astype(np.int64) for h in HASHES]
    return [((a << 21 | b) * h & 0xFFFFFFFFFFFFFFFF) >> (64 - COUNTERS) for h in HASHES]


class Model(dict):
    """Interpolated log probabilities of character pairs, worked out when they are first asked for."""

    def __init__(self, counters: list[np.ndarray], chars: dict[str, int]):
        self.counters, self.chars = counters, chars
        self.total = sum(chars.values()) + 1

    def __missing__(self, ab: str) -> float:
        a, b = ab
        one = (self.chars.get(b, 0) + 0.02) / (self.total + 0.02 * 70_000)
        n = self.chars.get(a, 0)
        both = min(float(c[k]) for c, k in zip(self.counters, _slots(ord(a), ord(b)))) if n and b in self.chars else 0.0
        got = math.log(0.75 * min(1.0, both / n) + 0.25 * one) if n else math.log(one * 0.5)
        if len(self) > 500_000:
            self.clear()
        self[ab] = got
        return got

    def score(self, before: str, s: str, after: str) -> float:
        """Mean log probability of the pairs that touch s."""
        t = before[-1:] + s + after[:1]
        if len(t) < 2:
            return self[" " + t] if t else 0.0
        return sum(map(self.__getitem__, map(concat, t, t[1:]))) / (len(t) - 1)


#: A character that no one-byte encoding has.
_WIDE = re.compile(r"[\u2e80-\uf8fe\uff00-\uffff\U00010000-\U0010ffff]")
#: What no accepted text holds: controls other than white space, private characters.
_BARRED = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ue000-\uf8ff]")


def encoded(s: str, encoding: str) -> bytes | None:
    """Bytes of a run as it was read in encoding; None if it can't have been."""
    try:
        return s.translate(_as_latin(encoding)).encode("latin-1") if encoding in SINGLE else s.encode(encoding)
    except UnicodeEncodeError:
        return None


def decoded(b: bytes, encoding: str) -> str | None:
    try:
        return b.decode(encoding)
    except UnicodeDecodeError:
        return None


def candidates(s: str, sure: bool = False) -> Iterator[tuple[str, str]]:
    """(chain, text) of every chain that gives another text, up to two steps; sure: only of those that end in UTF-8. A single character is only changed by UTF-8, whose decoding proves itself."""
    seen = {s}
    level = [("", s)]
    for _ in range(2):
        nxt = []
        for chain, t in level:
            rights = WRITTEN[:1] if sure or len(t) - len(_ASCII.findall(t)) < 2 else WRITTEN
            for wrong in DOUBLE if _WIDE.search(t) else (*SINGLE, *DOUBLE):
                b = encoded(t, wrong)
                if b is None:
                    continue
                for right in rights:
                    if right == wrong:
                        continue
                    u = decoded(b, right)
                    if not u or u in seen or _BARRED.search(u):
                        continue
                    seen.add(u)
                    step = f"{chain}{'>' if chain else ''}{wrong}:{right}"
                    yield step, u
                    if right == "utf-8":
                        nxt.append((step, u))
        level = nxt


#: Two whole sequences of UTF-8.
_SEQUENCES = re.compile(rb"(?s)(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}).*?(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})")


def lost(s: str, before: str, after: str, model: Model, margin: float) -> tuple[str, str] | None:
    """(chain, text) of a run of UTF-8 read in another encoding that lost characters: what is left, with U+FFFD for what is gone. At least two whole sequences that are likelier than the run by the margin, or a cut one of general punctuation."""
    for wrong in ("gb18030",) if _WIDE.search(s) else (*SINGLE, "gb18030"):
        b = encoded(s, wrong)
        if b is None or len(b) < 2 or not (_SEQUENCES.search(b) or b[-2:] == b"\xe2\x80"):
            continue
        u = b.decode("utf-8", "replace")
        gone = u.count("\ufffd")
        good = len(u) - gone - len(_ASCII.findall(u))
        likely = good >= 2 and good >= 2 * gone and model.score(before, u.replace("\ufffd", ""), after) > model.score(before, s, after) + margin
        if gone and (likely or gone == 1 and b[-2:] == b"\xe2\x80" and u[-1] == "\ufffd"):
            return f"{wrong}:utf-8 with losses", u
    return None


@lru_cache(100_000)
def _tried(s: str, sure: bool) -> tuple[tuple[str, str], ...]:
    return tuple(candidates(s, sure))


def best(s: str, before: str, after: str, model: Model, margins: tuple[float, float]) -> tuple[str, str, float] | None:
    """The likeliest accepted chain of a run: (chain, text, gain). margins: of chains that end in UTF-8, of others."""
    own, top = model.score(before, s, after), None
    only_sure = -own <= margins[1]  # no score is above 0, so no gain above -own
    for chain, u in _tried(s, only_sure) if len(s) <= 8 else candidates(s, only_sure):
        sure = chain.endswith(":utf-8")
        gain = model.score(before, u, after) - own + (20.0 if "\ufffd" in u and sure else 0.0)
        if gain > margins[0 if sure else 1] and (top is None or gain > top[2]):
            top = (chain, u, gain)
    return top


_ONE = re.compile(rb"[\xe0-\xef][\x80-\xbf]{2}")
_TWO = re.compile(rb"(?:[\xe0-\xef][\x80-\xbf]{2}){2}")


def hidden(s: str) -> list[tuple[int, int]]:
    """Stretches of a run whose bytes, in an encoding of two bytes a character, are two whole sequences of UTF-8 (of three bytes, as Chinese, Japanese, Korean and general punctuation have them) or more: garbled words between clean characters of the same script."""
    for wrong in DOUBLE[:4]:
        b = encoded(s, wrong)
        if b is None or not _TWO.search(b):
            continue
        at = list(accumulate((len(c.encode(wrong)) for c in s), initial=0)) if len(b) != 2 * len(s) else list(range(0, len(b) + 1, 2))
        place, out, i = {x: k for k, x in enumerate(at)}, [], 0
        while i < len(s):
            end, n, last = at[i], 0, -1
            while m := _ONE.match(b, end):
                end, n = m.end(), n + 1
                if n >= 2 and end in place:
                    last = place[end]
            if last > i:
                out.append((i, last))
                i = last
            else:
                i += 1
        if out:
            return out
    return []


def _spans(text: str, lo: int, hi: int, model: Model) -> Iterator[list[tuple[int, int]]]:
    """Ways to cut the run text[lo:hi], the coarsest first: as it is; without its last ASCII character; by script; to what hides UTF-8. What then looks garbled is also cut by sentence marks (which belong to what stands around), to what one encoding can hold, and at its ends."""
    s = text[lo:hi]
    yield [(lo, hi)]
    if s[-1] <= "\x7f":
        yield [(lo, hi - 1)]
    yield [(lo + x.start(), lo + x.end()) for x in PIECE.finditer(s)]
    if len(s) < 4:
        return
    if inside := [(lo + x.start() + i, lo + x.start() + j) for x in PIECE.finditer(s) if x[0][0] > "\u2e7f" for i, j in hidden(x[0])]:
        yield inside
    odd = []
    for x in CLAUSE.finditer(s):
        i, j = lo + x.start(), lo + x.end()
        if j - i >= 3 and model.score(text[max(0, i - 1) : i], text[i:j], text[j : j + 1]) < SUSPECT:
            odd.append((i, j))
    if odd:
        yield odd
        for a, b in ((1, 0), (0, 1), (1, 1), (0, 2), (2, 0)):
            yield [(i + a, j - b) for i, j in odd if j - i > a + b]
        for wrong in SINGLE:
            table = _bytes_of(wrong)
            cut: list[tuple[int, int]] = []
            for i, j in odd:
                at = i
                for k in range(i, j + 1):
                    if k == j or text[k] > "\x7f" and text[k] not in table:
                        cut += [(at, k)] if k - at > 3 else []
                        at = k + 1
            yield cut


def repair(text: str, model: Model, margins: tuple[float, float]) -> tuple[str, list[tuple[str, str, str, float, int]], int]:
    """The restored text, (run, chain, restored, gain, place) of each accepted run, and the number of runs. A run that no chain explains is tried again in its pieces."""
    out, at, found, n = [], 0, [], 0
    for m in RUN.finditer(text):
        n += 1
        lo, s = m.start(), m[0]
        got: list = []
        for group in _spans(text, lo, m.end(), model):
            for i, j in group:
                part = text[i:j]
                if x := best(part, text[max(0, i - 1) : i], text[j : j + 1], model, margins):
                    got.append((i, j, (part, *x)))
            if got:
                break
        else:
            for x in PIECE.finditer(s):
                i, j = lo + x.start(), lo + x.end()
                if y := lost(text[i:j], text[max(0, i - 1) : i], text[j : j + 1], model, margins[1] / 2):
                    got.append((i, j, (text[i:j], *y, 0.0)))
        for i, j, x in got:
            out += [text[at:i], x[2]]
            at = j
            found.append((*x, i))
    out.append(text[at:])
    return "".join(out), found, n


def train(df: DataFrame, text: str) -> Model:
    """Counts pairs and characters of all clean lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.zeros(1 << COUNTERS, np.int64) for _ in HASHES]
        chars = np.zeros(0x110000, np.int64)
        for b in batches:
            strange = _strange()
            clean = [line for t in b.column(0).to_pylist() if t for line in t.split("\n") if line.isascii() or not strange.search(line)]
            codes = np.frombuffer(("\n" + "\n".join(clean) + "\n").encode("utf-32-le"), np.uint32)
            used, n = np.unique(codes, return_counts=True)
            chars[used] += n
            for row, slots in zip(rows, _slots(codes[:-1], codes[1:])):
                slots, n = np.unique(slots, return_counts=True)
                row[slots] += n
        for k, counts in enumerate([*rows, chars]):
            at = np.flatnonzero(counts)
            for lo in range(0, len(at), 100_000):
                part = at[lo : lo + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k, np.int32)), pa.array(part.astype(np.int32)), pa.array(counts[part])], names=["row", "slot", "n"])

    got = spread(df.select(text)).mapInArrow(run, "row int, slot int, n bigint").groupBy("row", "slot").agg(F.sum("n").alias("n")).toPandas()  # at most HASHES x 2^COUNTERS rows and one per character
    counters = [np.zeros(1 << COUNTERS, np.float32) for _ in HASHES]
    for k, row in enumerate(counters):
        mine = got[got["row"] == k]
        row[mine["slot"].to_numpy()] = mine["n"].to_numpy()
    mine = got[got["row"] == len(HASHES)]
    return Model(counters, {chr(c): n for c, n in zip(mine["slot"].tolist(), mine["n"].tolist())})


def raised(gains: list[tuple[bool, int, int]], runs: int) -> tuple[float, float]:
    """Margins from the (sure, bin, count) of gains in clean lines: BASE, or where at most a share FALSE of all runs gains more."""
    out = []
    for sure, base in zip((True, False), BASE):
        above, margin = 0, base
        for _, b, n in sorted((g for g in gains if g[0] == sure), reverse=True):
            above += n
            if above > runs * FALSE:
                margin = max(base, (b + 1) / BINS)
                break
        out.append(margin)
    return out[0], out[1]


def restored(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, found, lost (characters are gone), runs (accepted), chains (distinct, sorted), restored (null where nothing changed) of every row."""
    model = train(df.select(text), text)
    sent = df.sparkSession.sparkContext.broadcast((model.counters, model.chars))
    name = uuid.uuid4().hex
    kind = df.schema[key].dataType.simpleString()
    result = "found boolean, lost boolean, runs int, chains array<string>, restored string"

    def tried(t: str, m: Model, margins: tuple[float, float]) -> tuple:
        u, found, n = repair(t, m, margins)
        gone = "\ufffd" in u
        return (bool(found) or gone, gone, len(found), sorted({x[1] for x in found}), u if found else None), found, n

    def first():
        m = _model(name, sent)

        def row(k, t):
            if t is None or t.isascii():
                return [(k, False, False, 0, [], None, None, 0, [])]
            got, found, n = tried(t, m, BASE)
            gains = []
            for _, chain, _, gain, at in found:
                line = t[t.rfind("\n", 0, at) + 1 : (t.find("\n", at) + 1 or len(t) + 1) - 1]
                if is_clean(line):
                    gains.append((chain.endswith(":utf-8"), int(gain * BINS)))
            return [(k, *got, t if got[0] else None, n, gains)]

        return row

    once = written(map_rows(spread(df.select(key, text)), first, f"`{key}` {kind}, {result}, _t string, _n int, _g array<struct<sure: boolean, bin: int>>"))
    runs = once.agg(F.sum("_n")).first()[0] or 0
    gains = [tuple(r) for r in once.select(F.explode("_g").alias("g")).groupBy("g.sure", "g.bin").agg(F.count("*")).collect()]  # BINS a unit of log probability
    margins = raised(gains, runs)
    if margins == BASE:
        return once.drop("_t", "_n", "_g")

    def second():
        m = _model(name, sent)
        return lambda k, t: [(k, *tried(t, m, margins)[0])]

    kept = map_rows(spread(once.where("found").select(key, "_t")), second, f"`{key}` {kind}, {result}")
    return once.where("not found").drop("_t", "_n", "_g").unionByName(kept)


_MODELS: dict[str, Model] = {}


def _model(name: str, sent) -> Model:
    """The model of a broadcast, built once per worker."""
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = Model(*sent.value)
    return _MODELS[name]
