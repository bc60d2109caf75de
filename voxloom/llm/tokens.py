"""Problem 8: encoding of a corpus with a public byte-level BPE tokenizer, by contiguous rank arrays.

A short word (a piece of the splitting pattern) is a list of part boundaries and a parallel list of the ranks of adjacent parts.
The least rank is found by scanning, its right boundary deleted and the two neighbouring ranks refreshed, until no pair has a
rank. Words of more than LONG bytes (runs without spaces can be whole paragraphs) use a heap with links instead, which gives the
same parts in n log n steps. Words repeat, so each Python worker remembers up to CACHE of them.

Empty and null texts both give an empty list; strings that look like special tokens are ordinary text; repeated rows each give a
row. The vocabulary is read on the executors from the installed file (parameter vocabulary), never copied.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread

VOCABULARY = "byte_bpe_50k.tiktoken"
LONG = 128
CACHE = 200_000
_NONE = 1 << 60


def file_of(vocabulary: str) -> str:
    """Path of a named public vocabulary; a path is taken as it is."""
    if "/" in vocabulary:
        return vocabulary
    import public_tokenizers

    return str(public_tokenizers.path(vocabulary))


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Boundaries of the parts of a short word."""
    at = list(range(len(word) + 1))
    get = ranks.get
    rank = [get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while rank:
        least = min(rank)
        if least == _NONE:
            break
        k = rank.index(least)
        del at[k + 1], rank[k]
        if k < len(rank):
            rank[k] = get(word[at[k] : at[k + 2]], _NONE)
        if k:
            rank[k - 1] = get(word[at[k - 1] : at[k + 1]], _NONE)
    return at


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same boundaries for a long word, by a heap of (rank, position) over linked parts."""
    n = len(word)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))  # part i spans i .. right[i]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray([1]) * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = right[i]
        if not alive[i] or j >= n or right[j] != end:
            continue
        right[i], alive[j] = end, 0
        if end < n:
            left[end] = i
            if (r := ranks.get(word[i : right[end]])) is not None:
                heapq.heappush(heap, (r, i, right[end]))
        if (h := left[i]) >= 0 and (r := ranks.get(word[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    at, i = [0], 0
    while i < n:
        i = right[i]
        at.append(i)
    return at


class Encoder:
    """One tokenizer, held per worker."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        raw = w.encode("utf-8", "replace")
        if raw in self.ranks:
            return [self.ranks[raw]]
        at = (_merge_short if len(raw) <= LONG else _merge_long)(raw, self.ranks)
        return [self.ranks[raw[a:b]] for a, b in zip(at, at[1:])]

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known = self.known
        for w in self.find(text) if text else ():
            got = known.get(w)
            if got is None:
                got = self.word(w)
                if len(w) <= LONG:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = got
            out += got
        return out


@cache
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    import public_tokenizers

    return Encoder(file_of(vocabulary), public_tokenizers.PATTERN)


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, out: str = "ids") -> DataFrame:
    """key and the token ids of each row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(ends[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[key, out])

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, `{out}` array<int>")


def count_tokens(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, out: str = "tokens", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, kept columns and the number of tokens of each row; the ids stay in the worker."""
    cols = [key, *keep]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            n = pa.array([len(enc.encode(t)) for t in b.column(len(cols)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(cols)], n], names=[*cols, out])

    return spread(df.select(*cols, F.col(text).alias("_text"))).mapInArrow(run, f"{kinds}, `{out}` bigint")
