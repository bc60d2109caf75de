"""Edit operations between sequences as Arrow UDFs (X15-X17): substitutions, insertions, deletions of one optimal alignment."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def operations(ref: list | str, hyp: list | str) -> tuple[int, int, int]:
    """(substitutions, insertions, deletions) of a shortest alignment; among those the one with most substitutions.

    Row by row over the shorter inner loop in NumPy: cost * big - substitutions is minimised, so that one pass finds both.
    """
    # what both begin or end with is matched in a best alignment
    low, most = 0, min(len(ref), len(hyp))
    while low < most and ref[low] == hyp[low]:
        low += 1
    high = 0
    while high < most - low and ref[-1 - high] == hyp[-1 - high]:
        high += 1
    ref, hyp = ref[low : len(ref) - high], hyp[low : len(hyp) - high]
    codes: dict = {}
    a = np.fromiter((codes.setdefault(x, len(codes)) for x in ref), np.int64, len(ref))
    b = np.fromiter((codes.setdefault(x, len(codes)) for x in hyp), np.int64, len(hyp))
    if not len(a) or not len(b):
        return 0, len(b), len(a)
    big = len(a) + len(b) + 1
    gaps = np.arange(len(b) + 1, dtype=np.int64) * big
    row = gaps.copy()
    for x in a.tolist():
        best = np.minimum(row[1:] + big, row[:-1] + np.where(b == x, 0, big - 1))
        nxt = np.concatenate([[row[0] + big], best])
        # an insertion adds big to the left neighbour: a running minimum of what is left after removing the gaps
        row = np.minimum.accumulate(nxt - gaps) + gaps
    cost = -(-int(row[-1]) // big)
    subs = cost * big - int(row[-1])
    rest, diff = cost - subs, len(b) - len(a)
    return subs, (rest + diff) // 2, (rest - diff) // 2


_OPS = T.StructType([T.StructField(c, T.IntegerType()) for c in "sidn"])


@F.pandas_udf(_OPS)
def _chars(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    rows = [(None,) * 4 if a is None or b is None else (*operations(a, b), len(a)) for a, b in zip(ref, hyp)]
    return pd.DataFrame(rows, columns=["s", "i", "d", "n"], dtype="Int32")


@F.pandas_udf(_OPS)
def _words(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    rows = [(None,) * 4 if a is None or b is None else (*operations(a.split(), b.split()), len(a.split(" "))) for a, b in zip(ref, hyp)]
    return pd.DataFrame(rows, columns=["s", "i", "d", "n"], dtype="Int32")


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def char_operations(ref: str | Column, hyp: str | Column) -> Column:
    """struct(s, i, d, n) by character; null if a side is null."""
    return _chars(ref, hyp)


def word_operations(ref: str | Column, hyp: str | Column) -> Column:
    """struct(s, i, d, n) by word; n counts the parts between single blanks, so an empty text counts one."""
    return _words(ref, hyp)


def match_ratio(a: str | Column, b: str | Column) -> Column:
    """Twice the matching characters over all characters, as difflib finds matches."""
    return _ratio(a, b)
