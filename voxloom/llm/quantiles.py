"""Problem 5: percentiles per group with bounded error, by deterministic buffer collapsing.

A summary holds full buffers of SIZE sorted values, each with a weight, and a tail of fewer than SIZE single values. When FAN
buffers of one weight exist, they collapse into one of FAN times the weight, by selecting evenly spaced positions of their merged
order; so weights form a tree and the total rank error is bounded by (W - C - 1) / 2 + w, with W the sum of the weights of all
collapse outputs, C the number of collapses and w the heaviest weight. W and C travel with the summary, so the bound holds for
whatever was joined: its values depend on how the rows were split into tasks, its bound doesn't fail. Groups of fewer than SIZE values
are exact. size_for() gives the size that an error of epsilon n needs (SIZE: 0.2 % of 10^5 values, 0.6 % of 10^10).

Summaries are made per task, group and day while reading, then folded, sorted by group, one after the other in constant memory:
first in SALTS parts per group and day, then per group and day, then per group. No random choice is made, and the bound holds whatever the order of joining.

Nulls, NaN and infinite values don't count; each row counts once, repeated ones too; a null group is a group of its own; empty
tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 1024
FAN = 4
SALTS = 16
LEVELS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
_FIELDS = "n bigint, collapses bigint, outputs bigint, weights array<bigint>, buffers array<double>, tail array<double>"


def size_for(epsilon: float, n: int, fan: int = FAN) -> int:
    """Least buffer size (a multiple of 64) with which the rank error stays below epsilon n for a group of n values: every level of the tree of collapses weighs n / size in all, and the heaviest buffer n / size at most."""
    size = 64
    while size < n:
        levels = max(0, math.ceil(math.log(n / size, fan)))
        if (levels / 2 + 1) / size <= epsilon:
            return size
        size += 64
    return size


class Summary:
    """Buffers by weight, tail, and what bounds the error."""

    def __init__(self, size: int = SIZE, fan: int = FAN):
        self.size, self.fan, self.n, self.collapses, self.outputs = size, fan, 0, 0, 0
        self.buffers: dict[int, list[np.ndarray]] = {}
        self.tail = np.empty(0)

    def _keep(self, weight: int, values: np.ndarray) -> None:
        self.buffers.setdefault(weight, []).append(values)
        while len(self.buffers.get(weight, ())) >= self.fan:
            merged = np.sort(np.concatenate(self.buffers.pop(weight)), kind="stable")
            # all inputs have one weight, so position p of the weighted order is element p // weight
            out = weight * self.fan
            first = (out + 1) // 2 if out % 2 else out // 2 + self.collapses % 2
            at = (first - 1 + out * np.arange(self.size)) // weight
            self.collapses, self.outputs, weight = self.collapses + 1, self.outputs + out, out
            self.buffers.setdefault(weight, []).append(merged[at])

    def add(self, values: np.ndarray) -> None:
        """Joins single values."""
        self.n += len(values)
        rest = np.concatenate([self.tail, values])
        full = len(rest) // self.size
        for k in range(full):
            self._keep(1, np.sort(rest[k * self.size : (k + 1) * self.size]))
        self.tail = rest[full * self.size :]

    def merge(self, n: int, collapses: int, outputs: int, weights: list[int], buffers: np.ndarray, tail: np.ndarray) -> None:
        """Joins another summary."""
        self.collapses += collapses
        self.outputs += outputs
        for k, w in enumerate(weights):
            self._keep(w, buffers[k * self.size : (k + 1) * self.size])
        self.add(tail)
        self.n += n - len(tail)

    def row(self) -> tuple:
        weights = [w for w in sorted(self.buffers) for _ in self.buffers[w]]
        flat = np.concatenate([b for w in sorted(self.buffers) for b in self.buffers[w]] or [np.empty(0)])
        return self.n, self.collapses, self.outputs, weights, flat, self.tail

    def error(self) -> float:
        """Most by which the rank of an answer can differ from the one asked for."""
        return max(0.0, (self.outputs - self.collapses - 1) / 2) + max(self.buffers) if self.collapses else 0.0

    def quantiles(self, levels: tuple[float, ...]) -> list[float]:
        """For each level q the least kept value whose weighted rank reaches ceil(q n), 1 at least."""
        _, _, _, weights, flat, tail = self.row()
        values = np.concatenate([flat, tail])
        heavy = np.concatenate([np.repeat(np.array(weights, np.int64), self.size), np.ones(len(tail), np.int64)])
        order = np.argsort(values, kind="stable")
        rank = np.cumsum(heavy[order])
        return [float(values[order][min(int(np.searchsorted(rank, max(1, math.ceil(q * self.n)))), len(values) - 1)]) for q in levels]


def _of(batch: pa.RecordBatch, at: int, i: int) -> tuple:
    n, c, o, w, b, t = (batch.column(at + k) for k in range(6))
    cut = lambda col: col.values.to_numpy(zero_copy_only=False)[col.offsets[i].as_py() : col.offsets[i + 1].as_py()]
    return n[i].as_py(), c[i].as_py(), o[i].as_py(), cut(w).tolist(), cut(b), cut(t)


def _batch(rows: list[tuple], groups: int) -> pa.RecordBatch:
    kinds = [pa.string()] * groups + [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[str(k) for k in range(groups + 6)])


def partials(df: DataFrame, value: str, groups: dict[str, Column], size: int = SIZE) -> DataFrame:
    """Summaries of value per task and group (string columns)."""
    names = list(groups)
    rows = df.select(*[c.cast("string").alias(k) for k, c in groups.items()], F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v) and abs(_v) < double('infinity')")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Summary] = {}
        for b in batches:
            keys = list(zip(*(c.to_pylist() for c in b.columns[:-1]))) if names else [()] * b.num_rows
            code: dict[tuple, int] = {}
            which = np.fromiter((code.setdefault(k, len(code)) for k in keys), np.int64, len(keys))
            v = b.column(len(names)).to_numpy(zero_copy_only=False)
            order = np.argsort(which, kind="stable")
            for k, part in zip(code, np.split(v[order], np.cumsum(np.bincount(which, minlength=len(code)))[:-1])):
                held.setdefault(k, Summary(size)).add(part)
            if len(held) > 5000:  # many small groups: hand them on, they are joined anyway
                yield _batch([(*k, *s.row()) for k, s in held.items()], len(names))
                held.clear()
        if held:
            yield _batch([(*k, *s.row()) for k, s in held.items()], len(names))

    return rows.mapInArrow(run, ", ".join([*[f"`{k}` string" for k in names], _FIELDS]))


def fold(df: DataFrame, names: list[str], salts: int = 1, size: int = SIZE) -> DataFrame:
    """Joins all summaries of a group (in salts parts), in constant memory. Columns before the six fields, other than names, are dropped."""
    fields = ["n", "collapses", "outputs", "weights", "buffers", "tail"]
    part = F.pmod(F.xxhash64("n", "tail"), F.lit(salts)).cast("string").alias("_salt")
    ordered = df.select(*names, part, *fields).repartition(*names, "_salt").sortWithinPartitions(*names, "_salt", "n")
    width = len(names) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = Summary(size), None
        for b in batches:
            done = []
            for i, k in enumerate(zip(*(c.to_pylist() for c in b.columns[:width]))):
                if key is not None and k != key:
                    done.append((*key[:-1], *now.row()))
                    now = Summary(size)
                key = k
                now.merge(*_of(b, width, i))
            if done:
                yield _batch(done, len(names))
        if key is not None:
            yield _batch([(*key[:-1], *now.row())], len(names))

    return ordered.mapInArrow(run, ", ".join([*[f"`{k}` string" for k in names], _FIELDS]))


def daily(df: DataFrame, value: str, groups: dict[str, Column], day: Column, size: int = SIZE) -> DataFrame:
    """Partial results per group and day, to be kept and joined later."""
    names = [*groups, "day"]
    return fold(fold(partials(df, value, groups | {"day": day}, size), names, SALTS, size), names, 1, size)


def percentiles(summaries: DataFrame, names: list[str], levels: tuple[float, ...] = LEVELS, size: int = SIZE) -> DataFrame:
    """Joins summaries over names and reads off the levels: names, q, value, n, rank_error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, k in enumerate(zip(*(c.to_pylist() for c in b.columns[: len(names)])) if names else [()] * b.num_rows):
                s = Summary(size)
                s.merge(*_of(b, len(names), i))
                rows += [(*k, q, v, s.n, s.error()) for q, v in zip(levels, s.quantiles(levels))] if s.n else []
            if rows:
                kinds = [pa.string()] * len(names) + [pa.float64(), pa.float64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[str(k) for k in range(len(kinds))])

    whole = fold(fold(summaries, names, SALTS, size), names, 1, size)
    return whole.mapInArrow(run, ", ".join([*[f"`{k}` string" for k in names], "q double, value double, n bigint, rank_error double"]))
