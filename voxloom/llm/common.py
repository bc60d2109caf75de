"""What the operators of this subpackage share: text units, Arrow mapping, and the session's helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread, table, written

__all__ = ["TAG", "UNIT", "folded", "letters", "map_rows", "spread", "table", "units", "written"]

#: A bracket tag such as [sigh].
TAG = re.compile(r"\[[^\[\]]*\]")
_CJK = "ぁ-ゖゝ-ゟァ-ヺー-ヿㇰ-ㇿ㐀-䶿一-鿿가-힣豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
#: One unit of a text: a CJK character, a run of digits, or a word of another script.
UNIT = re.compile(rf"[{_CJK}]|\d+|[^\W\d_{_CJK}]+")


def letters(text: str | None) -> str:
    """Lower-cased letters and digits of a text, its bracket tags dropped; null counts as empty."""
    return "".join(c for c in TAG.sub("", text.lower()) if c.isalnum()) if text else ""


def units(text: str | None) -> int:
    """Number of units of a text; tags don't count."""
    return len(UNIT.findall(TAG.sub("", text))) if text else 0


def folded(name: str | Column) -> Column:
    """Trimmed, lower-cased, - read as _."""
    return F.regexp_replace(F.lower(F.trim(F.col(name) if isinstance(name, str) else name)), "-", "_")


def map_rows(df: DataFrame, make: Callable[[], Callable[..., Iterator[tuple] | list[tuple]]], schema: str) -> DataFrame:
    """Arrow-batched row mapping. make() is called once per task and gives fn(*values of one row) -> rows of the result."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out: StructType = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = [r for x in zip(*(c.to_pylist() for c in batch.columns)) for r in fn(*x)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return df.mapInArrow(run, out)
