"""Array / sequence expressions (H1, H2, H4) — built-in array functions
only, so they stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_zero(arr: str | Column, n: int = 20) -> Column:
    """H1: right-pad with 0 to ``n``; longer arrays unchanged; an empty
    history becomes ``n`` zeros."""
    a = _c(arr)
    missing = F.lit(n) - F.size(a)
    return F.when(missing > 0, F.concat(a, F.array_repeat(F.lit(0).cast("int"), missing))).otherwise(a)


def split_last(arr: str | Column) -> tuple[Column, Column]:
    """H2: (history = all but last, label = last element)."""
    a = _c(arr)
    return F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.try_element_at(a, F.lit(-1))


def shifted_targets(arr: str | Column) -> tuple[Column, Column]:
    """H4: next-item pairs: inputs = positions 1..n-1, targets = 2..n."""
    a = _c(arr)
    n = F.size(a)
    return F.slice(a, 1, F.greatest(n - 1, F.lit(0))), F.slice(a, 2, F.greatest(n - 1, F.lit(0)))


def join_ints(arr: str | Column, sep: str = ",") -> Column:
    """Render an integer array as text (comparison-friendly output)."""
    return F.concat_ws(sep, F.transform(_c(arr), lambda x: x.cast("string")))


def explode_positions(df: DataFrame, arr: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """Array -> one row per (position, value), 0-based positions."""
    rest = [c for c in df.columns if c != arr]
    return df.select(*rest, F.posexplode(arr).alias(pos, value))
