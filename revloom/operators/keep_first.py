"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ascending(*columns: Column | str) -> list[Column]:
    """Ordering fields for :func:`keep_first` with NULLs last."""
    fields = []
    for column in columns:
        column = F.col(column) if isinstance(column, str) else column
        fields += [column.isNull(), column]
    return fields


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the smallest ``order`` per combination of ``keys``.

    NULL keys form a group like any other value.  Written as an aggregate, not as
    ``row_number() = 1``: every map task reduces a key to one row before the shuffle, so a
    key that holds a third of the table costs one row per task, and the optimizer learns
    that ``keys`` are unique in the result and can drop outer joins to it.

    ``order`` must end in something unique per key, or the choice among ties is arbitrary.
    """
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the largest ``order`` per combination of ``keys``."""
    return _pick(df, keys, order, F.max_by)


def _pick(df, keys, order, by) -> DataFrame:
    rest = [c for c in df.columns if c not in set(keys)]
    picked = df.groupBy(*keys).agg(by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[*keys, *[F.col("_row")[c].alias(c) for c in rest]]).select(*df.columns)
