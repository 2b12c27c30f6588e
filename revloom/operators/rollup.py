"""Roll children up to the parent's grain, then join one-to-one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_rollup(
    base: DataFrame, rollup: DataFrame, key: str, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Left join ``rollup`` (unique on ``key``) and fill the gaps named in ``defaults``.

    Each child is aggregated before it is joined, so several of them never multiply, and
    a hot or NULL parent key has been reduced to one row before it reaches the join.
    """
    joined = base.join(rollup, key, "left")
    fills = {
        name: F.coalesce(F.col(name), F.lit(value).cast(rollup.schema[name].dataType))
        for name, value in (defaults or {}).items()
    }
    return joined.withColumns(fills) if fills else joined
