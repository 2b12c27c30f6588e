"""Fixed-size batches without a global single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, key: str, name: str = "row_no", digits: int = 3) -> DataFrame:
    """Number the rows 0, 1, 2, ... without gaps, in the order of (md5(key), key).

    ``key`` must be unique.  The order is cut into ``16 ** digits`` equal stretches by the
    leading hex digits of the hash; each stretch is numbered by itself and shifted by the
    number of rows before it.  The table of shifts has at most ``16 ** digits`` rows
    (4,096 by default) however large ``df`` is, which bounds both the one-task running
    sum over it and its broadcast.
    """
    digest = F.md5(F.col(key).cast("binary"))
    cut = df.withColumn("_digest", digest).withColumn("_stretch", F.substring("_digest", 1, digits))
    sizes = cut.groupBy("_stretch").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_stretch", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_stretch").orderBy("_digest", key)
    return (
        cut.withColumn("_rn", F.row_number().over(within) - 1)
        .join(F.broadcast(shifts), "_stretch")
        .withColumn(name, (F.col("_shift") + F.col("_rn")).cast("bigint"))
        .select(*df.columns, name)
    )


def fixed_size_batches(df: DataFrame, key: str, item: str, size: int, digits: int = 3) -> DataFrame:
    """``(batch_no, batch_size, items)``: ``item`` values in runs of exactly ``size``.

    Only the last batch may be shorter; no rows give no batch.  A group never holds more
    than ``size`` values.
    """
    if size < 1:
        raise ValueError("batch size must be positive")
    numbered = number_rows(df.select(key, item), key, "_no", digits)
    return (
        numbered.groupBy(F.floor(F.col("_no") / size).cast("bigint").alias("batch_no"))
        .agg(F.array_sort(F.collect_list(F.struct("_no", F.col(item).alias("item")))).alias("_run"))
        .select(
            "batch_no",
            F.size("_run").cast("bigint").alias("batch_size"),
            F.col("_run.item").alias("items"),
        )
    )
