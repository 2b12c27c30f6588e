"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(
    df: DataFrame,
    value: str,
    bins: int = 20,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """``(bin, bin_low, bin_high, row_count)`` for bins 1..``bins``, empty bins included.

    The range is the data's own unless given.  Bins are closed below and open above; the
    last one is closed on both ends.  NULL values are not counted.  Row counts are
    reduced in the map tasks to one row per bin, so a bin holding most rows is harmless.
    """
    number = F.col(value).cast("double")
    present = df.where(F.col(value).isNotNull()).select(number.alias("_v"))
    if low is None or high is None:
        span = present.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    else:
        span = F.struct(F.lit(float(low)).alias("lo"), F.lit(float(high)).alias("hi"))
    lo, hi = F.col("_span.lo"), F.col("_span.hi")
    counted = (
        present.withColumn("_span", span)
        .select(_bin_of(F.col("_v"), lo, hi, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    # The scaffold has exactly `bins` rows and the counts at most that many.
    scaffold = df.sparkSession.range(1, bins + 1, 1, 1).select(
        F.col("id").cast("int").alias("bin"), span.alias("_span")
    )
    width = (hi - lo) / F.lit(float(bins))
    return (
        scaffold.where(lo.isNotNull())
        .join(F.broadcast(counted), "bin", "left")
        .select(
            "bin",
            F.round(lo + width * (F.col("bin") - 1), 4).alias("bin_low"),
            F.round(lo + width * F.col("bin"), 4).alias("bin_high"),
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        )
    )


def _bin_of(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    position = F.width_bucket(value, lo, hi, F.lit(bins)).cast("int")
    # One distinct value makes an empty range, for which width_bucket gives NULL.
    return F.coalesce(F.least(F.lit(bins), F.greatest(F.lit(1), position)), F.lit(1))
