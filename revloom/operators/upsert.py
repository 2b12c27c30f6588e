"""Keyed upsert without a row-level catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.operators.keep_first import keep_last


def _counted(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Keys and partial counts only: no blob is aggregated, and a hot key is one row per task.
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _refusals(counted: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No row, or an error for the first key that occurs twice."""
    message = F.concat(
        F.lit("duplicate key in batch: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    )
    fail = F.raise_error(message)
    return counted.where("_n > 1").select(
        *[fail.cast(field.dataType).alias(field.name) for field in source.schema.fields]
    )


def unique_batch(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, failing at run time when a key occurs twice.

    A merge with two candidate rows for one target row has no defined result, so it is
    refused.  Source rows are passed on as they are.
    """
    return source.unionByName(_refusals(_counted(source, keys), source, keys))


def latest_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``source`` reduced to its latest row per key."""
    return keep_last(source, keys, order)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[Column] | None = None,
    keep_newer: str | None = None,
) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key; others are added.

    Rows only in ``target`` are untouched.  Columns missing on one side become NULL.
    Duplicate keys in ``source`` raise, or with ``latest_by`` the latest row wins.  With
    ``keep_newer`` a stored row stays when its value in that column is greater than the
    incoming one's; by default the incoming row always wins.
    The target is only filtered by an anti join, never sorted or re-aggregated, and does
    not shuffle at all when the batch keys are small enough for the engine to broadcast.
    """
    keys = list(keys)
    batch = latest_per_key(source, keys, latest_by) if latest_by else source
    # The same keys serve the check and the anti join, so the aggregate is computed once.
    touched = batch.select(*keys) if latest_by else _counted(source, keys)
    refused = None if latest_by else _refusals(touched, source, keys)
    if keep_newer:
        stored = target.select(*keys, F.col(keep_newer).alias("_stored"))
        batch = batch.join(stored, keys, "left").where(
            F.col("_stored").isNull() | (F.col("_stored") <= F.col(keep_newer))
        )
        batch = batch.select(*source.columns)
        touched = batch.select(*keys)
    kept = target.join(touched.select(*keys), keys, "left_anti").select(*target.columns)
    merged = kept.unionByName(batch, allowMissingColumns=True)
    return merged if refused is None else merged.unionByName(refused, allowMissingColumns=True)


def newer_than_target(source: DataFrame, target: DataFrame, mark: str = "_loaded_at") -> DataFrame:
    """Rows of ``source`` past the high-water mark of ``target``; all of them when it is empty."""
    high = target.agg(F.max(mark)).scalar()
    return source.where(high.isNull() | (F.col(mark) > high))


def incremental_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    mark: str = "_loaded_at",
    latest_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Upsert only what arrived after the target's high-water mark."""
    return upsert(target, newer_than_target(source, target, mark), keys, latest_by)
