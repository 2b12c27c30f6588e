"""Data assertions.  Every check returns ``(test, failures)``; zero failures = pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _report(checks: DataFrame) -> DataFrame:
    return checks.select("test", F.col("failures").cast("bigint").alias("failures"))


def all_of(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL, per column; one scan for all the columns of a table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = counts.unpivot([], list(columns), "column", "failures")
    return _report(stacked.withColumn("test", F.concat(F.lit(f"not_null:{table}."), "column")))


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` by ``keys`` over the session's shuffle partitions, before anything is counted.

    Nearly all values of a key differ, so counting them ahead of the shuffle would save no row and
    hold them all in memory.  The partitions are named, not defaulted: merged into larger ones,
    as defaulted ones are, their counts would outgrow a task's memory.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    present = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_key"))
    repeated = _dealt(present, "_key").groupBy("_key").count().where("count > 1")
    counted = repeated.agg(F.count(F.lit(1)).alias("failures"))
    return _report(counted.withColumn("test", F.lit(f"unique:{table}.{column}")))


def keys(df: DataFrame, table: str, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """:func:`not_null` of ``columns`` and :func:`unique` of ``key`` from one pass.

    Rows are counted per key, NULLs with them; the totals follow from one row per key.
    """
    if key is None:
        return not_null(df, table, columns)
    others = [c for c in columns if c != key]
    # Rows without a key stay apart by the task that read them, so that no task gets them all.
    spread = F.when(F.col(key).isNull(), F.spark_partition_id()).alias("_spread")
    rows = df.select(F.col(key).alias("_key"), spread, *[F.col(c).isNull().alias(f"_{c}") for c in others])
    nulls = [F.count_if(f"_{c}").alias(f"_{c}") for c in others]
    per_key = _dealt(rows, "_key", "_spread").groupBy("_key", "_spread").agg(F.count(F.lit(1)).alias("_n"), *nulls)
    # The key's own NULLs are the groups without a key: nothing has to be carried for them.
    keyless = F.sum(F.when(F.col("_key").isNull(), F.col("_n")))
    totals = per_key.agg(
        *[
            F.coalesce(keyless if c == key else F.sum(f"_{c}"), F.lit(0)).alias(f"not_null:{table}.{c}")
            for c in columns
        ],
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias(f"unique:{table}.{key}"),
    )
    return _report(totals.unpivot([], [f"`{c}`" for c in totals.columns], "test", "failures"))


class WriteChecks:
    """Tests of single rows, counted while a table is written, so that no test reads it again.

    A lost executor may have rows of a write counted twice, or an optimized plan may drop the
    count.  So only "none fails" is believed; any other answer is settled by an exact count
    over the stored table, of the columns in question alone.
    """

    def __init__(self) -> None:
        self._watched: dict[str, tuple[Observation, dict[str, Column]]] = {}

    def watch(
        self, df: DataFrame, table: str, columns: Sequence[str] = (), rules: Mapping[str, Column] | None = None
    ) -> DataFrame:
        """``df``, to be written once; ``rules`` names conditions that no row may meet."""
        tests = {f"not_null:{table}.{c}": F.col(c).isNull() for c in columns} | dict(rules or {})
        if not tests:
            return df
        seen = Observation(f"{table}-{uuid.uuid4().hex}")
        self._watched[table] = (seen, tests)
        return df.observe(seen, *[F.count_if(failing).alias(f"_{i}") for i, failing in enumerate(tests.values())])

    def report(self, spark: SparkSession, stored: Callable[[str], DataFrame]) -> DataFrame:
        """``(test, failures)`` of all tables, once they are written."""
        clean, doubtful = [], []
        for table, (seen, tests) in self._watched.items():
            metrics = seen.get
            settled = [name for i, name in enumerate(tests) if metrics.get(f"_{i}") == 0]
            clean += [(name, 0) for name in settled]
            open_tests = {name: failing for name, failing in tests.items() if name not in settled}
            if open_tests:
                doubtful.append(_count_failing(stored(table), open_tests))
        return all_of([spark.createDataFrame(clean, "test string, failures bigint"), *doubtful])


def _count_failing(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    totals = df.agg(*[F.count_if(failing).alias(name) for name, failing in tests.items()])
    return _report(totals.unpivot([], [f"`{name}`" for name in tests], "test", "failures"))


def relationship(
    child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_name: str, parent_column: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    Child rows are first counted per key, so a key with a third of all rows meets the
    parent as a single row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).count()
    known = parent.select(F.col(parent_column).alias("_key"))
    orphans = keys.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures"))
    name = f"relationship:{child_name}.{column}->{parent_name}.{parent_column}"
    return _report(orphans.withColumn("test", F.lit(name)))


def expect_none(failing: DataFrame, name: str) -> DataFrame:
    """Counts the rows of a query that should return none."""
    return _report(failing.agg(F.count(F.lit(1)).alias("failures")).withColumn("test", F.lit(name)))


def run_suite(failing: Mapping[str, DataFrame]) -> DataFrame:
    """``(test, failures, passed)`` for a set of named queries that should return no row."""
    checks = all_of([expect_none(df, name) for name, df in failing.items()])
    return checks.withColumn("passed", F.col("failures") == 0)


def freshness(
    df: DataFrame,
    source: str,
    as_of: Column,
    warn_hours: float,
    error_hours: float,
    mark: str = "_loaded_at",
) -> DataFrame:
    """``(source, max_loaded_at, age_hours, status)``; an empty source is an error."""
    age = (F.unix_micros(as_of) - F.unix_micros("max_loaded_at")) / F.lit(3_600_000_000.0)
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return (
        df.agg(F.max(mark).alias("max_loaded_at"))
        .withColumn("source", F.lit(source))
        .withColumn("age_hours", F.round(age, 3))
        .withColumn("status", status)
        .select("source", "max_loaded_at", "age_hours", "status")
    )
