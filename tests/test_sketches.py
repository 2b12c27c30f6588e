"""Mergeable sketches against exact figures, within their stated errors."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revloom.plans import sketches


@pytest.fixture(scope="module")
def funnel(spark, tmp_path_factory):
    """60,000 contacts in 12 cohort months; three quarters become MQL, half of these SQL."""
    stage = "stage_no = 0 or (stage_no = 1 and id % 4 <> 0) or (stage_no = 2 and id % 8 < 4)"
    rows = spark.range(60_000).crossJoin(spark.range(3).withColumnRenamed("id", "stage_no")).where(stage)
    path = str(tmp_path_factory.mktemp("funnel") / "rows")
    rows.selectExpr(
        "cast(id as string) as contact_id",
        "add_months(date'2025-01-01', cast(id % 12 as int)) as cohort_month",
        "element_at(array('lead', 'marketingqualifiedlead', 'salesqualifiedlead'), cast(stage_no + 1 as int)) as lifecycle_stage",
        "if(stage_no = 2, cast(crc32(cast(id as string)) % 1000 as int), null) as days_to_convert",
    ).write.parquet(path)
    return spark.read.parquet(path)


def year():
    return F.trunc("cohort_month", "year")


def test_merged_counts_are_within_three_standard_errors(funnel):
    entries = 12
    kept = sketches.stage_sketches(funnel, entries)
    found = {r["lifecycle_stage"]: r["contact_count"] for r in sketches.stage_counts(kept, year(), entries).collect()}
    exact = {r["lifecycle_stage"]: r["count"] for r in funnel.groupBy("lifecycle_stage").count().collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[s] - n) <= 3 * n / 2 ** (entries / 2) for s, n in exact.items())
    assert any(found[s] != n for s, n in exact.items())  # an estimate, beyond its entries


def test_intersections_give_the_conversion(funnel):
    kept = sketches.stage_sketches(funnel)
    (row,) = sketches.conversion(kept, "lead", "marketingqualifiedlead", year()).collect()
    assert abs(row["rate"] - 0.75) < 0.03 and abs(row["both_count"] - 45_000) < 1500
    months = sketches.conversion(kept, "lead", "salesqualifiedlead", F.col("cohort_month")).collect()
    assert len(months) == 12  # exact: fewer contacts than entries
    exact = funnel.groupBy("cohort_month").agg(F.count_if(F.col("lifecycle_stage") == "salesqualifiedlead").alias("n"))
    assert {r["period"]: r["both_count"] for r in months} == {r["cohort_month"]: r["n"] for r in exact.collect()}
    none = sketches.conversion(kept, "customer", "lead", year()).collect()
    assert [(r["source_count"], r["rate"]) for r in none] == [(0, None)]


def test_merged_quantiles_are_within_the_rank_error(funnel):
    kept = sketches.handoff_sketches(funnel, 200)
    days = sorted(r[0] for r in funnel.where("days_to_convert is not null").select("days_to_convert").collect())
    for rank in (0.1, 0.5, 0.9):
        (row,) = sketches.handoff_quantile(kept, rank, year(), 200).collect()
        assert row["handoffs"] == len(days)
        low = sum(d < row["days"] for d in days) / len(days)
        high = sum(d <= row["days"] for d in days) / len(days)
        assert low - 0.02 <= rank <= high + 0.02


def test_a_later_month_only_adds_rows(funnel, tmp_path):
    path = str(tmp_path / "sketches")
    march = F.col("cohort_month") < F.lit("2025-04-01").cast("date")
    sketches.stage_sketches(funnel.where(march)).write.parquet(path)
    sketches.stage_sketches(funnel.where(~march)).write.mode("append").parquet(path)
    stored = funnel.sparkSession.read.parquet(path)
    want = sorted(map(tuple, sketches.stage_counts(sketches.stage_sketches(funnel), F.col("cohort_month")).collect()))
    assert sorted(map(tuple, sketches.stage_counts(stored, F.col("cohort_month")).collect())) == want
