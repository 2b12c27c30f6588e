"""Rollups stored side by side, and tests counted while marts are written."""

from __future__ import annotations

import glob
import os
from types import MappingProxyType

import pytest
from pyspark.sql import functions as F

from acceptance.fixtures import Fixture
from revloom.operators import quality
from revloom.plans import checks
from revloom.plans.copartitioned import AccountRollups, store_rollups
from revloom.plans.model import build_marts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("copartitioned"))
    fixture = Fixture(spark, SF)
    seen = quality.WriteChecks()
    marts = build_marts(spark, fixture.staged(), fixture.as_of, f"{path}/marts", database="copartitioned", seen=seen)
    return path, fixture, marts, seen


def rollups(spark, built, database):
    path, _, marts, _ = built
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}/{database}'")
    store_rollups(spark, marts, database, buckets=4)
    return AccountRollups(spark, database)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_health_joins_without_an_exchange(spark, built):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        health = rollups(spark, built, "rollups_a").health(built[1].as_of)
        plan = health._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(health) == rows(built[2]["fct_account_health"].select(health.columns))


def test_a_quarter_opens_no_file_of_another(spark, built):
    stored = rollups(spark, built, "rollups_b")
    chosen = F.expr("year = 1998 and quarter = 2")
    whole = rows(stored.revenue_of(chosen))
    assert len(whole) == 3
    assert "dynamicpruning" in stored.revenue_of(chosen)._jdf.queryExecution().executedPlan().toString()
    files = glob.glob(f"{built[0]}/rollups_b/account_revenue_*/metric_month=*/*.parquet")
    others = [f for f in files if not any(f"metric_month=1998-0{m}" in f for m in (4, 5, 6))]
    assert others and len(others) < len(files)
    for file in others:  # unreadable from now on
        os.truncate(file, 0)
    assert rows(stored.revenue_of(chosen)) == whole


def test_a_company_with_most_facts_is_a_row_a_month(spark, built):
    path, _, marts, _ = built
    hot = dict(marts)
    revenue = marts["fct_revenue"]
    hot["fct_revenue"] = revenue.withColumn("company_id", F.lit("7"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS rollups_c LOCATION '{path}/rollups_c'")
    store_rollups(spark, MappingProxyType(hot), "rollups_c", buckets=4)
    table = AccountRollups(spark, "rollups_c").table("account_revenue")
    assert table.count() == revenue.select("metric_month").distinct().count()
    assert table.agg(F.sum("subscriptions")).first()[0] == revenue.count()


def test_readers_see_the_last_build(spark, built):
    first = rollups(spark, built, "rollups_d")
    second = rollups(spark, built, "rollups_d")
    assert first.build != second.build
    assert AccountRollups(spark, "rollups_d").build == second.build
    assert first.table("account_deals").count() == second.table("account_deals").count()
    with pytest.raises(ValueError, match="no rollups"):
        AccountRollups(spark, "rollups_never")


def test_clean_marts_are_tested_by_their_write_alone(built):
    _, _, marts, seen = built
    asked = []

    def stored(name):
        asked.append(name)
        return marts[name]

    found = {r.test: r.failures for r in seen.report(marts["fct_deals"].sparkSession, stored).collect()}
    exact = {r.test: r.failures for r in checks.mart_tests(seen, marts).collect()}
    for test, failures in found.items():
        assert exact[test] == failures
    # Only what is not clean is read again.
    assert {name for name in asked} == {t.split(":")[1].split(".")[0] for t, n in found.items() if n}
    assert found["account_health_score_in_range"] == 0 and found["mrr_reconciliation"] == 0


def test_a_failing_rule_is_counted_from_storage(spark, tmp_path):
    seen = quality.WriteChecks()
    df = spark.createDataFrame([(1, None), (2, 5), (None, 7)], "id int, v int")
    path = str(tmp_path / "t")
    seen.watch(df, "t", ["id", "v"], {"small": F.col("v") > 10}).write.parquet(path)
    found = seen.report(spark, lambda name: spark.read.parquet(path))
    assert rows(found) == [("not_null:t.id", 1), ("not_null:t.v", 1), ("small", 0)]


def test_watching_nothing_changes_nothing(spark):
    seen = quality.WriteChecks()
    df = spark.range(3)
    assert seen.watch(df, "t") is df
    assert seen.report(spark, lambda name: df).collect() == []
