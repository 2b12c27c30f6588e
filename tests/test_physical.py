"""What the plans look like when nothing is small enough to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from acceptance.fixtures import Fixture
from acceptance.registry import all_queries
from revloom.plans import marts
from revloom.plans.model import RevenueModel, build_marts

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Keys whose feature is to write tables and read them back: building them runs jobs.
WRITING = (
    "stored_", "stream_", "ingest_", "dq_", "view_sql", "stage_metadata", "contract_snapshot", "incremental_account_health",
    "table_evolution", "sketch_", "copartitioned_", "revenue_of_",
)
LAZY = [name for name in sorted(all_queries()) if not name.startswith(WRITING) or name == "dq_freshness"]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_and_no_python(no_broadcast, name):
    plan = physical(all_queries()[name](no_broadcast, SF))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert operator not in plan


def test_building_a_query_runs_no_job(no_broadcast, monkeypatch):
    spark = no_broadcast
    names = ("region", "nation", "customer", "part", "orders", "lineitem", "events")
    schemas = {name: spark.read.parquet(f"{SF}/{name}.parquet").schema for name in names}
    # With the schema given, reading a table needs no look at its footer either.
    monkeypatch.setattr(
        Fixture, "table", lambda self, name: spark.read.schema(schemas[name]).parquet(f"{SF}/{name}.parquet")
    )
    for name in LAZY:
        spark.sparkContext.setJobGroup(f"building {name}", name)
        all_queries()[name](spark, SF)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}")) == [], name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_split_lookup_broadcasts_only_the_rows_of_hot_keys(no_broadcast):
    fixture = Fixture(no_broadcast, SF)
    model = RevenueModel(fixture.staged(), fixture.as_of, hot_companies=["7", "11"])
    plan = physical(model.fct_deals)
    assert plan.count("BroadcastExchange") == 1 and "company_id#" in plan
    assert "SortMergeJoin [company_id" in plan and "_spread" in plan
    assert plan.count("orders.parquet") == 1


@pytest.mark.parametrize("link", ["contact_company", "deal_company", "line_item_deal"])
def test_keyed_links_add_no_shuffle(spark, link):
    fixture = Fixture(spark, SF)
    rows = fixture.entity({"contact_company": "contacts", "deal_company": "deals"}.get(link, "line_items"))
    before = physical(rows).count("Exchange hash")
    assert physical(getattr(fixture.staged(), f"{link}_links")).count("Exchange hash") == before


def test_pipeline_shuffles_only_stage_totals(no_broadcast):
    plan = physical(Fixture(no_broadcast, SF).model().fct_pipeline)
    assert plan.count("Exchange hash") == 1 and "partial_sum" in plan and "SortMergeJoin" not in plan


def test_revenue_metrics_do_not_look_up_names(no_broadcast):
    plan = physical(all_queries()["metric_mrr"](no_broadcast, SF))
    assert "customer.parquet" not in plan


def test_stored_marts_take_filters_and_read_only_needed_columns(spark, tmp_path):
    fixture = Fixture(spark, SF)
    stored = build_marts(spark, fixture.staged(), fixture.as_of, str(tmp_path))
    plan = physical(marts.fct_pipeline(stored["fct_deals"]))
    assert re.search(r"PushedFilters: \[.*is_open", plan)
    assert "ReadSchema: struct<amount_usd:decimal(18,2),stage_id:string,is_open:boolean>" in plan
    month = stored["fct_revenue"].where(F.col("metric_month") == F.lit("1999-01-01").cast("date"))
    plan = physical(month.agg(F.sum("mrr_usd")))
    assert "EqualTo(metric_month,1999-01-01)" in plan
    assert "ReadSchema: struct<metric_month:date,mrr_usd:decimal(18,2)>" in plan


def test_funnel_needs_one_partitioning_by_contact(no_broadcast):
    plan = physical(Fixture(no_broadcast, SF).model().funnel)
    head = plan[: plan.index("SortMergeJoin")]
    assert "Exchange" not in head and head.count("Window [") == 2
