"""Rollups per company as co-partitioned catalog tables: joins on them move no rows.

Facts are not bucketed by company themselves, for one company may hold a third of them and
would fill one bucket.  Their rollups have a row per company (revenue: per company and
month), whatever the size of a company, so buckets are even.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.plans import marts
from revloom.plans.marts import MONEY_SUM
from revloom.sources.tables import write_bucketed

# Stored tables, all bucketed by company.
TABLES = ("account_profiles", "account_deals", "account_revenue", "account_funnel")


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    """Per company and month of closing: what months can be added up from."""
    def live(value: str) -> Column:
        return F.when(F.col("is_churned"), F.lit(0).cast(MONEY_SUM)).otherwise(F.col(value).cast(MONEY_SUM))

    return revenue.groupBy("company_id", "metric_month").agg(
        F.count(F.lit(1)).alias("subscriptions"),
        F.sum(F.col("mrr_usd").cast(MONEY_SUM)).cast(MONEY_SUM).alias("mrr_usd"),
        F.sum(F.col("churned_mrr_usd").cast(MONEY_SUM)).cast(MONEY_SUM).alias("churned_mrr_usd"),
        F.sum(live("arr_usd")).cast(MONEY_SUM).alias("active_arr_usd"),
        F.bool_or("is_churned").alias("has_churn"),
    )


def store_rollups(spark: SparkSession, stored: Mapping[str, DataFrame], database: str, buckets: int) -> None:
    """Write the rollups of stored marts into ``database``, which exists, as one new build.

    ``buckets`` follows the number of companies, not of facts.  Revenue is partitioned by month
    besides, so there are at most ``buckets`` files a month.  Readers see the old build
    or the new one: the last step replaces the view that names it.
    """
    build = uuid.uuid4().hex
    rollups = {
        "account_profiles": stored["dim_accounts"],
        "account_deals": marts.deal_rollup(stored["fct_deals"]).select(
            "company_id", "open_pipeline_usd", "last_activity_date"
        ),
        "account_revenue": revenue_by_month(stored["fct_revenue"]),
        "account_funnel": marts.funnel_rollup(stored["fct_funnel"]),
    }
    for name in TABLES:
        months = ("metric_month",) if name == "account_revenue" else ()
        write_bucketed(rollups[name], f"{database}.{name}_{build}", ["company_id"], buckets, months)
    # One row per month there is: a reader that picks months by it opens their partitions only.
    months = spark.table(f"{database}.account_revenue_{build}").select("metric_month").distinct()
    calendar = months.where("metric_month is not null").select(
        "metric_month", F.year("metric_month").alias("year"), F.quarter("metric_month").alias("quarter")
    )
    calendar.coalesce(1).write.format("parquet").saveAsTable(f"{database}.months_{build}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.rollups AS SELECT '{build}' AS build")


class AccountRollups:
    """The rollups of the last build in ``database``."""

    def __init__(self, spark: SparkSession, database: str) -> None:
        if not spark.catalog.tableExists(f"{database}.rollups"):
            raise ValueError(f"no rollups are stored in {database}")
        self.spark = spark
        self.database = database
        self.build = spark.table(f"{database}.rollups").first()["build"]

    def table(self, name: str) -> DataFrame:
        """One of :data:`TABLES`, or ``months``."""
        return self.spark.table(f"{self.database}.{name}_{self.build}")

    def health(self, as_of: Column) -> DataFrame:
        """``fct_account_health``: three joins and a sum over months, without an exchange."""
        base = self.table("account_profiles").join(self.table("account_deals"), "company_id", "left")
        revenue = self.table("account_revenue").groupBy("company_id").agg(
            F.sum("active_arr_usd").cast(MONEY_SUM).alias("active_arr_usd"), F.bool_or("has_churn").alias("has_churn")
        )
        return marts.fct_account_health(base, revenue, self.table("account_funnel"), as_of)

    def revenue_of(self, months: Column) -> DataFrame:
        """Revenue per month of the months that meet a condition on ``year``, ``quarter`` or ``metric_month``.

        The condition is evaluated on the calendar first; partitions of other months are not listed
        for reading.
        """
        chosen = F.broadcast(self.table("months").where(months))  # one row per month that has revenue
        return (
            self.table("account_revenue")
            .join(chosen, "metric_month")
            .groupBy("metric_month")
            .agg(
                F.count("company_id").alias("companies"),
                F.sum("subscriptions").alias("subscriptions"),
                F.sum("mrr_usd").cast(MONEY_SUM).alias("mrr_usd"),
                F.sum("churned_mrr_usd").cast(MONEY_SUM).alias("churned_mrr_usd"),
                F.sum("active_arr_usd").cast(MONEY_SUM).alias("active_arr_usd"),
            )
        )
