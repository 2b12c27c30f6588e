"""The dashboard's queries, as DataFrames over the marts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.functions import MONEY_SUM, safe_ratio
from revloom.operators import histogram
from revloom.plans.metrics import compute, sql_handoffs
from revloom.vocab import LIFECYCLE_LABELS

_ZERO = Decimal("0.00")


def kpi_revenue(revenue: DataFrame) -> DataFrame:
    def live(column: str):
        return F.sum(F.when(~F.col("is_churned"), F.col(column)).otherwise(_ZERO)).cast(MONEY_SUM)

    return revenue.agg(
        live("mrr_usd").alias("active_mrr"),
        live("arr_usd").alias("active_arr"),
        F.sum("churned_mrr_usd").cast(MONEY_SUM).alias("churned_mrr"),
        F.count(F.lit(1)).alias("won_deals"),
    )


def kpi_pipeline(pipeline: DataFrame) -> DataFrame:
    return pipeline.agg(
        F.sum("total_open_value_usd").cast(MONEY_SUM).alias("open_pipeline"),
        F.sum("weighted_value_usd").cast("decimal(38,3)").alias("weighted_pipeline"),
        F.sum("open_deal_count").alias("open_deals"),
    )


def kpi_win_rate(deals: DataFrame) -> DataFrame:
    counts = deals.agg(
        F.count_if("is_won").alias("won_count"), F.count_if("is_closed").alias("closed_count")
    )
    rate = F.coalesce(safe_ratio("won_count", "closed_count"), F.lit(0.0))
    return counts.withColumn("win_rate", F.round(rate, 6))


def mrr_by_month(revenue: DataFrame) -> DataFrame:
    booked = compute("mrr", revenue, ["metric_month"]).withColumnRenamed("mrr", "booked_mrr")
    return booked.orderBy(F.asc_nulls_last("metric_month"))


def acv_histogram(revenue: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(revenue, "acv_usd", bins)


def tcv_by_type(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("deal_type")
        .agg(F.sum("tcv_usd").cast(MONEY_SUM).alias("total_tcv"), F.count(F.lit(1)).alias("deal_count"))
        .orderBy(F.desc_nulls_last("total_tcv"), F.asc_nulls_last("deal_type"))
    )


def pipeline_by_stage(pipeline: DataFrame) -> DataFrame:
    return pipeline.select(
        "stage_id", "open_deal_count", "total_open_value_usd", "weighted_value_usd"
    ).orderBy(F.desc_nulls_last("weighted_value_usd"), "stage_id")


def pipeline_long(pipeline: DataFrame) -> DataFrame:
    """One row per stage and value column."""
    money = "decimal(38,3)"
    wide = pipeline.select(
        "stage_id",
        F.col("total_open_value_usd").cast(money).alias("Raw pipeline"),
        F.col("weighted_value_usd").cast(money).alias("Probability-weighted"),
    )
    return wide.unpivot(["stage_id"], ["Raw pipeline", "Probability-weighted"], "metric", "usd")


def funnel_counts(funnel: DataFrame) -> DataFrame:
    """Contacts per stage.  The distinct count is split over (stage, contact) first."""
    labels = F.create_map(*[F.lit(x) for pair in LIFECYCLE_LABELS.items() for x in pair])
    return (
        funnel.groupBy("lifecycle_stage")
        .agg(
            F.count_distinct("contact_id").alias("contact_count"),
            F.min("stage_order").alias("stage_order"),
        )
        .withColumn("label", F.coalesce(labels[F.col("lifecycle_stage")], "lifecycle_stage"))
        .orderBy(F.asc_nulls_last("stage_order"), "lifecycle_stage")
    )


def funnel_steps(funnel: DataFrame) -> DataFrame:
    """Conversion between neighbouring stages; 0 when the earlier one is empty.

    The window has no partition because its input is one row per stage.
    """
    along = Window.orderBy(F.asc_nulls_last("stage_order"), "lifecycle_stage")
    rate = F.coalesce(safe_ratio("contact_count", "_before"), F.lit(0.0))
    return (
        funnel_counts(funnel)
        .withColumns(
            {
                "from_label": F.lag("label").over(along),
                "_before": F.lag("contact_count").over(along),
            }
        )
        .where(F.col("_before").isNotNull())
        .select("from_label", F.col("label").alias("to_label"), F.round(rate, 6).alias("rate"))
    )


def median_handoff(funnel: DataFrame) -> DataFrame:
    return sql_handoffs(funnel).agg(F.median("days_to_convert").alias("median_days"))


def health_list(health: DataFrame) -> DataFrame:
    return health.select(
        "company_id", "company_name", "arr_usd", "open_pipeline_usd", "account_health_score", "has_churn"
    ).orderBy(F.desc_nulls_last("account_health_score"), "company_id")


def health_histogram(health: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(health, "account_health_score", bins, 0.0, 100.0)


def top_accounts_by_arr(health: DataFrame, limit: int = 10) -> DataFrame:
    """The top accounts; equal revenue keeps the healthier account first."""
    return (
        health.orderBy(
            F.desc_nulls_last("arr_usd"), F.desc_nulls_last("account_health_score"), "company_id"
        )
        .limit(limit)
        .select("company_id", "company_name", "arr_usd", "account_health_score")
    )
