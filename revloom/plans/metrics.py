"""The metric catalog: every metric defined once, on one mart."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.functions import MONEY_SUM, days_between, safe_ratio

_ZERO = Decimal("0.00")


def _money(column: Column) -> Column:
    return F.sum(column).cast(MONEY_SUM)


def _ratio(part: Column, whole: Column) -> Column:
    return F.round(safe_ratio(part, whole), 6)


def _live(column: str) -> Column:
    return F.when(F.col("is_churned"), F.lit(_ZERO)).otherwise(F.col(column))


@dataclass(frozen=True)
class Metric:
    """``value`` aggregates rows of ``mart`` after ``prepare``; ``cuts`` are its usual slices.

    ``prepare`` must leave one row per counted thing, so that ``value`` is a plain
    aggregate that any grouping can use.
    """

    name: str
    label: str
    mart: str
    value: Callable[[], Column]
    cuts: tuple[str, ...] = ()
    prepare: Callable[[DataFrame], DataFrame] | None = None


def contact_stages(funnel: DataFrame) -> DataFrame:
    """One row per contact: its cohort and which stages it reached.

    Replaces several distinct counts, each of which would multiply the rows shuffled, by
    one aggregate on the key the funnel is already partitioned by.
    """
    reached = {
        "lead": "lead",
        "mql": "marketingqualifiedlead",
        "sql": "salesqualifiedlead",
        "customer": "customer",
    }
    return funnel.groupBy("cohort_month", "contact_id").agg(
        *[F.bool_or(F.col("lifecycle_stage") == stage).alias(name) for name, stage in reached.items()]
    )


def _conversion(source: str, target: str) -> Callable[[], Column]:
    return lambda: _ratio(F.count_if(target), F.count_if(source))


def sql_handoffs(funnel: DataFrame) -> DataFrame:
    """Rows that carry the time from marketing- to sales-qualified."""
    return funnel.where(
        (F.col("lifecycle_stage") == "salesqualifiedlead") & F.col("days_to_convert").isNotNull()
    )


_REVENUE_CUTS = ("metric_month", "company_id", "is_churned")

CATALOG = {
    metric.name: metric
    for metric in (
        Metric("mrr", "Monthly Recurring Revenue", "fct_revenue", lambda: _money("mrr_usd"), _REVENUE_CUTS),
        Metric("arr", "Annual Recurring Revenue (booked)", "fct_revenue", lambda: _money("arr_usd"), ("is_churned",)),
        Metric(
            "arr_active",
            "Annual Recurring Revenue (active)",
            "fct_revenue",
            lambda: _money(_live("arr_usd")),
            ("metric_month",),
        ),
        Metric(
            "acv",
            "Annual Contract Value (average)",
            "fct_revenue",
            lambda: F.round(F.sum("acv_usd").cast("double") / F.count("acv_usd"), 6),
            ("deal_type",),
        ),
        Metric(
            "acv_total", "Annual Contract Value (total)", "fct_revenue", lambda: _money("acv_usd"), ("deal_type",)
        ),
        Metric(
            "tcv", "Total Contract Value", "fct_revenue", lambda: _money("tcv_usd"), ("deal_type", "metric_month")
        ),
        Metric(
            "churned_mrr",
            "Churned MRR",
            "fct_revenue",
            lambda: _money("churned_mrr_usd"),
            ("metric_month", "company_id"),
        ),
        Metric(
            "active_mrr", "Active MRR", "fct_revenue", lambda: _money(_live("mrr_usd")), ("metric_month",)
        ),
        Metric(
            "open_pipeline_value",
            "Open Pipeline Value",
            "fct_pipeline",
            lambda: _money("total_open_value_usd"),
            ("stage_id",),
        ),
        Metric(
            "weighted_pipeline_value",
            "Weighted Pipeline Value",
            "fct_pipeline",
            lambda: F.sum("weighted_value_usd").cast("decimal(38,3)"),
            ("stage_id",),
        ),
        Metric(
            "win_rate",
            "Win Rate",
            "fct_deals",
            lambda: _ratio(F.count_if("is_won"), F.count_if("is_closed")),
            ("company_id",),
        ),
        Metric(
            "lead_to_mql_rate",
            "Lead to MQL Conversion Rate",
            "fct_funnel",
            _conversion("lead", "mql"),
            ("cohort_month",),
            contact_stages,
        ),
        Metric(
            "mql_to_sql_rate",
            "MQL to SQL Conversion Rate",
            "fct_funnel",
            _conversion("mql", "sql"),
            ("cohort_month",),
            contact_stages,
        ),
        Metric(
            "sql_to_customer_rate",
            "SQL to Customer Conversion Rate",
            "fct_funnel",
            _conversion("sql", "customer"),
            ("cohort_month",),
            contact_stages,
        ),
        Metric(
            "median_days_mql_to_sql",
            "Median Days from MQL to SQL",
            "fct_funnel",
            # Exact.  The aggregate keeps one counter per distinct number of days, which
            # the calendar bounds, not one entry per row.
            lambda: F.median("days_to_convert"),
            ("cohort_month",),
            sql_handoffs,
        ),
        Metric(
            "account_health_score",
            "Account Health Score (average)",
            "fct_account_health",
            lambda: F.round(F.sum("account_health_score").cast("double") / F.count("account_health_score"), 6),
            ("health_bucket",),
            lambda health: health_buckets(health),
        ),
        Metric(
            "arr_per_account",
            "ARR per Account",
            "fct_account_health",
            lambda: _money("arr_usd"),
            ("company_id",),
        ),
    )
}


def health_buckets(health: DataFrame) -> DataFrame:
    """healthy from 70, moderate from 40, at-risk below."""
    bucket = (
        F.when(F.col("account_health_score") >= 70, "healthy")
        .when(F.col("account_health_score") >= 40, "moderate")
        .otherwise("at-risk")
    )
    return health.withColumn("health_bucket", bucket)


def compute(name: str, mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metric over the whole mart, or per combination of ``by``."""
    metric = CATALOG[name]
    rows = metric.prepare(mart) if metric.prepare else mart
    return rows.groupBy(*by).agg(metric.value().alias(name))


def compute_cuts(name: str, mart: DataFrame, cuts: Sequence[str] | None = None) -> DataFrame:
    """``(cut, cut_value, value)``: the total ('all') and each cut, in one scan."""
    metric = CATALOG[name]
    rows = metric.prepare(mart) if metric.prepare else mart
    cuts = list(metric.cuts if cuts is None else cuts)
    if not cuts:
        return rows.agg(metric.value().alias("value")).select(
            F.lit("all").alias("cut"), F.lit(None).cast("string").alias("cut_value"), "value"
        )
    grouped = rows.groupingSets([[], *[[c] for c in cuts]], *cuts).agg(
        *[F.grouping(c).alias(f"_off_{c}") for c in cuts], metric.value().alias("value")
    )
    cut, cut_value = F.lit("all"), F.lit(None).cast("string")
    for c in cuts:
        cut = F.when(F.col(f"_off_{c}") == 0, c).otherwise(cut)
        cut_value = F.when(F.col(f"_off_{c}") == 0, F.col(c).cast("string")).otherwise(cut_value)
    return grouped.select(cut.alias("cut"), cut_value.alias("cut_value"), "value")


def cohort_conversion_within(
    funnel: DataFrame,
    days: Sequence[int] = (90,),
    source: str = "lead",
    target: str = "marketingqualifiedlead",
) -> DataFrame:
    """Of the contacts that entered ``source`` in a month, how many reached ``target``
    at the same time or up to ``days`` days later.

    ``(source_month, within_days, entered, reached, rate)``, one row per month and span.
    """

    def first_entry(stage: str) -> Column:
        return F.min(F.when(F.col("lifecycle_stage") == stage, F.col("entered_at")))

    per_contact = (
        funnel.where(F.col("lifecycle_stage").isin(source, target))
        .groupBy("contact_id")
        .agg(first_entry(source).alias("_from"), first_entry(target).alias("_to"))
        .where(F.col("_from").isNotNull())
    )
    in_time = [
        F.count_if(
            (F.col("_to") >= F.col("_from")) & (days_between("_from", "_to") <= span)
        ).alias(str(span))
        for span in days
    ]
    per_month = per_contact.groupBy(F.trunc("_from", "month").alias("source_month")).agg(
        F.count(F.lit(1)).alias("entered"), *in_time
    )
    spans = [str(span) for span in days]
    return per_month.unpivot(["source_month", "entered"], spans, "within_days", "reached").select(
        "source_month",
        F.col("within_days").cast("int").alias("within_days"),
        F.col("entered").cast("bigint").alias("entered"),
        F.col("reached").cast("bigint").alias("reached"),
        _ratio(F.col("reached"), F.col("entered")).alias("rate"),
    )
