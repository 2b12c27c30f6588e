"""Dimensions and facts.

Every function takes only the columns it needs, so a caller may pass a stored mart or a
lazy plan.  Children are rolled up to the parent's grain before they are joined.
"""

from __future__ import annotations

from decimal import Decimal

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revloom.functions import (
    MONEY_SUM,
    days_between,
    health_score,
    is_closed_stage,
    is_in_state,
    month_of,
    monthly,
    over_term,
    safe_ratio,
    stage_at,
    stage_ordinal,
)
from revloom.operators import attach_rollup, lookup_join
from revloom.vocab import OPEN_STAGES, STAGE_LOST, STAGE_WON

_NO_MONEY = Decimal("0.00")
_DEAL_COUNTS = ("deal_count_total", "deal_count_won", "deal_count_lost", "deal_count_open")


# --- deals ---------------------------------------------------------------------------


def deal_flags(deals: DataFrame) -> DataFrame:
    """Status flags and dates of a deal; a NULL stage makes all four flags NULL."""
    return deals.withColumns(
        {
            "close_date_day": F.to_date("close_date"),
            "is_won": is_in_state("stage_id", STAGE_WON),
            "is_lost": is_in_state("stage_id", STAGE_LOST),
            "is_closed": is_closed_stage("stage_id"),
            "is_open": ~is_closed_stage("stage_id"),
            "created_date": F.to_date("created_at_hubspot"),
        }
    )


def deals_with_company(int_deals: DataFrame, deal_company: DataFrame | None = None) -> DataFrame:
    """Flagged deals with the company of their link.

    Without ``deal_company`` the deals bring their ``company_id`` themselves.  Otherwise
    both sides are unique on the deal.
    """
    if deal_company is None:
        return deal_flags(int_deals)
    return deal_flags(int_deals.join(deal_company.select("deal_id", "company_id"), "deal_id", "left"))


def with_company_name(
    rows: DataFrame, int_companies: DataFrame, hot: Sequence[str] = ()
) -> DataFrame:
    """Adds ``company_name``; NULL where cleaning removed the company or there is none."""
    names = int_companies.select("company_id", F.col("name").alias("company_name"))
    return lookup_join(rows, names, "company_id", hot=hot)


def fct_deals(deals: DataFrame, int_companies: DataFrame, hot: Sequence[str] = ()) -> DataFrame:
    """One row per deal; ``deals`` comes from :func:`deals_with_company`.

    The company id is the link's, so it may point at a company cleaning removed.
    """
    return with_company_name(deals, int_companies, hot).select(
        "deal_id",
        "company_id",
        "company_name",
        "deal_name",
        "amount_usd",
        "deal_type",
        "stage_id",
        "pipeline_id",
        "close_date",
        "close_date_day",
        "is_won",
        "is_lost",
        "is_closed",
        "is_open",
        "is_stale",
        "created_at_hubspot",
        "created_date",
    )


def open_stages(df: DataFrame) -> DataFrame:
    """The five open stages as a table."""
    return df.sparkSession.createDataFrame(
        list(OPEN_STAGES),
        "stage_id string, stage_label string, display_order int, win_probability string",
    ).withColumn("win_probability", F.col("win_probability").cast("decimal(2,1)"))


def fct_pipeline(deals: DataFrame) -> DataFrame:
    """One row per open stage, empty stages included; stages outside the five are dropped.

    Needs ``stage_id``, ``amount_usd`` and ``is_open``; pass flagged deals without the
    company and nothing is joined but five rows.
    """
    total = F.sum("amount_usd")
    per_stage = (
        deals.where(F.col("is_open") & F.col("stage_id").isin(*[stage[0] for stage in OPEN_STAGES]))
        .groupBy("stage_id")
        .agg(
            F.count(F.lit(1)).alias("open_deal_count"),
            total.cast(MONEY_SUM).alias("total_open_value_usd"),
            (total.cast("double") / F.count("amount_usd")).alias("avg_deal_value_usd"),
        )
    )
    return (
        # The filter leaves at most five groups, so this broadcast cannot grow.
        open_stages(deals)
        .join(F.broadcast(per_stage), "stage_id", "left")
        .select(
            "stage_id",
            "stage_label",
            "display_order",
            "win_probability",
            F.coalesce("open_deal_count", F.lit(0)).cast("bigint").alias("open_deal_count"),
            F.coalesce("total_open_value_usd", F.lit(0)).cast(MONEY_SUM).alias("total_open_value_usd"),
            F.coalesce(F.round("avg_deal_value_usd", 4), F.lit(0.0)).alias("avg_deal_value_usd"),
            F.coalesce(F.col("total_open_value_usd") * F.col("win_probability"), F.lit(0))
            .cast("decimal(38,3)")
            .alias("weighted_value_usd"),
        )
        .orderBy("display_order")
    )


# --- revenue -------------------------------------------------------------------------


def revenue_facts(int_subscriptions: DataFrame, deals: DataFrame) -> DataFrame:
    """One row per subscription of a won deal, without the company's name.

    ``deals`` is ``fct_deals``, or the deals it is made from.  The annual contract value
    is the amount; the billing interval is payment cadence and does not enter the monthly
    figure.
    """
    names = [c for c in ("company_name",) if c in deals.columns]
    won = deals.where("is_won").select("deal_id", "company_id", *names, "deal_name", "deal_type", "close_date")
    mrr = monthly("amount_usd")
    return int_subscriptions.join(won, "deal_id").select(
        "subscription_id",
        "deal_id",
        "company_id",
        *names,
        "deal_name",
        "deal_type",
        "close_date",
        month_of("close_date").alias("metric_month"),
        "billing_interval",
        "term_months",
        "status",
        "is_churned",
        "churned_at",
        F.col("amount_usd").alias("acv_usd"),
        mrr.alias("mrr_usd"),
        F.col("amount_usd").alias("arr_usd"),
        over_term("amount_usd", "term_months").alias("tcv_usd"),
        F.when(F.col("is_churned"), mrr).otherwise(_NO_MONEY).alias("churned_mrr_usd"),
        "_loaded_at",
    )


def fct_revenue(
    int_subscriptions: DataFrame,
    deals: DataFrame,
    int_companies: DataFrame | None = None,
    hot: Sequence[str] = (),
) -> DataFrame:
    """:func:`revenue_facts` with the company's name.

    Stored ``fct_deals`` bring the name.  Lazy deals do not: it is looked up last, on the
    fewer rows of won deals with a subscription.
    """
    facts = revenue_facts(int_subscriptions, deals)
    if int_companies is None:
        return facts
    named = with_company_name(facts, int_companies, hot)
    first = ["subscription_id", "deal_id", "company_id", "company_name"]
    return named.select(*first, *[c for c in facts.columns if c not in first])


# --- contacts and funnel -------------------------------------------------------------


def dim_contacts(
    int_contacts: DataFrame, int_companies: DataFrame, hot: Sequence[str] = ()
) -> DataFrame:
    return with_company_name(int_contacts, int_companies, hot).select(
        "contact_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "job_title",
        "phone",
        "lifecycle_stage",
        "company_id",
        "company_name",
        "created_at_hubspot",
        F.to_date("created_at_hubspot").alias("created_date"),
    )


def fct_funnel(events: DataFrame, contacts: DataFrame) -> DataFrame:
    """One row per funnel event of a surviving contact.

    ``events`` may be staging or cleaned events: the semi join to the surviving contacts
    and the join for their company are the same inner join on ``contact_id``.  Join, lag
    and cohort share one partitioning by contact.  A contact enters a stage at most once
    (the event id is contact and stage), so a window group has as many rows as there are
    stages.  ``company_name`` is in the result if ``contacts`` has it.
    """
    names = [c for c in ("company_name",) if c in contacts.columns]
    context = contacts.select("contact_id", "company_id", *names)
    by_stage = Window.partitionBy("contact_id").orderBy(
        F.asc_nulls_last("stage_order"), "entered_at", "event_id"
    )
    whole = Window.partitionBy("contact_id")
    return (
        events.select("event_id", "contact_id", "lifecycle_stage", "entered_at")
        .join(context, "contact_id", "inner")
        .withColumn("stage_order", stage_ordinal("lifecycle_stage"))
        .withColumns(
            {
                "previous_stage": F.lag("lifecycle_stage").over(by_stage),
                "previous_entered_at": F.lag("entered_at").over(by_stage),
                "cohort_month": month_of(F.min("entered_at").over(whole)),
            }
        )
        .select(
            "event_id",
            "contact_id",
            "company_id",
            *names,
            "lifecycle_stage",
            "stage_order",
            "previous_stage",
            "entered_at",
            F.to_date("entered_at").alias("entered_date"),
            "previous_entered_at",
            days_between("previous_entered_at", "entered_at").alias("days_to_convert"),
            "cohort_month",
        )
    )


# --- accounts ------------------------------------------------------------------------


def deal_rollup(deals: DataFrame) -> DataFrame:
    """Per company: deal counts, open value and last activity, in one pass."""
    open_value = F.when(F.col("is_open"), F.col("amount_usd")).otherwise(_NO_MONEY)
    return deals.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("deal_count_total"),
        F.count_if("is_won").alias("deal_count_won"),
        F.count_if("is_lost").alias("deal_count_lost"),
        F.count_if("is_open").alias("deal_count_open"),
        F.max("created_date").alias("last_activity_date"),
        F.sum(open_value).cast(MONEY_SUM).alias("open_pipeline_usd"),
    )


def contact_rollup(contact_company: DataFrame) -> DataFrame:
    """Primary links per company - of all contacts, also those cleaning removed."""
    return contact_company.groupBy("company_id").agg(F.count(F.lit(1)).alias("contact_count"))


def revenue_rollup(revenue: DataFrame, by: str = "company_id") -> DataFrame:
    live = F.when(~F.col("is_churned"), F.col("arr_usd")).otherwise(_NO_MONEY)
    return revenue.groupBy(by).agg(
        F.sum(live).cast(MONEY_SUM).alias("active_arr_usd"), F.bool_or("is_churned").alias("has_churn")
    )


def funnel_rollup(funnel: DataFrame) -> DataFrame:
    return funnel.groupBy("company_id").agg(F.max("stage_order").alias("max_stage_order"))


def accounts_base(int_companies: DataFrame, deals: DataFrame, contact_company: DataFrame) -> DataFrame:
    """Cleaned companies with both rollups attached; the base of both account models."""
    counted = attach_rollup(int_companies, deals, "company_id", {c: 0 for c in _DEAL_COUNTS})
    return attach_rollup(counted, contact_rollup(contact_company), "company_id", {"contact_count": 0})


def dim_accounts(base: DataFrame) -> DataFrame:
    """One row per company; ``base`` comes from :func:`accounts_base`."""
    return base.select(
        "company_id",
        "name",
        "domain",
        "industry",
        "employee_count",
        "annual_revenue_usd",
        "city",
        "country",
        "contact_count",
        *_DEAL_COUNTS,
        "created_at_hubspot",
        F.to_date("created_at_hubspot").alias("created_date"),
    )


def fct_account_health(
    base: DataFrame, revenue: DataFrame, funnel: DataFrame, as_of: Column
) -> DataFrame:
    """One row per company with its health score.

    ``base`` has the attributes and counts of an account, ``open_pipeline_usd`` and
    ``last_activity_date``: see :func:`accounts_base`, or :func:`stored_accounts_base`
    for stored marts.  ``revenue`` and ``funnel`` are the rollups of those names.
    """
    return scored_accounts(account_inputs(base, revenue, funnel), as_of)


def account_inputs(base: DataFrame, revenue: DataFrame, funnel: DataFrame) -> DataFrame:
    """What the health of a company is made of: nothing here depends on the time."""
    joined = base.join(revenue, "company_id", "left").join(funnel, "company_id", "left")
    return joined.select(
        "company_id",
        "name",
        "industry",
        "contact_count",
        *_DEAL_COUNTS,
        F.coalesce("open_pipeline_usd", F.lit(0)).cast(MONEY_SUM).alias("open_pipeline_usd"),
        "last_activity_date",
        F.coalesce("active_arr_usd", F.lit(0)).cast(MONEY_SUM).alias("arr_usd"),
        F.coalesce("has_churn", F.lit(False)).alias("has_churn"),
        "max_stage_order",
    )


def scored_accounts(inputs: DataFrame, as_of: Column) -> DataFrame:
    """Account health from :func:`account_inputs`, without a join."""
    ratio = F.coalesce(
        safe_ratio("deal_count_won", F.col("deal_count_won") + F.col("deal_count_lost")), F.lit(0.0)
    )
    filled = inputs.withColumn("_ratio", ratio)
    score = health_score(
        F.col("arr_usd"),
        F.col("_ratio"),
        F.col("open_pipeline_usd"),
        F.col("last_activity_date"),
        F.col("has_churn"),
        as_of,
    )
    return filled.select(
        "company_id",
        F.col("name").alias("company_name"),
        "industry",
        stage_at("max_stage_order").alias("lifecycle_stage"),
        "contact_count",
        *_DEAL_COUNTS,
        F.round("_ratio", 3).alias("win_rate"),
        "arr_usd",
        "open_pipeline_usd",
        "has_churn",
        "last_activity_date",
        score.alias("account_health_score"),
    )


def stored_accounts_base(accounts: DataFrame, deals: DataFrame) -> DataFrame:
    """The base of the health model out of the stored marts dim_accounts and fct_deals."""
    activity = deal_rollup(deals).select("company_id", "open_pipeline_usd", "last_activity_date")
    return accounts.join(activity, "company_id", "left")
