"""The data tests of the model, as lists of what is asserted where."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.operators import quality
from revloom.vocab import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS

Tables = Callable[[str], DataFrame]

# Asserted constraints: table, columns free of NULLs, unique column.
KEY_TESTS = (
    ("raw_companies", ("hs_object_id", "properties", "_loaded_at"), "hs_object_id"),
    ("raw_contacts", ("hs_object_id", "properties", "_loaded_at"), "hs_object_id"),
    ("raw_deals", ("hs_object_id", "properties", "_loaded_at"), "hs_object_id"),
    ("raw_line_items", ("hs_object_id", "properties", "_loaded_at"), "hs_object_id"),
    ("raw_products", ("hs_object_id", "properties", "_loaded_at"), "hs_object_id"),
    ("raw_lifecycle", ("event_id", "properties", "_loaded_at"), "event_id"),
    ("raw_subscriptions", ("subscription_id", "properties", "_loaded_at"), "subscription_id"),
    ("stg_companies", ("company_id",), "company_id"),
    ("stg_contacts", ("contact_id",), "contact_id"),
    ("stg_deals", ("deal_id",), "deal_id"),
    ("stg_line_items", ("line_item_id",), "line_item_id"),
    ("stg_products", ("product_id",), "product_id"),
    ("stg_lifecycle", ("event_id", "contact_id"), "event_id"),
    ("stg_subscriptions", ("subscription_id", "deal_id"), "subscription_id"),
    ("links_contact_company", ("contact_id", "company_id"), None),
    ("links_deal_company", ("deal_id", "company_id"), None),
    ("links_line_item_deal", ("line_item_id", "deal_id"), None),
    ("int_companies", ("company_id",), "company_id"),
    ("int_contacts", ("contact_id", "email"), "contact_id"),
    ("int_deals", ("deal_id", "amount_usd"), "deal_id"),
    ("int_line_items", ("line_item_id",), "line_item_id"),
    ("int_products", ("product_id",), "product_id"),
    ("int_lifecycle", ("event_id", "contact_id"), "event_id"),
    ("int_subscriptions", ("subscription_id", "deal_id"), "subscription_id"),
    ("int_contact_company_primary", ("contact_id", "company_id"), None),
    ("int_deal_company_primary", ("deal_id", "company_id"), None),
    ("int_line_item_deal_primary", ("line_item_id", "deal_id"), None),
    ("dim_accounts", ("company_id",), "company_id"),
    ("dim_contacts", ("contact_id", "email"), "contact_id"),
    ("fct_deals", ("deal_id", "amount_usd"), "deal_id"),
    ("fct_pipeline", ("stage_id",), "stage_id"),
    ("fct_revenue", ("subscription_id", "deal_id"), "subscription_id"),
    ("fct_funnel", ("event_id", "contact_id"), "event_id"),
    ("fct_account_health", ("company_id",), "company_id"),
)

# Asserted references: child table, child column, parent table, parent column.
RELATIONSHIPS = (
    ("int_subscriptions", "deal_id", "int_deals", "deal_id"),
    ("dim_contacts", "company_id", "dim_accounts", "company_id"),
    ("fct_deals", "company_id", "dim_accounts", "company_id"),
    ("fct_revenue", "deal_id", "fct_deals", "deal_id"),
    ("fct_revenue", "company_id", "dim_accounts", "company_id"),
    ("fct_funnel", "contact_id", "dim_contacts", "contact_id"),
    ("fct_funnel", "company_id", "dim_accounts", "company_id"),
    ("fct_account_health", "company_id", "dim_accounts", "company_id"),
)

FRESHNESS_SOURCES = ("companies", "contacts", "deals", "line_items", "products", "lifecycle", "subscriptions")


def not_null_tests(tables: Tables) -> DataFrame:
    return quality.all_of([quality.not_null(tables(name), name, columns) for name, columns, _ in KEY_TESTS])


def unique_tests(tables: Tables) -> DataFrame:
    return quality.all_of(
        [quality.unique(tables(name), name, column) for name, _, column in KEY_TESTS if column]
    )


def key_tests(tables: Tables) -> DataFrame:
    """Both of the above, with one aggregate per table in place of two."""
    return quality.all_of([quality.keys(tables(name), name, columns, key) for name, columns, key in KEY_TESTS])


def relationship_tests(tables: Tables) -> DataFrame:
    return quality.all_of(
        [
            quality.relationship(tables(child), child, column, tables(parent), parent, parent_column)
            for child, column, parent, parent_column in RELATIONSHIPS
        ]
    )


def _score_out_of_range() -> Column:
    score = F.col("account_health_score")
    return score.isNull() | (score < 0) | (score > 100)


def health_out_of_range(health: DataFrame) -> DataFrame:
    return health.where(_score_out_of_range()).select("company_id", "account_health_score")


def revenue_of_unwon_deals(revenue: DataFrame, deals: DataFrame) -> DataFrame:
    """Subscriptions in revenue whose deal is missing or not won."""
    state = deals.select("deal_id", "stage_id", "is_won")
    checked = revenue.select("subscription_id", "deal_id").join(state, "deal_id", "left")
    return checked.where(~F.coalesce("is_won", F.lit(False))).select(
        "subscription_id", "deal_id", "stage_id", "is_won"
    )


def _active_mrr() -> Column:
    return F.when(F.col("is_churned"), F.lit(Decimal("0.00"))).otherwise(F.col("mrr_usd"))


def _mrr_gap() -> Column:
    return F.col("mrr_usd") - (_active_mrr() + F.col("churned_mrr_usd"))


def _wide_gap(tolerance: str) -> Column:
    return F.abs(_mrr_gap()) > F.lit(tolerance).cast("decimal(18,2)")


def mrr_gaps(revenue: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Rows where active and churned MRR do not add up to MRR."""
    return (
        revenue.withColumn("active_mrr", _active_mrr())
        .withColumn("gap", _mrr_gap())
        .where(_wide_gap(tolerance))
        .select("subscription_id", "mrr_usd", "is_churned", "churned_mrr_usd", "active_mrr", "gap")
    )


def watched(seen: quality.WriteChecks, mart: str, df: DataFrame) -> DataFrame:
    """A mart about to be written, with its tests of single rows counted on the way."""
    columns = next((columns for name, columns, _ in KEY_TESTS if name == mart), ())
    rules = {
        "fct_account_health": {"account_health_score_in_range": _score_out_of_range()},
        "fct_revenue": {"mrr_reconciliation": _wide_gap("0.01")},
    }
    return seen.watch(df, mart, columns, rules.get(mart))


def mart_tests(seen: quality.WriteChecks, stored: Mapping[str, DataFrame]) -> DataFrame:
    """The tests of stored marts: those of single rows from their write, uniqueness from the key column."""
    found = [
        quality.unique(stored[name], name, column) for name, _, column in KEY_TESTS if column and name in stored
    ]
    spark = next(iter(stored.values())).sparkSession
    return quality.all_of([seen.report(spark, stored.__getitem__), *found])


def invariant_tests(tables: Tables) -> DataFrame:
    return quality.run_suite(
        {
            "account_health_score_in_range": health_out_of_range(tables("fct_account_health")),
            "revenue_only_won_deals": revenue_of_unwon_deals(tables("fct_revenue"), tables("fct_deals")),
            "mrr_reconciliation": mrr_gaps(tables("fct_revenue")),
        }
    )


def freshness_tests(raw: Tables, as_of: Column) -> DataFrame:
    return quality.all_of(
        [
            quality.freshness(raw(name), name, as_of, FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS)
            for name in FRESHNESS_SOURCES
        ]
    )
