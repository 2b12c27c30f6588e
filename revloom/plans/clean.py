"""Cleaning models: staging in, intermediate out.  Nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.functions import is_closed_stage, stage_ordinal
from revloom.operators import ascending, best_target, keep_first, labeled_pairs
from revloom.vocab import (
    CONTACT_COMPANY_LABEL,
    DEAL_COMPANY_LABEL,
    LINE_ITEM_DEAL_LABEL,
    SAMPLE_COMPANY_NAME,
    SAMPLE_EMAILS,
    STATUS_ACTIVE,
    STATUS_CHURNED,
    TEST_EMAILS,
)


def int_companies(stg_companies: DataFrame) -> DataFrame:
    """Trimmed names; no vendor sample, no nameless and no shell companies."""
    shell = (
        F.col("industry").isNull()
        & F.col("employee_count").isNull()
        & F.col("annual_revenue_usd").isNull()
    )
    # A NULL name makes the comparison NULL, which drops the row as well.
    return stg_companies.withColumn("name", F.trim("name")).where(
        (F.col("name") != SAMPLE_COMPANY_NAME) & ~shell
    )


def tidy_contacts(stg_contacts: DataFrame) -> DataFrame:
    """Contacts with an email that is nobody's test address; names trimmed, emails in lower case."""
    return stg_contacts.withColumns(
        {
            "first_name": F.trim("first_name"),
            "last_name": F.trim("last_name"),
            "email": F.lower(F.trim("email")),
        }
    ).where(F.col("email").isNotNull() & ~F.col("email").isin(*TEST_EMAILS, *SAMPLE_EMAILS))


def one_per_name(contacts: DataFrame, name: tuple[str, ...] = ("first_name", "last_name")) -> DataFrame:
    """Of the contacts of one name the earliest created."""
    return keep_first(contacts, list(name), ascending("created_at_hubspot", "contact_id"))


def int_contacts(stg_contacts: DataFrame, contact_links: DataFrame | None = None) -> DataFrame:
    """Normalized contacts, one per (first, last) name: the earliest created.

    The company comes from ``contact_links`` (exploded or de-duplicated), or without them
    from a ``company_id`` column of ``stg_contacts``.  A contact with several labeled
    companies gets the smallest company id.
    """
    # Reduce before any join: the company does not take part in the choice, and one
    # company per contact cannot change the number of rows.
    kept = one_per_name(tidy_contacts(stg_contacts))
    if contact_links is not None:
        primary = (
            contact_links.where(F.col("link_type") == CONTACT_COMPANY_LABEL)
            .groupBy("contact_id")
            .agg(F.min("company_id").alias("company_id"))
        )
        kept = kept.drop("company_id").join(primary, "contact_id", "left")
    return kept.select(
        "contact_id",
        "company_id",
        "first_name",
        "last_name",
        "email",
        "job_title",
        "phone",
        "lifecycle_stage",
        "created_at_hubspot",
        "modified_at_hubspot",
        "_loaded_at",
    )


def priced_deals(deals: DataFrame) -> DataFrame:
    """Deals with an amount of zero or more."""
    return deals.where(F.col("amount_usd") >= 0)


def int_deals(stg_deals: DataFrame, as_of: Column) -> DataFrame:
    """Deals with an amount of zero or more; open deals past their close date are flagged.

    A ``company_id`` column, when there is one, is carried along at the end.
    """
    stale = F.when(~is_closed_stage("stage_id") & (F.col("close_date") < as_of), True).otherwise(False)
    return priced_deals(stg_deals).select(
        "deal_id",
        "deal_name",
        "amount_usd",
        "stage_id",
        "deal_type",
        "pipeline_id",
        "close_date",
        stale.alias("is_stale"),
        "created_at_hubspot",
        "modified_at_hubspot",
        "_loaded_at",
        *[c for c in ("company_id",) if c in stg_deals.columns],
    )


def int_lifecycle(stg_lifecycle: DataFrame, contacts: DataFrame) -> DataFrame:
    """Events of surviving contacts, with the stage ordinal."""
    kept = stg_lifecycle.join(contacts.select("contact_id"), "contact_id", "left_semi")
    return kept.select(
        "event_id",
        "contact_id",
        "lifecycle_stage",
        stage_ordinal("lifecycle_stage").alias("stage_order"),
        "entered_at",
        "_loaded_at",
    )


def int_deal_company_primary(deal_links: DataFrame) -> DataFrame:
    """One company per deal, also when only unlabeled associations exist."""
    return best_target(deal_links, "deal_id", "company_id", DEAL_COMPANY_LABEL)


def int_contact_company_primary(contact_links: DataFrame, paired: bool = False) -> DataFrame:
    """Labeled links; ``paired`` links already have one row per pair."""
    return _primary(contact_links, "contact_id", "company_id", CONTACT_COMPANY_LABEL, paired)


def int_line_item_deal_primary(line_item_links: DataFrame, paired: bool = False) -> DataFrame:
    return _primary(line_item_links, "line_item_id", "deal_id", LINE_ITEM_DEAL_LABEL, paired)


def _primary(links: DataFrame, from_id: str, to_id: str, label: str, paired: bool) -> DataFrame:
    if paired:
        return links.where(F.col("link_type") == label).drop("link_type")
    return labeled_pairs(links, from_id, to_id, label)


def int_subscriptions(stg_subscriptions: DataFrame) -> DataFrame:
    return stg_subscriptions.select(
        "subscription_id",
        "deal_id",
        "billing_interval",
        "amount_usd",
        "term_months",
        "status",
        (F.col("status") == STATUS_ACTIVE).alias("is_active"),
        (F.col("status") == STATUS_CHURNED).alias("is_churned"),
        "started_at",
        "churned_at",
        "_loaded_at",
    )


def int_line_items(stg_line_items: DataFrame) -> DataFrame:
    return stg_line_items


def int_products(stg_products: DataFrame) -> DataFrame:
    return stg_products
