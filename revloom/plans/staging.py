"""RAW tables to typed staging, one row per RAW row; associations to link tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from revloom.functions import MONEY
from revloom.operators import Field, best_in_row, explode_links, flatten, one_per_pair, pairs_in_row
from revloom.vocab import CONTACT_COMPANY_LABEL, DEAL_COMPANY_LABEL, LINE_ITEM_DEAL_LABEL

_WHOLE = {"data_type": "decimal(38,0)", "then": "bigint"}
_CRM_DATES = (
    Field("createdate", "created_at_hubspot", "timestamp"),
    Field("hs_lastmodifieddate", "modified_at_hubspot", "timestamp"),
)


@dataclass(frozen=True)
class StagingSpec:
    """``key`` is (RAW column, output column)."""

    key: tuple[str, str]
    fields: tuple[Field, ...]


STAGING = {
    "companies": StagingSpec(
        ("hs_object_id", "company_id"),
        (
            Field("name", "name"),
            Field("domain", "domain"),
            Field("industry", "industry"),
            Field("numberofemployees", "employee_count", **_WHOLE),
            Field("annualrevenue", "annual_revenue_usd", **_WHOLE),
            Field("city", "city"),
            Field("country", "country"),
            *_CRM_DATES,
        ),
    ),
    "contacts": StagingSpec(
        ("hs_object_id", "contact_id"),
        (
            Field("firstname", "first_name"),
            Field("lastname", "last_name"),
            Field("email", "email"),
            Field("jobtitle", "job_title"),
            Field("phone", "phone"),
            Field("lifecyclestage", "lifecycle_stage"),
            *_CRM_DATES,
        ),
    ),
    "deals": StagingSpec(
        ("hs_object_id", "deal_id"),
        (
            Field("dealname", "deal_name"),
            Field("amount", "amount_usd", MONEY),
            Field("dealstage", "stage_id"),
            Field("dealtype", "deal_type"),
            Field("pipeline", "pipeline_id"),
            Field("closedate", "close_date", "timestamp"),
            *_CRM_DATES,
        ),
    ),
    "line_items": StagingSpec(
        ("hs_object_id", "line_item_id"),
        (
            Field("name", "product_name"),
            Field("quantity", "quantity", **_WHOLE),
            Field("price", "unit_price_usd", MONEY),
            Field("amount", "total_amount_usd", MONEY),
            Field("hs_product_id", "product_id"),
            *_CRM_DATES,
        ),
    ),
    "products": StagingSpec(
        ("hs_object_id", "product_id"),
        (
            Field("name", "product_name"),
            Field("price", "unit_price_usd", MONEY),
            Field("hs_sku", "sku"),
            *_CRM_DATES,
        ),
    ),
    "subscriptions": StagingSpec(
        ("subscription_id", "subscription_id"),
        (
            Field("crm_deal_id", "deal_id"),
            Field("billing_interval", "billing_interval"),
            Field("amount", "amount_usd", MONEY),
            Field("term_months", "term_months", "decimal(38,0)", "int"),
            Field("status", "status"),
            Field("started_at", "started_at", "timestamp"),
            Field("churned_at", "churned_at", "timestamp"),
        ),
    ),
    "lifecycle": StagingSpec(
        ("event_id", "event_id"),
        (
            Field("contact_id", "contact_id"),
            Field("stage", "lifecycle_stage"),
            Field("entered_at", "entered_at", "timestamp"),
        ),
    ),
}


def stage(entity: str, raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Typed staging rows of one entity."""
    spec = STAGING[entity]
    return flatten(raw, spec.key, spec.fields, lenient=lenient)


def stage_owned(entity: str, link: str, raw: DataFrame, lenient: bool = False) -> DataFrame:
    """:func:`stage` plus the ``company_id`` found in the same (keyed) row."""
    owned = raw.withColumn("company_id", owning_company(link, raw))
    spec = STAGING[entity]
    return flatten(owned, spec.key, spec.fields, lenient=lenient, keep=("company_id",))


@dataclass(frozen=True)
class LinkSpec:
    entity: str
    kind: str
    from_id: str
    to_id: str
    label: str


LINKS = {
    "contact_company": LinkSpec("contacts", "companies", "contact_id", "company_id", CONTACT_COMPANY_LABEL),
    "deal_company": LinkSpec("deals", "companies", "deal_id", "company_id", DEAL_COMPANY_LABEL),
    "line_item_deal": LinkSpec("line_items", "deals", "line_item_id", "deal_id", LINE_ITEM_DEAL_LABEL),
}


def exploded_links(name: str, raw: DataFrame) -> DataFrame:
    """Every association element, before the pair step."""
    spec = LINKS[name]
    return explode_links(raw, spec.kind, spec.from_id, spec.to_id, _key_in(raw, spec))


def links(name: str, raw: DataFrame, keyed: bool = True) -> DataFrame:
    """One row per pair, labeled association preferred.

    ``keyed`` states that an id has one row in ``raw``, as after a merge; then no shuffle
    is needed.  Pass False for history that may repeat an id.
    """
    spec = LINKS[name]
    if keyed:
        key = _key_in(raw, spec)
        return pairs_in_row(raw, spec.kind, spec.from_id, spec.to_id, spec.label, key)
    return one_per_pair(exploded_links(name, raw), spec.from_id, spec.to_id, spec.label)


def _key_in(raw: DataFrame, spec: LinkSpec) -> str:
    """RAW key, or the id itself when the table is already typed."""
    raw_key = STAGING[spec.entity].key[0]
    return raw_key if raw_key in raw.columns else spec.from_id


def owning_company(name: str, raw: DataFrame) -> Column:
    """The company of a deal or contact, read off its own row (``raw`` must be keyed).

    A deal takes its best association of any label, a contact only a labeled one.
    """
    spec = LINKS[name]
    return best_in_row(raw, spec.kind, spec.label, labeled_only=name == "contact_company")
