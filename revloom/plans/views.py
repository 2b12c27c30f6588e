"""The model under the table names SQL users know."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from revloom.operators import one_per_pair
from revloom.plans.model import MARTS, RevenueModel
from revloom.plans.staging import LINKS

# View name and the table of the model behind it.
STAGING_VIEWS = {
    "stg_hubspot__companies": "companies",
    "stg_hubspot__contacts": "contacts",
    "stg_hubspot__deals": "deals",
    "stg_hubspot__line_items": "line_items",
    "stg_hubspot__products": "products",
    "stg_hubspot__contact_lifecycle_history": "lifecycle",
    "stg_billing__subscriptions": "subscriptions",
}
LINK_VIEWS = {
    "stg_hubspot__contact_company_links": "contact_company",
    "stg_hubspot__deal_company_links": "deal_company",
    "stg_hubspot__line_item_deal_links": "line_item_deal",
}
CLEAN_VIEWS = {
    "int_hubspot__companies": "int_companies",
    "int_hubspot__contacts": "int_contacts",
    "int_hubspot__deals": "int_deals",
    "int_hubspot__line_items": "int_line_items",
    "int_hubspot__products": "int_products",
    "int_hubspot__contact_lifecycle_history": "int_lifecycle",
    "int_hubspot__contact_company_primary": "int_contact_company_primary",
    "int_hubspot__deal_company_primary": "int_deal_company_primary",
    "int_hubspot__line_item_deal_primary": "int_line_item_deal_primary",
    "int_billing__subscriptions": "int_subscriptions",
}


def register_views(model: RevenueModel, marts: Callable[[str], DataFrame] | None = None) -> list[str]:
    """Temporary views for every staging, cleaned and mart table; returns their names.

    Staging and cleaned tables are lazy.  ``marts`` gives stored marts by name; without it
    marts are lazy, too.
    """
    staged = model.staged
    views: dict[str, DataFrame] = {}
    for view, entity in STAGING_VIEWS.items():
        table = getattr(staged, entity)
        owned = staged.keyed and entity in ("contacts", "deals")
        views[view] = table.drop("company_id") if owned else table
    for view, link in LINK_VIEWS.items():
        spec, links = LINKS[link], getattr(staged, f"{link}_links")
        views[view] = links if staged.keyed else one_per_pair(links, spec.from_id, spec.to_id, spec.label)
    views.update({view: getattr(model, name) for view, name in CLEAN_VIEWS.items()})
    views.update({name: marts(name) if marts else getattr(model, name) for name in MARTS})
    for view, df in views.items():
        df.createOrReplaceTempView(view)
    return list(views)
