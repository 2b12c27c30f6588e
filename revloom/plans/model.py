"""The whole model: staged inputs in, cleaned tables and marts out, built lazily."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.operators import quality
from revloom.plans import checks, clean, marts, staging
from revloom.sources.tables import publish, published, write_clustered


@dataclass(frozen=True)
class Staged:
    """Typed staging tables.

    With ``keyed`` every id has one row in its RAW table.  Then ``deals`` and ``contacts``
    carry the ``company_id`` found in their own row, and the link tables hold one row per
    pair.  Without it, links are joined and de-duplicated across rows.
    """

    companies: DataFrame
    contacts: DataFrame
    deals: DataFrame
    line_items: DataFrame
    products: DataFrame
    lifecycle: DataFrame
    subscriptions: DataFrame
    contact_company_links: DataFrame
    deal_company_links: DataFrame
    line_item_deal_links: DataFrame
    keyed: bool = False

    @classmethod
    def from_raw(
        cls, raw: Callable[[str], DataFrame], lenient: bool = False, keyed: bool = True
    ) -> "Staged":
        """From RAW tables, given as ``raw(entity)``.

        A RAW table written by an upsert is keyed.
        """
        tables = {name: raw(name) for name in staging.STAGING}
        entities = {name: staging.stage(name, tables[name], lenient) for name in tables}
        if keyed:
            for entity, link in (("deals", "deal_company"), ("contacts", "contact_company")):
                entities[entity] = staging.stage_owned(entity, link, tables[entity], lenient)
        links = {}
        for name, spec in staging.LINKS.items():
            build = staging.links if keyed else staging.exploded_links
            links[f"{name}_links"] = build(name, tables[spec.entity])
        return cls(**entities, **links, keyed=keyed)


class RevenueModel:
    """Lazy cleaned tables and marts.

    ``as_of`` stands for "now" in stale-deal and recency rules.  ``hot_companies`` names
    companies that hold a large share of the rows, if any are known (see ``lookup_join``).
    Each attribute is one DataFrame, so plans that share an attribute also share its
    exchanges.  Building them runs no job.
    """

    def __init__(self, staged: Staged, as_of: Column, hot_companies: Sequence[str] = ()) -> None:
        self.staged = staged
        self.as_of = as_of
        self.hot = hot_companies

    @cached_property
    def int_companies(self) -> DataFrame:
        return clean.int_companies(self.staged.companies)

    @cached_property
    def int_contacts(self) -> DataFrame:
        links = None if self.staged.keyed else self.staged.contact_company_links
        return clean.int_contacts(self.staged.contacts, links)

    @cached_property
    def int_deals(self) -> DataFrame:
        return self._owned_deals.drop("company_id")

    @cached_property
    def _owned_deals(self) -> DataFrame:
        return clean.int_deals(self.staged.deals, self.as_of)

    @cached_property
    def int_lifecycle(self) -> DataFrame:
        return clean.int_lifecycle(self.staged.lifecycle, self.int_contacts)

    @cached_property
    def int_deal_company_primary(self) -> DataFrame:
        if self.staged.keyed:
            owned = self.staged.deals.where(F.col("company_id").isNotNull())
            return owned.select("deal_id", "company_id", "_loaded_at")
        return clean.int_deal_company_primary(self.staged.deal_company_links)

    @cached_property
    def int_contact_company_primary(self) -> DataFrame:
        return clean.int_contact_company_primary(self.staged.contact_company_links, self.staged.keyed)

    @cached_property
    def int_line_item_deal_primary(self) -> DataFrame:
        return clean.int_line_item_deal_primary(self.staged.line_item_deal_links, self.staged.keyed)

    @cached_property
    def int_subscriptions(self) -> DataFrame:
        return clean.int_subscriptions(self.staged.subscriptions)

    @cached_property
    def int_line_items(self) -> DataFrame:
        return clean.int_line_items(self.staged.line_items)

    @cached_property
    def int_products(self) -> DataFrame:
        return clean.int_products(self.staged.products)

    @cached_property
    def deals(self) -> DataFrame:
        """Flagged deals with their company id, before the name is looked up."""
        if self.staged.keyed:
            return marts.deals_with_company(self._owned_deals)
        return marts.deals_with_company(self._owned_deals, self.int_deal_company_primary)

    @cached_property
    def _accounts_base(self) -> DataFrame:
        return marts.accounts_base(
            self.int_companies, marts.deal_rollup(self.deals), self.int_contact_company_primary
        )

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return marts.dim_accounts(self._accounts_base)

    @cached_property
    def dim_contacts(self) -> DataFrame:
        return marts.dim_contacts(self.int_contacts, self.int_companies, self.hot)

    @cached_property
    def fct_deals(self) -> DataFrame:
        return marts.fct_deals(self.deals, self.int_companies, self.hot)

    @cached_property
    def fct_pipeline(self) -> DataFrame:
        return marts.fct_pipeline(marts.deal_flags(self.int_deals))

    @cached_property
    def revenue(self) -> DataFrame:
        """``fct_revenue`` without the company's name."""
        return marts.revenue_facts(self.int_subscriptions, self.deals)

    @cached_property
    def fct_revenue(self) -> DataFrame:
        return marts.fct_revenue(self.int_subscriptions, self.deals, self.int_companies, self.hot)

    @cached_property
    def funnel(self) -> DataFrame:
        """``fct_funnel`` without the company's name."""
        return marts.fct_funnel(self.staged.lifecycle, self.int_contacts)

    @cached_property
    def fct_funnel(self) -> DataFrame:
        return marts.fct_funnel(self.staged.lifecycle, self.dim_contacts)

    @cached_property
    def fct_account_health(self) -> DataFrame:
        return marts.fct_account_health(
            self._accounts_base,
            marts.revenue_rollup(self.revenue),
            marts.funnel_rollup(self.funnel),
            self.as_of,
        )

    def unnamed(self, mart: str) -> DataFrame:
        """A mart for consumers that do not read ``company_name``: the same rows, without
        the join that adds it."""
        lean = {
            "dim_contacts": "int_contacts",
            "fct_deals": "deals",
            "fct_revenue": "revenue",
            "fct_funnel": "funnel",
        }
        return getattr(self, lean.get(mart, mart))


# Sort columns of the stored marts: the date they are filtered by, then the key, which
# also splits a date that holds much of the table over several files.
CLUSTERING = {
    "fct_deals": ("close_date_day", "deal_id"),
    "fct_revenue": ("metric_month", "subscription_id"),
    "fct_funnel": ("entered_date", "event_id"),
}

MARTS = (
    "dim_accounts",
    "dim_contacts",
    "fct_deals",
    "fct_pipeline",
    "fct_revenue",
    "fct_funnel",
    "fct_account_health",
)


def build_marts(
    spark: SparkSession,
    staged: Staged,
    as_of: Column,
    path: str,
    parallel: int = 4,
    hot_companies: Sequence[str] = (),
    database: str = "revloom",
    seen: quality.WriteChecks | None = None,
) -> dict[str, DataFrame]:
    """Write every mart below ``path`` (full refresh) and return the stored tables.

    A refresh is written beside the last one and published in the catalog by replacing one
    view, so readers (:func:`stored_marts`) see the old marts or the new ones, whole.  A
    failed refresh changes nothing.  ``database`` also has a view per mart.

    Cleaned companies are stored first, then ``fct_deals`` and ``dim_contacts``; the other
    marts come out of these.  RAW companies and deals are parsed once, RAW contacts once for
    their columns and once for their links, which accounts count whether or not cleaning
    keeps the contact.  Marts that do not depend on each other are written side by side.
    ``seen`` counts the data tests of single rows on the way (:func:`checks.mart_tests`).
    """
    folder = f"{path.rstrip('/')}/builds/{uuid.uuid4().hex}"
    model = RevenueModel(staged, as_of, hot_companies)
    stored: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> None:
        target = f"{folder}/{name}"
        if seen is not None and name in MARTS:
            df = checks.watched(seen, name, df)
        if name in CLUSTERING:
            # Range bounds come from a sample, which would compute the mart a second time.
            df.write.option("compression", "zstd").parquet(f"{folder}/unordered/{name}")
            unordered = spark.read.schema(df.schema).parquet(f"{folder}/unordered/{name}")
            # The count is read off the footers.
            write_clustered(unordered, target, CLUSTERING[name], unordered.count())
        else:
            df.write.option("compression", "zstd").parquet(target)
        stored[name] = spark.read.schema(df.schema).parquet(target)

    def store_all(plans: dict[str, Callable[[], DataFrame]]) -> None:
        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(lambda item: store(item[0], item[1]()), plans.items()))

    store("int_companies", model.int_companies)
    model.__dict__["int_companies"] = stored["int_companies"]
    store_all({"dim_contacts": lambda: model.dim_contacts, "fct_deals": lambda: model.fct_deals})
    deals = stored["fct_deals"]
    store_all(
        {
            "dim_accounts": lambda: marts.dim_accounts(
                marts.accounts_base(
                    stored["int_companies"], marts.deal_rollup(deals), model.int_contact_company_primary
                )
            ),
            "fct_pipeline": lambda: marts.fct_pipeline(deals),
            "fct_revenue": lambda: marts.fct_revenue(model.int_subscriptions, deals),
            "fct_funnel": lambda: marts.fct_funnel(staged.lifecycle, stored["dim_contacts"]),
        }
    )
    store(
        "fct_account_health",
        marts.fct_account_health(
            marts.stored_accounts_base(stored["dim_accounts"], deals),
            marts.revenue_rollup(stored["fct_revenue"]),
            marts.funnel_rollup(stored["fct_funnel"]),
            as_of,
        ),
    )
    publish(spark, database, folder, MARTS)
    return {name: stored[name] for name in MARTS}


def stored_marts(spark: SparkSession, database: str = "revloom") -> dict[str, DataFrame]:
    """The marts of the last refresh published in ``database``."""
    return published(spark, database, MARTS)
