"""Account health kept up to date from changed rows, without rebuilding the facts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.functions import stage_ordinal
from revloom.plans import clean, marts
from revloom.plans.model import Staged
from revloom.plans.staging import STAGING
from revloom.session import stored_copy
from revloom.sources.tables import KeyedTable

_DEAL = (
    "deal_id string, company_id string, is_won boolean, is_lost boolean, is_open boolean, amount_usd decimal(18,2), "
    "created_date date, active_arr_usd decimal(38,2), has_churn boolean"
)
_CONTACT = "contact_id string, name_key string, company_id string, created_at_hubspot timestamp"
_SUBSCRIPTION = "subscription_id string, deal_id string, amount_usd decimal(18,2), is_churned boolean"
_FACTS = ("deal_id", "company_id", "is_won", "is_lost", "is_open", "amount_usd", "created_date")
_STAGED_COMPANY = ("company_id", "name", "industry", "employee_count", "annual_revenue_usd")
_STAGED_CONTACT = ("contact_id", "first_name", "last_name", "email", "company_id", "created_at_hubspot")
_REACH = "contact_id string, company_id string, max_stage_order int"
_PAIR = "contact_id string, company_id string"
_ACCOUNT = (
    "company_id string, name string, industry string, contact_count bigint, deal_count_total bigint, "
    "deal_count_won bigint, deal_count_lost bigint, deal_count_open bigint, open_pipeline_usd decimal(38,2), "
    "last_activity_date date, arr_usd decimal(38,2), has_churn boolean, max_stage_order int"
)
_COMPANY = "company_id string, name string, industry string"
#: Name: schema, key, and what the buckets are made by, if not the key.
_TABLES: dict[str, tuple[str, tuple[str, ...], tuple[str, ...] | None]] = {
    "companies": (_COMPANY, ("company_id",), None),
    "deals": (_DEAL, ("deal_id",), None),
    "deals_by_company": (_DEAL, ("deal_id",), ("company_id",)),
    "subscriptions": (_SUBSCRIPTION, ("subscription_id",), None),
    "subscriptions_by_deal": (_SUBSCRIPTION, ("subscription_id",), ("deal_id",)),
    "contacts": (_CONTACT, ("contact_id",), None),
    "contacts_by_name": (_CONTACT, ("contact_id",), ("name_key",)),
    "survivors": (_PAIR, ("contact_id",), None),
    "events_by_contact": ("event_id string, contact_id string, stage_order int", ("event_id",), ("contact_id",)),
    "reach": (_REACH, ("contact_id",), None),
    "reach_by_company": (_REACH, ("contact_id",), ("company_id",)),
    "links": (_PAIR, ("contact_id", "company_id"), ("contact_id",)),
    "links_by_company": (_PAIR, ("contact_id", "company_id"), ("company_id",)),
    "accounts": (_ACCOUNT, ("company_id",), None),
    "marks": ("entity string, mark timestamp", ("entity",), None),
}


class AccountHealth:
    """State below ``path`` from which account health is read, maintained by affected keys.

    Every fact is stored twice, by its own id and by what it is rolled up to.  A changed row
    finds its old self by id, and so the keys it leaves and those it comes to: deals lead to
    companies, subscriptions to deals, contacts to the contacts of the same name (of whom one
    survives), events to contacts.  Rollups of just these companies are computed from the
    buckets they lie in, and replace the old ones; other buckets are neither read nor written.
    What depends on the time, the score, is computed when it is read.

    Rows of a deal or contact that arrives later than what refers to it wait under its id.
    A refresh that failed is repeated from the same rows; one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark = spark
        self.tables = {
            name: KeyedTable(spark, f"{path.rstrip('/')}/{name}", schema, keys, buckets, by)
            for name, (schema, keys, by) in _TABLES.items()
        }

    def read(self, as_of: Column) -> DataFrame:
        """``fct_account_health`` at ``as_of``."""
        return marts.scored_accounts(self.tables["accounts"].read(), as_of)

    def refresh_from_raw(self, raw: Callable[[str], DataFrame]) -> None:
        """Take in the rows of the RAW tables ``raw(entity)`` loaded since the last call.

        The marks are moved last, so a call that failed is repeated whole.
        """
        marks = {r["entity"]: r["mark"] for r in self.tables["marks"].read().collect()}
        fresh = {}
        for entity in STAGING:
            rows = raw(entity)
            fresh[entity] = rows.where(F.col("_loaded_at") > F.lit(marks[entity])) if marks.get(entity) else rows
        self.refresh(Staged.from_raw(fresh.__getitem__))
        seen = [rows.agg(F.lit(entity).alias("entity"), F.max("_loaded_at").alias("mark")) for entity, rows in fresh.items()]
        self.tables["marks"].merge(reduce(DataFrame.union, seen).where("mark is not null"))

    def refresh(self, changed: Staged) -> None:
        """Take in ``changed``: staged rows (keyed) that are new or replace rows with the same id."""
        if not changed.keyed:
            raise ValueError("changed rows have to be keyed: one per id")
        # Every step reads its rows several times: what it needs of them is taken out of their blobs once.
        companies = stored_copy(changed.companies.select(*_STAGED_COMPANY), "staged-companies")
        deals = stored_copy(marts.deal_flags(changed.deals).select(*_FACTS), "staged-deals")
        contacts = stored_copy(changed.contacts.select(*_STAGED_CONTACT), "staged-contacts")
        steps = (
            lambda: self._companies(companies),
            lambda: self._deals(deals, changed.subscriptions),
            lambda: self._links(contacts, changed.contact_company_links),
            lambda: self._funnel(contacts, changed.lifecycle),
        )
        # No two steps share a table, and much of a step is small jobs that leave the cluster idle.
        with ThreadPoolExecutor(len(steps)) as pool:
            touched = list(pool.map(lambda step: step(), steps))
        companies = reduce(DataFrame.union, touched).where("company_id is not null").distinct()
        self._accounts(stored_copy(companies, "companies"))

    # Each step returns the companies it touched: (company_id).

    def _companies(self, staged: DataFrame) -> DataFrame:
        ids = staged.select("company_id").distinct()
        rows = clean.int_companies(staged).select("company_id", "name", "industry")
        self._swap("companies", ids, rows, ids)
        return ids

    def _deals(self, flagged: DataFrame, staged_subscriptions: DataFrame) -> DataFrame:
        subscriptions = clean.int_subscriptions(staged_subscriptions).select(
            "subscription_id", "deal_id", "amount_usd", "is_churned"
        )
        subscriptions = stored_copy(subscriptions, "subscriptions")
        subscription_ids = subscriptions.select("subscription_id")
        before = self._of("subscriptions", subscription_ids).select("deal_id")
        sold = before.union(subscriptions.select("deal_id")).where("deal_id is not null").distinct()
        sold = stored_copy(sold, "sold")
        self._swap("subscriptions", subscription_ids, subscriptions, subscription_ids)
        self._swap("subscriptions_by_deal", subscription_ids, subscriptions.where("deal_id is not null"), sold)

        delta_ids = flagged.select("deal_id").distinct()
        ids = stored_copy(delta_ids.union(sold).distinct(), "deals")
        old = stored_copy(self._of("deals", ids), "old-deals")
        new = clean.priced_deals(flagged).unionByName(old.select(*_FACTS).join(delta_ids, "deal_id", "left_anti"))
        paid = self._of("subscriptions_by_deal", ids).withColumnRenamed("amount_usd", "arr_usd")
        won = new.where("is_won").select("deal_id")
        revenue = marts.revenue_rollup(paid.join(won, "deal_id", "left_semi"), "deal_id")
        new = stored_copy(new.join(revenue, "deal_id", "left"), "new-deals")
        companies = old.select("company_id").union(new.select("company_id")).where("company_id is not null").distinct()
        self._swap("deals", ids, new, ids)
        self._swap("deals_by_company", ids, new.where("company_id is not null"), companies)
        return companies

    def _links(self, staged: DataFrame, links: DataFrame) -> DataFrame:
        ids = staged.select("contact_id").distinct()
        new = stored_copy(clean.int_contact_company_primary(links, True).select("contact_id", "company_id"), "new-links")
        old = stored_copy(self._of("links", ids), "old-links")
        companies = old.select("company_id").union(new.select("company_id")).distinct()
        self._swap("links", ids, new, ids)
        self._swap("links_by_company", ids, new, companies)
        return companies

    def _funnel(self, staged: DataFrame, staged_events: DataFrame) -> DataFrame:
        name = F.to_json(F.struct("first_name", "last_name"), {"ignoreNullFields": "false"}).alias("name_key")
        new = clean.tidy_contacts(staged).select("contact_id", name, "company_id", "created_at_hubspot")
        new = stored_copy(new, "new-contacts")
        ids = staged.select("contact_id").distinct()
        names = self._of("contacts", ids).select("name_key").union(new.select("name_key")).distinct()
        names = stored_copy(names, "names")
        self._swap("contacts", ids, new, ids)
        self._swap("contacts_by_name", ids, new, names)
        namesakes = self._of("contacts_by_name", names)
        survivors = stored_copy(clean.one_per_name(namesakes, ("name_key",)).select("contact_id", "company_id"), "survivors")
        in_doubt = stored_copy(namesakes.select("contact_id").union(ids).distinct(), "namesakes")
        self._swap("survivors", in_doubt, survivors, in_doubt)

        events = staged_events.where("contact_id is not null").select(
            "event_id", "contact_id", stage_ordinal("lifecycle_stage").cast("int").alias("stage_order")
        )
        events = stored_copy(events, "events")
        self._swap("events_by_contact", events.select("event_id"), events, events.select("contact_id"))
        contacts = stored_copy(in_doubt.union(events.select("contact_id")).distinct(), "contacts")
        furthest = self._of("events_by_contact", contacts).groupBy("contact_id").agg(F.max("stage_order").alias("max_stage_order"))
        reach = self._of("survivors", contacts).join(furthest, "contact_id")
        reach = stored_copy(reach.select("contact_id", "company_id", "max_stage_order"), "new-reach")
        old = stored_copy(self._of("reach", contacts), "old-reach")
        companies = old.select("company_id").union(reach.select("company_id")).where("company_id is not null").distinct()
        self._swap("reach", contacts, reach, contacts)
        self._swap("reach_by_company", contacts, reach.where("company_id is not null"), companies)
        return companies

    def _accounts(self, companies: DataFrame) -> None:
        deals = self._of("deals_by_company", companies)
        sums = deals.where("active_arr_usd is not null").groupBy("company_id")
        revenue = sums.agg(F.sum("active_arr_usd").alias("active_arr_usd"), F.bool_or("has_churn").alias("has_churn"))
        reach = self._of("reach_by_company", companies).withColumnRenamed("max_stage_order", "stage_order")
        base = marts.accounts_base(
            self._of("companies", companies), marts.deal_rollup(deals), self._of("links_by_company", companies)
        )
        inputs = marts.account_inputs(base, revenue, marts.funnel_rollup(reach))
        self._swap("accounts", companies, stored_copy(inputs, "accounts"), companies)

    def _of(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows whose bucket columns are among ``keys``; only their buckets are read."""
        table = self.tables[name]
        return table.read_buckets(table.touched(keys)).join(keys, table.by, "left_semi")

    def _swap(self, name: str, gone: DataFrame, rows: DataFrame, places: DataFrame) -> None:
        """Replace the rows with the keys ``gone`` by ``rows``; ``places`` has the bucket columns of both."""
        table = self.tables[name]
        buckets = table.touched(places)
        kept = table.read_buckets(buckets).join(gone, gone.columns, "left_anti")
        table.write_buckets(buckets, kept.unionByName(rows))
