"""CRM-shaped inputs derived from the driver tables.

``customer`` plays the companies, ``orders`` the deals and subscriptions, ``lineitem`` the
line items, ``part`` the products and ``events`` the contacts and their funnel events.
Typed staging tables come first; RAW tables wrap them into VARIANT blobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.plans.model import RevenueModel
from revloom.plans.staging import LINKS, STAGING, exploded_links, links, owning_company
from revloom.session import prepare

AS_OF = "2000-01-01 00:00:00"
FRESH_AS_OF = "2024-02-01 00:00:00"
SYNCED_AT = "2024-02-01 12:00:00"

_LOADED = "timestamp'2024-01-31 06:00:00'"


class Fixture:
    #: Folder of stored RAW tables per input, filled by :meth:`store_raw`.
    stored: dict[str, str] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.as_of = F.lit(AS_OF).cast("timestamp")
        self._read: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    # --- typed staging -------------------------------------------------------------

    def companies(self) -> DataFrame:
        shell = "c_custkey % 97 = 0"
        created = "timestampadd(DAY, cast(c_custkey % 365 as int), timestamp'1995-01-01 00:00:00')"
        # One row per nation by construction, so the join goes away when country is not read.
        nation = self.table("nation").groupBy("n_nationkey").agg(F.min("n_name").alias("n_name"))
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .selectExpr(
                "cast(c_custkey as string) as company_id",
                "case when c_custkey % 50 = 0 then concat('  ', c_name, '  ') "
                "when c_custkey % 211 = 5 then 'HubSpot' else c_name end as name",
                "concat('c', c_custkey, '.com') as domain",
                f"if({shell}, null, c_mktsegment) as industry",
                f"if({shell}, null, cast(c_custkey % 5000 + 1 as bigint)) as employee_count",
                f"if({shell}, null, cast(round(c_acctbal) as bigint)) as annual_revenue_usd",
                "cast(null as string) as city",
                "n_name as country",
                f"{created} as created_at_hubspot",
                f"{created} + interval 10 days as modified_at_hubspot",
                f"{_LOADED} as _loaded_at",
            )
        )

    def deals(self) -> DataFrame:
        company = "cast(o_custkey as string)"
        loose = f"named_struct('id', {company}, 'type', 'deal_to_company_unlabeled')"
        labeled = f"named_struct('id', {company}, 'type', 'deal_to_company')"
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as deal_id",
            "concat('Deal ', o_orderkey) as deal_name",
            f"{self._amount()} as amount_usd",
            "case when o_orderstatus = 'F' then 'closedwon' when o_orderstatus = 'P' then 'closedlost' "
            "else case substr(o_orderpriority, 1, 1) when '1' then 'contractsent' "
            "when '2' then 'decisionmakerboughtin' when '3' then 'presentationscheduled' "
            "when '4' then 'qualifiedtobuy' when '5' then 'appointmentscheduled' end end as stage_id",
            "if(o_orderkey % 10 < 7, 'newbusiness', 'existingbusiness') as deal_type",
            "'default' as pipeline_id",
            "cast(o_orderdate as timestamp) as close_date",
            "cast(o_orderdate as timestamp) - interval 30 days as created_at_hubspot",
            "cast(o_orderdate as timestamp) as modified_at_hubspot",
            "cast(o_orderdate as timestamp) + interval 30 hours as _loaded_at",
            "named_struct('companies', named_struct('results', "
            f"if(o_orderkey % 4 = 0, array({loose}), array({labeled}, {loose})))) as associations",
        )

    @staticmethod
    def _amount() -> str:
        return (
            "case when o_orderkey % 101 = 0 then null "
            "when o_orderkey % 103 = 0 then -cast(o_totalprice as decimal(18,2)) "
            "else cast(o_totalprice as decimal(18,2)) end"
        )

    def subscriptions(self) -> DataFrame:
        closed = "cast(o_orderdate as timestamp)"
        return (
            self.table("orders")
            .where(f"o_orderstatus = 'F' and {self._amount()} is not null")
            .selectExpr(
                "concat('sub_', o_orderkey) as subscription_id",
                "cast(o_orderkey as string) as deal_id",
                "if(o_orderkey % 10 < 3, 'monthly', 'annual') as billing_interval",
                f"{self._amount()} as amount_usd",
                "cast((o_orderkey % 3 + 1) * 12 as int) as term_months",
                "if(o_orderkey % 7 = 0, 'churned', 'active') as status",
                f"{closed} as started_at",
                f"if(o_orderkey % 7 = 0, {closed} + interval 90 days, null) as churned_at",
                f"{closed} + interval 30 hours as _loaded_at",
            )
        )

    def line_items(self) -> DataFrame:
        cents = "cast(round(l_extendedprice * 100) as bigint)"
        quantity = "cast(l_quantity as bigint)"
        shipped = "cast(l_shipdate as timestamp)"
        return self.table("lineitem").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            f"date_format(l_shipdate, 'yyyyMMdd'), {cents}) as line_item_id",
            "concat('Part ', l_partkey) as product_name",
            f"{quantity} as quantity",
            f"cast(cast((2 * {cents} + {quantity}) div (2 * {quantity}) as decimal(18,0)) * 0.01 "
            "as decimal(18,2)) as unit_price_usd",
            "cast(l_extendedprice as decimal(18,2)) as total_amount_usd",
            "cast(l_partkey as string) as product_id",
            f"{shipped} as created_at_hubspot",
            f"{shipped} as modified_at_hubspot",
            f"{shipped} + interval 30 hours as _loaded_at",
            "named_struct('deals', named_struct('results', array(named_struct("
            "'id', cast(l_orderkey as string), 'type', 'line_item_to_deal')))) as associations",
        )

    def products(self) -> DataFrame:
        created = "timestamp'1995-01-01 00:00:00'"
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "p_name as product_name",
            "cast(p_retailprice as decimal(18,2)) as unit_price_usd",
            "concat(p_brand, '-', p_partkey) as sku",
            f"{created} as created_at_hubspot",
            f"{created} as modified_at_hubspot",
            f"{_LOADED} as _loaded_at",
        )

    def _event_rows(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id * 20 + event_id % 20 as id",
            "cast(ts as timestamp) as ts",
            "case event_type when 'view' then 'lead' when 'click' then 'marketingqualifiedlead' "
            "when 'signup' then 'salesqualifiedlead' when 'error' then 'opportunity' "
            "when 'purchase' then 'customer' end as stage",
            "case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3 "
            "when 'error' then 4 when 'purchase' then 5 end as ordinal",
        )

    def _contact_ids(self) -> DataFrame:
        return self._event_rows().groupBy("id").agg(F.min("ts").alias("ts"), F.max("ordinal").alias("ordinal"))

    def contacts(self) -> DataFrame:
        natural = "if(id % 29 = 0, id + 1, id)"
        link = "named_struct('id', cast({id} as string), 'type', '{type}')"
        own = link.format(id="id % n", type="contact_to_company")
        loose = link.format(id="id % n", type="contact_to_company_unlabeled")
        other = link.format(id="(id + 1) % n", type="contact_to_company_unlabeled")
        companies = self.table("customer").agg(F.count(F.lit(1))).scalar()
        return (
            self._event_rows()
            .groupBy("id")
            .agg(F.min("ts").alias("ts"), F.max("ordinal").alias("ordinal"))
            .withColumn("n", companies)
            .selectExpr(
                "cast(id as string) as contact_id",
                f"concat('F', {natural} % 1000) as first_name",
                f"concat('L', {natural} div 1000) as last_name",
                "case when id % 31 = 0 then null when id % 37 = 0 then 'test@test.com' "
                "when id % 5 = 0 then concat(' C', id, '@X.COM ') else concat('c', id, '@x.com') end as email",
                "concat('Title ', id % 7) as job_title",
                "cast(null as string) as phone",
                "element_at(array('lead', 'marketingqualifiedlead', 'salesqualifiedlead', 'opportunity', "
                "'customer'), ordinal) as lifecycle_stage",
                "ts as created_at_hubspot",
                "ts as modified_at_hubspot",
                "date_trunc('day', ts) + interval 30 hours as _loaded_at",
                "if(id % 41 = 0, null, named_struct('companies', named_struct('results', "
                f"if(id % 3 = 0, array({own}, {loose}, {other}), array({own}, {loose}))))) as associations",
            )
        )

    def lifecycle(self) -> DataFrame:
        return (
            self._event_rows()
            .groupBy("id", "stage")
            .agg(F.min("ts").alias("ts"))
            .selectExpr(
                "concat(id, '_', stage) as event_id",
                "cast(id as string) as contact_id",
                "stage as lifecycle_stage",
                "ts as entered_at",
                "date_trunc('day', ts) + interval 30 hours as _loaded_at",
            )
        )

    # --- inputs of the model -----------------------------------------------------------

    def entity(self, name: str) -> DataFrame:
        """Typed rows of an entity, with the association struct where it has one."""
        if name not in self._built:
            self._built[name] = getattr(self, name)()
        return self._built[name]

    def staged(self, keyed: bool = True) -> "LazyStaged":
        return LazyStaged(self, keyed)

    def model(self) -> RevenueModel:
        return RevenueModel(self.staged(), self.as_of)

    def raw(self, entity: str) -> DataFrame:
        if self.sf_dir in Fixture.stored:
            return self.spark.read.parquet(f"{Fixture.stored[self.sf_dir]}/{entity}")
        return raw_rows(entity, self.entity(entity))

    def store_raw(self, folder: str) -> None:
        """Write every RAW table below ``folder``; fixtures of the same input read them from there."""
        for entity in STAGING:
            raw_rows(entity, self.entity(entity)).write.parquet(f"{folder}/{entity}")
        Fixture.stored[self.sf_dir] = folder


class LazyStaged:
    """The attributes of ``Staged``, each built when it is first asked for."""

    def __init__(self, fixture: Fixture, keyed: bool) -> None:
        self.keyed = keyed
        self._fixture = fixture

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        self.__dict__[name] = built = self._build(name)
        return built

    def _build(self, name: str) -> DataFrame:
        if name.endswith("_links"):
            link = name.removesuffix("_links")
            rows = self._fixture.entity(LINKS[link].entity)
            return links(link, rows) if self.keyed else exploded_links(link, rows)
        rows = self._fixture.entity(name)
        if self.keyed and name in ("deals", "contacts"):
            link = f"{name.removesuffix('s')}_company"
            rows = rows.withColumn("company_id", owning_company(link, rows))
        return rows.drop("associations")


def api_records(entity: str, typed: DataFrame) -> DataFrame:
    """Typed rows as API records: property values are text or null, blobs are structs."""
    values = []
    for field in STAGING[entity].fields:
        text = f"cast({field.name} as string)"
        if field.data_type == "timestamp":
            text = f"date_format({field.name}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
        values += [f"'{field.source}'", text]
    source_key, key = STAGING[entity].key
    record = [f"{key} as {source_key}", f"named_struct({', '.join(values)}) as properties"]
    if source_key == "hs_object_id":
        links = "associations" if "associations" in typed.columns else "null as associations"
        record += [
            links,
            "created_at_hubspot as created_at",
            "modified_at_hubspot as updated_at",
            "false as archived",
        ]
    return typed.selectExpr(*record, "_loaded_at")


def raw_rows(entity: str, typed: DataFrame) -> DataFrame:
    """The RAW table: :func:`api_records` with VARIANT blobs."""
    records = api_records(entity, typed)
    columns = []
    for name in records.columns:
        if name == "properties" or (name == "associations" and "associations" in typed.columns):
            columns.append(f"to_variant_object({name}) as {name}")
        elif name == "associations":
            columns.append("cast(null as variant) as associations")
        else:
            columns.append(name)
    return records.selectExpr(*columns)
