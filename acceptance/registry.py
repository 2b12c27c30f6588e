"""Query name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.fixtures import FRESH_AS_OF, SYNCED_AT, Fixture, api_records, raw_rows
from revloom.operators import contract, fixed_size_batches, quality
from revloom.operators.chain import whole_chain
from revloom.operators.upsert import incremental_upsert, upsert
from revloom.plans import checks, clean, export, metrics, reports, sketches, staging
from revloom.plans.copartitioned import AccountRollups, store_rollups
from revloom.plans.incremental import AccountHealth
from revloom.plans.model import RevenueModel, Staged, build_marts
from revloom.plans.views import register_views
from revloom.session import has_scratch, name_scratch_root, prepare, scratch_path, stored_copy
from revloom.sources import ingest, landing
from revloom.sources.tables import RAW_ENTITY_SCHEMA, KeyedTable, append_rows, ensure_table
from revloom.streaming import stream_pages, stream_upsert
from revloom.vocab import tracked_names

Query = Callable[[SparkSession, str], DataFrame]


def _fixture(build: Callable[[Fixture], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Fixture(spark, sf_dir))


def _model(build: Callable[[RevenueModel], DataFrame]) -> Query:
    return _fixture(lambda fixture: build(fixture.model()))


# --- staging and cleaning ------------------------------------------------------------


def _staging_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for entity in staging.STAGING:
        found[f"stg_{entity}"] = _fixture(lambda f, e=entity: staging.stage(e, f.raw(e)))
    for link, spec in staging.LINKS.items():
        found[f"links_{link}"] = _fixture(lambda f, n=link, e=spec.entity: staging.links(n, f.raw(e)))
    return found


def _twice_delivered(fixture: Fixture) -> DataFrame:
    """RAW deals of which every third came again a day later, with other associations.

    The second delivery adds a company with a smaller id, unlabeled, one with a larger id,
    labeled, and repeats the first one without a label.
    """
    deals = fixture.entity("deals")
    link = "named_struct('id', cast({} as string), 'type', {})"
    own = "cast(associations.companies.results[0].id as bigint)"
    again = deals.where("cast(deal_id as bigint) % 3 = 0").selectExpr(
        *[c for c in deals.columns if c not in ("associations", "_loaded_at")],
        "_loaded_at + interval 1 day as _loaded_at",
        "named_struct('companies', named_struct('results', array("
        + ", ".join(
            [
                link.format(f"{own} - 1", "'deal_to_company_unlabeled'"),
                link.format(f"{own} + 1", "'deal_to_company'"),
                link.format(own, "cast(null as string)"),
            ]
        )
        + "))) as associations",
    )
    return raw_rows("deals", deals.unionByName(again))


def _across_rows_queries() -> dict[str, Query]:
    def pairs(fixture: Fixture) -> DataFrame:
        return staging.links("deal_company", _twice_delivered(fixture), keyed=False)

    def best(fixture: Fixture) -> DataFrame:
        return clean.int_deal_company_primary(staging.exploded_links("deal_company", _twice_delivered(fixture)))

    def contacts(fixture: Fixture) -> DataFrame:
        staged = fixture.staged(keyed=False)
        return clean.int_contacts(staged.contacts, staged.contact_company_links)

    return {
        "links_deal_company_across_rows": _fixture(pairs),
        "int_deal_company_across_rows": _fixture(best),
        "int_contacts_across_rows": _fixture(contacts),
    }


def _view_sql(fixture: Fixture) -> DataFrame:
    """A user's statement over the registered views."""
    register_views(fixture.model(), _marts(fixture).__getitem__)
    return fixture.spark.sql(
        """
        select a.country, count(distinct d.deal_id) as deals, sum(d.amount_usd) as won_usd,
               count(distinct s.subscription_id) as subscriptions
        from dim_accounts a
        join fct_deals d on d.company_id = a.company_id
        left join int_billing__subscriptions s on s.deal_id = d.deal_id
        where d.is_won
        group by a.country
        """
    )


def _stage_metadata(fixture: Fixture) -> DataFrame:
    """A pipeline per region whose stages are its nations, as saved metadata pages."""
    nations = fixture.table("nation").selectExpr(
        "n_regionkey",
        "named_struct('id', cast(n_nationkey as string), 'label', n_name, 'displayOrder', cast(n_nationkey as int), "
        "'metadata', named_struct('probability', cast(n_nationkey / 100 as decimal(4,2)), "
        "'isClosed', cast(n_nationkey % 5 = 0 as string))) as stage",
    )
    pipelines = (
        nations.groupBy("n_regionkey")
        .agg(F.sort_array(F.collect_list("stage")).alias("stages"))
        .join(fixture.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("named_struct('id', cast(r_regionkey as string), 'label', r_name, 'stages', stages) as pipeline")
    )
    page = pipelines.agg(F.sort_array(F.collect_list("pipeline")).alias("results"))
    path = _scratch(fixture.spark, "stages")
    page.select(F.to_json(F.struct("results")).alias("value")).write.text(path)
    return landing.read_stages(fixture.spark, path)


def _text_blobs(fixture: Fixture) -> DataFrame:
    """Deals whose blobs arrive as JSON text; a third of them without any text."""
    records = api_records("deals", fixture.entity("deals"))
    text = F.to_json("properties", {"ignoreNullFields": "false"})
    rows = records.select(
        F.col("hs_object_id").cast("bigint").alias("hs_object_id"),
        F.when(F.col("hs_object_id").cast("bigint") % 3 != 0, text).alias("properties"),
        "_loaded_at",
    )
    return staging.stage("deals", landing.raw_from_text(rows, "hs_object_id")).drop("pipeline_id")


def _clean_queries() -> dict[str, Query]:
    names = (
        "int_companies",
        "int_contacts",
        "int_deals",
        "int_lifecycle",
        "int_deal_company_primary",
        "int_contact_company_primary",
        "int_line_item_deal_primary",
        "int_subscriptions",
        "int_line_items",
        "int_products",
    )
    return {name: _model(lambda m, n=name: getattr(m, n)) for name in names}


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh scratch path.  Only a local session without a shared folder gets one named here."""
    if not has_scratch(spark) and spark.sparkContext.master.startswith("local["):
        name_scratch_root(tempfile.mkdtemp(prefix="acceptance-"))
    return scratch_path(spark, name)


def _database(path: str) -> str:
    """A catalog database of its own for a scratch path."""
    return "marts_" + path.rsplit("-", 1)[-1]


# --- marts ---------------------------------------------------------------------------


#: Per entity the rows that are missing at first, and those that are different, as the second load finds them.
LATE = {
    "companies": ("cast(company_id as bigint) % 13 = 4", "cast(company_id as bigint) % 8 = 1"),
    "contacts": ("cast(contact_id as bigint) % 9 = 2", "cast(contact_id as bigint) % 4 = 0 or cast(contact_id as bigint) % 6 = 1"),
    "deals": ("cast(deal_id as bigint) % 11 = 3", "cast(deal_id as bigint) % 5 = 0 or cast(deal_id as bigint) % 7 = 0"),
    "subscriptions": ("crc32(subscription_id) % 6 = 5", "crc32(subscription_id) % 10 = 1"),
    "lifecycle": ("crc32(event_id) % 3 = 1", "false"),
}


def earlier_rows(fixture: Fixture, entity: str) -> DataFrame:
    """The typed rows of the first load: other owners, names, stages and more links than at last."""
    rows = fixture.entity(entity)
    if entity not in LATE:
        return rows
    missing, other = (F.expr(text) for text in LATE[entity])

    def linked(key: str, label: str) -> Column:
        neighbour = (F.col(f"associations.{key}.results")[0]["id"].cast("bigint") + 1).cast("string")
        link = F.struct(neighbour.alias("id"), F.lit(label).alias("type"))
        return F.struct(F.struct(F.array(link, F.col(f"associations.{key}.results")[0]).alias("results")).alias(key))

    changes = {
        "companies": {"name": F.lit("HubSpot")},
        "contacts": {
            "first_name": F.concat(F.lit("X"), "first_name"),
            "associations": linked("companies", "contact_to_company"),
        },
        "deals": {"stage_id": F.lit("contractsent"), "associations": linked("companies", "deal_to_company")},
        "subscriptions": {"deal_id": (F.col("deal_id").cast("bigint") + 1).cast("string"), "status": F.lit("churned")},
        "lifecycle": {},
    }[entity]
    kept = rows.where(~missing)
    return kept.withColumns({name: F.when(other, value).otherwise(F.col(name)) for name, value in changes.items()})


def later_rows(fixture: Fixture, entity: str) -> DataFrame:
    """The typed rows of the second load."""
    if entity not in LATE:
        return fixture.entity(entity).limit(0)
    missing, other = LATE[entity]
    return fixture.entity(entity).where(f"({missing}) or ({other})")


def _incremental_health(fixture: Fixture) -> DataFrame:
    """Health out of two loads, the second of which moves, renames, unlinks and adds rows."""
    state = AccountHealth(fixture.spark, _scratch(fixture.spark, "health"), buckets=8)
    for rows in (earlier_rows, later_rows):
        state.refresh(Staged.from_raw(lambda e, rows=rows: raw_rows(e, rows(fixture, e))))
    return state.read(fixture.as_of)


def _mart_queries() -> dict[str, Query]:
    names = (
        "dim_accounts",
        "dim_contacts",
        "fct_deals",
        "fct_pipeline",
        "fct_revenue",
        "fct_funnel",
        "fct_account_health",
    )
    found = {name: _model(lambda m, n=name: getattr(m, n)) for name in names}

    def from_raw(fixture: Fixture) -> DataFrame:
        return RevenueModel(Staged.from_raw(fixture.raw), fixture.as_of).fct_account_health

    def stored(fixture: Fixture) -> DataFrame:
        """The mart as a reader of the catalog finds it."""
        path = _scratch(fixture.spark, "marts")
        build_marts(fixture.spark, fixture.staged(), fixture.as_of, path, database=_database(path))
        return fixture.spark.table(f"{_database(path)}.fct_account_health")

    def quarter(fixture: Fixture) -> DataFrame:
        return _rollups(fixture).revenue_of(F.expr("year = 1998 and quarter = 2"))

    found["copartitioned_account_health"] = _fixture(lambda f: _rollups(f).health(f.as_of))
    found["revenue_of_quarter"] = _fixture(quarter)
    found["incremental_account_health"] = _fixture(_incremental_health)
    found["raw_to_account_health"] = _fixture(from_raw)
    found["stored_account_health"] = _fixture(stored)
    return found


# --- metrics and reports ---------------------------------------------------------------


def _metric_queries() -> dict[str, Query]:
    keys = {
        "metric_mrr": "mrr",
        "metric_arr": "arr",
        "metric_arr_active": "arr_active",
        "metric_acv": "acv",
        "metric_acv_total": "acv_total",
        "metric_tcv": "tcv",
        "metric_churned_mrr": "churned_mrr",
        "metric_active_mrr": "active_mrr",
        "metric_open_pipeline": "open_pipeline_value",
        "metric_weighted_pipeline": "weighted_pipeline_value",
        "metric_win_rate": "win_rate",
        "metric_lead_to_mql": "lead_to_mql_rate",
        "metric_mql_to_sql": "mql_to_sql_rate",
        "metric_sql_to_customer": "sql_to_customer_rate",
        "metric_median_days_mql_to_sql": "median_days_mql_to_sql",
        "metric_account_health": "account_health_score",
        "metric_arr_per_account": "arr_per_account",
    }

    def cuts(model: RevenueModel, name: str) -> DataFrame:
        return metrics.compute_cuts(name, model.unnamed(metrics.CATALOG[name].mart))

    found = {key: _model(lambda m, n=name: cuts(m, n)) for key, name in keys.items()}
    found["metric_account_health_buckets"] = _model(
        lambda m: metrics.health_buckets(m.fct_account_health)
        .groupBy("health_bucket")
        .agg(F.count(F.lit(1)).alias("accounts"))
    )
    found["cohort_conversion_within"] = _model(
        lambda m: metrics.cohort_conversion_within(m.funnel, (1, 7, 90))
    )
    return found


def _report_queries() -> dict[str, Query]:
    return {
        "kpi_revenue": _model(lambda m: reports.kpi_revenue(m.revenue)),
        "kpi_pipeline": _model(lambda m: reports.kpi_pipeline(m.fct_pipeline)),
        "kpi_win_rate": _model(lambda m: reports.kpi_win_rate(m.deals)),
        "report_mrr_by_month": _model(lambda m: reports.mrr_by_month(m.revenue)),
        "report_acv_histogram": _model(lambda m: reports.acv_histogram(m.revenue)),
        "report_tcv_by_type": _model(lambda m: reports.tcv_by_type(m.revenue)),
        "report_pipeline_by_stage": _model(lambda m: reports.pipeline_by_stage(m.fct_pipeline)),
        "report_pipeline_long": _model(lambda m: reports.pipeline_long(m.fct_pipeline)),
        "report_funnel_counts": _model(lambda m: reports.funnel_counts(m.funnel)),
        "report_funnel_steps": _model(lambda m: reports.funnel_steps(m.funnel)),
        "report_median_handoff": _model(lambda m: reports.median_handoff(m.funnel)),
        "report_health_list": _model(lambda m: reports.health_list(m.fct_account_health)),
        "report_health_histogram": _model(lambda m: reports.health_histogram(m.fct_account_health)),
        "top_accounts_by_arr": _model(lambda m: reports.top_accounts_by_arr(m.fct_account_health)),
    }


def _sketch_queries() -> dict[str, Query]:
    """Reports out of stored sketches; with as many entries as here they are exact."""
    lg_entries, size = 20, 65535

    def stored(fixture: Fixture, rows: DataFrame) -> DataFrame:
        _scratch(fixture.spark, "sketches")
        return stored_copy(rows, "sketches")

    def month(unit: str) -> Column:
        return F.trunc("cohort_month", unit)

    def counts(fixture: Fixture) -> DataFrame:
        kept = stored(fixture, sketches.stage_sketches(fixture.model().funnel, lg_entries))
        return sketches.stage_counts(kept, month("quarter"), lg_entries)

    def conversion(fixture: Fixture) -> DataFrame:
        kept = stored(fixture, sketches.stage_sketches(fixture.model().funnel, lg_entries))
        return sketches.conversion(kept, "lead", "marketingqualifiedlead", month("quarter"), lg_entries)

    def median(fixture: Fixture) -> DataFrame:
        kept = stored(fixture, sketches.handoff_sketches(fixture.model().funnel, size))
        return sketches.handoff_quantile(kept, 0.5, month("year"), size)

    return {
        "sketch_stage_counts": _fixture(counts),
        "sketch_conversion": _fixture(conversion),
        "sketch_handoff_median": _fixture(median),
    }


# --- checks and contracts --------------------------------------------------------------


_built: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _marts(fixture: Fixture) -> dict[str, DataFrame]:
    """The stored marts, built once per session and input."""
    key = (fixture.spark.sparkContext.applicationId, fixture.sf_dir)
    if key not in _built:
        path = _scratch(fixture.spark, "marts")
        _built[key] = build_marts(fixture.spark, fixture.staged(), fixture.as_of, path, database=_database(path))
    return _built[key]


def _rollups(fixture: Fixture) -> AccountRollups:
    """The stored marts rolled up into bucketed tables of a database of their own."""
    spark, path = fixture.spark, _scratch(fixture.spark, "rollups")
    spark.sql(f"CREATE DATABASE {_database(path)} LOCATION '{path}'")
    store_rollups(spark, _marts(fixture), _database(path), buckets=8)
    return AccountRollups(spark, _database(path))


def _tested_while_written(fixture: Fixture) -> DataFrame:
    path, seen = _scratch(fixture.spark, "marts"), quality.WriteChecks()
    marts = build_marts(
        fixture.spark, fixture.staged(), fixture.as_of, path, database=_database(path), seen=seen
    )
    return checks.mart_tests(seen, marts)


def _tables(fixture: Fixture) -> Callable[[str], DataFrame]:
    """Any table of the model by the name the checks use; marts are the stored ones."""
    model, marts = fixture.model(), _marts(fixture)

    def table(name: str) -> DataFrame:
        layer, _, rest = name.partition("_")
        if layer == "raw":
            return fixture.raw(rest)
        if layer == "stg":
            return getattr(model.staged, rest)
        if layer == "links":
            return getattr(model.staged, f"{rest}_links")
        return marts[name] if name in marts else getattr(model, name)

    return table


_CRM = ("companies", "contacts", "deals", "line_items", "products")


def _contract_of(raw: DataFrame, entity: str) -> DataFrame:
    return contract.contract_from_blobs(raw, entity, tracked=tracked_names(entity))


def _observed(fixture: Fixture) -> DataFrame:
    return quality.all_of([_contract_of(fixture.raw(e), e) for e in _CRM])


def _observed_after_change(fixture: Fixture) -> DataFrame:
    """The same sources after the CRM retyped, renamed, dropped and added properties."""
    text = {name: F.variant_get("properties", f"$.{name}", "string").alias(name) for name in tracked_names("deals")}
    renamed = [column.alias("deal_kind") if name == "dealtype" else column for name, column in text.items()]
    plain = [column for name, column in zip(text, renamed, strict=True) if name not in ("amount", "closedate")]
    amount = F.variant_get("properties", "$.amount", "decimal(18,2)").alias("amount")
    # Every third deal still sends its amount as text, every fifth has no close date at all.
    number = F.col("hs_object_id").cast("bigint")
    deals = raw_rows("deals", fixture.entity("deals")).select(
        F.when(number % 5 == 0, F.to_variant_object(F.struct(*plain, amount)))
        .when(number % 3 == 0, F.to_variant_object(F.struct(*plain, text["amount"], text["closedate"])))
        .otherwise(F.to_variant_object(F.struct(*plain, amount, text["closedate"])))
        .alias("properties")
    )
    products = api_records("products", fixture.entity("products")).select(
        F.to_variant_object(F.struct("properties.*", F.lit("USD").alias("currency"))).alias("properties")
    )
    changed = {"deals": deals, "products": products}
    live = [_contract_of(changed[e] if e in changed else fixture.raw(e), e) for e in _CRM]
    # Not in the baseline, hence ignored by the comparison.
    live.append(contract.contract_from_blobs(fixture.raw("subscriptions"), "subscriptions"))
    return quality.all_of(live)


def _changes(fixture: Fixture) -> DataFrame:
    return contract.diff(_observed(fixture), _observed_after_change(fixture))


def _nested_changes(fixture: Fixture) -> DataFrame:
    """Typed deals against a delivery that changed inside their associations."""
    deals = fixture.entity("deals")
    later = deals.drop("amount_usd").withColumn(
        "associations",
        F.expr(
            "named_struct('companies', named_struct('results', transform(associations.companies.results, r -> "
            "named_struct('id', cast(r.id as bigint), 'type', if(cast(deal_id as bigint) % 4 = 0, null, r.type), "
            "'labeled', if(cast(deal_id as bigint) % 4 = 0, null, r.type = 'deal_to_company'))), 'paging', cast(null as struct<after:string>)))"
        ),
    )
    return contract.diff(contract.contract_from_rows(deals, "deals"), contract.contract_from_rows(later, "deals"))


def _normalized(fixture: Fixture) -> DataFrame:
    """A property catalog with more properties and fields than the contract tracks."""
    catalog = _observed_after_change(fixture).select(
        "object_type", "name", "type", F.col("field_type").alias("fieldType"), F.upper("name").alias("label")
    )
    rows = [(entity, name) for entity in _CRM for name in tracked_names(entity)]
    return contract.contract_from_catalog(catalog, fixture.spark.createDataFrame(rows, "object_type string, name string"))


def _snapshot(fixture: Fixture) -> DataFrame:
    path = _scratch(fixture.spark, "contract")
    contract.write_snapshot(_observed(fixture), f"{path}/accepted")
    return contract.read_snapshot(fixture.spark, f"{path}/accepted")


def _check_queries() -> dict[str, Query]:
    return {
        "dq_unique": _fixture(lambda f: checks.unique_tests(_tables(f))),
        "dq_not_null": _fixture(lambda f: checks.not_null_tests(_tables(f))),
        "dq_relationships": _fixture(lambda f: checks.relationship_tests(_tables(f))),
        "dq_keys": _fixture(lambda f: checks.key_tests(_tables(f))),
        "dq_health_range": _fixture(
            lambda f: quality.expect_none(
                checks.health_out_of_range(_tables(f)("fct_account_health")), "account_health_score_in_range"
            )
        ),
        "dq_revenue_only_won": _fixture(
            lambda f: quality.expect_none(
                checks.revenue_of_unwon_deals(_tables(f)("fct_revenue"), _tables(f)("fct_deals")),
                "revenue_only_won_deals",
            )
        ),
        "dq_mrr_reconciliation": _fixture(
            lambda f: quality.expect_none(checks.mrr_gaps(_tables(f)("fct_revenue")), "mrr_reconciliation")
        ),
        "dq_invariants": _fixture(lambda f: checks.invariant_tests(_tables(f))),
        "dq_freshness": _fixture(
            lambda f: checks.freshness_tests(f.raw, F.lit(FRESH_AS_OF).cast("timestamp"))
        ),
        "dq_on_write": _fixture(_tested_while_written),
        "contract_schema": _fixture(_nested_changes),
        "contract_observed": _fixture(_observed),
        "contract_diff": _fixture(_changes),
        "contract_status": _fixture(lambda f: contract.status(_changes(f))),
        "contract_report": _fixture(lambda f: contract.report(_observed(f), _changes(f))),
        "contract_normalize": _fixture(_normalized),
        "contract_snapshot": _fixture(_snapshot),
    }


# --- RAW, upserts, export ----------------------------------------------------------------


def _again(deals: DataFrame) -> DataFrame:
    """The deals as a later extract delivers them: renamed, loaded ten days later."""
    return deals.withColumns(
        {
            "deal_name": F.concat("deal_name", F.lit(" (again)")),
            "_loaded_at": F.col("_loaded_at") + F.expr("interval 10 days"),
        }
    )


_DEAL_COLUMNS = ("deal_id", "deal_name", "amount_usd", "_loaded_at")


def _upsert_entity(fixture: Fixture) -> DataFrame:
    """Deals closed by 2000 are in the table; a later extract brings those from mid-1999 on."""
    deals = fixture.entity("deals")
    target = raw_rows("deals", deals.where(F.col("close_date") < F.lit("2000-01-01").cast("timestamp")))
    later = deals.where(F.col("close_date") >= F.lit("1999-07-01").cast("timestamp"))
    merged = upsert(target, raw_rows("deals", _again(later)), ["hs_object_id"])
    return staging.stage("deals", merged).select(*_DEAL_COLUMNS)


def _upsert_incremental(fixture: Fixture) -> DataFrame:
    """The table was loaded up to 1999; a full extract arrives, only later loads are merged."""
    deals = fixture.entity("deals")
    loaded = deals.where(F.col("_loaded_at") < F.lit("2000-01-01").cast("timestamp"))
    target, source = raw_rows("deals", loaded), raw_rows("deals", _again(deals))
    merged = incremental_upsert(target, source, ["hs_object_id"])
    return staging.stage("deals", merged).select(*_DEAL_COLUMNS)


def _upsert_subscriptions(fixture: Fixture) -> DataFrame:
    """Subscriptions re-sent by billing, cancelled from 1999 on, over the stored ones."""
    typed = fixture.entity("subscriptions")
    target = raw_rows("subscriptions", typed)
    later = typed.where(F.col("started_at") >= F.lit("1999-01-01").cast("timestamp"))
    batch = raw_rows("subscriptions", later.withColumn("status", F.lit("churned")))
    merged = upsert(target, batch, ["subscription_id"])
    return staging.stage("subscriptions", merged).select("subscription_id", "amount_usd", "status")


def _history(fixture: Fixture) -> DataFrame:
    """Every single stage report, under the internal contact id 'c<id>'."""
    return fixture.table("events").selectExpr(
        "concat('c', user_id * 20 + event_id % 20) as _contact_id",
        "case event_type when 'view' then 'lead' when 'click' then 'marketingqualifiedlead' "
        "when 'signup' then 'salesqualifiedlead' when 'error' then 'opportunity' "
        "when 'purchase' then 'customer' end as stage",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") as entered_at",
    )


def _id_map(fixture: Fixture) -> DataFrame:
    """Contacts with an email are known to the CRM; the others have no id there."""
    known = fixture.entity("contacts").where(F.col("email").isNotNull())
    return known.select(F.concat(F.lit("c"), "contact_id").alias("_contact_id"), "contact_id")


def _lifecycle_load(fixture: Fixture) -> DataFrame:
    loaded = F.lit(SYNCED_AT).cast("timestamp")
    return staging.stage("lifecycle", landing.raw_lifecycle(_history(fixture), _id_map(fixture), loaded))


def _ingest_pages(fixture: Fixture) -> DataFrame:
    """Company records saved as API pages of 100, read back, wrapped, staged."""
    loaded = F.lit("2024-01-31 06:00:00").cast("timestamp")
    records = api_records("companies", fixture.entity("companies")).select(
        F.col("hs_object_id").alias("id"),
        F.to_json(
            F.struct(F.col("hs_object_id").alias("id"), "properties", F.col("created_at").alias("createdAt")),
            {"ignoreNullFields": "false"},
        ).alias("record"),
    )
    pages = fixed_size_batches(records, "id", "record", 100).select(
        F.concat(F.lit('{"results":['), F.concat_ws(",", "items"), F.lit("]}")).alias("value")
    )
    path = _scratch(fixture.spark, "pages")
    pages.write.text(path)
    landed = landing.read_pages(fixture.spark, path, tracked_names("companies"), page_per_line=True)
    return staging.stage("companies", landing.raw_envelope(landed, loaded))


def _page(records: DataFrame) -> DataFrame:
    """(id, record): API records as JSON text."""
    fields = [F.col("hs_object_id").alias("id"), "properties", F.col("created_at").alias("createdAt")]
    more = [F.col(c).alias(n) for c, n in (("updated_at", "updatedAt"), ("associations", "associations")) if c in records.columns]
    return records.select(
        F.col("hs_object_id").alias("id"), F.to_json(F.struct(*fields, *more), {"ignoreNullFields": "false"}).alias("record")
    )


def _ingest_page_chain(fixture: Fixture) -> DataFrame:
    """Pages with cursors that tell nothing of their order, the last one empty: the chain, and what was loaded."""
    spark, path = fixture.spark, _scratch(fixture.spark, "chain")
    batches = fixed_size_batches(_page(api_records("companies", fixture.entity("companies"))), "id", "record", 100)
    last = batches.agg(F.max("batch_no") + 1).scalar()
    end = batches.agg((F.max("batch_no") + 1).alias("batch_no")).select("batch_no", F.array().cast("array<string>").alias("items"))
    pages = batches.select("batch_no", "items").union(end).withColumn("last", last)
    cursor = lambda number: F.md5(F.concat(F.lit("page "), number.cast("string")))
    after = F.when(F.col("batch_no") > 0, cursor(F.col("batch_no")))
    following = F.when(F.col("batch_no") < F.col("last"), cursor(F.col("batch_no") + 1))
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    line = F.concat(
        F.lit('{"after":'), F.coalesce(quoted(after), F.lit("null")),
        F.lit(',"results":['), F.concat_ws(",", "items"), F.lit("]"),
        F.coalesce(F.concat(F.lit(',"paging":{"next":{"after":'), quoted(following), F.lit("}}")), F.lit("")),
        F.lit("}"),
    )
    pages.select(line.alias("value")).write.text(f"{path}/pages")
    loaded = ingest.ingest_entity(
        spark, "companies", f"{path}/pages", f"{path}/raw", F.lit(SYNCED_AT).cast("timestamp"), page_per_line=True
    )
    chain = whole_chain(landing.read_cursors(spark, f"{path}/pages", page_per_line=True))
    stored = ingest.raw_table(spark, f"{path}/raw", "companies").read().agg(F.count(F.lit(1))).scalar()
    return chain.select("position", "records", F.lit(loaded).cast("bigint").alias("loaded"), stored.alias("stored"))


def _stream_pages(fixture: Fixture) -> DataFrame:
    """Company pages arrive in three deliveries; the stream is stopped before the last one.

    The second delivery repeats the first and renames odd companies; the third is late: older
    versions under other names, and every seventh company for the first time.
    """
    spark, path = fixture.spark, _scratch(fixture.spark, "pages")
    typed = fixture.entity("companies")
    number = F.col("company_id").cast("bigint")
    seventh = number % 7 == 0

    def deliver(name: str, rows: DataFrame, at: str) -> None:
        records = api_records("companies", rows).withColumn("updated_at", F.lit(at).cast("timestamp"))
        pages = fixed_size_batches(_page(records), "id", "record", 100)
        page = F.concat(F.lit('{"results":['), F.concat_ws(",", "items"), F.lit("]}"))
        # A few files each, so that a delivery takes several micro-batches.
        pages.select(page.alias("value")).repartition(3).write.mode("append").text(f"{path}/files/{name}")

    def run() -> None:
        stream_pages(
            spark,
            f"{path}/files/*",
            ingest.raw_table(spark, f"{path}/raw", "companies"),
            f"{path}/checkpoint",
            F.lit("2024-01-31 06:00:00").cast("timestamp"),
            tracked_names("companies"),
            page_per_line=True,
            files_per_batch=2,
        ).awaitTermination()

    first = typed.where(~seventh)
    deliver("1", first, "2024-01-10 00:00:00")
    deliver("2", first, "2024-01-10 00:00:00")
    deliver("2", first.where(number % 2 == 1).withColumn("name", F.concat("name", F.lit(" (new)"))), "2024-01-12 00:00:00")
    run()
    deliver("3", first.withColumn("name", F.concat("name", F.lit(" (old)"))), "2024-01-09 00:00:00")
    deliver("3", typed.where(seventh), "2024-01-09 00:00:00")
    run()
    return staging.stage("companies", ingest.raw_table(spark, f"{path}/raw", "companies").read())


def _table_evolution(fixture: Fixture) -> DataFrame:
    """A catalog table made before associations were carried, extended, and loaded again, then with no rows."""
    spark, path = fixture.spark, _scratch(fixture.spark, "evolution")
    name = "raw_deals_" + path.rsplit("-", 1)[-1]
    deals = raw_rows("deals", fixture.entity("deals"))
    early = F.col("created_at") < F.lit("1995-01-01").cast("timestamp")
    plain = ", ".join(part for part in RAW_ENTITY_SCHEMA.split(", ") if not part.startswith("associations"))
    ensure_table(spark, name, plain, f"{path}/table")
    append_rows(deals.where(early).drop("associations"), name)
    for _ in range(2):  # the second time there is nothing to add
        ensure_table(spark, name, RAW_ENTITY_SCHEMA)
    append_rows(deals.where(~early), name)
    append_rows(deals.limit(0), name)
    table = spark.table(name)
    return staging.stage_owned("deals", "deal_company", table).select(
        "deal_id", "company_id", "amount_usd", "created_at_hubspot", "_loaded_at"
    )


def _ingest_subscriptions(fixture: Fixture) -> DataFrame:
    """Billing documents by month into the stored table; the second load repeats a month."""
    moment = F.lit("2024-01-31 06:00:00").cast("timestamp")
    records = api_records("subscriptions", fixture.entity("subscriptions")).selectExpr(
        "named_struct('subscription_id', subscription_id, 'body', properties) as r", "_loaded_at"
    )
    one = F.struct(F.col("r.subscription_id").alias("subscription_id"), "r.body.*")
    lines = records.select(F.to_json(one, {"ignoreNullFields": "false"}).alias("value"), "_loaded_at")
    path = _scratch(fixture.spark, "billing")
    cut = F.lit("1996-01-01").cast("timestamp")
    lines.where(F.col("_loaded_at") < cut).select("value").write.text(f"{path}/old")
    lines.where(F.col("_loaded_at") >= F.expr("timestamp'1995-12-01'")).select("value").write.text(f"{path}/new")
    table = ingest.raw_table(fixture.spark, f"{path}/raw", "subscriptions")
    for part in ("old", "new", "new"):
        raw = landing.read_subscriptions(fixture.spark, f"{path}/{part}", moment, record_per_line=True)
        table.merge(raw)
    return staging.stage("subscriptions", table.read()).drop("_loaded_at")


def _ingest_lifecycle(fixture: Fixture) -> DataFrame:
    """The stage history, one record per line, loaded twice into the stored table."""
    path = _scratch(fixture.spark, "history")
    _history(fixture).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/files")
    moment = F.lit(SYNCED_AT).cast("timestamp")
    for _ in range(2):
        ingest.ingest_lifecycle(
            fixture.spark, f"{path}/files", _id_map(fixture), f"{path}/raw", moment, record_per_line=True
        )
    return staging.stage("lifecycle", ingest.raw_table(fixture.spark, f"{path}/raw", "lifecycle").read())


def _stream_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive as a stream of three files and are merged into a stored table.

    The second file updates every other order and repeats each of its keys; the third is
    late: older rows, which must not replace newer ones.
    """
    prepare(spark)
    schema = "deal_id string, status string, amount_usd decimal(18,2), updated_at timestamp"
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) as deal_id",
        "o_orderstatus as status",
        "cast(o_totalprice as decimal(18,2)) as amount_usd",
        "cast(o_orderdate as timestamp) as updated_at",
    )
    odd = orders.where("cast(deal_id as bigint) % 2 = 1")
    path = _scratch(spark, "stream")
    update = odd.withColumns({"status": F.lit("U"), "updated_at": F.expr("updated_at + interval 2 days")})
    repeat = odd.withColumns({"status": F.lit("R"), "updated_at": F.expr("updated_at + interval 1 day")})
    late = orders.withColumns({"status": F.lit("L"), "updated_at": F.expr("updated_at - interval 1 day")})
    table = KeyedTable(spark, f"{path}/table", schema, ["deal_id"])
    for number, rows in enumerate((orders, update.unionByName(repeat), late)):
        rows.write.mode("append").parquet(f"{path}/files/{number}")
        stream = spark.readStream.schema(schema).parquet(f"{path}/files/*")
        stream_upsert(stream, table, f"{path}/checkpoint", keep_newer="updated_at").awaitTermination()
    return table.read()


def _raw_queries() -> dict[str, Query]:
    def documents(model: RevenueModel) -> DataFrame:
        rows = export.export_scan(model.fct_account_health)
        return export.payloads(rows, F.lit(SYNCED_AT).cast("timestamp"))

    return {
        "raw_upsert_entity": _fixture(_upsert_entity),
        "raw_upsert_subscriptions": _fixture(_upsert_subscriptions),
        "incremental_upsert": _fixture(_upsert_incremental),
        "stream_upsert": _stream_deals,
        "ingest_pages": _fixture(_ingest_pages),
        "ingest_page_chain": _fixture(_ingest_page_chain),
        "stream_pages": _fixture(_stream_pages),
        "table_evolution": _fixture(_table_evolution),
        "ingest_subscriptions": _fixture(_ingest_subscriptions),
        "ingest_lifecycle": _fixture(_ingest_lifecycle),
        "stage_metadata": _fixture(_stage_metadata),
        "raw_text_blobs": _fixture(_text_blobs),
        "view_sql": _fixture(_view_sql),
        "lifecycle_id_resolution": _fixture(_lifecycle_load),
        "lifecycle_unmapped": _fixture(lambda f: landing.unmapped_events(_history(f), _id_map(f))),
        "won_deal_scan": _fixture(lambda f: landing.won_deals(f.raw("deals"))),
        "export_scan": _model(lambda m: export.export_scan(m.fct_account_health)),
        "reverse_etl_payload": _model(documents),
        "reverse_etl_batches": _model(lambda m: export.payload_batches(documents(m))),
    }


def all_queries() -> dict[str, Query]:
    return {
        **_staging_queries(),
        **_clean_queries(),
        **_across_rows_queries(),
        **_mart_queries(),
        **_metric_queries(),
        **_report_queries(),
        **_sketch_queries(),
        **_check_queries(),
        **_raw_queries(),
    }
