"""Files in, RAW tables, marts, SQL and payloads out."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from acceptance.fixtures import Fixture
from revloom.plans.model import MARTS, RevenueModel, Staged, build_marts
from revloom.plans.staging import STAGING
from revloom.plans.views import register_views
from revloom.sources import ingest

NOW = "2026-06-01 06:00:00"


def moment(text):
    return F.lit(text).cast("timestamp")


def link(kind, *ends):
    return {kind: {"results": [{"id": i, "type": t} for i, t in ends]}}


def rec(key, properties, associations=None):
    out = {"id": key, "properties": properties, "createdAt": "2026-01-01T00:00:00Z", "updatedAt": "2026-01-02T00:00:00Z"}
    return out | ({"associations": associations} if associations else {})


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    created = {"createdate": "2026-03-01T00:00:00Z", "hs_lastmodifieddate": "2026-03-02T00:00:00Z"}

    def deal(key, amount, stage, *companies):
        properties = {"dealname": f"Deal {key}", "amount": amount, "dealstage": stage, "dealtype": "newbusiness",
                      "pipeline": "default", "closedate": "2026-05-01T00:00:00Z", **created}
        return rec(key, properties, link("companies", *companies))

    pages = {
        "companies": [
            rec("c1", {"name": " Acme ", "industry": "X", "numberofemployees": "10", "annualrevenue": "1000", "secret": "s", **created}),
            rec("c2", {"name": "HubSpot", "industry": "X", **created}),
        ],
        "contacts": [
            rec("p1", {"firstname": "Ann", "lastname": "Lee", "email": "A@x.com", "lifecyclestage": "customer", **created},
                link("companies", ("c1", "contact_to_company"), ("c1", "contact_to_company_unlabeled"))
                | link("deals", ("d1", "x"))),
            rec("p2", {"firstname": "Bo", "lastname": "Z", "email": None, **created}),
        ],
        "deals": [
            deal("d1", "1200.00", "closedwon", ("c1", "deal_to_company")),
            deal("d2", "500", "contractsent", ("c1", "deal_to_company_unlabeled")),
            deal("d3", "300", "closedlost", ("c2", "deal_to_company")),
        ],
        "line_items": [rec("l1", {"name": "Seat", "quantity": "2", "price": "600", "amount": "1200", "hs_product_id": "9", **created},
                           link("deals", ("d1", "line_item_to_deal")))],
        "products": [rec("9", {"name": "Seat", "price": "600", "hs_sku": "S-1", **created})],
    }
    for entity, records in pages.items():
        (root / entity).mkdir()
        for number, record in enumerate(records):  # one record per page, so paging matters
            page = {"results": [record]} | ({"after": f"c{number}"} if number else {})
            if number + 1 < len(records):
                page["paging"] = {"next": {"after": f"c{number + 1}"}}
            (root / entity / f"{number}.json").write_text(json.dumps(page))
    (root / "billing.json").write_text(json.dumps({"_meta": {}, "subscriptions": [
        {"subscription_id": "s1", "crm_deal_id": "d1", "billing_interval": "monthly", "amount": 1200.0, "term_months": 24,
         "status": "active", "started_at": "2026-05-01T00:00:00+00:00", "churned_at": None}]}))
    (root / "history.json").write_text(json.dumps({"lifecycle_history": [
        {"_contact_id": "i1", "stage": "lead", "entered_at": "2026-03-01T00:00:00+00:00"},
        {"_contact_id": "i1", "stage": "marketingqualifiedlead", "entered_at": "2026-03-11T00:00:00+00:00"},
        {"_contact_id": "i9", "stage": "lead", "entered_at": "2026-03-01T00:00:00+00:00"}]}))
    return root


def test_files_to_marts_and_sql(spark, landed, tmp_path):
    raw_root = str(tmp_path / "raw")
    ids = spark.createDataFrame([("i1", "p1")], "_contact_id string, contact_id string")
    for _ in range(2):  # a second load changes nothing
        counts = ingest.ingest_entities(spark, str(landed), raw_root, moment(NOW))
        assert counts == {"companies": 2, "contacts": 2, "deals": 3, "line_items": 1, "products": 1}
        assert ingest.ingest_subscriptions(spark, str(landed / "billing.json"), raw_root, moment(NOW)) == 1
        assert ingest.ingest_lifecycle(spark, str(landed / "history.json"), ids, raw_root, moment(NOW)) == (2, 1)

    tables = {entity: ingest.raw_table(spark, raw_root, entity).read() for entity in STAGING}
    assert tables["deals"].count() == 3
    blobs = tables["contacts"].where("hs_object_id = 'p1'").select(F.to_json("associations")).first()[0]
    assert set(json.loads(blobs)) == {"companies"}  # only the associations of the entity
    assert "secret" not in str(tables["companies"].select(F.to_json("properties")).collect())

    staged = Staged.from_raw(tables.__getitem__)
    stored = build_marts(spark, staged, moment(NOW), str(tmp_path / "marts"))
    health = stored["fct_account_health"].collect()
    assert [(r.company_id, r.company_name, r.lifecycle_stage, str(r.arr_usd), str(r.open_pipeline_usd), r.account_health_score)
            for r in health] == [("c1", "Acme", "marketingqualifiedlead", "1200.00", "500.00", 90)]  # activity 92 days old

    views = register_views(RevenueModel(staged, moment(NOW)), stored.__getitem__)
    assert len(views) == 27
    assert spark.sql("select sum(mrr_usd) from fct_revenue").first()[0] == 100
    assert spark.sql("select count(*) from int_hubspot__line_item_deal_primary").first()[0] == 1
    rows = spark.sql("""
        select a.name, count(distinct f.contact_id) as contacts, max(f.days_to_convert) as days
        from dim_accounts a join fct_funnel f on a.company_id = f.company_id group by a.name""").collect()
    assert [tuple(r) for r in rows] == [("Acme", 1, 10)]
    assert [tuple(r) for r in spark.sql(
        "select deal_id, company_name from fct_deals where company_id = 'c2'").collect()] == [("d3", None)]


def test_lazy_views_match_the_model(spark):
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    for keyed in (True, False):
        model = RevenueModel(fixture.staged(keyed), fixture.as_of)
        register_views(model)
        assert "company_id" not in spark.table("stg_hubspot__deals").columns
        pairs = spark.table("stg_hubspot__contact_company_links")
        assert pairs.count() == pairs.select("contact_id", "company_id").distinct().count()
        assert spark.table("fct_pipeline").count() == 5
    assert set(MARTS) <= {t.name for t in spark.catalog.listTables()}
