"""Business rules of the models on hand-made rows."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from acceptance.fixtures import Fixture
from revloom.functions import monthly, over_term
from revloom.plans import checks, clean, export, marts, metrics, reports
from revloom.operators import quality
from revloom.plans.model import MARTS, RevenueModel, Staged, build_marts, stored_marts
from revloom.plans.staging import STAGING

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)


def as_of(text="2024-03-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def only(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- cleaning ----------------------------------------------------------------------------


def test_companies(spark):
    df = spark.createDataFrame(
        [
            ("1", " Acme ", "x", None, None),
            ("2", " HubSpot ", "x", 1, 1),
            ("3", None, "x", 1, 1),
            ("4", "Shell", None, None, None),
            ("5", "Almost", None, None, 0),
            ("6", "\tTab", "x", 1, 1),
        ],
        "company_id string, name string, industry string, employee_count bigint, annual_revenue_usd bigint",
    )
    assert only(clean.int_companies(df), "company_id", "name") == [("1", "Acme"), ("5", "Almost"), ("6", "\tTab")]


def contact_rows(spark, *rows):
    schema = "contact_id string, first_name string, last_name string, email string, created_at_hubspot timestamp"
    return spark.createDataFrame(list(rows), schema).selectExpr(
        "*", "'t' job_title", "'p' phone", "'lead' lifecycle_stage", "created_at_hubspot modified_at_hubspot", "created_at_hubspot _loaded_at"
    )


def test_contacts(spark):
    later = DAY + dt.timedelta(days=1)
    contacts = contact_rows(
        spark,
        ("10", "Ann", "Lee", "ANN@x.com ", later),
        ("9", " Ann", "Lee ", "ann2@x.com", DAY),
        ("8", "Ann", "Lee", None, DAY - dt.timedelta(days=9)),
        ("7", "Tess", "T", " Test@Test.com", DAY),
        ("6", "Bo", "M", "bh@hubspot.com", DAY),
        ("5", None, None, "n1@x.com", None),
        ("4", None, None, "n2@x.com", DAY),
        ("30", "Same", "Time", "s1@x.com", DAY),
        ("200", "Same", "Time", "s2@x.com", DAY),
    )
    links = spark.createDataFrame(
        [
            ("9", "c2", "contact_to_company"),
            ("9", "c1", "contact_to_company"),
            ("9", "c0", "contact_to_company_unlabeled"),
            ("4", "c5", "contact_to_company_unlabeled"),
        ],
        "contact_id string, company_id string, link_type string",
    ).withColumn("_loaded_at", F.lit(DAY))
    got = clean.int_contacts(contacts, links)
    assert only(got, "contact_id", "company_id", "first_name", "last_name", "email") == [
        ("200", None, "Same", "Time", "s2@x.com"),  # ids are text: '200' < '30'
        ("4", None, None, None, "n2@x.com"),  # nameless contacts are one identity, NULL time last
        ("9", "c1", "Ann", "Lee", "ann2@x.com"),
    ]


def test_a_third_of_all_contacts_without_a_name(spark):
    rows = spark.range(3000).selectExpr(
        "cast(id as string) contact_id",
        "if(id % 3 = 0, null, concat('F', id)) first_name",
        "if(id % 3 = 0, null, 'L') last_name",
        "concat(id, '@x.com') email",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) created_at_hubspot",
    )
    df = contact_rows(spark, ("x", "y", "z", None, DAY)).limit(0).unionByName(rows, allowMissingColumns=True)
    links = spark.createDataFrame([], "contact_id string, company_id string, link_type string")
    got = clean.int_contacts(df, links)
    assert got.count() == 2001
    assert got.where("first_name is null").first().contact_id == "0"


def deal_rows(spark, *rows):
    schema = "deal_id string, amount_usd decimal(18,2), stage_id string, close_date timestamp"
    return spark.createDataFrame([(i, a and Decimal(a), s, c) for i, a, s, c in rows], schema).selectExpr(
        "*", "'n' deal_name", "'newbusiness' deal_type", "'default' pipeline_id",
        "close_date - interval 30 days created_at_hubspot", "close_date modified_at_hubspot", "close_date _loaded_at",
    )


DEALS = (
    ("1", "10.00", "closedwon", DAY),
    ("2", "20.00", "closedlost", DAY),
    ("3", "30.00", "contractsent", DAY),
    ("4", "40.00", "contractsent", dt.datetime(2025, 1, 1)),
    ("5", "0.00", "appointmentscheduled", DAY),
    ("6", "-1.00", "closedwon", DAY),
    ("7", None, "closedwon", DAY),
    ("8", "5.00", None, DAY),
    ("9", "7.00", "customstage", DAY),
    ("10", "7.00", "qualifiedtobuy", None),
)


def test_deals_flags_and_staleness(spark):
    deals = marts.deal_flags(clean.int_deals(deal_rows(spark, *DEALS), as_of()))
    assert only(deals, "deal_id", "is_stale", "is_won", "is_lost", "is_closed", "is_open") == [
        ("1", False, True, False, True, False),
        ("10", False, False, False, False, True),
        ("2", False, False, True, True, False),
        ("3", True, False, False, False, True),
        ("4", False, False, False, False, True),
        ("5", True, False, False, False, True),
        ("8", False, None, None, None, None),
        ("9", True, False, False, False, True),
    ]


def test_pipeline_keeps_empty_stages_and_drops_unknown_ones(spark):
    deals = marts.deal_flags(clean.int_deals(deal_rows(spark, *DEALS), as_of()))
    got = marts.fct_pipeline(deals).collect()
    assert [
        (r.stage_id, r.open_deal_count, str(r.total_open_value_usd), r.avg_deal_value_usd, str(r.weighted_value_usd))
        for r in got
    ] == [
        ("appointmentscheduled", 1, "0.00", 0.0, "0.000"),
        ("qualifiedtobuy", 1, "7.00", 7.0, "2.800"),
        ("presentationscheduled", 0, "0.00", 0.0, "0.000"),
        ("decisionmakerboughtin", 0, "0.00", 0.0, "0.000"),
        ("contractsent", 2, "70.00", 35.0, "63.000"),
    ]


def test_deal_without_labeled_link_still_has_a_company(spark):
    links = spark.createDataFrame(
        [("1", "c9", "deal_to_company_unlabeled"), ("2", "c9", "deal_to_company"), ("2", "c1", "deal_to_company_unlabeled")],
        "deal_id string, company_id string, link_type string",
    ).withColumn("_loaded_at", F.lit(DAY))
    assert only(clean.int_deal_company_primary(links), "deal_id", "company_id") == [("1", "c9"), ("2", "c9")]


# --- money -------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("amount", "months", "mrr", "tcv"),
    [
        ("120000.00", 12, "10000.00", "120000.00"),
        ("10310.63", 12, "859.22", "10310.63"),
        ("0.06", 36, "0.01", "0.18"),  # half a cent goes up
        ("0.18", 24, "0.02", "0.36"),
        ("100.00", 18, "8.33", "150.00"),
        ("0.00", 24, "0.00", "0.00"),
    ],
)
def test_monthly_and_term_value(spark, amount, months, mrr, tcv):
    df = spark.createDataFrame([(Decimal(amount), months)], "a decimal(18,2), m int")
    got = df.select(monthly("a").alias("mrr"), over_term("a", "m").alias("tcv")).first()
    assert (str(got.mrr), str(got.tcv)) == (mrr, tcv)


def subscription_rows(spark, *rows):
    schema = "subscription_id string, deal_id string, amount_usd decimal(18,2), status string"
    return spark.createDataFrame([(i, d, Decimal(a), s) for i, d, a, s in rows], schema).selectExpr(
        "*", "'monthly' billing_interval", "24 term_months", "timestamp'2024-01-01' started_at",
        "cast(null as timestamp) churned_at", "timestamp'2024-01-01' _loaded_at",
    )


def test_revenue_is_won_only_and_splits_churn(spark):
    deals = marts.deal_flags(clean.int_deals(deal_rows(spark, *DEALS), as_of())).selectExpr(
        "*", "'c1' company_id", "'Acme' company_name"
    )
    subs = clean.int_subscriptions(
        subscription_rows(
            spark,
            ("s1", "1", "120.00", "active"),
            ("s2", "1", "60.00", "churned"),
            ("s3", "2", "60.00", "active"),
            ("s4", "6", "60.00", "active"),
            ("s5", "1", "12.00", "paused"),
        )
    )
    revenue = marts.fct_revenue(subs, deals)
    assert only(revenue, "subscription_id", "mrr_usd", "tcv_usd", "churned_mrr_usd", "metric_month") == [
        ("s1", Decimal("10.00"), Decimal("240.00"), Decimal("0.00"), dt.date(2024, 1, 1)),
        ("s2", Decimal("5.00"), Decimal("120.00"), Decimal("5.00"), dt.date(2024, 1, 1)),
        ("s5", Decimal("1.00"), Decimal("24.00"), Decimal("0.00"), dt.date(2024, 1, 1)),
    ]
    rollup = marts.revenue_rollup(revenue).first()
    assert (str(rollup.active_arr_usd), rollup.has_churn) == ("132.00", True)
    assert checks.mrr_gaps(revenue).count() == 0
    assert checks.mrr_gaps(revenue.withColumn("churned_mrr_usd", F.col("mrr_usd"))).count() == 2
    assert checks.revenue_of_unwon_deals(revenue, deals).count() == 0
    bent = revenue.withColumn("deal_id", F.when(F.col("subscription_id") == "s1", "2").otherwise("gone"))
    assert only(checks.revenue_of_unwon_deals(bent, deals), "subscription_id", "stage_id") == [
        ("s1", "closedlost"),
        ("s2", None),
        ("s5", None),
    ]


# --- funnel ------------------------------------------------------------------------------


def funnel(spark):
    def at(day, hour=0):
        return dt.datetime(2024, 1, day, hour)

    events = spark.createDataFrame(
        [
            ("a_lead", "a", "lead", at(1, 23)),
            ("a_mql", "a", "marketingqualifiedlead", at(2, 1)),
            ("a_sql", "a", "salesqualifiedlead", at(12)),
            ("b_lead", "b", "lead", at(20)),
            ("b_sql", "b", "salesqualifiedlead", at(10)),  # earlier than the lead: negative days
            ("c_mql", "c", "marketingqualifiedlead", at(5)),
            ("c_odd", "c", "subscriber", at(4)),
            ("gone_lead", "gone", "lead", at(1)),
        ],
        "event_id string, contact_id string, lifecycle_stage string, entered_at timestamp",
    )
    contacts = spark.createDataFrame(
        [("a", "c1", "Acme"), ("b", None, None), ("c", "c1", "Acme")],
        "contact_id string, company_id string, company_name string",
    )
    return marts.fct_funnel(events, contacts)


def test_funnel_lags_by_stage_not_by_time(spark):
    assert only(funnel(spark), "event_id", "stage_order", "previous_stage", "days_to_convert") == [
        ("a_lead", 1, None, None),
        ("a_mql", 2, "lead", 1),  # midnights crossed, not 24-hour spans
        ("a_sql", 3, "marketingqualifiedlead", 10),
        ("b_lead", 1, None, None),
        ("b_sql", 3, "lead", -10),
        ("c_mql", 2, None, None),
        ("c_odd", None, "marketingqualifiedlead", -1),
    ]


def test_funnel_metrics(spark):
    facts = funnel(spark)
    value = lambda name: metrics.compute(name, facts).first()[0]
    assert value("lead_to_mql_rate") == 1.0
    assert value("mql_to_sql_rate") == 1.0
    assert value("sql_to_customer_rate") == 0.0
    assert value("median_days_mql_to_sql") == 0.0
    counts = {r.label: r.contact_count for r in reports.funnel_counts(facts).collect()}
    assert counts == {"Lead": 2, "MQL": 2, "SQL": 2, "subscriber": 1}
    steps = [(r.from_label, r.to_label, r.rate) for r in reports.funnel_steps(facts).collect()]
    assert steps == [("Lead", "MQL", 1.0), ("MQL", "SQL", 1.0), ("SQL", "subscriber", 0.5)]
    within = metrics.cohort_conversion_within(facts, (0, 1)).orderBy("within_days").collect()
    assert [(r.within_days, r.entered, r.reached, r.rate) for r in within] == [(0, 2, 0, 0.0), (1, 2, 1, 0.5)]


def test_rate_without_a_denominator_is_null(spark):
    assert metrics.compute("lead_to_mql_rate", funnel(spark).limit(0)).first()[0] is None
    empty = marts.deal_flags(clean.int_deals(deal_rows(spark, DEALS[2]), as_of()))
    assert metrics.compute("win_rate", empty).first()[0] is None
    assert reports.kpi_win_rate(empty).first().win_rate == 0.0


# --- accounts ------------------------------------------------------------------------------


def test_accounts_zero_fill_and_scores(spark):
    companies = spark.createDataFrame(
        [("c1", "Acme"), ("c2", "Bare"), ("c3", "Lost"), ("c4", "Old")], "company_id string, name string"
    ).selectExpr(
        "*", "'d' domain", "'i' industry", "1L employee_count", "1L annual_revenue_usd", "'x' city", "'y' country",
        "timestamp'2024-01-01' created_at_hubspot",
    )
    recent = dt.datetime(2024, 2, 20)
    owned = {"1": "c1", "2": "c1", "3": "c1", "4": "c3", "5": "c4", "6": None}
    deals = deal_rows(
        spark,
        ("1", "10.00", "closedwon", recent),
        ("2", "20.00", "closedlost", recent),
        ("3", "30.00", "contractsent", recent),
        ("4", "5.00", "closedlost", DAY - dt.timedelta(days=400)),
        ("5", "9.00", "closedwon", DAY - dt.timedelta(days=60)),
        ("6", "9.00", "closedwon", recent),
    )
    company = F.create_map(*[F.lit(x) for pair in owned.items() for x in pair])[F.col("deal_id")]
    deals = marts.deals_with_company(clean.int_deals(deals.withColumn("company_id", company), as_of()))
    links = spark.createDataFrame([("x", "c1"), ("y", "c1"), ("z", None)], "contact_id string, company_id string")
    base = marts.accounts_base(companies, marts.deal_rollup(deals), links)
    counts = ("contact_count", "deal_count_total", "deal_count_won", "deal_count_lost", "deal_count_open")
    assert only(marts.dim_accounts(base), "company_id", *counts) == [
        ("c1", 2, 3, 1, 1, 1),
        ("c2", 0, 0, 0, 0, 0),
        ("c3", 0, 1, 0, 1, 0),
        ("c4", 0, 1, 1, 0, 0),
    ]
    subs = clean.int_subscriptions(
        subscription_rows(spark, ("s1", "1", "10.00", "active"), ("s5", "5", "9.00", "churned"), ("s6", "6", "9.00", "active"))
    )
    named = deals.withColumn("company_name", F.lit("n"))
    revenue = marts.revenue_rollup(marts.fct_revenue(subs, named))
    stages = spark.createDataFrame([("c1", 5), (None, 2), ("c3", None)], "company_id string, max_stage_order int")
    health = marts.fct_account_health(base, revenue, stages, as_of())
    assert only(health, "company_id", "win_rate", "arr_usd", "has_churn", "lifecycle_stage", "account_health_score") == [
        ("c1", 0.5, Decimal("10.00"), False, "customer", 90),  # 40 + 10 + 20 + 20
        ("c2", 0.0, Decimal("0.00"), False, None, 0),
        ("c3", 0.0, Decimal("0.00"), False, None, 0),
        ("c4", 1.0, Decimal("0.00"), True, None, 10),  # 20 + 10 for 151 days - 20
    ]
    buckets = {r.company_id: r.health_bucket for r in metrics.health_buckets(health).collect()}
    assert buckets == {"c1": "healthy", "c2": "at-risk", "c3": "at-risk", "c4": "at-risk"}
    assert checks.health_out_of_range(health).count() == 0
    broken = health.withColumn("account_health_score", F.lit(None).cast("int"))
    assert checks.health_out_of_range(broken).count() == 4


# --- export --------------------------------------------------------------------------------


def health_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, Decimal(a), Decimal(o), s) for i, a, o, s in rows],
        "company_id string, arr_usd decimal(38,2), open_pipeline_usd decimal(38,2), account_health_score int",
    )


def test_payload_has_text_numbers_and_an_integer_time(spark):
    sync = F.lit("2024-04-05 19:34:38").cast("timestamp")
    row = export.payloads(health_rows(spark, ("c-907", "41250.75", "0", 63)), sync).first()
    assert json.loads(row.payload) == {
        "id": "c-907",
        "properties": {
            "arr_usd": "41250.75",
            "open_pipeline_usd": "0.00",
            "account_health_score": "63",
            "last_synced_from_warehouse": 1_712_345_678_000,
        },
    }


def test_bodies_hold_at_most_a_hundred_updates(spark):
    rows = health_rows(spark, *[(f"c{i}", "1000.00", "500.00", 50) for i in range(250)])
    documents = export.payloads(rows, F.lit("2024-01-01").cast("timestamp"))
    bodies = export.payload_batches(documents).orderBy("batch_no").collect()
    assert [r.batch_size for r in bodies] == [100, 100, 50]
    sent = [x["id"] for r in bodies for x in json.loads(r.body)["inputs"]]
    assert sorted(sent) == sorted(f"c{i}" for i in range(250))
    assert export.payload_batches(documents.limit(0)).count() == 0


# --- whole model -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def fixture(spark):
    return Fixture(spark, SF)


@pytest.mark.parametrize("name", ["dim_accounts", "dim_contacts", "fct_deals", "fct_funnel", "fct_account_health"])
def test_links_across_rows_give_the_same_marts(fixture, name):
    in_row = getattr(RevenueModel(fixture.staged(keyed=True), fixture.as_of), name)
    across = getattr(RevenueModel(fixture.staged(keyed=False), fixture.as_of), name)
    assert only(in_row, *in_row.columns) == only(across, *in_row.columns)


def test_raw_path_equals_typed_path(fixture):
    for keyed in (True, False):
        raw = RevenueModel(Staged.from_raw(fixture.raw, keyed=keyed), fixture.as_of).dim_accounts
        typed = fixture.model().dim_accounts
        assert only(raw, *typed.columns) == only(typed, *typed.columns)


def test_stored_marts_equal_lazy_marts(spark, fixture, tmp_path):
    stored = build_marts(spark, fixture.staged(), fixture.as_of, str(tmp_path))
    model = fixture.model()
    for name in MARTS:
        lazy = getattr(model, name)
        assert only(stored[name], *lazy.columns) == only(lazy, *lazy.columns), name


def test_every_metric_is_on_an_existing_mart(fixture):
    assert len(metrics.CATALOG) >= 15
    for metric in metrics.CATALOG.values():
        assert metric.mart in MARTS
        assert set(metric.cuts) <= set(
            (metric.prepare or (lambda df: df))(getattr(fixture.model(), metric.mart)).columns
        )


# --- data tests and refreshes on what is stored -----------------------------------------


class Doubled:
    """The staged tables with every company delivered twice."""

    def __init__(self, staged):
        self.staged = staged

    def __getattr__(self, name):
        table = getattr(self.staged, name)
        return table.union(table) if name == "companies" else table


def test_a_company_delivered_twice_fails_the_data_tests(spark, tmp_path):
    fixture = Fixture(spark, "/root/testdata/sf0.001")

    def failures(staged, path):
        stored = build_marts(spark, staged, fixture.as_of, str(tmp_path / path))
        found = quality.unique(stored["fct_deals"], "fct_deals", "deal_id").union(
            quality.unique(stored["dim_accounts"], "dim_accounts", "company_id")
        )
        both = quality.keys(stored["fct_deals"], "fct_deals", ["deal_id", "amount_usd"], "deal_id")
        return [r.failures for r in found.collect()], {r.test: r.failures for r in both.collect()}

    assert failures(fixture.staged(), "once")[0] == [0, 0]
    counts, both = failures(Doubled(fixture.staged()), "twice")
    assert min(counts) > 0
    assert both["unique:fct_deals.deal_id"] == counts[0] and both["not_null:fct_deals.deal_id"] == 0


def test_a_refresh_becomes_visible_as_a_whole(spark, tmp_path, monkeypatch):
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    path, database = str(tmp_path / "marts"), "refresh_test"
    with pytest.raises(ValueError, match="nothing is published"):
        stored_marts(spark, database)
    build_marts(spark, fixture.staged(), fixture.as_of, path, database=database)
    old = stored_marts(spark, database)
    scores = lambda marts: sorted(map(tuple, marts["fct_account_health"].collect()))
    before = scores(old)
    later = F.lit("2010-01-01 00:00:00").cast("timestamp")

    with monkeypatch.context() as broken:
        broken.setattr("revloom.plans.marts.fct_account_health", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            build_marts(spark, fixture.staged(), later, path, database=database)
    assert scores(stored_marts(spark, database)) == before  # most marts were written, none is seen

    with monkeypatch.context() as slow:  # a reader comes after each single statement of the switch
        seen, sql = [], type(spark).sql

        def look(session, statement, *rest):
            done = sql(session, statement, *rest)
            folders = {f.rsplit("/", 2)[0] for m in stored_marts(spark, database).values() for f in m.inputFiles()}
            seen.append(len(folders))
            return done

        slow.setattr(type(spark), "sql", look)
        build_marts(spark, fixture.staged(), later, path, database=database)
    assert len(seen) > 7 and set(seen) == {1}
    assert scores(old) == before  # a reader that began before the refresh goes on undisturbed
    new = scores(stored_marts(spark, database))
    assert new != before
    assert sorted(map(tuple, spark.table(f"{database}.fct_account_health").collect())) == new


def test_marts_read_raw_deals_and_companies_once(spark, tmp_path):
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    counts = {}

    def raw(entity):
        seen = counts[entity] = spark.sparkContext.accumulator(0)

        def look(key):
            seen.add(1)
            return key

        counted = F.udf(look, "string").asNondeterministic()
        return fixture.raw(entity).withColumn(STAGING[entity].key[0], counted(STAGING[entity].key[0]))

    build_marts(spark, Staged.from_raw(raw), fixture.as_of, str(tmp_path / "marts"))
    for entity in ("companies", "deals"):
        assert counts[entity].value == fixture.raw(entity).count(), entity
    # Once for the columns; the links are counted without the contact's id.
    assert counts["contacts"].value == fixture.raw("contacts").count()
