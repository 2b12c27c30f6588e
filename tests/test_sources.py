"""Landing files and table sinks."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revloom.plans import staging
from revloom.sources import landing, tables
from revloom.sources.tables import (
    RAW_ENTITY_SCHEMA,
    KeyedTable,
    ensure_table,
    raw_blob_schema,
    replace_table,
    write_clustered,
)
from revloom.streaming import stream_upsert
from revloom.vocab import tracked_names

LOADED = dt.datetime(2026, 1, 5, 6)


def loaded_at():
    return F.lit(LOADED.isoformat(sep=" ")).cast("timestamp")


def record(key, name, **extra):
    return {
        "id": key,
        "properties": {"name": name, "annualrevenue": "12.5", "untracked": "x"},
        "createdAt": "2026-01-01T00:00:00Z",
        "updatedAt": "2026-01-02T00:00:00.000Z",
        "archived": False,
        **extra,
    }


def write_pages(folder, *pages):
    folder.mkdir(exist_ok=True)
    for number, records in enumerate(pages):
        page = {"results": records, "paging": {"next": {"after": str(number)}}}
        (folder / f"page-{number}-{len(list(folder.iterdir()))}.json").write_text(json.dumps(page, indent=1))
    return str(folder)


def test_pages_become_records(spark, tmp_path):
    path = write_pages(
        tmp_path / "pages", [record("1", "A"), record("2", "B")], [record("3", "C"), record("4", "D")], [record("5", "E")], []
    )
    raw = landing.raw_envelope(landing.read_pages(spark, path, tracked_names("companies")), loaded_at())
    assert raw.columns == [f.split()[0] for f in RAW_ENTITY_SCHEMA.split(", ")]
    staged = staging.stage("companies", raw).orderBy("company_id").collect()
    assert [r.company_id for r in staged] == ["1", "2", "3", "4", "5"]
    assert [r.name for r in staged] == list("ABCDE")
    assert staged[0].annual_revenue_usd == 13  # 12.5, half up
    keys = raw.select(F.to_json("properties")).first()[0]
    assert "untracked" not in keys


def test_one_page_per_line(spark, tmp_path):
    lines = [json.dumps({"results": [record(str(i), f"N{i}")]}) for i in range(3)]
    (tmp_path / "pages.jsonl").write_text("\n".join(lines))
    landed = landing.read_pages(spark, str(tmp_path / "pages.jsonl"), page_per_line=True)
    assert landed.count() == 3


def test_envelope_defaults(spark, tmp_path):
    bare = {"id": "1"}
    linked = record("2", "B", associations={"companies": {"results": [{"id": "9", "type": "t"}]}}, archived=True)
    empty = record("3", "C", associations={})
    null = record("4", "D", associations=None)
    path = write_pages(tmp_path / "pages", [bare, linked, empty, null])
    raw = landing.raw_envelope(landing.read_pages(spark, path), loaded_at())
    got = {
        r.hs_object_id: r
        for r in raw.select(
            "hs_object_id",
            F.to_json("properties").alias("p"),
            F.to_json("associations").alias("a"),
            "archived",
            "_loaded_at",
        ).collect()
    }
    assert got["1"].p == "{}" and got["1"].a is None and got["1"].archived is False
    assert json.loads(got["2"].a)["companies"]["results"][0]["id"] == "9" and got["2"].archived is True
    assert got["3"].a is None and got["4"].a is None
    assert {r._loaded_at for r in got.values()} == {LOADED}


def test_text_blobs_are_parsed_and_null_stays_null(spark):
    rows = spark.createDataFrame(
        [(1, '{"a":1}', None), (2, "{}", '{"x":[]}')], "hs_object_id int, properties string, associations string"
    )
    raw = landing.raw_from_text(rows, "hs_object_id")
    got = raw.select(
        "hs_object_id", F.variant_get("properties", "$.a", "int"), F.col("associations").isNull()
    ).collect()
    assert [tuple(r) for r in got] == [("1", 1, True), ("2", None, False)]


def test_staging_is_strict_or_lenient(spark):
    rows = spark.createDataFrame([("1", '{"amount":"","dealname":"x"}')], "hs_object_id string, properties string")
    raw = landing.raw_from_text(rows, "hs_object_id").withColumn("_loaded_at", loaded_at())
    with pytest.raises(Exception):
        staging.stage("deals", raw).collect()
    row = staging.stage("deals", raw, lenient=True).first()
    assert row.amount_usd is None and row.deal_name == "x"


SUBSCRIPTIONS = {
    "_meta": {"count": 2},
    "subscriptions": [
        {
            "subscription_id": "sub_1",
            "crm_deal_id": "77",
            "billing_interval": "monthly",
            "amount": 10310.63,
            "term_months": 12,
            "status": "active",
            "started_at": "2026-05-18T00:00:00+00:00",
            "churned_at": None,
        },
        {
            "subscription_id": "sub_2",
            "crm_deal_id": "78",
            "billing_interval": "annual",
            "amount": 5,
            "term_months": 36,
            "status": "churned",
            "started_at": "2026-05-09T00:00:00+00:00",
            "churned_at": "2026-05-19T02:00:00+02:00",
        },
    ],
}


def test_billing_file(spark, tmp_path):
    path = tmp_path / "billing.json"
    path.write_text(json.dumps(SUBSCRIPTIONS, indent=2))
    raw = landing.read_subscriptions(spark, str(path), loaded_at())
    assert "subscription_id" not in raw.select(F.to_json("properties")).first()[0]
    got = staging.stage("subscriptions", raw).orderBy("subscription_id").collect()
    assert [(r.subscription_id, r.deal_id, str(r.amount_usd), r.term_months) for r in got] == [
        ("sub_1", "77", "10310.63", 12),
        ("sub_2", "78", "5.00", 36),
    ]
    assert got[0].churned_at is None and got[1].churned_at == dt.datetime(2026, 5, 19)


def test_lifecycle_ids_are_resolved_and_misses_counted(spark, tmp_path):
    path = tmp_path / "history.json"
    events = [
        {"_contact_id": "a", "stage": "lead", "entered_at": "2026-01-01T00:00:00+00:00"},
        {"_contact_id": "a", "stage": "lead", "entered_at": "2026-01-03T00:00:00+00:00"},
        {"_contact_id": "a", "stage": "customer", "entered_at": "2026-02-01T00:00:00+00:00"},
        {"_contact_id": "b", "stage": "lead", "entered_at": "2026-01-02T00:00:00+00:00"},
        {"_contact_id": "c", "stage": "lead", "entered_at": "2026-01-02T00:00:00+00:00"},
        {"_contact_id": "c", "stage": "customer", "entered_at": "2026-01-02T00:00:00+00:00"},
    ]
    path.write_text(json.dumps({"lifecycle_history": events}))
    history = landing.read_lifecycle_history(spark, str(path))
    ids = spark.createDataFrame([("a", "100"), ("b", "")], "_contact_id string, contact_id string")
    got = staging.stage("lifecycle", landing.raw_lifecycle(history, ids, loaded_at())).orderBy("event_id")
    assert [(r.event_id, r.contact_id, r.entered_at) for r in got.collect()] == [
        ("100_customer", "100", dt.datetime(2026, 2, 1)),
        ("100_lead", "100", dt.datetime(2026, 1, 3)),
    ]
    assert landing.unmapped_events(history, ids).first().skipped == 3


def test_stages_are_flattened_in_display_order(spark, tmp_path):
    page = {
        "results": [
            {
                "id": "default",
                "label": "Sales",
                "stages": [
                    {"id": "won", "label": "Won", "displayOrder": 1, "metadata": {"probability": "1.0", "isClosed": "true"}},
                    {"id": "new", "label": "New", "displayOrder": 0, "metadata": {"probability": "0.2"}},
                    {"id": "bare", "label": "Bare", "displayOrder": 2},
                ],
            }
        ]
    }
    (tmp_path / "stages.json").write_text(json.dumps(page))
    got = [tuple(r)[2:] for r in landing.read_stages(spark, str(tmp_path / "stages.json")).collect()]
    assert got == [
        ("new", "New", 0, "0.2", None),
        ("won", "Won", 1, "1.0", "true"),
        ("bare", "Bare", 2, None, None),
    ]


def test_won_deals_keep_negative_amounts(spark):
    blobs = [
        ("1", '{"dealstage":"closedwon","amount":"5.5"}'),
        ("2", '{"dealstage":"closedwon","amount":null}'),
        ("3", '{"dealstage":"closedlost","amount":"5"}'),
        ("4", '{"dealstage":"closedwon","amount":"-5"}'),
    ]
    raw = landing.raw_from_text(
        spark.createDataFrame(blobs, "hs_object_id string, properties string"), "hs_object_id"
    )
    assert sorted((r.deal_id, str(r.acv_usd)) for r in landing.won_deals(raw).collect()) == [
        ("1", "5.50"),
        ("4", "-5.00"),
    ]


# --- sinks -----------------------------------------------------------------------------


def smoke(spark, *pairs):
    rows = [(key, json.dumps({"name": name}), LOADED) for key, name in pairs]
    df = spark.createDataFrame(rows, "subscription_id string, properties string, _loaded_at timestamp")
    return landing.raw_from_text(df, "subscription_id")


def names(table):
    got = table.read().select("subscription_id", F.variant_get("properties", "$.name", "string"))
    return dict(sorted(tuple(r) for r in got.collect()))


def test_merge_is_idempotent(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), raw_blob_schema("subscription_id"), ["subscription_id"])
    assert table.read().count() == 0
    batch = smoke(spark, ("s1", "A"), ("s2", "B"), ("s3", "C"))
    assert table.merge(batch) == 3
    assert table.merge(batch) == 3
    assert names(table) == {"s1": "A", "s2": "B", "s3": "C"}
    assert table.merge(smoke(spark, ("s1", "A2"))) == 1
    assert names(table) == {"s1": "A2", "s2": "B", "s3": "C"}


def files(path):
    return {str(f) for f in path.rglob("*.parquet")}


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), raw_blob_schema("subscription_id"), ["subscription_id"])
    assert table.merge(smoke(spark, ("s1", "A")).limit(0)) == 0
    assert table.read().count() == 0
    table.merge(smoke(spark, ("s1", "A")))
    before = files(tmp_path / "t")
    assert table.merge(smoke(spark, ("s1", "B")).limit(0)) == 0
    assert files(tmp_path / "t") == before and names(table) == {"s1": "A"}


def test_a_failed_merge_leaves_the_old_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), raw_blob_schema("subscription_id"), ["subscription_id"])
    table.merge(smoke(spark, *((f"s{k}", "A") for k in range(40))))
    before = files(tmp_path / "t")
    with pytest.raises(Exception, match="duplicate key"):
        table.merge(smoke(spark, *((f"s{k}", "B") for k in range(40)), ("s1", "C")))
    assert files(tmp_path / "t") == before and set(names(table).values()) == {"A"}
    table.merge(smoke(spark, ("s1", "D")))
    assert names(table)["s1"] == "D" and len(names(table)) == 40


def test_a_column_added_later_is_null_in_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    KeyedTable(spark, path, "k string, v int", ["k"]).replace(spark.createDataFrame([("a", 1)], "k string, v int"))
    wider = KeyedTable(spark, path, "k string, v int, extra string", ["k"])
    wider.merge(spark.createDataFrame([("b", 2, "x")], "k string, v int, extra string"))
    assert sorted(tuple(r) for r in wider.read().collect()) == [("a", 1, None), ("b", 2, "x")]


def test_merge_new_honours_the_high_water_mark(spark, tmp_path):
    schema = "k string, v int, _loaded_at int"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"])
    assert table.merge_new(spark.createDataFrame([("a", 1, 5)], schema)) == 1
    late = spark.createDataFrame([("a", 9, 5), ("b", 2, 6)], schema)
    assert table.merge_new(late) == 1
    assert table.merge_new(late) == 0
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 1, 5), ("b", 2, 6)]


def test_clustered_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """Cut by compressed size, well compressed rows made one large sort, which spilled."""
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 100)
    df = spark.range(1000).selectExpr("id", "cast(id % 2 as int) as day", "repeat('x', 200) as pad")
    write_clustered(df, str(tmp_path / "c"), ("day", "id"), 1000)
    files = [spark.read.parquet(str(f)) for f in (tmp_path / "c").glob("*.parquet")]
    assert sum(f.count() for f in files) == 1000 and max(f.count() for f in files) < 300
    assert len(files) >= 8
    for file in files:
        rows = [(r.day, r.id) for r in file.collect()]
        assert rows == sorted(rows)
    write_clustered(df.limit(0), str(tmp_path / "none"), ("day", "id"), 0)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "none")).count() == 0


def test_clustered_files_can_be_skipped_by_date(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 100 as int)) as day")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(df, str(tmp_path / "c"), ("day", "id"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    stored = spark.read.parquet(str(tmp_path / "c"))
    spans = (
        stored.groupBy(F.input_file_name()).agg(F.min("day").alias("lo"), F.max("day").alias("hi")).orderBy("lo").collect()
    )
    assert len(spans) > 2
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))
    plan = stored.where("day = date'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day" in plan


def test_one_hot_date_is_split_over_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "date'2024-01-01' as day")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(df, str(tmp_path / "c"), ("day", "id"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 2000


def test_ensure_table_creates_and_migrates(spark):
    spark.sql("DROP TABLE IF EXISTS t_ensure")
    ensure_table(spark, "t_ensure", "hs_object_id string, properties variant")
    ensure_table(spark, "t_ensure", RAW_ENTITY_SCHEMA)
    ensure_table(spark, "t_ensure", RAW_ENTITY_SCHEMA)
    assert spark.table("t_ensure").columns == [f.split()[0] for f in RAW_ENTITY_SCHEMA.split(", ")]
    replace_table(spark.range(3).toDF("n"), "t_ensure")
    assert spark.table("t_ensure").count() == 3
    spark.sql("DROP TABLE t_ensure")


def test_stream_merges_pages_as_they_arrive(spark, tmp_path):
    folder = tmp_path / "pages"
    old = record("1", "old")
    new = record("1", "new") | {"updatedAt": "2026-01-09T00:00:00Z"}
    write_pages(folder, [old, record("2", "B")], [new])
    table = KeyedTable(spark, str(tmp_path / "t"), RAW_ENTITY_SCHEMA, ["hs_object_id"])

    def run():
        stream = landing.raw_envelope(landing.read_pages_stream(spark, str(folder)), loaded_at())
        query = stream_upsert(stream, table, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        got = table.read().select("hs_object_id", F.variant_get("properties", "$.name", "string"))
        return dict(tuple(r) for r in got.collect())

    assert run() == {"1": "new", "2": "B"}
    write_pages(folder, [record("2", "B2"), record("3", "C")])
    assert run() == {"1": "new", "2": "B2", "3": "C"}
    before = files(tmp_path / "t")
    assert run() == {"1": "new", "2": "B2", "3": "C"} and files(tmp_path / "t") == before


# --- nothing is lost --------------------------------------------------------------------


def torn(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


@pytest.mark.parametrize("page_per_line", [False, True])
def test_a_torn_page_fails_the_read(spark, tmp_path, page_per_line):
    good = json.dumps({"results": [record("1", "A"), record("2", "B")]})
    path = torn(tmp_path / "pages", "1.json", good)
    assert landing.read_pages(spark, path, page_per_line=page_per_line).count() == 2
    torn(tmp_path / "pages", "2.json", good[: len(good) // 2])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        landing.read_pages(spark, path, page_per_line=page_per_line).collect()


def test_a_bad_timestamp_fails_the_read(spark, tmp_path):
    bad = record("1", "A") | {"createdAt": "yesterday"}
    path = torn(tmp_path / "pages", "1.json", json.dumps({"results": [bad]}))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        landing.read_pages(spark, path).collect()


def test_torn_documents_fail_the_read(spark, tmp_path):
    billing = json.dumps({"subscriptions": [{"subscription_id": "s1", "x": 1}, {"subscription_id": "s2"}]})
    history = json.dumps({"lifecycle_history": [{"_contact_id": "a", "stage": "lead", "entered_at": "2026-01-01"}]})
    path = torn(tmp_path / "b", "1.json", billing[:-20])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        landing.read_subscriptions(spark, path, loaded_at()).collect()
    path = torn(tmp_path / "h", "1.json", history[:-20])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        landing.read_lifecycle_history(spark, path).collect()


def test_records_one_per_line(spark, tmp_path):
    rows = [{"subscription_id": f"s{k}", "amount": k, "plan": {"n": k}} for k in range(5)]
    path = torn(tmp_path / "b", "1.json", "\n".join(map(json.dumps, rows)) + "\n")
    whole = torn(tmp_path / "d", "1.json", json.dumps({"subscriptions": rows}))

    def read(*args, **options):
        found = landing.read_subscriptions(spark, *args, loaded_at(), **options)
        return sorted(map(tuple, found.select("subscription_id", F.to_json("properties")).collect()))

    assert read(path, record_per_line=True) == read(whole)
    torn(tmp_path / "b", "2.json", '{"subscription_id": "s9"')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read(path, record_per_line=True)


def test_the_latest_stage_entry_is_the_latest_in_time(spark):
    times = ["2026-01-01T00:00:00Z", "2026-01-01T00:00:00.5Z", "2026-01-01T01:00:00+02:00", None]
    history = spark.createDataFrame(
        [("a", "lead", t) for t in times], "_contact_id string, stage string, entered_at string"
    )
    ids = spark.createDataFrame([("a", "1")], "_contact_id string, contact_id string")
    row = landing.raw_lifecycle(history, ids, loaded_at()).select(
        F.variant_get("properties", "$.entered_at", "string").alias("at")
    )
    assert [r["at"] for r in row.collect()] == ["2026-01-01T00:00:00.5Z"]


def test_undeclared_columns_are_refused(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k string, v int", ["k"])
    wide = spark.createDataFrame([("a", 1, "x")], "k string, v int, extra string")
    with pytest.raises(ValueError, match="extra"):
        table.merge(wide)
    with pytest.raises(ValueError, match="extra"):
        table.replace(wide)
    assert table.read().count() == 0


def test_a_merge_opens_and_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k bigint, v bigint", ["k"], buckets=8)
    table.merge(spark.range(400).selectExpr("id as k", "id as v"))
    before = files(tmp_path / "t")
    (bucket,) = table.touched(spark.createDataFrame([(7,)], "k bigint"))
    # No file of another bucket can be read any more.
    for path in before:
        if f"_bucket={bucket}/" not in path:
            open(path, "wb").close()
    table.merge(spark.createDataFrame([(7, -7)], "k bigint, v bigint"))
    after = files(tmp_path / "t")
    assert {p for p in before if f"_bucket={bucket}/" not in p} <= after
    assert not {p for p in before if f"_bucket={bucket}/" in p} & after
    own = table.read_buckets([bucket])
    assert own.where("v = -7").count() == 1 and own.where("k = 7").count() == 1


def test_rows_that_move_leave_their_bucket(spark, tmp_path):
    schema = "k bigint, owner string"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=8, by=["owner"])
    table.replace(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], schema))
    new = spark.createDataFrame([(1, "b")], schema)
    buckets = sorted({*table.touched(new), *table.touched(table.read().where("k = 1"))})
    assert len(buckets) == 2
    kept = table.read_buckets(buckets).join(new.select("k"), "k", "left_anti")
    table.write_buckets(buckets, kept.unionByName(new))
    assert sorted(map(tuple, table.read().collect())) == [(1, "b"), (2, "b"), (3, "b")]


def test_a_newer_stored_row_can_stay(spark, tmp_path):
    schema = "k string, v int, at int"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"])
    table.merge(spark.createDataFrame([("a", 1, 5), ("b", 1, 5)], schema))
    late = spark.createDataFrame([("a", 2, 4), ("b", 2, 6), ("c", 2, 1)], schema)
    table.merge(late, keep_newer="at")
    assert sorted(map(tuple, table.read().collect())) == [("a", 1, 5), ("b", 2, 6), ("c", 2, 1)]
    table.merge(late)
    assert sorted(map(tuple, table.read().collect())) == [("a", 2, 4), ("b", 2, 6), ("c", 2, 1)]


def test_replayed_ties_merge_to_the_same_rows(spark, tmp_path):
    schema = "k string, v string, updated_at int"
    rows = [("a", f"v{n}", 1) for n in range(40)]
    seen = set()
    for number, order in enumerate((rows, rows[::-1], rows[20:] + rows[:20])):
        folder = str(tmp_path / f"in{number}")
        spark.createDataFrame(order, schema).repartition(5).write.parquet(folder)
        table = KeyedTable(spark, str(tmp_path / f"t{number}"), schema, ["k"])
        stream = spark.readStream.schema(schema).parquet(folder)
        stream_upsert(stream, table, str(tmp_path / f"c{number}")).awaitTermination()
        seen.update(map(tuple, table.read().collect()))
    assert len(seen) == 1
