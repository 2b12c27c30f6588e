"""Contract drift: what is removed, changed, added, and how bad that is."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revloom.operators import contract
from revloom.vocab import TRACKED_PROPERTIES

AMOUNT = ("deals", "amount", "number", "number")
NAME = ("deals", "dealname", "string", "text")
EMAIL = ("contacts", "email", "string", "text")


@pytest.fixture()
def table(spark):
    return lambda *rows: spark.createDataFrame(list(rows), contract.CONTRACT_SCHEMA)


def changes(baseline, live):
    return sorted((r.object_type, r.name, r.change) for r in contract.diff(baseline, live).collect())


def test_no_change(table):
    assert changes(table(AMOUNT, NAME), table(NAME, AMOUNT)) == []


def test_removed(table):
    assert changes(table(AMOUNT, NAME), table(AMOUNT)) == [("deals", "dealname", "removed")]


def test_type_change_keeps_both_sides(table):
    found = contract.diff(table(AMOUNT, NAME), table(("deals", "amount", "string", "text"), NAME)).collect()
    assert [tuple(r) for r in found] == [
        ("deals", "amount", "changed", "number", "number", "string", "text")
    ]


def test_field_type_change_alone(table):
    was, now = ("deals", "dealstage", "enumeration", "select"), ("deals", "dealstage", "enumeration", "radio")
    assert changes(table(was), table(now)) == [("deals", "dealstage", "changed")]


def test_added(table):
    assert changes(table(AMOUNT), table(AMOUNT, NAME)) == [("deals", "dealname", "added")]


def test_objects_outside_the_baseline_are_ignored(table):
    assert changes(table(AMOUNT), table(AMOUNT, EMAIL)) == []
    assert changes(table(AMOUNT, EMAIL), table(AMOUNT)) == [("contacts", "email", "removed")]


def test_null_types_compare_as_values(table):
    was, now = ("deals", "x", None, "a"), ("deals", "x", None, "b")
    assert changes(table(was), table(was)) == []
    assert changes(table(was), table(now)) == [("deals", "x", "changed")]


@pytest.mark.parametrize(
    ("live", "status", "code"),
    [
        ((AMOUNT, NAME), "none", 0),
        ((AMOUNT,), "breaking", 1),
        ((AMOUNT, ("deals", "dealname", "string", "textarea")), "breaking", 1),
        ((AMOUNT, NAME, ("deals", "new", "string", "text")), "informational", 2),
        ((AMOUNT, ("deals", "new", "string", "text")), "breaking", 1),
    ],
)
def test_status(table, live, status, code):
    found = contract.status(contract.diff(table(AMOUNT, NAME), table(*live))).first()
    assert (found.status, found.exit_code) == (status, code)


def test_report_has_one_line_per_object(table):
    baseline = table(AMOUNT, NAME, EMAIL)
    live = table(AMOUNT, EMAIL, ("contacts", "phone", "string", "text"))
    found = contract.report(baseline, contract.diff(baseline, live)).orderBy("object_type").collect()
    assert [tuple(r) for r in found] == [
        ("contacts", "WARN", 1, "ADDED phone"),
        ("deals", "FAIL", 2, "REMOVED dealname"),
    ]
    retyped = contract.report(baseline, contract.diff(baseline, table(NAME, ("deals", "amount", "string", "text"), EMAIL)))
    assert retyped.where("status = 'FAIL'").first().details == "CHANGED amount (number/number -> string/text)"
    same = contract.report(baseline, contract.diff(baseline, baseline)).collect()
    assert {r.status for r in same} == {"OK"}


def test_catalog_is_reduced_to_tracked_names_and_fields(spark, table):
    catalog = spark.createDataFrame(
        [("deals", "amount", "number", "number", "Amount"), ("deals", "internal", "string", "text", "x")],
        "object_type string, name string, type string, fieldType string, label string",
    )
    tracked = table(AMOUNT, NAME)
    found = contract.contract_from_catalog(catalog, tracked)
    assert [tuple(r) for r in found.collect()] == [AMOUNT]


def test_tracked_properties_make_a_contract(spark):
    found = contract.contract_from_properties(spark, TRACKED_PROPERTIES)
    assert found.count() == 9 + 8 + 8 + 7 + 5


def test_contract_of_any_schema(spark):
    df = spark.createDataFrame([], "id string not null, amount decimal(18,2)")
    found = {tuple(r) for r in contract.contract_from_schema(df, "t").collect()}
    assert found == {("t", "id", "string", "required"), ("t", "amount", "decimal(18,2)", "nullable")}


NESTED = "id int, who struct<name:string, tags:array<string>>, `odd name` map<string,struct<n:int>>, calls array<struct<at:date, by:array<int>>>"


def test_contract_walks_into_nested_columns(spark):
    df = spark.createDataFrame([], NESTED)
    found = [tuple(r)[1:3] for r in contract.contract_from_schema(df, "t").collect()]
    assert found == [
        ("id", "int"), ("who", "struct"), ("who.name", "string"), ("who.tags", "array"), ("who.tags[]", "string"),
        ("odd name", "map"), ("odd name{key}", "string"), ("odd name{value}", "struct"), ("odd name{value}.n", "int"),
        ("calls", "array"), ("calls[]", "struct"), ("calls[].at", "date"), ("calls[].by", "array"), ("calls[].by[]", "int"),
    ]
    assert {r.field_type for r in contract.contract_from_rows(df, "t").collect()} == {"unseen"}


def test_contract_from_rows_tells_what_is_missing_inside(spark):
    rows = [
        (1, ("a", ["x", None]), {"k": (1,)}, [(None, [1]), (None, [])]),
        (2, None, {}, []),
        (3, ("b", []), None, [(None, [2, None])]),
    ]
    found = {r.name: r.field_type for r in contract.contract_from_rows(spark.createDataFrame(rows, NESTED), "t").collect()}
    assert found == {
        "id": "required", "who": "optional", "who.name": "required", "who.tags": "required", "who.tags[]": "optional",
        "odd name": "optional", "odd name{key}": "required", "odd name{value}": "required", "odd name{value}.n": "required",
        "calls": "required", "calls[]": "required", "calls[].at": "unseen", "calls[].by": "required", "calls[].by[]": "optional",
    }


def test_drift_inside_an_array_is_one_change(spark):
    was = spark.createDataFrame([], "id int, calls array<struct<at:date, by:int>>")
    now = spark.createDataFrame([], "id int, calls array<struct<at:date, by:string>>")
    changes = contract.diff(contract.contract_from_schema(was, "t"), contract.contract_from_schema(now, "t")).collect()
    assert [(r.name, r.change, r.was_type, r.now_type) for r in changes] == [("calls[].by", "changed", "int", "string")]


def test_contract_observed_in_blobs(spark):
    texts = ['{"a":"x","b":1,"c":null}', '{"a":"y","b":"2"}', '{"a":"z","b":2.5,"d":{"e":[1]}}', None]
    raw = spark.createDataFrame([(t,) for t in texts], "properties string").select(
        F.parse_json("properties").alias("properties")
    )
    for tracked in ((), ("a", "b", "absent"), ("a", "b", "c", "d")):
        contract_rows = contract.contract_from_blobs(raw, "o", tracked=tracked).collect()
        assert {(r.name, r.type, r.field_type) for r in contract_rows} == {
            ("a", "string", "required"),
            ("b", "number|string", "required"),
            ("c", "unknown", "optional"),
            ("d", "object", "optional"),
        }


def test_contract_observed_in_odd_blobs(spark):
    texts = [
        '{"a":{"x":[1,{"y, z":2}]},"odd name":1.25,"t`k: DECIMAL(1,2)":true,"n<m>":null,"":[null]}',
        '{"a":[],"odd name":12.5,"":{}}',
        "{}",
        "null",
        None,
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("properties"))
    found = {(r.name, r.type, r.field_type) for r in contract.contract_from_blobs(raw, "o", tracked=("a",)).collect()}
    assert found == {
        ("a", "array|object", "optional"),
        ("odd name", "number", "optional"),
        ("t`k: DECIMAL(1,2)", "boolean", "optional"),
        ("n<m>", "unknown", "optional"),
        ("", "array|object", "optional"),
    }
    assert contract.contract_from_blobs(raw.where("properties is null"), "o").collect() == []


def test_a_contract_takes_one_scan_and_a_report_no_more(spark, tmp_path):
    """Blobs used to be scanned for tracked names, again for the others, and a third time for their number."""
    raw = spark.range(50).select(F.to_variant_object(F.struct("id", F.lit("x").alias("name"))).alias("properties"))
    raw.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    observe = lambda: contract.contract_from_blobs(stored, "o", tracked=("id",))
    for frame in (observe(), contract.report(observe(), contract.diff(observe(), observe()))):
        assert frame.count() > 0
        rows = frame.collect()
        final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1, final
    assert [tuple(r) for r in rows] == [("o", "OK", 2, "")]


def test_snapshot_round_trip_and_missing_baseline(spark, table, tmp_path):
    path = str(tmp_path / "new" / "folder" / "baseline")
    contract.write_snapshot(table(NAME, AMOUNT, EMAIL), path)
    stored = contract.read_snapshot(spark, path)
    assert sorted(tuple(r) for r in stored.collect()) == sorted([NAME, AMOUNT, EMAIL])
    with pytest.raises(FileNotFoundError, match="snapshot"):
        contract.read_snapshot(spark, str(tmp_path / "absent"))
