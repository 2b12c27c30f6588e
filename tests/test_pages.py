"""Whole chains of pages, and pages as a stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from revloom.operators.chain import BrokenChain, chain_faults, positions, whole_chain
from revloom.sources import ingest, landing
from revloom.sources.tables import RAW_ENTITY_SCHEMA, KeyedTable, append_rows, ensure_table
from revloom.streaming import stream_pages


def moment():
    return F.lit("2026-01-05 06:00:00").cast("timestamp")
LINKS = "run string, at string, to string"


def page(folder, name, after, following, *keys, run=None, at="2026-01-02T00:00:00Z", label="n"):
    folder.mkdir(exist_ok=True, parents=True)
    found = {"results": [{"id": k, "properties": {"name": f"{label}{k}"}, "updatedAt": at} for k in keys]}
    found |= {"after": after} if after else {}
    found |= {"run": run} if run else {}
    found |= {"paging": {"next": {"after": following}}} if following else {}
    (folder / f"{name}.json").write_text(json.dumps(found))


def whole(folder):
    page(folder, "a", None, "x9", "1", "2")
    page(folder, "b", "x9", "x2", "3")
    page(folder, "c", "x2", "x5")
    page(folder, "d", "x5", None, "4", "5")
    return folder


def faults(spark, folder):
    found = chain_faults(landing.read_cursors(spark, str(folder))).collect()
    return sorted(((f["cursor"], f["fault"]) for f in found), key=repr)


def test_positions_of_a_whole_chain(spark, tmp_path):
    links = landing.read_cursors(spark, str(whole(tmp_path / "p")))
    found = whole_chain(links).orderBy("position").collect()
    assert [(r["position"], r["at"], r["to"], r["records"]) for r in found] == [
        (0, None, "x9", 2), (1, "x9", "x2", 1), (2, "x2", "x5", 0), (3, "x5", None, 2)
    ]


@pytest.mark.parametrize("pages", [1, 2, 3, 17, 64, 65])
def test_long_chains_and_several_runs(spark, pages):
    rows = [(run, str(k * 7 % 101) if k else None, str((k + 1) * 7 % 101) if k + 1 < n else None)
            for run, n in (("a", pages), ("b", 5)) for k in range(n)]
    found = whole_chain(spark.createDataFrame(rows[::-1], LINKS)).collect()
    assert sorted((r["run"], r["position"], r["at"], r["to"]) for r in found) == sorted(
        (run, k, at, to) for (run, at, to), k in zip(rows, [*range(pages), *range(5)], strict=True)
    )


@pytest.mark.parametrize("lost, want", [("a", "no first page"), ("b", "page missing"), ("d", "no last page")])
def test_a_missing_page_fails_the_load(spark, tmp_path, lost, want):
    folder = whole(tmp_path / "p")
    (folder / f"{lost}.json").unlink()
    assert want in [f for _, f in faults(spark, folder)]
    with pytest.raises(BrokenChain, match=want):
        ingest.ingest_entity(spark, "companies", str(folder), str(tmp_path / "raw"), moment())
    assert not (tmp_path / "raw").exists()
    assert ingest.ingest_entity(spark, "companies", str(folder), str(tmp_path / "raw"), moment(), whole=False) < 5


def test_a_repeated_page_fails_the_load(spark, tmp_path):
    folder = whole(tmp_path / "p")
    page(folder, "again", "x9", "x2", "3")
    assert faults(spark, folder) == [("x2", "page linked twice"), ("x9", "page repeated")]
    with pytest.raises(BrokenChain, match="page repeated"):
        ingest.ingest_entity(spark, "companies", str(folder), str(tmp_path / "raw"), moment())


def test_looping_pages_fail_the_load(spark, tmp_path):
    folder = whole(tmp_path / "p")
    page(folder, "d", "x5", "x2", "4", "5")  # back to an earlier page
    assert ("x2", "page linked twice") in faults(spark, folder)
    folder = whole(tmp_path / "q")
    for k in range(3):  # a ring beside a whole chain: no cursor tells it
        page(folder, f"ring{k}", f"r{k}", f"r{(k + 1) % 3}", f"r{k}")
    assert faults(spark, folder) == []
    with pytest.raises(BrokenChain, match="loop"):
        positions(landing.read_cursors(spark, str(folder)))
    folder = tmp_path / "r"
    for k in range(3):  # nothing but a ring
        page(folder, f"ring{k}", f"r{k}", f"r{(k + 1) % 3}", f"r{k}")
    assert [f for _, f in chain_faults(landing.read_cursors(spark, str(folder))).select("cursor", "fault").collect()] == ["no first page"]


def test_an_empty_page_loads_nothing(spark, tmp_path):
    page(tmp_path / "p", "a", None, None)
    assert ingest.ingest_entity(spark, "companies", str(tmp_path / "p"), str(tmp_path / "raw"), moment()) == 0
    assert ingest.raw_table(spark, str(tmp_path / "raw"), "companies").read().count() == 0


def test_pages_stream_through_a_restart(spark, tmp_path):
    folder, opened = tmp_path / "p", []
    table = KeyedTable(spark, str(tmp_path / "t"), RAW_ENTITY_SCHEMA, ["hs_object_id"], buckets=2)

    def run():
        query = stream_pages(spark, str(folder), table, str(tmp_path / "c"), moment(), files_per_batch=1)
        query.awaitTermination()
        opened.append([p["numInputRows"] for p in query.recentProgress])
        got = table.read().select("hs_object_id", F.variant_get("properties", "$.name", "string"))
        return dict(sorted(map(tuple, got.collect())))

    page(folder, "1", None, None, "1", "2")
    page(folder, "2", None, None, "2", "3")  # repeats 2 in a later micro-batch
    assert run() == {"1": "n1", "2": "n2", "3": "n3"}
    assert len([n for n in opened[0] if n]) == 2
    files = {str(f) for f in (tmp_path / "t").rglob("*.parquet")}
    page(folder, "3", None, None, "1", "2", "3")  # known before the restart: the state drops them
    assert run() == {"1": "n1", "2": "n2", "3": "n3"}
    assert {str(f) for f in (tmp_path / "t").rglob("*.parquet")} == files
    page(folder, "4", None, None, "1", "4", at="2025-12-01T00:00:00Z", label="late")
    page(folder, "5", None, None, "3", at="2026-02-01T00:00:00Z", label="new")
    assert run() == {"1": "n1", "2": "n2", "3": "new3", "4": "late4"}


def test_a_catalog_table_grows_a_column(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_grows")
    ensure_table(spark, "t_grows", "k string, v int", str(tmp_path / "t"))
    append_rows(spark.createDataFrame([(1, "a")], "v int, k string"), "t_grows")
    ensure_table(spark, "t_grows", "k string, extra string, v int")
    append_rows(spark.createDataFrame([("x", "b")], "extra string, k string"), "t_grows")
    append_rows(spark.createDataFrame([], "k string"), "t_grows")
    assert sorted(map(tuple, spark.table("t_grows").select("k", "v", "extra").collect())) == [("a", 1, None), ("b", None, "x")]
    with pytest.raises(ValueError, match="other"):
        append_rows(spark.createDataFrame([("x",)], "other string"), "t_grows")
    spark.sql("DROP TABLE t_grows")
