"""The five stages, each against what it read."""

from __future__ import annotations

import corpus_pipeline
from revloom.llm.shared import keep, prepare

from .samples import SF, awkward, collected, table
from .test_dedup import linked, repeated_lines
from .test_tokens import check_pieces, plain


def test_every_stage_on_its_own_input(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        found = keep(stage(spark, docs, SF), "test-stage")
        steps[name] = (docs, found)
        docs = found
        if name != "packing":
            assert found.columns == columns and found.dtypes == steps["language"][0].dtypes

    before, after = steps["language"]
    kept = {r["doc_id"] for r in after.collect()}
    gone = [r for r in before.collect() if r["doc_id"] not in kept]
    assert len(gone) <= 0.03 * before.count()

    before, after = steps["lines"]
    want = [r for r in repeated_lines([(r["doc_id"], r["text"]) for r in before.collect()]) if r[1].strip()]
    assert collected(after.select("doc_id", "text")) == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = steps["near_duplicates"]
    classes = {c for _, n, c in linked([(r["doc_id"], r["text"]) for r in before.collect()]) if n}
    assert {r["doc_id"] for r in after.collect()} == classes

    before, after = steps["decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in before.collect() if any(item in r["text"] for item in items)}
    kept = {r["doc_id"] for r in after.collect()}
    assert leaked and not leaked & kept and before.count() - after.count() <= 2 * len(leaked)

    before, after = steps["packing"]
    check_pieces(after.collect(), [(r["doc_id"], plain(r["text"], 2)) for r in before.collect()])


def test_stages_take_awkward_rows(spark):
    prepare(spark)
    for rows in (awkward(), []):
        docs = table(spark, rows, clashes=True)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = keep(stage(spark, docs, SF), "test-stage")
            assert name == "packing" or docs.columns == columns
        assert (docs.count() > 0) == bool(rows)


def test_run_returns_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns) and found.count() > 100
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language",
        "lines",
        "near_duplicates",
        "decontamination",
        "packing",
    ]
