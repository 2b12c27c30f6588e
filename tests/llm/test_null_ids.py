"""Rows with a null doc_id, alone and in groups."""

from __future__ import annotations

import random

from revloom.llm import jaccard, line_dedup, pii, quality

from .samples import table

rnd = random.Random(11)
prose = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))


def rows(*pairs):
    return [(i, text, None, None, 0) for i, text in pairs]


def test_first_of_each_class_keeps_one_of_each(spark):
    alone, mixed, unnamed, blank = prose(60), prose(60), prose(60), "  "
    docs = table(spark, rows((None, alone), (None, mixed), (4, mixed), (7, mixed), (None, unnamed), (None, unnamed), (None, blank)))
    kept = [(r["doc_id"], r["text"]) for r in jaccard.first_of_each_class(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(None, alone), (4, mixed), (None, unnamed), (None, blank)], key=repr)


def test_repeated_lines_go(spark):
    run = "\n".join(prose(15) for _ in range(4))
    docs = table(spark, rows((None, f"{run}\nmiddle\n{run}"), (1, f"before\n{run}")))
    found = {r["doc_id"]: r["kept_text"] for r in line_dedup.remove_repeats(docs).collect()}
    assert found == {None: f"{run}\nmiddle", 1: "before"}


def test_frequent_lines_count(spark):
    line = prose(50)
    docs = table(spark, rows(*((None, f"{line}\n{prose(10)}") for _ in range(12))))
    found = [(r["frequent_words"], r["kept"]) for r in quality.judge(docs).collect()]
    assert found == [(50, False)] * 12


def test_found_spans_stay(spark):
    pairs = [(i, f"please mail me at user{i}@x{i}.example.org thanks") for i in range(60)]
    found = pii.find(table(spark, rows(*pairs, (None, "do mail me at user0[x]hidden7 thanks"))))
    assert [[tuple(s) for s in r["spans"]] for r in found.where("doc_id is null").collect()] == [[(0, 14, 29)]]
