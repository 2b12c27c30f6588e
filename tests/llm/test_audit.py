"""Filter interaction audit."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np

from revloom.llm import audit
from revloom.llm.queries import ORACLE_SQL, QUERIES
from revloom.llm.shared import keep, prepare

from .samples import SF, awkward, table
from .test_filters import same_rows

LABELS = "doc_id bigint, quality int, toxic int"


def by_sql(docs, labels):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    con.register("labels", labels.toArrow())
    return con.sql(ORACLE_SQL["op13_filter_audit"]).to_arrow_table()


def test_audit_query_equals_sql(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    same_rows(QUERIES["op13_filter_audit"](spark, SF), by_sql(docs, labels))


def awkward_labels():
    return [(0, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (3, 0, 1), (None, 1, 1), (999, 1, 1), (4, 2, 3)]


def test_audit_of_awkward_rows_equals_sql(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 2000)
    rows = awkward() + [(None, t, "en", "a", 0) for t in ("same", "same", "A" * 9, None)] + [(70, "same", None, None, 0)] * 2
    rows += [(60 + k, " ".join(["word"] * 250 + [f"w{j}" for j in range(k * 60)]) + "#" * (k % 2), "en", "b", 0) for k in range(6)]
    docs, labels = table(spark, rows, clashes=True), spark.createDataFrame(awkward_labels(), LABELS)
    same_rows(audit.audit(docs, labels), by_sql(docs, labels))
    assert audit.audit(table(spark, []), labels).count() == 0
    unlabelled = audit.audit(docs, labels.where("doc_id = 999"))
    assert {(r["good_lost"], r["toxic_lost"]) for r in unlabelled.collect()} == {(0, 0)}


def test_audit_by_applying_the_filters(spark):
    """Each order applied document by document."""
    rnd = random.Random(5)
    rows = []
    for i in range(80):
        words = [rnd.choice(["ab", "Cd", "ef"]) if rnd.random() < 0.5 else f"x{rnd.randrange(10**6)}" for _ in range(rnd.choice([30, 260]))]
        rows.append((i, " ".join(words) + rnd.choice(["", " #", " ABCDEFGHIJ" * 4]), "en", rnd.choice("pq"), 0))
    rows += [(100 + i, rows[i][1], "en", rnd.choice("pq"), 0) for i in range(0, 80, 3)]
    labels = [(r[0], rnd.randrange(2), rnd.randrange(2)) for r in rows if rnd.random() < 0.7]
    told = {i: (q, x) for i, q, x in labels}
    seen: dict[str, int] = {}
    for r in rows:
        seen[r[1]] = min(seen.get(r[1], r[0]), r[0])

    def fails(i, text):
        words = re.findall("[^\x20\x09-\x0d]+", text)
        tests = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)),
            seen[text] < i,
        ]
        return {name for name, failed in zip("ABCDE", tests, strict=True) if failed}

    want = {}
    for part in "pq":
        own = [(r[0], fails(r[0], r[1])) for r in rows if r[3] == part]
        first = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                late = sum(name in f for _, f in own) - len(gone)
                left = [(i, f) for i, f in left if name not in f]
                first[name] += len(gone)
                good, toxic = (sum(told.get(i, (0, 0))[k] for i, _ in gone) for k in (0, 1))
                want[part, "".join(order), step] = [len(left), len(gone), late, sum(f == {name} for _, f in own), good, toxic]
        for (p, order, step), values in want.items():
            if p == part:
                values.append(first[order[step - 1]])
    found = audit.audit(table(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in found} == want


def test_matrix_rebuilds_the_bags_of_words(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 3000)
    prepare(spark)
    docs = table(spark)
    matrix = keep(audit.term_matrix(docs), "test-matrix")
    words = {r["id"]: r["word"] for r in audit.dictionary(docs, matrix).collect()}
    assert sorted(words) == list(range(len(words))) and len(set(words.values())) == len(words)
    found = []
    for r in matrix.collect():
        starts, local, counts = (np.frombuffer(r[n], t) for n, t in (("starts", "<i8"), ("columns", "<i4"), ("counts", "<i4")))
        columns = np.frombuffer(r["ids"] or b"", "<i8")
        for k, doc in enumerate(r["docs"]):
            cut = slice(starts[k], starts[k + 1])
            bag = {words[int(columns[c])]: int(n) for c, n in zip(local[cut], counts[cut], strict=True)}
            found.append((doc["doc_id"], bag))
    want = [(r["doc_id"], dict(Counter(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")))) for r in docs.collect()]
    order = lambda pair: (pair[0], sorted(pair[1].items()))
    assert sorted(found, key=order) == sorted(want, key=order)
    assert matrix.count() > 4
