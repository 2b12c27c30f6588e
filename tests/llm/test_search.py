"""Ranked lexical search and nearest neighbours."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from revloom.llm import lexical, nearest
from revloom.llm.queries import ORACLE_SQL, QUERIES

from .samples import SF, awkward, collected, table
from .test_filters import same_rows

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
ITEMS = "item_id bigint, text string"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, best=10):
    """Every document scored for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    total, known = sum(sum(b.values()) for _, b in bags), sum(1 for _, b in bags if b)
    df = Counter(t for _, b in bags for t in b)
    rows = []
    for item, text in set(items):
        found = []
        for doc, bag in bags:
            if not bag:
                continue
            m = 25 + 75 * sum(bag.values()) * known // total
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * known + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        rows += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:best], 1)]
    return sorted(rows, key=repr)


def test_search_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.register(name, spark.read.parquet(f"{SF}/{name}.parquet").toArrow())
    same_rows(QUERIES["op11_ranked_search"](spark, SF), con.sql(ORACLE_SQL["op11_ranked_search"]).to_arrow_table())


def test_search_of_awkward_rows(spark, monkeypatch):
    rnd = random.Random(3)
    rows = awkward() + [(None, "wan el wan", None, None, 0)] * 2 + [(500 + k, "Zel_zio 12,34-5 ÀÉ", None, None, 0) for k in range(15)]
    vocabulary = [w for r in rows for w in terms(r[1])]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 40])))) for k in range(12)]
    items += [(90, " ".join(sorted(set(vocabulary)) + [f"none{k}" for k in range(99)])), (91, None), (92, ""), (93, "?!"), (94, "absent")]
    items += [(95, "zel zel ZIO 12"), (95, "zel zel ZIO 12"), (95, "wan"), (None, "wan el"), (96, "x" * 3000)]
    asked = spark.createDataFrame(items, ITEMS)
    want = ranked([(r[0], r[1]) for r in rows], items)
    for documents, entries, lot, per_file, step in ((8192, 1 << 21, 1 << 22, 1024, 256), (4, 50, 1, 3, 2)):
        monkeypatch.setattr(lexical, "SEGMENT_DOCUMENTS", documents)
        monkeypatch.setattr(lexical, "SEGMENT_ENTRIES", entries)
        monkeypatch.setattr(lexical, "LOT_ENTRIES", lot)
        monkeypatch.setattr(lexical, "ITEMS_PER_FILE", per_file)
        monkeypatch.setattr(lexical, "STEP", step)
        found = lexical.search(table(spark, rows, clashes=True), asked).select("item_id", "rank", "doc_id", "score")
        assert collected(found) == want
    assert lexical.search(table(spark, []), asked).count() == 0
    assert lexical.search(table(spark), asked.where("item_id < 0")).count() == 0


def test_masks_are_taken_until_none_can_win(monkeypatch):
    rnd = np.random.default_rng(1)
    monkeypatch.setattr(lexical, "STEP", 8)
    for width in (5, 90):  # masks of one word and of two
        lists = [np.sort(rnd.choice(300, rnd.integers(1, 200), replace=False)) for _ in range(width)]
        starts = np.cumsum([0, *map(len, lists)])
        added = rnd.integers(1, 5, starts[-1])
        segment = lexical.Segment(np.arange(300), np.arange(width), starts, np.concatenate(lists), added)
        factors = rnd.integers(0, 4, width)
        score = np.zeros(300, np.int64)
        for k, own in enumerate(lists):
            score[own] += factors[k] * added[starts[k] : starts[k + 1]]
        want = [(-s, p) for s, p in sorted((-int(s), p) for p, s in enumerate(score) if s > 0)[:10]]
        assert lexical.best_of(segment, np.arange(width), factors, 10) == want
        floor = want[3][0]
        assert lexical.best_of(segment, np.arange(width), factors, 10, floor) == [w for w in want if w[0] >= floor]


# --- nearest neighbours ------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, radius int, dimension int, ids int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], VECTORS)


def by_force(rows, asked, best=10):
    """All distances, for rows with one vector per id."""
    good = {
        i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    found = {}
    for q in asked:
        if q in good:
            own = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            found[q] = own[:best]
    return found


def answers(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        own = found.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["score"], r["vec_id"]))
    return found


def recall(found, want):
    total = sum(map(len, want.values()))
    return sum(len({i for _, i in found.get(q, [])} & {i for _, i in own}) for q, own in want.items()) / total


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = answers(QUERIES["op12_nearest_neighbours"](spark, sf))
    want = by_force(rows, [i for i, _ in rows if i % 100 == 0])
    assert recall(found, want) >= 0.95
    exact = {i: np.array(v, float) for i, v in rows}
    for q, own in found.items():
        assert own == sorted(own) and all(abs(s - np.linalg.norm(exact[q] - exact[i])) < 1e-12 for s, i in own)


def test_clustered_vectors_and_one_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SEGMENT_VECTORS", 300)
    monkeypatch.setattr(nearest, "LOT_VECTORS", 600)
    monkeypatch.setattr(nearest, "QUERIES_PER_FILE", 7)
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(20, 16)) * 50
    rows = [(i, (centres[i % 20] + rnd.normal(size=16)).astype(np.float32).tolist()) for i in range(1500)]
    hot = rnd.normal(size=16).astype(np.float32).tolist()
    rows += [(1500 + i, hot) for i in range(800)]
    rnd.shuffle(asked := [i for i in range(2300) if i % 20 == 0])
    frame = vectors(spark, rows)
    found = answers(nearest.search(frame, frame.where("vec_id % 20 = 0")))
    want = by_force(rows, asked)
    assert recall({q: found[q] for q in asked if q < 1500}, {q: w for q, w in want.items() if q < 1500}) >= 0.95
    # All at distance 0: the smallest ids of the group.
    assert all(found[q] == want[q] for q in asked if q >= 1500)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [None, 1.0]), (8, [3.0, -1.0]), (9, [1.0, 1.0, 1.0]), (10, [5.0, 5.0, 5.0]), (None, [1.0, 2.0]), (100, None), (200, [0.0, 0.0])]
    rows += [(300, [3e38, -3e38]), (400, [1e-30, 1e-30]), (500, [7.0])]
    frame = vectors(spark, rows + rows[:2] + [(8, [1.0, 2.0])])
    found = answers(nearest.search(frame, frame.where("vec_id % 100 = 0 or vec_id in (2, 9)")))
    nearer = [(i, [1.0, 2.0] if i == 8 else v) for i, v in rows]
    want = by_force(nearer, [0, 9])
    assert found[0] == want[0] and found[9] == want[9]
    assert set(found) == {0, 9, 300, 400}  # alone in its length, 500 has no candidate
    assert len(found[300]) == 4
    assert nearest.search(frame.limit(0), frame).count() == 0
    assert nearest.search(frame, frame.limit(0)).count() == 0
