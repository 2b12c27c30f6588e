"""Language identification and language-model scoring."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from revloom.llm import langid, lm, ppm
from revloom.llm.blocks import blocks
from revloom.llm.queries import QUERIES

from .samples import SF, awkward, table


def lower(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


class Slow:
    """The same model by dictionaries, one symbol at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, {}
        for text in texts:
            data = self.symbols(text)
            for at in range(order, len(data)):
                for k in range(order + 1):
                    self.seen.setdefault(tuple(data[at - k : at]), Counter())[data[at]] += 1

    fold = staticmethod(lower)

    def symbols(self, text):
        return [0] * self.order + [max(b, 1) for b in self.fold(text).encode()] + [0]

    def log10(self, text):
        data, total = self.symbols(text), 0.0
        for at in range(self.order, len(data)):
            out = set()
            for k in range(self.order, -1, -1):
                counts = {s: n for s, n in self.seen.get(tuple(data[at - k : at]), {}).items() if s not in out}
                if not counts:
                    continue
                whole = sum(counts.values())
                if data[at] in counts:
                    total += math.log10((counts[data[at]] - 0.5) / whole)
                    break
                total += math.log10(len(counts) / (2 * whole))
                out |= set(counts)
            else:
                total -= math.log10(256 - len(out))
        return total


class SlowAsWritten(Slow):
    """Languages tell capitals apart."""

    fold = staticmethod(lambda text: text or "")


def test_tree_gives_a_distribution_after_any_context():
    batch = pa.record_batch({"text": ["abracadabra", "", "hello abra", "abracadabra" * 3]})
    tree = ppm.Tree(*ppm.counted(ppm.grams(next(blocks(batch)), 3)[0]), 3)
    for context in (b"abr", b"xyz", b"\0\0\0", b"rac", b"zab", b"zza"):
        codes = np.array([int.from_bytes(context, "big") << 8 | symbol for symbol in range(256)])
        assert abs((10 ** tree.score(codes)).sum() - 1) < 1e-9


@pytest.mark.parametrize("order", [0, 2, 5])
def test_scores_equal_the_slow_model(spark, order):
    rows = awkward()
    trained = [r for r in rows if r[0] % 3]
    model = lm.train(table(spark, trained), order)
    slow = Slow([r[1] for r in trained], order)
    want = sorted((i, round(slow.log10(t), 6)) for i, t, *_ in rows)
    found = lm.score(table(spark, clashes=True), model).collect()
    assert sorted((r["doc_id"], round(r["score"], 6)) for r in found) == want


def test_lm_query_base_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    words = lambda t: [*re.findall("[^\x20\x09-\x0d]+", lower(t)), None]
    counts = Counter()
    for d in docs:
        if zlib.crc32(str(d["doc_id"]).encode()) % 10:
            counts.update(words(d["text"]))
    total, distinct = sum(counts.values()), len(counts)
    found = {r["doc_id"]: r for r in QUERIES["op5_lm_scoring"](spark, SF).collect()}
    assert len(found) == len(docs)
    for d in docs:
        own, row = words(d["text"]), found[d["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert abs(row["base_score"] - base) <= 1e-9 * abs(base)
        assert row["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 10 == 0)


def test_a_model_of_nothing_is_even(spark):
    model = lm.train(table(spark, []))
    rows = {r["doc_id"]: r for r in lm.score(table(spark, [(1, "abc", None, None, 0), (2, None, None, None, 0)]), model).collect()}
    assert abs(rows[1]["score"] + 4 * math.log10(256)) < 1e-9 and rows[1]["n_known"] == 0
    assert abs(rows[2]["score"] + math.log10(256)) < 1e-9 and rows[2]["n_tokens"] == 1
    assert lm.score(table(spark, []), model).count() == 0


def test_held_out_languages(spark):
    lang = {d["doc_id"]: d["lang"] for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op4_language_id"](spark, SF).collect()
    assert len(found) == len(lang)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_awkward_rows(spark):
    docs = table(spark, clashes=True)
    found = langid.identify(docs, langid.train(docs)).collect()
    assert len(found) == len(awkward())
    no_letter = {i for i, t, *_ in awkward() if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in found if r["lang_pred"] == "und"} == no_letter
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")


def test_no_language_to_learn(spark):
    docs = table(spark, [(1, "some words", None, "a", 0), (2, None, "en", "a", 0)])
    assert langid.train(docs) == {}
    assert [r["lang_pred"] for r in langid.identify(docs, {}).collect()] == ["und", "und"]
    assert langid.train(table(spark, [])) == {}


def test_the_sample_is_bounded(spark):
    rows = [(i, f"wan el io um {i} " * 50, "en" if i % 2 else "fr", "a", 0) for i in range(400)]
    trees = langid.train(table(spark, rows), sample_bytes=40_000)
    size = sum(counts.sum() for tree in trees.values() for _, counts in tree.grams[-1:])
    assert sorted(trees) == ["en", "fr"] and 10_000 < size < 80_000


@pytest.mark.parametrize("order", [0, 2, 4])
def test_languages_equal_the_slow_model(spark, order):
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 3000]
    trees = langid.train(table(spark, [r for r in rows if r[0] % 3]), order)
    slow = {lang: SlowAsWritten([t for i, t, own, *_ in rows if i % 3 and t and own == lang], order) for lang in ("en", "fr")}
    want = []
    for i, t, *_ in rows:
        sums = [slow[lang].log10(t) for lang in ("en", "fr")]
        odds = [10 ** ((s - max(sums)) / (order + 1)) for s in sums]
        known = any(map(str.isalpha, t or ""))
        rate = round(-max(sums) * math.log2(10) / (len((t or "").encode()) + 1), 6)
        want.append((i, ("en", "fr")[sums.index(max(sums))] if known else "und", round(1 / sum(odds), 6) if known else 0.0, rate))
    found = langid.identify(table(spark, rows, clashes=True), trees, order).collect()
    assert sorted((r["doc_id"], r["lang_pred"], round(r["score"], 6), round(r["bits_per_byte"], 6)) for r in found) == sorted(want)


def test_every_language_has_a_tree_however_long_its_texts(spark, monkeypatch):
    """A few very long documents of one language, many short ones of another, a small sample."""
    monkeypatch.setattr(langid, "SEGMENT", 1000)
    rows = [(1, "wan el io um " * 20_000, "long", "a", 0), (2, "uno due tre quattro " * 20_000, "other", "a", 0)]
    rows += [(i, f"and so on {i}", "short", "a", 0) for i in range(3, 300)]
    for sample in (3, 30_000):
        trees = langid.train(table(spark, rows), sample_bytes=sample)
        assert sorted(trees) == ["long", "other", "short"]
        # At most one segment more than a language's part.
        assert all(tree.grams[-1][1].sum() < 3 * (sample / 3 + 2000) for tree in trees.values())
    found = langid.identify(table(spark, rows[:2] + [(9, "uno due", None, None, 0)]), trees).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {1: "long", 2: "other", 9: "other"}
