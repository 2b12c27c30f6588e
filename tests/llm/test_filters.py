"""Quality rules, personal data and decontamination."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from revloom.llm import decontam, pii, quality
from revloom.llm.blocks import blocks, mixed
from revloom.llm.queries import ORACLE_SQL, QUERIES

from .samples import SF, awkward, collected, table

# --- quality ----------------------------------------------------------------------------


def judged_by_sql(arrow, sql=ORACLE_SQL["op3_quality_rules"]):
    con = duckdb.connect()
    con.register("documents", arrow)
    return con.sql(sql).to_arrow_table()


def same_rows(frame, arrow):
    columns = sorted(frame.columns)
    assert columns == sorted(arrow.column_names)
    got = sorted(map(tuple, frame.select(*columns).collect()))
    assert got == sorted(tuple(row[c] for c in columns) for row in arrow.select(columns).to_pylist())


def test_quality_query_equals_sql(spark):
    same_rows(QUERIES["op3_quality_rules"](spark, SF), judged_by_sql(spark.read.parquet(f"{SF}/documents.parquet").toArrow()))


def test_quality_of_awkward_rows_equals_sql(spark):
    docs = table(spark, clashes=True)
    same_rows(quality.judge(docs), judged_by_sql(docs.select("doc_id", "text", "source").toArrow()))
    assert quality.judge(table(spark, [])).count() == 0


def test_boilerplate_of_one_host_depletes_its_documents(spark):
    own = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    menu = own("menu", 40)
    rows = [(i, f"{menu}\n{own(i, 30)}", "en", "a", 0) for i in range(11)]
    rows += [(100 + i, f"{menu}\n{own(200 + i, 30)}", "en", "b", 0) for i in range(10)]
    rows += [(200 + i, own("copy", 60), "en", "a", 0) for i in range(40)]
    found = {r["doc_id"]: r for r in quality.judge(table(spark, rows)).collect()}
    assert not any(found[i]["kept"] for i in range(11)) and found[0]["frequent_words"] == 40
    # Ten documents are within the limit; copies of one text count once.
    assert all(found[i]["kept"] for i in (*range(100, 110), *range(200, 240)))


@pytest.mark.parametrize("bits, window", [(26, "xxhash64({words}[i]) & 2"), (56, None), (3, None)])
def test_colliding_windows_hide_no_repeat(spark, monkeypatch, bits, window):
    """With hashes of few values, and with more words than places."""
    monkeypatch.setattr(quality, "_PLACE_BITS", bits)
    if window:
        monkeypatch.setattr(quality, "_WINDOW_HASH", f"(({window}) << 60)")
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (0, 2, 3, 4, 6, 7, 8, 9, 10, 30, 90, 224)]
    rows = [(i, t, None, "a", 0) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r["n_repeat_words"] for r in quality.judge(table(spark, rows)).collect()}
    for i, text in enumerate(texts):
        words = text.split()
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
        assert found[i] == len(covered), i


def test_texts_without_frequent_lines(spark):
    own = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    menu = own("menu", 40)
    rows = [(i, f"{own(i, 5)}\n\n {menu.upper()}  \n{own(i, 3)}\n", "en", "a", 0) for i in range(11)]
    rows += [(50, None, "en", "a", 0), (51, "", "en", "a", 0), (None, menu, "en", "a", 0), (60, f"x\n{menu}", "en", "b", 0)]
    docs = table(spark, rows, clashes=True)
    found = quality.remove_frequent_lines(docs)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert all(texts[i] == f"{own(i, 5)}\n\n{own(i, 3)}\n" for i in range(11))
    assert texts[50] is None and texts[51] == "" and texts[None] == "" and texts[60] == f"x\n{menu}"
    # The verdict counts just the words that are gone.
    words = lambda t: len((t or "").split())
    gone = {r["doc_id"]: r["frequent_words"] for r in quality.judge(docs).collect()}
    assert gone == {i: words(t) - words(texts[i]) for i, t, *_ in rows}


def test_quality_runs_no_python(spark):
    plan = QUERIES["op3_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- personal data ----------------------------------------------------------------------


def plain_spans(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", m)] * all(int(part) <= 255 for part in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        out += [("card", m)] * (13 <= len(digits) <= 19 and pii.luhn(digits))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", m)] * (9 <= len(re.sub("[^0-9]", "", m[0])) <= 15)
    return [(kind, m.start(), m.end()) for kind, m in out]


@pytest.mark.parametrize("letters", ["a@.-b1", "12. -+()", "1.", "@a.", "0123456789 -", "+1 2().-", "aé1@.٣"])
def test_base_spans_equal_the_plain_patterns(letters):
    rnd = random.Random(1)
    for _ in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.choice([5, 12, 30])))
        assert pii.base_spans(text) == plain_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_personal_data_query(spark):
    found = {r["doc_id"]: r for r in QUERIES["op9_personal_data"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        spans, row = plain_spans(d["text"]), found[d["doc_id"]]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(row["spans"].split(","))
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(s[0] == kind for s in spans) for kind in pii.KINDS]


def test_context_finds_what_patterns_miss(spark):
    rows = [(i, f"please mail me at user{i}@x{i}.example.org thanks, item {10000 + i} sold", None, None, 0) for i in range(60)]
    rows += [(100 + i, f"do mail me at user{i}[x]hidden7 thanks, nothing else", None, None, 0) for i in range(5)]
    rows += [(200, "order 99999 thanks", None, None, 0), (201, None, None, None, 0)]
    found = {r["doc_id"]: r for r in pii.find(table(spark, rows, clashes=True)).collect()}
    text = rows[60][1]
    begin = text.index("user")
    assert [tuple(s) for s in found[100]["spans"]] == [(0, begin, begin + len("user0[x]hidden7"))]
    assert found[100]["base"] == [] and found[0]["spans"] == found[0]["base"] != []
    assert found[200]["spans"] == [] and found[201]["spans"] == []


def test_context_finds_tokens_without_digits_and_groups(spark):
    rnd = random.Random(3)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    cards = []
    while len(cards) < 40:
        card = f"4{digits(3)} {digits(4)} {digits(4)} {digits(4)}"
        cards += [card] * pii.luhn(card.replace(" ", ""))
    texts = [f"please mail me at user{chr(97 + i % 26)}{i}@x.example.org thanks" for i in range(40)]
    texts += [f"you can call us on +44 20 7946 {1000 + i} any time" for i in range(40)]
    texts += [f"it was charged to {card} last week" for card in cards]
    planted = [
        ("do mail me at ", "jane.doe[at]example.org", " thanks"),
        ("do mail me at ", "jane.doe@localhost", ", thanks"),
        ("so call us on ", "020 7946 0958", " any day"),
        ("was charged to ", "4111 1111 1111 1112", " last week"),
    ]
    # A new entity's own context, which no seed has, makes others known in a later round.
    names = [f"{name}(at)home" for name in "abcdefghijkl"]
    planted += [("do mail me at ", name, " thanks") for name in names]
    planted += [("", name, " is mine") for name in names] + [("", "emil(at)home", " is mine")]
    rows = [(i, text, None, None, 0) for i, text in enumerate(texts + ["".join(parts) for parts in planted])]
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(table(spark, rows)).collect()}
    kinds = [0, 0, 3, 2] + [0] * (2 * len(names) + 1)
    for i, (parts, kind) in enumerate(zip(planted, kinds, strict=True)):
        begin = len(parts[0])
        assert found[len(texts) + i] == [(kind, begin, begin + len(parts[1]))], parts
    assert all(len(found[i]) == 1 for i in range(len(texts)))


def test_runs_next_to_base_spans_are_no_part_of_them():
    text = "at 192.168.0.1 12 34, 56 (78) 90. 11"
    words, firsts = pii._hashes([text], pii._Words())
    first, last = pii._runs(words)
    places, use = pii._free(text, first - firsts[0], last - firsts[0], (first - firsts[0], last - firsts[0]))
    assert [text[a:b] for (a, b), u in zip(places, use, strict=True) if u] == ["12 34", "56 (78) 90"]


def test_personal_data_of_awkward_rows(spark):
    assert pii.find(table(spark, clashes=True)).count() == len(awkward())
    assert pii.find(table(spark, [])).count() == 0


def test_long_runs_take_time_in_proportion():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "." * 300_000, "@a" * 150_000, "+1 " * 100_000):
        list(pii._mentions(text, pii.base_spans(text)))


# --- decontamination --------------------------------------------------------------------


def slow_tiles(left, right, size):
    """Greedy string tiling as published: the longest free matches first, one mark at a time."""
    used_left, used_right, found = set(), set(), []
    while True:
        best = None
        for i in range(len(left)):
            for j in range(len(right)):
                k = 0
                while (
                    i + k < len(left)
                    and j + k < len(right)
                    and left[i + k] == right[j + k]
                    and i + k not in used_left
                    and j + k not in used_right
                ):
                    k += 1
                if k >= size and (best is None or k > best[2]):
                    best = (i, j, k)
        if not best:
            return found
        found.append(best)
        used_left.update(range(best[0], best[0] + best[2]))
        used_right.update(range(best[1], best[1] + best[2]))


def test_tiles_equal_the_slow_algorithm():
    rnd = random.Random(2)
    for _ in range(60):
        left = [rnd.choice("abc") for _ in range(rnd.randrange(4, 25))]
        right = [rnd.choice("abc") for _ in range(rnd.randrange(4, 40))]
        size = rnd.choice([2, 3, 4])
        pairs = [
            (i, j)
            for i in range(len(left) - size + 1)
            for j in range(len(right) - size + 1)
            if left[i : i + size] == right[j : j + size]
        ]
        assert decontam.tiles(pairs, size) == slow_tiles(left, right, size)
        hashes = [mixed(np.array([ord(w) for w in words], np.uint64)) for words in (left, right)]
        assert decontam.tiles_by_hash(*hashes, size) == slow_tiles(left, right, size)


@pytest.mark.parametrize("limit", [0, 1, decontam.PAIRS_PER_WORD])
def test_crowded_texts_are_tiled_alike(spark, monkeypatch, limit):
    rnd = random.Random(5)
    monkeypatch.setattr(decontam, "PAIRS_PER_WORD", limit)
    prose = lambda n: " ".join(rnd.choice("ab") for _ in range(n))
    items = [prose(n) for n in (6, 12, 30, 30, 3)]
    texts = [prose(n) for n in (40, 7, 60, 0, 25)]
    data = pa.record_batch({"text": pa.array(texts)})
    part = decontam._items(list(range(len(items))), items, 4)
    found = [sorted(row) for block in blocks(data) for row in decontam._coverage(block, part)]
    for text, row in zip(texts, found, strict=True):
        want = []
        for number, item in enumerate(items):
            marked = slow_tiles(item.split(), text.split(), min(4, len(item.split())))
            if marked:
                want.append((number, sum(t[2] for t in marked) / len(item.split())))
        assert row == want


def test_one_word_repeated_takes_memory_in_proportion():
    """100,000 equal words against 1,000: 100 million common places, none of them listed."""
    part = decontam._items([1, 2], ["aa " * 1000, "aa " * 999 + "bb"], 5)
    block = next(blocks(pa.record_batch({"text": pa.array(["aa " * 100_000])})))
    tracemalloc.start()
    found = decontam._coverage(block, part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(0, 1.0), (1, 0.999)]] and peak < 100 << 20


def test_decontamination_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    split = lambda t: t.lower().split()
    found = {r["doc_id"]: r for r in QUERIES["op10_decontamination"](spark, SF).collect()}
    assert len(found) == len(docs)
    leaks = {d["doc_id"] for d in docs for item in items if " ".join(split(item["text"])) in " ".join(split(d["text"]))}
    assert leaks and leaks <= {i for i, r in found.items() if r["contaminated"]}
    for d in docs:
        if found[d["doc_id"]]["contaminated"]:
            item = next(x for x in items if x["item_id"] == found[d["doc_id"]]["best_item"])
            tiles = slow_tiles(split(item["text"]), split(d["text"]), decontam.MIN_MATCH)
            assert sum(t[2] for t in tiles) / len(split(item["text"])) == found[d["doc_id"]]["best_coverage"]


def test_reordered_and_partial_passages(spark, monkeypatch):
    item = [f"b{k}" for k in range(40)]
    fill = [f"f{k}" for k in range(30)]
    texts = {
        1: item,
        2: item[20:] + fill + item[:20],
        3: item[30:] + fill[:9] + item[15:25] + fill[9:] + item[:15],
        4: fill + item[:19] + fill,
        5: fill + item[:20] + fill,
        6: [w for w in item for w in (w, "x")],
        7: ["tiny", "item"],
    }
    rows = [(i, " ".join(w).upper(), None, None, 0) for i, w in texts.items()]
    rows += [(8, None, None, None, 0), (9, "", None, None, 0)]
    items = [(1, " ".join(item)), (2, "tiny item"), (3, None), (4, ""), (5, "tiny item")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = {1: 1.0, 2: 1.0, 3: 0.875, 4: 0.475, 5: 0.5, 6: 0.0, 7: 1.0, 8: 0.0, 9: 0.0}
    for part in (decontam.PART_BYTES, 400):  # in one part, in several
        monkeypatch.setattr(decontam, "PART_BYTES", part)
        found = {r["doc_id"]: r for r in decontam.contamination(table(spark, rows, clashes=True), bench).collect()}
        assert {i: r["best_coverage"] for i, r in found.items()} == want
        assert {i for i, r in found.items() if r["contaminated"]} == {1, 2, 3, 5, 7}
        assert found[7]["n_items"] == 2 and found[6]["best_item"] is None
    assert decontam.contamination(table(spark, []), bench).count() == 0
    nothing = decontam.contamination(table(spark), bench.where("item_id < 0"))
    assert nothing.count() == len(awkward()) and not nothing.where("contaminated").count()


@pytest.mark.parametrize("kind", ["bigint", "smallint", "decimal(9,0)", "string"])
def test_ties_do_not_depend_on_the_parts(spark, monkeypatch, kind):
    text = " ".join(f"b{k}" for k in range(12))
    bench = spark.createDataFrame([(n, text) for n in range(10, 50)] + [(9, f"{text} more words")], "item_id bigint, text string")
    bench = bench.select(bench["item_id"].cast(kind).alias("item_id"), "text")
    docs = table(spark, [(1, text, None, None, 0), (2, "b1 b2", None, None, 0)])
    for part in (decontam.PART_BYTES, 900):
        monkeypatch.setattr(decontam, "PART_BYTES", part)
        found = {r["doc_id"]: r for r in decontam.contamination(docs, bench).collect()}
        assert str(found[1]["best_item"]) == "10" and found[1]["n_items"] == 41 and found[2]["n_items"] == 0


def test_columns_pass_through(spark):
    docs = table(spark, clashes=True)
    bench = spark.createDataFrame([(1, "wan el io")], "item_id bigint, text string")
    found = decontam.contamination(docs, bench, passed=tuple(docs.columns)).select(*docs.columns)
    assert collected(found) == collected(docs)
