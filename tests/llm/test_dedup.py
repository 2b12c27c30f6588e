"""Suffix dedup, line dedup and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from revloom.llm import jaccard, line_dedup, shared, suffixes
from revloom.llm.components import components
from revloom.llm.queries import ORACLE_SQL, QUERIES
from revloom.llm.shared import keep, prepare, sorted_table

from .samples import SF, awkward, collected, table


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op7_line_dedup", "op8_jaccard_join"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.sql(ORACLE_SQL[name]).to_arrow_table()
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(want.column_names)
    columns = sorted(found.columns)
    assert collected(found.select(*columns)) == sorted((tuple(r[c] for c in columns) for r in want.to_pylist()), key=repr)


def documents(spark):
    return [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# --- byte strings -----------------------------------------------------------------------


def repeated_bytes(rows, length=200):
    seen, out = {}, []
    data = [(i, (text or "").encode()) for i, text in rows]
    for _, raw in data:
        for at in range(len(raw) - length + 1):
            seen[raw[at : at + length]] = seen.get(raw[at : at + length], 0) + 1
    for i, raw in data:
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - length + 1):
            if seen[raw[at : at + length]] > 1:
                gone[at : at + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed_bytes(frame, **options):
    return sorted(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
        for r in suffixes.remove_repeats(frame, **options).collect()
    )


def test_repeated_bytes_of_awkward_rows(spark):
    assert removed_bytes(table(spark, clashes=True)) == repeated_bytes([r[:2] for r in awkward()])


def test_repeated_bytes_of_pasted_texts(spark):
    rnd = random.Random(3)
    fresh = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    pool = [fresh(n) for n in (150, 190, 210, 250, 400, 900)]
    part = lambda: rnd.choice(
        [fresh(rnd.randrange(120)), rnd.choice(pool)[rnd.randrange(60) :], rnd.choice(pool), "ab" * rnd.randrange(200)]
    )
    rows = [(i, "".join(part() for _ in range(rnd.randrange(6)))) for i in range(120)]
    frame = table(spark, [(*r, None, None, 0) for r in rows])
    assert removed_bytes(frame) == repeated_bytes(rows)
    assert removed_bytes(frame, length=90, batches=7) == repeated_bytes(rows, 90)


def test_a_text_longer_than_a_block(spark, monkeypatch):
    rnd = random.Random(4)
    fresh = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    shared = fresh(300)
    rows = [(1, fresh(2_120_000) + shared), (2, "x" + shared + "y"), (3, fresh(2_095_000) + shared[:250] + fresh(9_000))]
    frame = table(spark, [(*r, None, None, 0) for r in rows])
    got = {r[0]: r[2] for r in removed_bytes(frame)}
    assert got == {1: 300, 2: 300, 3: 250}


def test_suffix_query(spark):
    found = QUERIES["op1_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == repeated_bytes(documents(spark))


def test_a_task_reads_only_what_concerns_its_own_texts(spark, monkeypatch):
    rnd = random.Random(5)
    fresh = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    rows = []
    for group in range(20):  # both kinds of run, in each group their own
        passage = fresh(500)
        rows += [(len(rows) + k, fresh(50) + passage[k * 20 : 480] + fresh(50)) for k in range(4)]
    frame = table(spark, [(*r, None, None, 0) for r in rows]).repartitionByRange(4, "doc_id")
    steps, reads, kind, plain, read = [], [], type(frame), type(frame).mapInArrow, shared.pq.read_table
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **k: steps.append((self, a[0])) or plain(self, *a, **k))
    assert removed_bytes(frame) == repeated_bytes(rows)
    source, remove = steps[-1]

    def counted(*args, **options):
        found = read(*args, **options)
        reads.append(len(found))
        return found

    monkeypatch.setattr(shared.pq, "read_table", counted)

    def rows_read(texts):
        reads.clear()
        assert sum(len(b) for b in remove(iter(texts.toArrow().to_batches(max_chunksize=1)))) == texts.count()
        return list(reads)

    few, every = rows_read(source.where("doc_id < 8").orderBy("doc_id")), rows_read(source.orderBy("doc_id"))
    assert len(few) == 1 and len(every) == 4  # once a chunk, not a text
    assert 2 * sum(few) < sum(every)


def test_texts_of_several_chunks_and_lots(spark, monkeypatch):
    rnd = random.Random(6)
    fresh = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    pool = [fresh(n) for n in (210, 300, 700)]
    rows = [(i, "".join(rnd.choice([fresh(90), rnd.choice(pool)[rnd.randrange(60) :]]) for _ in range(4))) for i in range(90)]
    monkeypatch.setattr(suffixes, "CHUNK_BITS", 2)
    monkeypatch.setattr(suffixes, "LOT_BYTES", 0)
    frame = table(spark, [(*r, None, None, 0) for r in rows + rows[:9]])
    assert removed_bytes(frame) == repeated_bytes(rows + rows[:9])
    assert removed_bytes(frame, length=64) == repeated_bytes(rows + rows[:9], 64)


def test_levels_merge_geometrically(spark):
    index = suffixes.SuffixIndex()
    for number in range(6):
        entries = spark.createDataFrame([(number, number, 1), (100, 7, 1)], "key bigint, span bigint, n bigint")
        repeated = [r["key"] for r in index.add(entries).collect()]
        assert repeated == ([] if number == 0 else [100])
    assert [size for size, _ in index.levels] == [4, 2]
    assert suffixes.remove_repeats(table(spark, [])).count() == 0


# --- lines ------------------------------------------------------------------------------


def repeated_lines(rows, least=line_dedup.MIN_WORDS):
    """Kept text per row; rows equal in id and text are one place.  Every two places of a line are extended both ways."""
    texts = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0], r[1]))
    plain = [[(k, " ".join(line.lower().split())) for k, line in enumerate(t.split("\n")) if line.split()] for _, t in texts]
    at, gone = {}, [set() for _ in texts]
    for d, lines in enumerate(plain):
        for p, (_, line) in enumerate(lines):
            for e, q in at.setdefault(line, []):
                other = plain[e]
                if p and q and lines[p - 1][1] == other[q - 1][1]:
                    continue  # found from the line before
                n = 0
                while p + n < len(lines) and q + n < len(other) and lines[p + n][1] == other[q + n][1]:
                    n += 1
                if sum(len(words.split()) for _, words in lines[p : p + n]) >= least:
                    gone[d].update(k for k, _ in lines[p : p + n])
            at[line].append((d, p))
    kept = {
        text: "\n".join(line for k, line in enumerate(text[1].split("\n")) if k not in own)
        for text, own in zip(texts, gone, strict=True)
    }
    return sorted(((i, kept.get((i, t))) for i, t in rows), key=repr)


def test_repeated_lines_query(spark):
    want = [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in repeated_lines(documents(spark))]
    found = QUERIES["op7_line_dedup"](spark, SF)
    assert collected(found.select("doc_id", "kept_sha256")) == sorted(want, key=repr)


def test_repeated_lines_of_awkward_rows(spark):
    rows = [r[:2] for r in awkward() if r[0] != 3]  # an id with two texts orders them by hash
    found = line_dedup.remove_repeats(table(spark, [r for r in awkward() if r[0] != 3], clashes=True))
    assert collected(found.select("doc_id", "kept_text")) == repeated_lines(rows)
    assert line_dedup.remove_repeats(table(spark, [])).count() == 0


def test_later_runs_go_in_one_document_too(spark):
    run = "\n".join(" ".join(f"w{k}{n}" for n in range(15)) for k in range(4))
    rows = [(1, f"{run}\nmiddle\n{run}", None, None, 0), (2, f"before\n\n{run.upper()}\nafter", None, None, 0)]
    found = {r["doc_id"]: r for r in line_dedup.remove_repeats(table(spark, rows)).collect()}
    assert found[1]["kept_text"] == f"{run}\nmiddle" and (found[1]["n_removed"], found[1]["n_runs"]) == (4, 1)
    assert found[2]["kept_text"] == "before\n\nafter"


def test_equal_windows_select_one_fingerprint():
    line = lambda k: " ".join(f"w{k}x{n}" for n in range(12))
    run = [line(k) for k in range(9)]
    ours = {w[1]: w[0] for w in line_dedup.windows("\n".join([line(70), *run]), 40)}
    theirs = {w[1]: w[0] for w in line_dedup.windows("\n".join([line(80), line(81), *run, line(82)]), 40)}
    common = ours.keys() & theirs.keys()
    assert len(common) == 6 and all(ours[c] == theirs[c] for c in common)


def test_places_are_joined_on_their_line(spark, monkeypatch):
    line = lambda k: " ".join(f"w{k}x{n}" for n in range(12))
    run = [line(k) for k in range(9)]
    alone = "\n".join(line(k) for k in range(100, 160))
    texts = ["\n".join([line(70), *run]), "\n".join([line(80), *run, line(82)]), alone, None, "", "\n".join(run[:1] * 9)]
    monkeypatch.setattr(line_dedup, "ROWS", 7)
    found = line_dedup.selected_places(table(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]))
    rows = found.collect()
    for i, text in enumerate(texts):
        signed = lambda n: n - (n >> 63 << 64)
        want = sorted((signed(a), signed(b), c, d, e) for a, b, c, d, e in line_dedup.windows(text or "", 40))
        assert sorted(tuple(r)[2:] for r in rows if r["doc_id"] == i) == want
        assert len({w[2:4] for w in want}) == len(want)
    assert {r["doc_id"] for r in line_dedup.joined_places(found).collect()} == {0, 1, 5}


@pytest.mark.parametrize("sizes", [(30, 12, 12, 12), (40,), (1,) * 41, (12, 12, 12, 30), (39,), (5, 90, 5)])
def test_a_repeated_run_goes_whole(spark, sizes):
    run = "\n".join(" ".join(f"r{k}n{n}" for n in range(size)) for k, size in enumerate(sizes))
    other = lambda k: "\n".join(" ".join(f"o{k}l{j}n{n}" for n in range(9)) for j in range(6))
    rows = [(1, f"{other(1)}\n{run}\n{other(2)}"), (2, f"{other(3)}\n{run}\n{other(4)}"), (3, f"{run}\n\n{other(5)}\n{run}")]
    found = line_dedup.remove_repeats(table(spark, [(i, t, None, None, 0) for i, t in rows]))
    kept = {r["doc_id"]: r["kept_text"] for r in found.collect()}
    assert sorted(kept.items()) == repeated_lines(rows)
    if sum(sizes) >= 40:
        assert kept[2] == f"{other(3)}\n{other(4)}" and kept[3] == f"\n{other(5)}"
    else:
        assert kept == dict(rows)


def test_random_runs_equal_brute_force(spark):
    rnd = random.Random(6)
    lines = [" ".join(f"l{k}w{n}" for n in range(rnd.choice([1, 3, 8, 20, 45]))) for k in range(7)]
    rows = [(i, "\n".join(rnd.choice([*lines, "", f"own {i}"]) for _ in range(rnd.randrange(30)))) for i in range(60)]
    found = line_dedup.remove_repeats(table(spark, [(i, t, None, None, 0) for i, t in rows]))
    assert collected(found.select("doc_id", "kept_text")) == repeated_lines(rows)


# --- sets -------------------------------------------------------------------------------


def linked(rows, words=5, percent=80):
    def shingles(text):
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
        if len(w) < words:
            return {tuple(w)} if w else set()
        return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}

    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(sets)))

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[top(a)] = top(b)
    first = {}
    for a, (i, _) in enumerate(sets):
        first[top(a)] = min(i, first.get(top(a), i))
    return sorted((i, len(x), first[top(a)]) for a, (i, x) in enumerate(sets))


def mutated(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for _ in range(50):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 120, 300]))]
        for _ in range(rnd.choice([1, 1, 2, 6, 12])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                at = rnd.randrange(len(w) + 1)
                w[at : at + rnd.randrange(2)] = rnd.sample(vocabulary, rnd.randrange(2))
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_mutated_copies(spark, seed):
    rows = mutated(seed)
    assert collected(jaccard.join(table(spark, [(*r, None, None, 0) for r in rows]))) == sorted(linked(rows), key=repr)


def test_links_of_awkward_rows(spark):
    rows = [r[:2] for r in awkward()]
    assert collected(jaccard.join(table(spark, clashes=True))) == sorted(linked(rows), key=repr)
    assert jaccard.join(table(spark, [])).count() == 0


def test_jaccard_query(spark):
    assert collected(QUERIES["op8_jaccard_join"](spark, SF)) == sorted(linked(documents(spark)), key=repr)


def test_one_group_with_many_members_that_are_not_alike(spark):
    """Documents that share half of their words: all candidates, few links; blocks of a group are compared too."""
    rnd = random.Random(5)
    common = [f"c{k}" for k in range(40)]
    rows = [(i, " ".join(common + [f"u{i}x{k}" for k in range(rnd.choice([3, 4, 12, 40]))])) for i in range(120)]
    rows += [(500 + i, rows[i][1] + " tail") for i in range(0, 120, 9)]
    frame = table(spark, [(*r, None, None, 0) for r in rows])
    assert collected(jaccard.join(frame)) == sorted(linked(rows), key=repr)


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_similar_sets_share_a_signature(percent):
    """The pigeonhole: whatever differs within the threshold, a signature is left in a common band."""
    rnd = np.random.default_rng(8)
    for _ in range(600):
        size = int(rnd.choice([1, 2, 4, 5, 6, 9, 14, 25, 40, 90, 300]))
        x = rnd.integers(0, 2**63, size, dtype=np.uint64)
        gone = int(rnd.integers(0, size + 1))
        y = np.concatenate([x[gone:], rnd.integers(0, 2**63, int(rnd.integers(0, size + 1)), dtype=np.uint64)])
        if not len(y) or 100 * (size - gone) < percent * len(set(x) | set(y)):
            continue
        keys = []
        for s in (np.unique(x), np.unique(y)):
            band = jaccard.band_of(len(s), percent)
            keys.append({k for b in range(max(0, band - 1), band + 1) for k in jaccard.signatures(s, b, percent).tolist()})
        assert keys[0] & keys[1]


def test_first_of_each_class(spark):
    rows = awkward()
    kept = jaccard.first_of_each_class(table(spark, clashes=True))
    got = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"] and r["text"].split())
    assert len(got) == len(set(got))
    classes = {c for i, n, c in linked([r[:2] for r in rows]) if n}
    assert {i for i, _ in got} >= classes
    blank = [r for r in rows if not re.search("[^\x20\x09-\x0d]", r[1] or "")]
    assert sum(1 for r in kept.collect() if not re.search("[^\x20\x09-\x0d]", r["text"] or "")) == len(blank)
    assert kept.columns == table(spark, clashes=True).columns


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 400), (400, 500), (7, 7)], "a bigint, b bigint")
    assert dict(map(tuple, components(links).collect())) == {k: 0 for k in range(201)} | {400: 400, 500: 400}


def test_alike_sets_beside_an_odd_smallest_one_make_few_pairs(spark, monkeypatch):
    """A group whose members are all alike, but unlike its smallest: pairs grow with its members only."""
    from pyspark.sql import functions as F

    prepare(spark)
    rnd = random.Random(12)
    base = [f"w{k}" for k in range(104)]

    def near():
        words = list(base)
        words[rnd.randrange(30, 104)] = f"x{rnd.randrange(10**6)}"
        return " ".join(words)

    # The odd one shares a run with all others, under the threshold.
    texts = [" ".join([*base[:60], *(f"odd{k}" for k in range(44))])] + [near() for _ in range(150)]
    docs = table(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)])
    wanted = docs.select(F.lit(1).alias("number")).limit(0).withColumn("wanted", F.lit(1))
    numbers = [r["number"] for r in jaccard._set_table(docs, 5, ("doc_id",)).collect()]
    every = spark.createDataFrame([(n, 1) for n in set(numbers)], "number bigint, wanted int")
    sets = jaccard._shingles_of(docs, sorted_table(every.union(wanted), "number", "test-wanted"), 5)
    sketches = jaccard._sketches(sets, 80)
    members = sets.select("number", F.lit(0).alias("label"), "n")
    band = jaccard.band_of(100, 80)
    groups = keep(members.select(F.lit(7).cast("bigint").alias("signature"), F.lit(band).alias("band"), F.lit(0).cast("bigint").alias("hub"), F.col("number").alias("member")), "test-groups")
    alone = spark.createDataFrame([], "node bigint, label bigint")
    pairs, opened = jaccard._unsettled(groups, alone, sketches, 80, 1, block=40)
    count, size = pairs.count(), groups.count()
    assert [r["signature"] for r in opened.collect()] == [7]
    everything = jaccard._unsettled(groups, alone, sketches, 80, None, block=40)[0].count()
    assert size - 3 <= count < 12 * size < everything
    labels = components(jaccard._verified(pairs, sets, 80))
    left = jaccard._unsettled(groups, labels, sketches, 80, None, block=40)[0].count()
    assert left < everything / 10
    found = jaccard.join(docs).groupBy("component_id").count().collect()
    assert sorted(r["count"] for r in found) == [1, 150]
