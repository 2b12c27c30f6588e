"""Packing and stream files: exact round trips against the tokenizer itself."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from revloom.llm import blocks as texts_in_blocks
from revloom.llm import packing, stream_files
from revloom.llm.blocks import BLOCK_BYTES, blocks
from revloom.llm.queries import QUERIES
from revloom.llm.shared import handing_back, prepare
from revloom.llm.tokens import CALL_PIECES, TOKEN_BLOCK, TOKENIZER_FILE, WordTokenizer
from revloom.session import scratch_path

from .samples import SF, awkward, collected, table

TOKENIZER = Tokenizer.from_file(TOKENIZER_FILE)


def plain(text, end_id):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end_id]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("remembered", [40, 1_000_000])
def test_piecewise_ids_are_those_of_the_whole_text(remembered):
    texts = [row[1] for row in awkward()] + [
        "a\x1cb c\x85d  e 　f",
        "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
        "é ́a ͅ",
        "İstanbul ΣΑΣ 's 'T don't I'LL",
        "a., b.. c), 1. 2. , . é. ×, a.",
        "😀👍🏽 𝔘𝔫𝔦 한국어 한",
    ]
    encoder = WordTokenizer(remembered=remembered)
    found = []
    for block in blocks(pa.record_batch({"text": pa.array(texts)}), limit=3000):
        ids, bounds = encoder.encode(block, 2)
        found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [plain(text, 2) for text in texts]


def check_pieces(rows, expected, length=4096):
    """Every id of every document in exactly one piece, sequences without gaps, padding only at the end."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    left = defaultdict(list)
    for doc_id, ids in expected:
        left[doc_id, len(ids)].append(ids)
    for key, pieces in by_doc.items():
        starts = sorted((p["start"], p["length"], p["ids_crc32"]) for p in pieces)
        want = sorted((s, n, crc(ids[s : s + n])) for ids in left[key] for s, n in {(s, n) for s, n, _ in starts})
        assert set(starts) <= set(want)
        assert sum(n for _, n, _ in starts) == sum(map(len, left[key]))
    assert set(by_doc) == set(left)
    sizes = []
    for number in range(max(by_sequence, default=-1) + 1):
        at = 0
        for offset, size in sorted(by_sequence[number]):
            assert offset == at
            at += size
        sizes.append(at)
    assert all(size == length for size in sizes[:-1]) and all(0 < size <= length for size in sizes)


def test_packing_places_every_id_once(spark):
    rows = packing.pack(table(spark, clashes=True), sequence=256, window_sequences=2).collect()
    check_pieces(rows, [(i, plain(t, 2)) for i, t, *_ in awkward()], 256)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_pieces(QUERIES["op2_packing"](spark, SF).collect(), [(d["doc_id"], plain(d["text"], 2)) for d in docs])


def test_packing_of_nothing(spark):
    assert packing.pack(table(spark, [])).count() == 0


def test_windows_hold_the_target_proportions(spark):
    rows = [(i, "wan el io um " * 100, "en", "abc"[i % 3], 0) for i in range(300)]
    found = packing.pack(table(spark, rows), sequence=512, window_sequences=4, weights={"a": 0.5, "b": 0.3, "c": 0.2})
    share = defaultdict(lambda: defaultdict(int))
    for r in found.collect():
        share[r["window_id"]][r["source"]] += r["length"]
    assert len(share) > 40
    part = {window: [own[s] / sum(own.values()) for s in "abc"] for window, own in share.items()}
    # "a" runs dry first, after its third of the tokens at half of each window; then b and c share 3 : 2.
    dry = max(window for window, own in share.items() if own["a"])
    for window, found in part.items():
        want = [0.5, 0.3, 0.2] if window <= dry else [0.0, 0.6, 0.4] if share[window]["b"] else [0.0, 0.0, 1.0]
        assert all(abs(x - y) < 0.002 for x, y in zip(found, want, strict=True)), window
    assert abs(dry / len(share) - 2 / 3) < 0.05


def test_deficits_add_up():
    mixture = packing.Mixture([1000, 37, 0, 5000], [1000.0, 37.0, 0.0, 5000.0], 64)
    taken = np.zeros(6037, int)
    for queue, total in enumerate(mixture.totals.tolist()):
        at = 0
        while at < total:
            size = min(17, total - at)
            for _, length, place, _ in mixture.places(queue, at, size):
                taken[place : place + length] += 1
            at += size
    assert (taken == 1).all()


@pytest.mark.parametrize("weights", [None, [0.5, 0.1, 0.4, 0.0]])
def test_places_are_those_of_a_round_robin_that_carries_deficits(weights):
    """Window by window every queue earns its share, gives whole tokens and keeps the fraction."""
    totals = [400, 37, 0, 900] if weights is None else [400, 37, 900, 0]
    mixture = packing.Mixture(totals, weights or [float(t) for t in totals], 64)
    stream = []
    for given, amounts, windows, _ in mixture.phases:
        deficit, at = [Fraction(0)] * 4, given.tolist()
        for _ in range(windows):
            for queue, amount in enumerate(amounts.tolist()):
                deficit[queue] += Fraction(amount, windows)
                out = math.floor(deficit[queue])
                deficit[queue] -= out
                stream += [(queue, at[queue] + k) for k in range(out)]
                at[queue] += out
        assert not any(deficit)
    placed = {}
    for queue, total in enumerate(totals):
        for at, length, place, _ in mixture.places(queue, 0, total):
            placed |= {place + k: (queue, at + k) for k in range(length)}
    assert [placed[k] for k in range(len(stream))] == stream and len(placed) == sum(totals)


def test_every_source_has_its_share_of_every_window(spark):
    """Forty sources, one of them with a third of all tokens, and many with next to nothing."""
    rows = [(i, "wan el io um " * 40, "en", "hot" if i % 3 == 0 else f"s{i % 40}", 0) for i in range(1200)]
    rows += [(2000 + i, "", "en", f"tiny{i}", 0) for i in range(30)] + [(3000, "wan " * 900, "en", None, 0)]
    found = packing.pack(table(spark, rows), sequence=512, window_sequences=8).collect()
    share, whole = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in found:
        share[r["window_id"]][r["source"]] += r["length"]
        whole[r["source"]] += r["length"]
    assert len(share) > 20 and all(whole[f"tiny{i}"] == 1 for i in range(30))
    for source in {r[3] for r in rows if not str(r[3]).startswith("tiny")}:
        for own in share.values():
            assert abs(own[source] - whole[source] / len(share)) <= 1, source


@pytest.mark.parametrize("bits", [1, 4])
def test_the_number_of_stretches_shows_in_no_result(spark, monkeypatch, bits):
    plan = lambda: collected(packing.pack(table(spark), sequence=256, window_sequences=2).drop("doc_id", "source"))
    want = plan()
    monkeypatch.setattr(packing, "LEAST_BITS", bits)
    assert plan() == want


@pytest.mark.parametrize("kind", ["smallint", "decimal(9,0)", "string"])
def test_packing_takes_any_type_of_id(spark, kind):
    rows = [(1, "wan el", "en", "a", 0), (None, "io um", "en", None, 0), (3, None, "en", "a", 0)]
    docs = table(spark, rows)
    found = packing.pack(docs.withColumn("doc_id", docs["doc_id"].cast(kind)))
    assert dict(found.dtypes)["doc_id"] == kind
    assert sorted(str(r["doc_id"]) for r in found.collect()) == ["1", "3", "None"]


def test_stream_files_query(spark):
    docs = sorted((d["doc_id"], plain(d["text"], 1)) for d in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = sorted(QUERIES["op6_stream_files"](spark, SF).collect())
    start = 0
    for (doc_id, ids), row in zip(docs, found, strict=True):
        assert tuple(row) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)


def test_stream_files_are_read_by_row_without_copying(spark):
    prepare(spark)
    folder = scratch_path(spark, "files")
    rows = awkward()
    manifest = stream_files.write_files(
        table(spark, clashes=True), folder, length=64, sequences_per_batch=4, documents_per_file=20
    ).orderBy("number").collect()
    assert len(manifest) > 1 and sum(m["n_docs"] for m in manifest) == len(rows)
    assert [m["first_doc"] for m in manifest] == sorted(m["first_doc"] for m in manifest)
    stream = []
    for m in manifest:
        for number in range(m["n_sequences"]):
            ids, mask = stream_files.sequence(m["path"] + ".arrow", number)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            stream += ids[mask].tolist()
    # Same ids, ascending documents; rows that share an id stand together in some order.
    assert len(stream) == sum(len(plain(t, 1)) for _, t, *_ in rows)
    found = stream_files.read_documents(spark.read.parquet(f"{folder}/manifest")).collect()
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in found) == sorted((i, crc(plain(t, 1))) for i, t, *_ in rows)
    for r in found:
        assert crc(stream[r["start"] : r["start"] + r["n_tokens"]]) == r["ids_crc32"]
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])] == sorted(i for i, *_ in rows)


def test_stream_files_of_nothing(spark):
    assert stream_files.write_and_read(table(spark, [])).count() == 0


def test_a_worker_bounds_calls_of_the_tokenizer_and_hands_memory_back():
    """Workers of an executor held 250 to 310 MB each, so that packing took more than its memory."""
    words = [f"{word:x}q" for word in range(3 * CALL_PIECES)]
    text = " ".join(words)
    batch = pa.RecordBatch.from_pydict({"text": [text, None, "a " + text]})
    encoder = WordTokenizer()
    made, called = encoder._call, []
    encoder._call = lambda pieces: called.append(sum(map(len, pieces))) or made(pieces)

    def encode(batches):
        for found in batches:
            for block in blocks(found, limit=TOKEN_BLOCK):
                ids, bounds = encoder.encode(block, 2)
                yield from (ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:]))
            assert sum(map(len, texts_in_blocks._powers)) <= 2 * (batch.nbytes + BLOCK_BYTES)

    found = list(handing_back(encode)(iter([batch])))
    assert found == [plain(t, 2) for t in (text, None, "a " + text)]
    assert len(called) >= 3 and max(called) <= CALL_PIECES * (len(words[-1]) + 3)
    assert sum(map(len, texts_in_blocks._powers)) == 2
