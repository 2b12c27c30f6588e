"""Removal of byte strings that occur more than once, by a logarithmic family of suffix arrays.

The arrays are sparse: of all suffixes they hold those that start at an anchor, the place
with the least hash of its next ``KEY`` bytes among the places of a window.  Every string
of ``length`` bytes has exactly one anchor, and equal strings have it in the same place, so
no long match escapes.  Strings next to each other that share their anchor form a run; an
entry is the anchor's key (the order of the array: a hash stands for the first ``KEY``
bytes) and the hash of all the run's bytes around the anchor.

Documents arrive in batches.  A batch gets its array, which is merge-scanned against every
existing level for equal keys; then it becomes a level, and equal-sized levels merge, so
each entry is rewritten only log2(batches) times.

A key that the scans found twice is a possible match.  A run that occurs twice as a whole
is one.  Of runs that share only their key, all strings are hashed and counted, each
distinct run once.

Texts are stored once in chunks and never shuffled.  Hashes spread evenly, so a task that
looked up its runs in a table of all of them would read the whole table.  Instead, entries
name their chunk, and what is found out about a run is joined to them and dealt by chunk:
a task reads what concerns its own chunks, once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.blocks import Block, blocks, mixed, powers
from revloom.llm.shared import DealtTable, dealt_table, keep, prepare, texts

LENGTH = 200
KEY = 64
BATCHES = 4
_PLACE_BITS = 21
_PIECE = (1 << _PLACE_BITS) - 4096
#: A chunk is at most so many rows of one task's input, as a power of two.
CHUNK_BITS = 14
#: A lot is packed when it has so many bytes.
LOT_BYTES = 1 << 22


@dataclass
class Runs:
    """Runs of strings with one anchor: strings start at first..last; key and hash name them."""

    key: np.ndarray
    span: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    count = len(values) - width + 1
    full = np.concatenate([values, np.full(-len(values) % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def runs(block: Block, length: int) -> Runs:
    """All runs of a block's texts, in order."""
    size = len(block.data)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    # A text beyond the block size comes in pieces that overlap by one string less a byte.
    for begin in range(0, max(0, size - length + 1), _PIECE):
        data = block.data[begin : begin + _PIECE + length - 1]
        bounds = np.clip(block.bounds - begin, 0, len(data))
        piece = Block(data, bounds)
        prefix = piece.prefix()
        # Rank places by the unmixed hash: its high bits depend on all bytes of the key.
        count = len(data) - KEY + 1
        ranked = (prefix[KEY : KEY + count] - prefix[:count]) * powers(count)[1]
        ranked >>= np.uint64(_PLACE_BITS)
        ranked <<= np.uint64(_PLACE_BITS)
        ranked |= np.arange(count, dtype=np.uint64)
        anchor = _least(ranked, length - KEY + 1)
        anchor &= np.uint64((1 << _PLACE_BITS) - 1)
        ends = np.repeat(bounds[1:], np.diff(bounds))[: len(anchor)]
        start = np.flatnonzero(np.arange(length, length + len(anchor)) <= ends)
        if not len(start):
            continue
        anchor = anchor[start].astype(np.int64)
        # The last strings of a text are cut off, so a new text shows as a gap.
        new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))
        first, last = start[new], start[np.append(new[1:], len(start)) - 1]
        at = anchor[new]
        keys = piece.hashes(prefix, at, at + KEY)
        span = mixed(piece.hashes(prefix, first, last + length) + (at - first).astype(np.uint64))
        found.append((keys, span, first + begin, last + begin))
    return Runs(*(np.concatenate(column) for column in zip(*found, strict=True)))


@dataclass
class SuffixIndex:
    """The family: levels of (key, span, n), the number of batches in each a power of two."""

    levels: list[tuple[int, DataFrame]] = field(default_factory=list)

    def add(self, entries: DataFrame) -> DataFrame:
        """Index a batch of (key, span, n); returns the keys it repeats, within itself or from a level."""
        array = entries.groupBy("key", "span").agg(F.sum("n").alias("n"))
        array = keep(array.sortWithinPartitions("key", "span"), "suffix-array")
        scanned = array.select("key", "n", F.lit(True).alias("new"))
        for _, level in self.levels:
            scanned = scanned.union(level.select("key", "n", F.lit(False).alias("new")))
        met = scanned.groupBy("key").agg(F.sum("n").alias("n"), F.bool_or("new").alias("new"))
        repeated = keep(met.where("new and n > 1").select("key"), "suffix-matches")
        self.levels.append((1, array))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, left), (_, right) = self.levels.pop(), self.levels.pop()
            merged = left.union(right).groupBy("key", "span").agg(F.sum("n").alias("n"))
            self.levels.append((2 * size, keep(merged.sortWithinPartitions("key", "span"), "suffix-level")))
        return repeated

    def entries(self) -> DataFrame:
        """All entries of all levels; one row per level that holds a run."""
        first, *rest = [level for _, level in self.levels]
        for level in rest:
            first = first.union(level)
        return first


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Each chunk of a batch and its rows."""
    chunk = batch.column("chunk").to_numpy()
    edges = np.flatnonzero(np.diff(chunk)) + 1
    for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(chunk)], strict=True):
        if end > begin:
            yield int(chunk[begin]), batch.slice(begin, end - begin)


def _entries(docs: DataFrame, length: int) -> DataFrame:
    """(batch, chunk, key, span, n) of each chunk's runs, added up within the chunk."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        count, here = 0, None

        def summed() -> Iterator[pa.RecordBatch]:
            for number, parts in held.items():
                key, span = (np.concatenate(column) for column in zip(*parts, strict=True))
                span, first, n = np.unique(span, return_index=True, return_counts=True)
                own = [np.full(len(span), number, np.int32), np.full(len(span), here, np.int64)]
                columns = [*own, key[first].view(np.int64), span.view(np.int64), n]
                names = ["batch", "chunk", "key", "span", "n"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            held.clear()

        for batch in batches:
            for chunk, rows in _stretches(batch):
                if chunk != here or count > 1 << 20:
                    yield from summed()
                    count, here = 0, chunk
                number = rows.column("batch").to_numpy()
                for block in blocks(rows):
                    found = runs(block, length)
                    own = number[block.first + np.searchsorted(block.bounds, found.first, "right") - 1]
                    for each in np.unique(own).tolist():
                        held.setdefault(each, []).append((found.key[own == each], found.span[own == each]))
                    count += len(own)
        yield from summed()

    made = docs.select("batch", "chunk", "text")
    return made.mapInArrow(index, "batch int, chunk bigint, key bigint, span bigint, n bigint")


def _place(sorted_names: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each name stands, and whether it does."""
    at = np.minimum(np.searchsorted(sorted_names, names), len(sorted_names) - 1)
    return at, sorted_names[at] == names


def _bodies(docs: DataFrame, wanted: DealtTable, length: int) -> DataFrame:
    """(span, raw) of the wanted runs: each once a task at most, from the chunk that is to give it."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names = None, None
        for batch in batches:
            for chunk, rows in _stretches(batch):
                if chunk != here:
                    own, here = wanted.load(chunk), chunk
                    names = None if own is None else own.column("span").to_numpy()
                    left = np.ones(0 if own is None else len(names), bool)
                for block in blocks(rows) if left.any() else ():
                    found = runs(block, length)
                    at, hit = _place(names, found.span.view(np.int64))
                    at = at[new := np.flatnonzero(hit & left[at])]
                    at, first = np.unique(at, return_index=True)
                    left[at] = False
                    pairs = zip(found.first[new[first]].tolist(), (found.last[new[first]] + length).tolist(), strict=True)
                    raw = pa.array([block.data[begin:end].tobytes() for begin, end in pairs], pa.binary())
                    if len(raw):
                        yield pa.RecordBatch.from_arrays([pa.array(names[at]), raw], names=["span", "raw"])

    return docs.select("chunk", "text").mapInArrow(collect, "span bigint, raw binary")


def _lots(bodies: DataFrame) -> DataFrame:
    """Distinct bodies (span, raw) packed into rows: the lot's name (its first span), spans, ends and bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[np.ndarray] = []
        raws: list[bytes] = []

        def lot() -> pa.RecordBatch:
            names = np.concatenate(spans)
            ends = np.cumsum([len(raw) for raw in raws]).astype(np.int32)
            parts = (names.tobytes(), ends.tobytes(), b"".join(raws))
            columns = [pa.array(names[:1]), *(pa.array([part], pa.binary()) for part in parts)]
            spans.clear()
            raws.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lot", "spans", "ends", "raw"])

        size = 0
        for batch in batches:
            spans.append(batch.column("span").to_numpy())
            raws += batch.column("raw").to_pylist()
            size += batch.column("raw").nbytes
            if size > LOT_BYTES:
                yield lot()
                size = 0
        if raws:
            yield lot()

    return bodies.mapInArrow(pack, "lot bigint, spans binary, ends binary, raw binary")


def _strings(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Each lot of a batch: its name, its spans, of all strings the number of their body and their hash."""
    for lot, spans, ends, raw in zip(*(column.to_pylist() for column in batch.columns), strict=True):
        bounds = b"\0\0\0\0" + ends
        array = pa.Array.from_buffers(pa.binary(), len(bounds) // 4 - 1, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        bodies, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for block in blocks(pa.RecordBatch.from_arrays([array], names=["raw"]), "raw"):
            sizes = np.diff(block.bounds)
            start = np.flatnonzero(np.arange(len(block.data)) + length <= np.repeat(block.bounds[1:], sizes))
            bodies.append(block.first + np.repeat(np.arange(len(block)), np.maximum(sizes - length + 1, 0)))
            hashes.append(block.hashes(block.prefix(), start, start + length))
        yield lot, np.frombuffer(spans, np.int64), np.concatenate(bodies), np.concatenate(hashes)


def _marks(lots: DataFrame, length: int, several: int) -> DataFrame:
    """(span, marks) of the bodies with a string that occurs in any other place: a bit for each string.

    Hashes travel as sorted blobs, one per bucket of their high bits, not as rows.  For each
    blob a bit per hash comes back.
    """
    parts = int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = length - KEY + 1
    buckets = max(parts, several * most >> 21)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot, _, _, hashes in _strings(batch, length):
                hashes = np.sort(hashes)
                bucket = ((hashes >> np.uint64(32)).astype(np.int64) * buckets) >> 32
                begin = np.flatnonzero(np.diff(bucket, prepend=-1))
                raw, ends = hashes.tobytes(), np.append(begin[1:], len(hashes))
                blobs = [raw[8 * a : 8 * b] for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(bucket[begin]), pa.array(np.full(len(begin), lot)), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "lot", "hashes"])

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: int | None = None
        held: list[tuple[int, bytes]] = []

        def found() -> pa.RecordBatch:
            hashes = np.sort(np.frombuffer(b"".join(raw for _, raw in held), np.uint64))
            twice = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
            flags = []
            for _, raw in held:
                own = np.frombuffer(raw, np.uint64)
                flags.append(np.packbits(_place(twice, own)[1] if len(twice) else np.zeros(len(own), bool)).tobytes())
            columns = [pa.array(np.full(len(held), here)), pa.array([lot for lot, _ in held], pa.int64())]
            columns += [pa.array([len(raw) // 8 for _, raw in held], pa.int64()), pa.array(flags, pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "lot", "n", "flags"])

        for batch in batches:
            for bucket, lot, hashes in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if bucket != here and held:
                    yield found()
                here = bucket
                held.append((lot, hashes))
        if held:
            yield found()

    dealt = lots.mapInArrow(deal, "bucket bigint, lot bigint, hashes binary")
    dealt = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket")
    flagged = dealt.mapInArrow(repeats, "bucket bigint, lot bigint, n bigint, flags binary")
    flagged = dealt_table(flagged, "lot", "suffix-strings")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot, spans, body, hashes in _strings(batch, length):
                own = flagged.load(lot)
                twice = np.empty(len(hashes), bool)
                # Buckets are ranges of hashes, so the blobs' bits follow the hashes' order.
                pairs = zip(own.column("flags").to_pylist(), own.column("n").to_pylist(), strict=True)
                bits = [np.unpackbits(np.frombuffer(raw, np.uint8), count=n) for raw, n in pairs]
                twice[np.argsort(hashes)] = np.concatenate(bits)
                marks = np.zeros((len(spans), most), bool)
                marks[body, np.arange(len(body)) - np.searchsorted(body, body)] = twice
                some = np.flatnonzero(marks.any(axis=1))
                raw = pa.array([row.tobytes() for row in np.packbits(marks[some], axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(spans[some]), raw], names=["span", "marks"])

    return lots.mapInArrow(mark, "span bigint, marks binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept of every row of ``docs`` (doc_id, text).

    A byte goes if some string of ``length`` bytes that covers it also starts anywhere else,
    in its own or another document; strings are judged on the input.  ``kept`` holds the
    remaining bytes.  A null text is empty.  Repeated rows repeat each other's strings.
    An empty table gives an empty result.
    """
    if length < KEY:
        raise ValueError(f"strings of fewer than {KEY} bytes have no anchor")
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    numbered = texts(docs).withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))
    numbered = numbered.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS))
    rows = keep(numbered, "suffix-texts", compression="zstd")
    entries = keep(_entries(rows, length), "suffix-entries")
    index, matches = SuffixIndex(), []
    for number in range(batches):
        matches.append(index.add(entries.where(F.col("batch") == number).select("key", "span", "n")))
    repeated = matches[0]
    for more in matches[1:]:
        repeated = repeated.union(more)
    merged = index.entries().join(repeated.distinct(), "key", "left_semi")
    merged = keep(merged.groupBy("key", "span").agg(F.sum("n").alias("n")), "suffix-repeated")
    shared = merged.groupBy("key").agg((F.count("*") > 1).alias("several"))
    # 1: the run occurs twice; 2: it shares its key with other runs.
    state = (F.col("n") > 1).cast("int") + 2 * F.col("several").cast("int")
    states = keep(merged.join(shared, "key").select("span", state.alias("state")).where("state > 0"), "suffix-flags")
    several = states.where("state >= 2").count()

    # What a run's state says is brought to its chunks; each distinct run is given by one chunk.
    met = keep(entries.select("chunk", "span").join(states, "span").select("chunk", "span", "state"), "suffix-met")
    givers = met.where("state >= 2").groupBy("span").agg(F.min("chunk").alias("chunk"))
    bodies = _bodies(rows, dealt_table(givers, "chunk", "suffix-givers"), length)
    # A chunk may be read by two tasks; all that carry one name carry the same bytes.
    bodies = bodies.groupBy("span").agg(F.first("raw").alias("raw"))
    marks = keep(_marks(keep(_lots(bodies), "suffix-lots", compression="zstd"), length, several), "suffix-marks")
    whole = met.where("state % 2 = 1").select("chunk", "span", F.lit(None).cast("binary").alias("marks"))
    answers = met.where("state = 2").select("chunk", "span").join(marks, "span").select("chunk", "span", "marks")
    answers = dealt_table(whole.union(answers), "chunk", "suffix-answers")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own = None, None
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for chunk, part in _stretches(batch):
                if chunk != here:
                    own, here = answers.load(chunk), chunk
                    if own is not None:
                        names, raws = own.column("span").to_numpy(), own.column("marks")
                        partly = raws.is_valid().to_numpy()
                        bits = np.zeros((len(names), -(-(length - KEY + 1) // 8)), np.uint8)
                        known = b"".join(raws.drop_null().to_pylist())
                        bits[partly] = np.frombuffer(known, np.uint8).reshape(-1, bits.shape[1])
                for block in blocks(part):
                    edges = np.zeros(len(block.data) + 1, np.int32)
                    if own is not None:
                        found = runs(block, length)
                        at, hit = _place(names, found.span.view(np.int64))
                        all_of_it = hit & ~partly[at]
                        np.add.at(edges, found.first[all_of_it], 1)
                        np.add.at(edges, found.last[all_of_it] + length, -1)
                        some = np.flatnonzero(hit & partly[at])
                        run, string = np.nonzero(np.unpackbits(bits[at[some]], axis=1))
                        start = found.first[some][run] + string
                        np.add.at(edges, start, 1)
                        np.add.at(edges, start + length, -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    before = np.append(False, gone[:-1])
                    inner = block.bounds[:-1]
                    before[inner[inner < len(before)]] = False
                    sums = np.concatenate([[0], np.cumsum(gone)])
                    starts = np.concatenate([[0], np.cumsum(gone & ~before)])
                    low, high = block.bounds[:-1], block.bounds[1:]
                    sizes.append(high - low)
                    removed.append(sums[high] - sums[low])
                    spans.append(starts[high] - starts[low])
                    rest = block.data[~gone].tobytes()
                    cuts = block.bounds - sums[block.bounds]
                    kept += [rest[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            columns = [np.concatenate([np.zeros(0, np.int64), *column]) for column in (sizes, removed, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(column) for column in columns), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows.mapInArrow(remove, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


#: What the query returns, in SQL: strings of 200 bytes by their hash, kept bytes as hex digits.
REMOVED_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as raw, hex(encode(coalesce(text, ''))) as h
  from documents
),
starts as (
  select r, i, hash(raw[i + 1:i + 200]) as string
  from (select r, raw, unnest(range(0, octet_length(raw) - 199)) as i from docs where octet_length(raw) >= 200)
),
twice as (
  select r, i from starts join (select string from starts group by string having count(*) > 1) using (string)
),
edges as (
  select r, i, lag(i) over (partition by r order by i) as before from twice
),
numbered as (
  select r, i, sum(case when before is null or i > before + 200 then 1 else 0 end)
                 over (partition by r order by i) as run
  from edges
),
runs as (
  select r, run, min(i) as a, max(i) + 200 as b from numbered group by r, run
),
gaps as (
  select r, run, a, b, coalesce(lag(b) over (partition by r order by run), 0) as after from runs
),
kept as (
  select g.r, sum(b - a) as n_removed, count(*) as n_spans,
         string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' order by run) || substr(any_value(h), 2 * max(b) + 1) as h
  from gaps g join docs d on d.r = g.r group by g.r
)
select doc_id, (length(d.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(k.h, d.h))) as kept_sha256
from docs d left join kept k on k.r = d.r
"""
