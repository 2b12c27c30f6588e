"""Exact similarity join of documents by the Jaccard index of their word shingles.

Universe partition with pigeonhole.  Sizes fall into bands; two sets that reach the
threshold lie in the same band or in neighbouring ones.  For each band a hash deals all
shingles into ``m`` segments.  Similar sets of the band differ in at most H shingles, so a
set that spreads its trust over its segments - 1 for a segment that has to be equal, 2 for
one that may differ by one shingle - has a trusted segment that holds, once it has trusted
H + 1.  Every segment is indexed by a hash of its content, those that may differ by the
hashes of their one-deletion neighbourhood as well.  How many segments a band has and how
many get neighbourhoods follows from a cost model (:func:`allocation`).  A set whose
shingles leave too many segments empty to trust H + 1 is indexed by each single shingle
next to others of that kind, so nothing is lost.

Sets with equal content are one set from the start.  Sets with a signature in common are
candidates.  Candidates are verified exactly, in steps that do not list the pairs of a group:
each set against the smallest member of each of its groups; then pairs that would
span what is still apart in a group if they were links; then members of one group that
are still in different components.  In all steps only pairs that a bitmap of their shingles
cannot tell apart are emitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.blocks import Block, blocks, mixed, shingle_hashes
from revloom.llm.components import components
from revloom.llm.shared import SortedTable, handing_back, join_rows, keep, prepare, sorted_table, texts

WORDS = 5
PERCENT = 80
_LARGEST = 1 << 40


@cache
def band_edges(percent: int) -> tuple[int, ...]:
    """Smallest size of each band."""
    edges = [1]
    while edges[-1] < _LARGEST:
        edges.append(max(edges[-1] + 1, edges[-1] * 100 // percent))
    return tuple(edges)


def needed(total: int, percent: int) -> int:
    """Least intersection of two sets whose sizes add up to ``total``."""
    return -(-percent * total // (100 + percent))


@cache
def differences(band: int, percent: int) -> int:
    """H: the most shingles in which a set of the band and a similar set, as large or larger, can differ."""
    high = band_edges(percent)[band + 1] - 1
    total = high + high * 100 // percent
    return max(t - 2 * needed(t, percent) for t in range(max(2, total - 20), total + 1))


@cache
def allocation(band: int, percent: int) -> tuple[int, int, int]:
    """(H, segments, of these with neighbourhoods) of the least estimated cost for a middling set.

    Cost: signatures to store, plus candidates expected to be false, which get rarer with
    the shingles a signature covers, plus single shingles to store if too few segments are
    filled.  Weights are relative to one stored signature.
    """
    edges = band_edges(percent)
    size = max(1, (edges[band] + edges[band + 1] - 1) // 2)
    most = differences(band, percent)
    if not most:
        return 0, 1, 0
    best = (math.inf, 0, 0)
    for share in (0.0, 0.125, 0.25, 0.5, 1.0):
        for slack in (0.0, 0.04, 0.08, 0.15, 0.3):
            segments = max(1, math.ceil((most + 1) * (1 + slack) / (1 + share)))
            wide = math.ceil(segments * share)
            each = size / segments
            empty = math.exp(-each)
            trust = segments * (1 - empty) + wide * (1 - empty - each * empty)
            spread = math.sqrt(segments * empty * (1 - empty) + wide * (empty + each * empty)) + 1e-9
            if segments == 1:
                trust, spread = 1.0 + wide * (size > 1), 1e-9
            missing = 0.5 * math.erfc((trust - most - 0.5) / spread / math.sqrt(2))
            stored = segments * (1 - empty) + wide * each
            false = 60 * (segments * math.exp(-1.2 * each) + wide * each * math.exp(-1.2 * max(0.0, each - 1)))
            cost = stored + false + missing * size * 4
            best = min(best, (cost, segments, wide))
    return most, best[1], best[2]


def shingle_sets(block: Block, words: int) -> Iterator[np.ndarray]:
    """The set of each text: sorted hashes of its distinct shingles."""
    hashes, firsts = block.lowered().word_hashes()
    runs = shingle_hashes(hashes, words)
    for begin, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if end - begin >= words:
            yield np.unique(runs[begin : end - words + 1])
        else:
            yield shingle_hashes(hashes[begin:end], end - begin) if end > begin else np.zeros(0, np.uint64)


def set_number(shingles: np.ndarray) -> int:
    """A 64-bit name of a set's content."""
    return int(mixed(np.array([mixed(shingles).sum() + np.uint64(len(shingles))], np.uint64))[0].view(np.int64))


def band_of(size: int, percent: int) -> int:
    edges = band_edges(percent)
    low, high = 0, len(edges) - 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if edges[middle] <= size else (low, middle)
    return low


def signatures(shingles: np.ndarray, band: int, percent: int) -> np.ndarray:
    """The signatures of a set in a band."""
    most, segments, wide = allocation(band, percent)
    salt = np.uint64((band * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    own = mixed(shingles + salt)
    segment = ((own >> np.uint64(33)).astype(np.int64) * segments) >> 31
    counts = np.bincount(segment, minlength=segments)
    sums = np.zeros(segments, np.uint64)
    np.add.at(sums, segment, own)
    filled = np.flatnonzero(counts)
    found = [_named(sums[filled], filled, salt)]
    trusted = len(filled) + int((counts[:wide] > 1).sum())
    if wide:
        loose = (segment < wide) & (counts[segment] > 1)
        found.append(_named(sums[segment[loose]] - own[loose], segment[loose], salt))
    if trusted <= most:
        found.append(mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.concatenate(found)


def _named(sums: np.ndarray, segment: np.ndarray, salt: np.uint64) -> np.ndarray:
    return mixed(sums + mixed(segment.astype(np.uint64) + salt))


def _set_table(docs: DataFrame, words: int, passed: tuple[str, ...]) -> DataFrame:
    """Columns ``passed``, n and number of each document; number is null for an empty set."""
    kinds = dict(docs.dtypes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers = [], []
            for block in blocks(batch):
                for shingles in shingle_sets(block, words):
                    sizes.append(len(shingles))
                    numbers.append(set_number(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in passed), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64())],
                names=[*passed, "n", "number"],
            )

    schema = "".join(f"`{name}` {kinds[name]}, " for name in passed)
    return docs.select(*passed, "text").mapInArrow(handing_back(measure), f"{schema}n bigint, number bigint")


def _groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(signature, band, hub, member): sets sharing a signature, each with the smallest of its group."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, size // (16 << 20), 64)
    record = np.dtype([("signature", "<u8"), ("band", "<u1"), ("number", "<i8")])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        count = 0

        def deal() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = ((rows["signature"] >> np.uint64(32)).astype(np.int64) * buckets) >> 32
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            raw, ends = rows.tobytes(), np.append(begin[1:], len(rows))
            size = record.itemsize
            blobs = [raw[b * size : e * size] for b, e in zip(begin.tolist(), ends.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[begin]), pa.array(blobs, pa.binary())], names=["bucket", "rows"]
            )

        for batch in batches:
            for block in blocks(batch):
                for shingles in shingle_sets(block, words):
                    if not len(shingles) or (number := set_number(shingles)) in seen:
                        continue
                    seen.add(number)
                    band = band_of(len(shingles), percent)
                    # As the smaller or equal partner in its own band, as the larger in the one below.
                    for scheme in range(max(0, band - 1), band + 1):
                        found = signatures(shingles, scheme, percent)
                        rows = np.empty(len(found), record)
                        rows["signature"], rows["band"], rows["number"] = found, scheme, number
                        held.append(rows)
                        count += len(rows)
                if count > 1 << 19:
                    yield deal()
                    held, count = [], 0
        if count:
            yield deal()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for bucket, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != here and held:
                    yield from grouped(held)
                    held = []
                here = bucket
                held.append(rows)
        if held:
            yield from grouped(held)

    def grouped(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(held), record)
        signature, number = rows["signature"], rows["number"]
        # Only signatures that occur twice need to be ordered by set as well.
        order = np.argsort(signature, kind="stable")
        ordered = signature[order]
        same = ordered[1:] == ordered[:-1]
        order = order[np.append(same, False) | np.append(False, same)]
        signature, number, band = signature[order], number[order], rows["band"][order]
        order = np.lexsort((number, signature))
        signature, number, band = signature[order], number[order], band[order]
        if not len(signature):
            return
        new = np.append(True, signature[1:] != signature[:-1])
        hub = number[np.flatnonzero(new)[np.cumsum(new) - 1]]
        other = np.append(True, (number[1:] != number[:-1]) | new[1:]) & (number != hub)
        if other.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signature[other].view(np.int64)),
                    pa.array(band[other].astype(np.int32)),
                    pa.array(hub[other]),
                    pa.array(number[other]),
                ],
                names=["signature", "band", "hub", "member"],
            )

    dealt = texts(docs).select("text").mapInArrow(handing_back(index), "bucket bigint, rows binary")
    dealt = dealt.repartition(min(buckets, max(parts, 1)), "bucket").sortWithinPartitions("bucket")
    return keep(dealt.mapInArrow(handing_back(meet), "signature bigint, band int, hub bigint, member bigint"), "jaccard-groups")


def _shingles_of(docs: DataFrame, wanted: SortedTable, words: int) -> DataFrame:
    """(number, n, shingles) of the wanted sets, each once."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for block in blocks(batch):
                sets = [s for s in shingle_sets(block, words) if len(s)]
                numbers = np.array([set_number(s) for s in sets], np.int64)
                distinct = np.unique(numbers)
                good = set(distinct[wanted.find(distinct)[0] > 0].tolist()) - seen
                out = []
                for number, shingles in zip(numbers.tolist(), sets, strict=True):
                    if number in good:
                        good.discard(number)
                        seen.add(number)
                        out.append({"number": number, "n": len(shingles), "shingles": shingles.tobytes()})
                if out:
                    yield pa.RecordBatch.from_pylist(
                        out, schema=pa.schema([("number", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])
                    )

    found = texts(docs).select("text").mapInArrow(handing_back(fetch), "number bigint, n bigint, shingles binary")
    return keep(found, "jaccard-sets")


def _sketches(sets: DataFrame, percent: int) -> DataFrame:
    """(number, band, n, bitmap) of each set for the bands it was indexed in.

    A shingle flips one bit, so two sets differ in at least as many shingles as their
    bitmaps differ in bits.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = [("number", pa.int64()), ("band", pa.int32()), ("n", pa.int64()), ("bitmap", pa.binary())]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = mixed(np.frombuffer(row["shingles"], np.uint64) + np.uint64(1))
                top = band_of(row["n"], percent)
                for band in range(max(0, top - 1), top + 1):
                    bits = _bits(band, percent)
                    flips = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
                    out.append((row["number"], band, row["n"], np.packbits(flips & 1 == 1).tobytes()))
            columns = zip(*out, strict=True) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, (_, kind) in zip(columns, schema, strict=True)], schema=pa.schema(schema)
            )

    found = sets.mapInArrow(handing_back(draw), "number bigint, band int, n bigint, bitmap binary")
    return keep(found.dropDuplicates(["number", "band"]), "jaccard-sketches")


def _possible(left: np.ndarray, right: np.ndarray, n_left, n_right, percent: int) -> np.ndarray:
    """Which pairs sizes and bitmaps (rows of 64-bit words) leave possible."""
    most = n_left + n_right + 2 * (-percent * (n_left + n_right) // (100 + percent))
    fit = np.minimum(n_left, n_right) * 100 >= np.maximum(n_left, n_right) * percent
    return fit & (np.bitwise_count(left ^ right).sum(axis=1) <= most)


def _words(bitmaps: list[bytes]) -> np.ndarray:
    maps = np.frombuffer(b"".join(bitmaps), np.uint8).reshape(len(bitmaps), -1)
    return np.ascontiguousarray(np.pad(maps, ((0, 0), (0, -maps.shape[1] % 8)))).view(np.uint64)


def _sifted(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b, band) those that sketches leave possible."""
    of = lambda name: sketches.select(
        F.col("number").alias(name), "band", F.col("n").alias(f"n{name}"), F.col("bitmap").alias(f"m{name}")
    )
    both = pairs.join(of("b"), ["b", "band"]).join(of("a"), ["a", "band"])
    both = both.where(f"least(na, nb) * 100 >= greatest(na, nb) * {percent}")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            band, na, nb = (batch.column(name).to_numpy() for name in ("band", "na", "nb"))
            good = np.zeros(batch.num_rows, bool)
            ma, mb = batch.column("ma").to_pylist(), batch.column("mb").to_pylist()
            for own in np.unique(band):
                at = np.flatnonzero(band == own)
                left, right = _words([ma[k] for k in at]), _words([mb[k] for k in at])
                good[at] = _possible(left, right, na[at], nb[at], percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "band", "na", "nb", "ma", "mb").mapInArrow(handing_back(sift), "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    pairs = keep(pairs, "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("number")).union(pairs.select("b")).distinct()
    wanted = sorted_table(ends.withColumn("wanted", F.lit(1)), "number", "jaccard-ends")

    def needed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct, place = np.unique(batch.column("number").to_numpy(), return_inverse=True)
            yield batch.filter(pa.array(wanted.find(distinct)[0][place] > 0))

    # Sets nobody asks for stay where they are; the others travel once per side.
    few = sets.select("number", "shingles").mapInArrow(handing_back(needed_sets), "number bigint, shingles binary")
    few = keep(few.dropDuplicates(["number"]), "jaccard-asked")
    full = pairs.join(few.select(F.col("number").alias("b"), F.col("shingles").alias("right")), "b").join(
        few.select(F.col("number").alias("a"), F.col("shingles").alias("left")), "a"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return full.select("a", "b", "left", "right").mapInArrow(handing_back(verify), "a bigint, b bigint")


def _bits(band: int, percent: int) -> int:
    return min(1 << 16, 1 << (2 * band_edges(percent)[band + 1]).bit_length())


def _unsettled(
    groups: DataFrame,
    labels: DataFrame,
    sketches: DataFrame,
    percent: int,
    spanning: int | None = None,
    among: DataFrame | None = None,
    block: int = 1024,
) -> tuple[DataFrame, DataFrame]:
    """Pairs of one group in different components that sizes and bitmaps leave possible, and the groups that have some.

    The smallest member of a group has met all others already.  Groups with the same
    members are one, named by their least signature; ``among`` (signature) are those to look at.  A group of more than ``block`` members is dealt out as pairs of
    blocks, so no task holds more than two blocks.

    With ``spanning`` (a salt for the order of members) pairs are taken to be links as they are
    found, and only pairs that would join two components are: fewer than there are members.
    Without, all pairs are found.
    """
    label = labels.select(F.col("node").alias("member"), "label")
    rows = groups.select("signature", "band", "member").join(label, "member", "left")
    rows = keep(rows.withColumn("label", F.coalesce("label", "member")), "jaccard-members")
    open_groups = (
        rows.groupBy("signature", "band")
        .agg(
            F.count("*").alias("size"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.bit_xor(F.xxhash64("member")).alias("x"),
            F.bit_xor(F.xxhash64("member", F.lit(1))).alias("y"),
        )
        .where("low <> high")
        .groupBy("band", "size", "x", "y")
        .agg(F.min("signature").alias("signature"))
        .select("signature", "band", F.expr(f"cast(ceil(size / {block}) as int)").alias("blocks"))
    )
    if among is not None:
        open_groups = open_groups.join(among, "signature", "left_semi")
    rows = rows.join(open_groups, ["signature", "band"])
    own = F.expr("cast(pmod(xxhash64(member), blocks) as int)")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select(
        "signature", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "band", "member", "label"
    )
    rows = rows.join(sketches.withColumnRenamed("number", "member"), ["member", "band"])
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "signature", "band", "x", "y").sortWithinPartitions("signature", "band", "x", "y")

    pair = np.dtype([("a", "<i8"), ("b", "<i8")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, found, opened, count = None, [], [], [], 0

        def close() -> int:
            pairs = possible(held)
            if len(pairs):
                found.append(pairs)
                opened.append(here[0])
            return len(pairs)

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["signature"], row["band"], row["x"], row["y"])
                if key != here and held:
                    count += close()
                    held = []
                    if count > 1 << 20:
                        yield dealt_out(found, opened)
                        found, opened, count = [], [], 0
                here = key
                held.append(row)
        if held:
            close()
        if found:
            yield dealt_out(found, opened)

    def possible(held: list[dict]) -> np.ndarray:
        held.sort(key=lambda row: row["member"])
        number = np.array([row["member"] for row in held])
        if spanning is not None:
            order = np.argsort(mixed(number.view(np.uint64) + np.uint64(spanning)), kind="stable")
            held, number = [held[k] for k in order.tolist()], number[order]
        labels = np.array([row["label"] for row in held])
        n = np.array([row["n"] for row in held])
        own = np.array([row["own"] for row in held])
        across = held[0]["x"] != held[0]["y"]
        maps = _words([row["bitmap"] for row in held])
        pairs = [np.zeros(0, pair)]
        for i in range(len(held) - 1):
            apart = labels[i + 1 :] != labels[i]
            if across:
                apart &= own[i + 1 :] != own[i]
            at = np.flatnonzero(apart) + i + 1
            at = at[_possible(maps[at], maps[i], n[at], n[i], percent)]
            if spanning is not None and len(at):
                joined, first = np.unique(labels[at], return_index=True)
                at = at[first]
                labels[np.isin(labels, joined)] = labels[i]
            pairs.append(np.empty(len(at), pair))
            pairs[-1]["a"], pairs[-1]["b"] = np.minimum(number[i], number[at]), np.maximum(number[i], number[at])
        return np.concatenate(pairs)

    def dealt_out(found: list[np.ndarray], opened: list[int]) -> pa.RecordBatch:
        """Distinct pairs as blobs, one per bucket: groups overlap, so many report the same pair.  Bucket -1: groups."""
        pairs = np.unique(np.concatenate(found))
        bucket = (mixed(pairs["a"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        pairs, bucket = pairs[order], bucket[order]
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(begin[1:], len(pairs))[: len(begin)]
        blobs = [pairs[i:j].tobytes() for i, j in zip(begin.tolist(), ends.tolist(), strict=True)]
        blobs.append(np.unique(np.array(opened, np.int64)).tobytes())
        buckets = np.append(bucket[begin], -1)
        return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(blobs, pa.binary())], names=["bucket", "pairs"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(0, pair)
        for batch in batches:
            raw = b"".join(batch.column(1).to_pylist())
            pairs = np.unique(np.concatenate([pairs, np.frombuffer(raw, pair)]))
        yield pa.RecordBatch.from_arrays([pa.array(pairs["a"].copy()), pa.array(pairs["b"].copy())], names=["a", "b"])

    def signatures_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(blob.as_buffer(), np.int64))], names=["signature"])

    blobs = keep(dealt.mapInArrow(handing_back(compare), "bucket bigint, pairs binary"), "jaccard-unsettled")
    pairs = blobs.where("bucket >= 0").repartition(parts, "bucket").mapInArrow(handing_back(distinct), "a bigint, b bigint")
    return pairs, blobs.where("bucket < 0").mapInArrow(handing_back(signatures_of), "signature bigint").distinct()


def classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``passed`` of every row of ``docs`` (doc_id, text), n_shingles, and the ``class`` of connected sets.

    ``class`` is an arbitrary number, null for an empty set.  See :func:`join`.
    """
    prepare(docs.sparkSession)
    members = keep(_set_table(docs, words, passed), "jaccard-documents")
    groups = _groups(docs, words, percent)
    candidates = groups.select(F.col("hub").alias("number")).union(groups.select("member")).distinct()
    wanted = sorted_table(candidates.withColumn("wanted", F.lit(1)), "number", "jaccard-candidates")
    sets = _shingles_of(docs, wanted, words)

    sketches = _sketches(sets, percent)

    # Each set against the smallest member of each of its groups.
    pairs = groups.groupBy(F.col("hub").alias("a"), F.col("member").alias("b")).agg(F.min("band").alias("band"))
    links = keep(_verified(_sifted(pairs, sketches, percent), sets, percent), "jaccard-links")
    labels = components(links)
    # Among the others of a group: first pairs that span it, which leave few members apart even where all
    # are alike but unlike the smallest, then all that are left.
    opened = None
    for spanning in (1, None):
        pairs, opened = _unsettled(groups, labels, sketches, percent, spanning, opened)
        links = links.union(keep(_verified(pairs, sets, percent), "jaccard-links"))
        labels = components(links)

    named = members.join(labels.withColumnRenamed("node", "number"), "number", "left")
    return named.select(*passed, F.col("n").alias("n_shingles"), F.coalesce("label", "number").alias("class"))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * intersection >= ``percent`` * union of their sets
    of ``words``-word shingles (A-Z in lower case; fewer words: the whole sequence as one
    shingle; no word or a null text: empty, linked with nothing).  ``component_id`` is the
    smallest doc_id reachable by links, itself included.  Repeated rows are linked like
    any equal texts, and each keeps its row.  An empty table gives an empty result.
    """
    named = keep(classes(docs, words, percent), "jaccard-classes")
    # One row per class; empty sets have none.
    first = named.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return named.join(first, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def first_of_each_class(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps the one with the smallest doc_id (null last; then text hash).

    Rows without a word, null texts included, are in no class and all stay.  Of rows equal
    in doc_id and text one stays.
    """
    columns = docs.columns
    keyed = docs.select(F.struct(*columns).alias("row"), "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    named = classes(keyed, words, percent, ("doc_id", "hash"))
    first = (
        named.where("class is not null")
        .groupBy("class")
        .agg(F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "hash")).alias("first"))
        .select("first.doc_id", "first.hash")
        .distinct()
    )
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = join_rows(keyed.where(worded), first, ["doc_id", "hash"], "left_semi").dropDuplicates(["doc_id", "hash"])
    return kept.select("row").union(keyed.where(~worded).select("row")).select("row.*")


#: :func:`join` in SQL.
JOIN_SQL = r"""
with recursive words as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') as w
  from documents
),
shingles as (
  select distinct r, array_to_string(w[i:i + 4], chr(10)) as t
  from (select r, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)
),
sizes as (select r, count(*) as n from shingles group by r),
shared as (
  select a.r as x, b.r as y, count(*) as common
  from shingles a join shingles b on a.t = b.t and a.r <> b.r group by a.r, b.r
),
links as (
  select x, y from shared join sizes p on p.r = x join sizes q on q.r = y
  where 100 * common >= 80 * (p.n + q.n - common)
),
reached as (
  select r as x, r as y from words
  union
  select reached.x, links.y from reached join links on reached.y = links.x
)
select a.doc_id, coalesce(max(n), 0)::bigint as n_shingles, min(b.doc_id) as component_id
from reached join words a on a.r = reached.x join words b on b.r = reached.y left join sizes s on s.r = a.r
group by a.r, a.doc_id
"""
