"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item are compared where they share a run of ``min_match`` words (a
seed, found by its rolling hash).  Tiling then repeatedly marks the longest run of words that
both have and that no tile covers yet, down to ``min_match`` words.  Tiles do not overlap
and may come in any order, so a passage whose sentences were shuffled is still covered.
The share of the item's words under tiles decides.

Where seeds repeat so often that the places both have in common outnumber the words, the
longest match is looked for by Karp-Rabin hashes of all free runs of a length instead, which
takes memory in proportion to the words.  Both ways mark the same tiles.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from revloom.llm.blocks import Block, blocks, mixed, powers, shingle_hashes
from revloom.llm.shared import StoredBlocks, handing_back, prepare
from revloom.session import scratch_path

MIN_MATCH = 5
MIN_COVERAGE = 0.5
#: Benchmark text that a task reads at once.
PART_BYTES = 4 << 20
#: Parts a task keeps ready; it reads the others again for each batch.
HELD_PARTS = 4
#: Common places of two texts, per word of both, that are listed.
PAIRS_PER_WORD = 16


def tiles(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the places (i, j) where runs of ``size`` words agree.

    Returns tiles (i, j, length).  Of equally long matches the one with the smallest i,
    then j, is marked first.
    """
    diagonals = defaultdict(list)
    for i, j in pairs:
        diagonals[j - i].append(i)
    heap = []
    for shift, places in diagonals.items():
        places.sort()
        begin = last = places[0]
        for i in places[1:]:
            if i != last + 1:
                heap.append((-(last - begin + size), begin, begin + shift))
                begin = i
            last = i
        heap.append((-(last - begin + size), begin, begin + shift))
    heapq.heapify(heap)
    used_left: set[int] = set()
    used_right: set[int] = set()
    found = []
    while heap:
        length, i, j = heapq.heappop(heap)
        length = -length
        free = [i + k not in used_left and j + k not in used_right for k in range(length)]
        if all(free):
            found.append((i, j, length))
            used_left.update(range(i, i + length))
            used_right.update(range(j, j + length))
            continue
        begin = None
        for k, ok in enumerate([*free, False]):
            if ok and begin is None:
                begin = k
            elif not ok and begin is not None:
                if k - begin >= size:
                    heapq.heappush(heap, (-(k - begin), i + begin, j + begin))
                begin = None
    return found


def _free_runs(prefix: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs of ``length`` unmarked words, and their hashes."""
    held = np.concatenate([[0], np.cumsum(free)])
    places = np.flatnonzero(held[length:] - held[:-length] == length)
    _, down = powers(len(prefix))
    return places, mixed((prefix[places + length] - prefix[places]) * down[places])


def tiles_by_hash(left: np.ndarray, right: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """The tiles of :func:`tiles` for two sequences of word hashes, in memory linear in the words.

    The longest match that is still free is found by halving, as a free match of a length holds one
    of every smaller length; then all tiles of that length are marked.  At most as many
    lengths are tried as differ among the tiles.
    """
    prefixes = []
    for words in (left, right):
        up, _ = powers(len(words))
        prefixes.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)]))
    free = [np.ones(len(left), bool), np.ones(len(right), bool)]
    found = []
    top = min(len(left), len(right))
    while top >= size:
        low, high = size - 1, top  # the longest free match has ``low`` words or more
        while low < high:
            middle = (low + high + 1) // 2
            both = [_free_runs(prefix, own, middle)[1] for prefix, own in zip(prefixes, free, strict=True)]
            if np.isin(both[0], both[1]).any():
                low = middle
            else:
                high = middle - 1
        if low < size:
            break
        (starts, wanted), (places, runs) = (_free_runs(prefix, own, low) for prefix, own in zip(prefixes, free, strict=True))
        order = np.argsort(runs, kind="stable")
        places, runs = places[order], runs[order]
        begin, end = np.searchsorted(runs, wanted, "left"), np.searchsorted(runs, wanted, "right")
        passed: dict[int, int] = {}  # places of a run before this one are no longer free
        for i, first, stop in zip(*(column[end > begin].tolist() for column in (starts, begin, end)), strict=True):
            if not free[0][i : i + low].all():
                continue
            at = passed.get(first, first)
            while at < stop and not free[1][places[at] : places[at] + low].all():
                at += 1
            passed[first] = at
            if at < stop:
                j = int(places[at])
                found.append((i, j, low))
                free[0][i : i + low] = False
                free[1][j : j + low] = False
        top = low - 1
    return found


@dataclass
class Items:
    """Some benchmark items: the words of each, and for each seed length the sorted seeds and where they occur."""

    names: list
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _items(names: list, texts: list[str | None], min_match: int) -> Items:
    seeds = defaultdict(list)
    words = []
    for number, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        hashes, _ = Block(raw, np.array([0, len(raw)])).lowered().word_hashes()
        words.append(hashes)
        size = min(min_match, len(hashes))
        if size:
            found = shingle_hashes(hashes, size)
            seeds[size].append((found, np.full(len(found), number), np.arange(len(found))))
    sorted_seeds = {}
    for size, parts in seeds.items():
        found, number, place = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.argsort(found, kind="stable")
        sorted_seeds[size] = found[order], number[order], place[order]
    return Items(names, words, sorted_seeds)


def _crowded(
    words: np.ndarray, hit: np.ndarray, first: np.ndarray, count: np.ndarray, size: int, number: np.ndarray, place: np.ndarray, items: Items
) -> list[tuple[int, float]]:
    """Coverage of the items that share seeds with one text, which are at ``hit`` in it; one item at a time."""
    seed, which, times = np.unique(first, return_inverse=True, return_counts=True)
    order = np.argsort(which, kind="stable")
    of_seed = np.split(hit[order], np.cumsum(times)[:-1])
    width = np.zeros(len(seed), np.int64)
    width[which] = count
    # Each place of a common seed in an item once: bounded by the part of the benchmark.
    at = np.repeat(seed - np.cumsum(width) + width, width) + np.arange(width.sum())
    kind = np.repeat(np.arange(len(seed)), width)
    by_item = np.argsort(number[at], kind="stable")
    at, kind = at[by_item], kind[by_item]
    edges = np.flatnonzero(np.diff(number[at], prepend=-1, append=-1))
    found = []
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        item = int(number[at[begin]])
        other = items.words[item]
        if times[kind[begin:end]].sum() > PAIRS_PER_WORD * (len(words) + len(other)):
            marked = tiles_by_hash(other, words, size)
        else:
            both = zip(place[at[begin:end]].tolist(), kind[begin:end].tolist(), strict=True)
            marked = tiles([(i, j) for i, k in both for j in of_seed[k].tolist()], size)
        found.append((item, sum(length for _, _, length in marked) / len(other)))
    return found


def _coverage(block: Block, items: Items) -> list[list[tuple[int, float]]]:
    """For each text the items it shares a seed with, and how much of each is tiled."""
    hashes, firsts = block.lowered().word_hashes()
    found: list[list[tuple[int, float]]] = [[] for _ in range(len(block))]
    for size, (seeds, number, place) in items.seeds.items():
        runs = shingle_hashes(hashes, size)
        low = np.searchsorted(seeds, runs, "left")
        hit = np.flatnonzero(seeds[np.minimum(low, len(seeds) - 1)] == runs)
        if not len(hit):
            continue
        owner = np.searchsorted(firsts, hit, "right") - 1
        inside = hit + size <= firsts[owner + 1]  # a run must not cross into the next text
        hit, owner = hit[inside], owner[inside]
        first = low[hit]
        count = np.searchsorted(seeds, runs[hit], "right") - first
        # Texts with very many common places are settled one by one.
        sizes = np.diff(firsts)
        many = np.bincount(owner, count, len(block)) > PAIRS_PER_WORD * sizes
        for text in np.flatnonzero(many).tolist():
            own = owner == text
            words = hashes[firsts[text] : firsts[text + 1]]
            found[text] += _crowded(words, hit[own] - firsts[text], first[own], count[own], size, number, place, items)
        few = ~many[owner]
        hit, owner, first, count = hit[few], owner[few], first[few], count[few]
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        pairs = defaultdict(list)
        texts, places = np.repeat(owner, count).tolist(), np.repeat(hit - firsts[owner], count).tolist()
        for text, item, i, j in zip(texts, number[at].tolist(), place[at].tolist(), places, strict=True):
            pairs[text, item].append((i, j))
        for (text, item), both in pairs.items():
            covered = sum(length for _, _, length in tiles(both, size))
            found[text].append((item, covered / len(items.words[item])))
    return found


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    passed: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``passed`` columns of every row of ``docs`` (with text), n_items, best_item, best_coverage, contaminated.

    ``benchmark`` has item_id and text; words are runs without white space, A-Z in lower
    case.  An item of fewer than ``min_match`` words has to occur whole; one without words,
    null included, is never found.  ``n_items`` counts items covered to ``min_coverage`` or
    more; ``best_item`` is the best covered (ties: the smallest item_id, null first), null without any
    common seed.  Repeated rows and items are treated each on their own.  Empty tables
    give no rows or no contamination.

    The benchmark is stored in files of about ``PART_BYTES`` of text, which a task reads one
    after the other for each of its batches; ``HELD_PARTS`` of them stay ready.  ``docs`` is read
    once, without a shuffle, however large the benchmark is.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64).alias("bytes")).first()["bytes"] or 0
    parts = max(1, -(-size // PART_BYTES))
    kind = dict(items.dtypes)["item_id"]
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    folder = scratch_path(spark, "benchmark-parts")
    items.repartition(parts, F.xxhash64("item_id", "text")).write.parquet(folder)
    stored = StoredBlocks(sorted(spark.read.schema(items.schema).parquet(folder).inputFiles()), cached_bytes=0)
    kinds = dict(docs.select(*passed).dtypes)
    schema = ", ".join([f"`{name}` {kinds[name]}" for name in passed])
    added = f"`n items` bigint, `best item` {kind}, `best coverage` double"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Items] = {}

        def every_part() -> Iterator[Items]:
            for index in range(len(stored.paths)):
                part = held.get(index)
                if part is None:
                    table = stored.load(index)
                    part = _items(table.column("item_id").to_pylist(), table.column("text").to_pylist(), min_match)
                    if len(held) < HELD_PARTS:
                        held[index] = part
                yield part

        for batch in batches:
            counts, best, score = [0] * batch.num_rows, [None] * batch.num_rows, [0.0] * batch.num_rows
            for part in every_part():
                for block in blocks(batch):
                    for index, found in enumerate(_coverage(block, part)):
                        row = block.first + index
                        for item, covered in found:
                            counts[row] += covered >= min_coverage
                            name = part.names[item]
                            # Ties go by item_id, null first, in whatever part an item lies.
                            tie = covered == score[row] > 0 and (name is not None, name) < (best[row] is not None, best[row])
                            if covered > score[row] or tie:
                                best[row], score[row] = name, covered
            columns = [batch.column(name) for name in passed]
            columns += [pa.array(counts, pa.int64()), pa.array(best, item_type), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, "n items", "best item", "best coverage"])

    frame = docs.select(*passed, "text") if "text" not in passed else docs.select(*passed)
    frame = frame.mapInArrow(handing_back(compare), f"{schema}, {added}")
    return frame.select(
        *passed,
        F.col("n items").alias("n_items"),
        F.col("best item").alias("best_item"),
        F.col("best coverage").alias("best_coverage"),
        (F.col("n items") > 0).alias("contaminated"),
    )
