"""Nearest neighbours by collision counting over sorted single projections.

Every vector is projected on ``PROJECTIONS`` random normal directions.  A segment of the index
keeps its vectors and, for each direction, its values in sorted order.  For a radius R a query
opens a window of half width ``WIDTH`` * R around its own value in every direction (virtual
rehashing: the windows of a larger radius hold those of a smaller one).  The difference of
two vectors at distance d is normal with deviation d in every direction, so a vector within R
collides in a direction with a known probability, and in at least :func:`threshold` of all
directions with probability ``CAUGHT``.  Vectors that reach the threshold are verified on the
original vectors.

Two passes.  The first expands the windows of a query in each segment, as many values in each
direction, until enough vectors reach the threshold; those that collide most are verified,
and the k-th nearest of all bounds the radius.  The second opens windows of that radius in
all segments, or of a smaller one as soon as k nearer vectors are known: each true neighbour
lies within it, so it is missed with probability 1 - ``CAUGHT`` at most, unless the first pass
had it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.shared import StoredBlocks, keep, prepare, stored_blocks

BEST = 10
PROJECTIONS = 128
WIDTH = 1.5
CAUGHT = 0.97
#: In the first pass windows grow by this factor, and so many times the vectors asked for are verified in a segment.
GROWTH = 4
EXPANDED = 5
#: Vectors of a segment (below 2 ** 16), and of all segments that a task holds at once.
SEGMENT_VECTORS = 8192
LOT_VECTORS = 65536
QUERIES_PER_FILE = 1024


@cache
def directions(dimension: int) -> np.ndarray:
    return np.random.default_rng(20240615).standard_normal((dimension, PROJECTIONS))


@cache
def threshold(projections: int = PROJECTIONS, width: float = WIDTH, caught: float = CAUGHT) -> int:
    """The most collisions that a vector at the radius reaches with probability ``caught``."""
    p = math.erf(width / math.sqrt(2))
    tail = 0.0
    for count in range(projections, -1, -1):
        tail += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if tail >= caught:
            return count
    return 0


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, components as doubles."""
    vector = F.col("embedding")
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & vector.isNotNull() & plain & F.exists(vector, lambda x: x != 0)
    return vectors.where(good).select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("vector"))


def index(vectors: DataFrame) -> DataFrame:
    """Segments of the index over ``vectors`` (vec_id, vector), stored: one row each.

    ``ids`` ascend; ``vectors`` are in that order; ``orders`` and ``values`` hold for each
    direction the vectors' places in order of their values, and the values.
    """
    count = vectors.count()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def segment(dimension: int) -> pa.RecordBatch:
            ids, rows = (np.concatenate(column) for column in zip(*held.pop(dimension), strict=True))
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], rows[order]
            projected = np.ascontiguousarray((rows @ directions(dimension)).T)
            orders = np.argsort(projected, axis=1).astype(np.uint16)
            with np.errstate(over="ignore"):  # windows at infinite values hold all vectors
                values = np.take_along_axis(projected, orders.astype(np.int64), 1).astype(np.float32)
            blobs = [pa.array([blob.tobytes()], pa.binary()) for blob in (ids, rows, orders, values)]
            return pa.RecordBatch.from_arrays(
                [pa.array([dimension]), *blobs], names=["dimension", "ids", "vectors", "orders", "values"]
            )

        for batch in batches:
            ids, lists = batch.column("vec_id").to_numpy(), batch.column("vector")
            sizes = np.diff(lists.offsets.to_numpy())
            flat, starts = lists.values.to_numpy(), lists.offsets.to_numpy()[:-1]
            for dimension in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dimension)
                for begin in range(0, len(own), SEGMENT_VECTORS):
                    taken = own[begin : begin + SEGMENT_VECTORS]
                    rows = flat[starts[taken][:, None] + np.arange(dimension)]
                    there = held.setdefault(dimension, [])
                    if sum(len(i) for i, _ in there) + len(taken) > SEGMENT_VECTORS:
                        yield segment(dimension)
                        there = held.setdefault(dimension, [])
                    there.append((ids[taken], rows))
        for dimension in list(held):
            yield segment(dimension)

    # Rows are dealt round: segments are full whatever the files are like, and no id is hot.
    dealt = vectors.repartition(max(1, -(-count // SEGMENT_VECTORS)))
    made = dealt.mapInArrow(build, "dimension bigint, ids binary, vectors binary, orders binary, values binary")
    return keep(made, "nearest-segments")


class Segment:
    """A segment in arrays."""

    def __init__(self, batch: pa.RecordBatch, k: int) -> None:
        def blob(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(batch.column(name)[k].as_buffer(), kind)

        self.dimension = batch.column("dimension")[k].as_py()
        self.ids = blob("ids", "<i8")
        self.vectors = blob("vectors", "<f8").reshape(len(self.ids), -1)
        self.orders = blob("orders", "<u2").reshape(PROJECTIONS, -1)
        self.values = blob("values", "<f4").reshape(PROJECTIONS, -1)
        # Values are rounded to 24 bits: windows are wider by that.
        self.slack = 2.0**-22 * (1e-30 + float(np.abs(self.values[:, [0, -1]]).max()))

    def windows(self, centre: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the window around ``centre`` in every direction."""
        half += self.slack
        low, high = (centre - half).astype(np.float32), (centre + half).astype(np.float32)
        begin = np.array([v.searchsorted(x, "left") for v, x in zip(self.values, low, strict=True)])
        end = np.array([v.searchsorted(x, "right") for v, x in zip(self.values, high, strict=True)])
        return begin, end

    def count(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each vector lies in ``begin:end`` of a direction's order."""
        cuts = [own[b:e] for own, b, e in zip(self.orders, begin.tolist(), end.tolist(), strict=True)]
        return np.bincount(np.concatenate(cuts), minlength=len(self.ids))

    def collisions(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many windows each vector lies in, counted from within or from without, whichever is less."""
        size = len(self.ids)
        if 2 * int((end - begin).sum()) <= size * PROJECTIONS:
            return self.count(begin, end)
        return PROJECTIONS - self.count(np.zeros_like(begin), begin) - self.count(end, np.full_like(end, size))

    def distances(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Euclidean distances of the original vectors."""
        return np.sqrt(((self.vectors[places] - query) ** 2).sum(axis=1))

    def expand(self, centre: np.ndarray, wanted: int) -> np.ndarray:
        """The ``wanted`` vectors that collide most, once so many reach the threshold or windows hold a quarter of all."""
        size = len(self.ids)
        if size <= wanted:
            return np.arange(size)
        near = np.array([v.searchsorted(x) for v, x in zip(self.values, centre.astype(np.float32), strict=True)])
        begin = end = near
        counts, reach = np.zeros(size, np.int64), wanted
        while True:
            wider = np.maximum(near - reach, 0), np.minimum(near + reach, size)
            counts += self.count(wider[0], begin) + self.count(end, wider[1])  # only what the windows gained
            begin, end = wider
            if int((counts >= threshold()).sum()) >= wanted or 8 * reach >= size:
                return np.argpartition(-counts, wanted)[:wanted]
            reach = min(reach * GROWTH, -(-size // 8))


def _answers(segments: DataFrame, queries: StoredBlocks, best: int, expand: bool) -> DataFrame:
    """(query_id, vec_id, score): per query and lot of segments the best of what was verified."""

    def answer(lot: list[Segment], own: int, query: np.ndarray, centre: np.ndarray, radius: float | None):
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        bound = math.inf if radius is None else radius
        for segment in lot:
            if segment.dimension != len(query):
                continue
            if expand:
                places = segment.expand(centre, EXPANDED * best + 1)
            else:
                places = np.flatnonzero(segment.collisions(*segment.windows(centre, WIDTH * bound)) >= threshold())
            places = places[segment.ids[places] != own]
            ids = np.concatenate([ids, segment.ids[places]])
            scores = np.concatenate([scores, segment.distances(places, query)])
            order = np.lexsort((ids, scores))
            ids, scores = ids[order], scores[order]
            # A row of the same id counts once, at its nearest.
            first = np.sort(np.unique(ids, return_index=True)[1])[:best]
            ids, scores = ids[first], scores[first]
            if len(ids) == best:
                bound = min(bound, float(scores[-1]))
        return ids, scores

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot: list[Segment] = []

        def answers() -> Iterator[pa.RecordBatch]:
            for _, table in queries:
                names, lists = table.column("query_id").to_pylist(), table.column("vector").combine_chunks()
                radii = table.column("radius").to_pylist()
                found = []
                for k, (own, radius) in enumerate(zip(names, radii, strict=True)):
                    query = lists[k].values.to_numpy()
                    with np.errstate(over="ignore"):
                        ids, scores = answer(lot, own, query, query @ directions(len(query)), radius)
                    found.append((np.full(len(ids), own, np.int64), ids, scores))
                if found:
                    columns = [pa.array(np.concatenate(column)) for column in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

        for batch in batches:
            for k in range(batch.num_rows):
                lot.append(Segment(batch, k))
                if sum(len(segment.ids) for segment in lot) >= LOT_VECTORS:
                    yield from answers()
                    lot = []
        if lot:
            yield from answers()

    return segments.mapInArrow(search, "query_id bigint, vec_id bigint, score double")


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, queries: DataFrame, best: int = BEST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``best`` nearest of ``vectors`` found for each of ``queries`` (both vec_id, embedding).

    The score is the Euclidean distance in double precision; ties go to the smaller vec_id.
    A query's own vec_id is no candidate.  Rows take no part whose vec_id is null or whose
    vector is null, empty, all zeros, or holds a null or non-finite component; a query meets
    vectors of its own length only.  Rows that share a vec_id count once, at their nearest;
    queries that share one are one query, with the least vector.  With fewer than ``best``
    candidates all are found.  Empty tables give no rows.  Found neighbours are true
    distances; a true neighbour is missed with probability 1 - ``CAUGHT`` at most.

    Every row is indexed.  Queries are stored in files of bounded size that each lot of
    segments reads one after the other, once in each pass.
    """
    prepare(vectors.sparkSession)
    asked = usable(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked = keep(asked, "nearest-queries")
    segments = index(usable(vectors))
    open_queries = stored_blocks(asked.withColumn("radius", F.lit(None).cast("double")), "nearest-open", QUERIES_PER_FILE)
    first = keep(_ranked(_answers(segments, open_queries, best, True), best), "nearest-first")
    # With fewer than ``best`` found every candidate has been verified.
    bounded = asked.join(first.where(F.col("rank") == best).select("query_id", F.col("score").alias("radius")), "query_id")
    bounded_queries = stored_blocks(bounded, "nearest-bounded", QUERIES_PER_FILE)
    second = _answers(segments, bounded_queries, best, False)
    return _ranked(first.select("query_id", "vec_id", "score").union(second), best)
