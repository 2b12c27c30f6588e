"""Ranked lexical search by presence masks.

Documents are indexed in segments: for every term of the queries the documents that hold it
and how often.  Within a segment an item's documents are grouped by mask, the bitmap of
which of the item's terms they hold.  A mask's greatest possible score is the sum over its
terms of what the term can add at most in this segment.  Masks are taken in descending order
of that bound, and their documents scored, until no mask left can reach the worst of the best
documents found.  Segments are independent; their best meet in one top-k.  Terms are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.blocks import blocks
from revloom.llm.shared import SortedTable, StoredBlocks, keep, prepare, sorted_table, stored_blocks, texts

BEST = 10
#: A segment ends at so many documents or so many entries.
SEGMENT_DOCUMENTS = 8192
SEGMENT_ENTRIES = 1 << 21
#: Segments that a task holds at once, in entries; queries are read once for each such lot.
LOT_ENTRIES = 1 << 22
#: Items in a file of queries.
ITEMS_PER_FILE = 1024
#: Documents scored between two looks at the bound.
STEP = 256

#: Bytes of no term: ASCII other than digits and letters.
_BORDER = np.ones(256, bool)
_BORDER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def query_terms(items: DataFrame) -> DataFrame:
    """(item, term, repeats): the terms (hashes) of each text of ``items`` (item, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                hashes, firsts = block.lowered().word_hashes(_BORDER)
                owner = batch.column("item").to_numpy()[block.first : block.first + len(block)]
                for k, (begin, end) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
                    terms, repeats = np.unique(hashes[begin:end], return_counts=True)
                    columns = [np.full(len(terms), owner[k]), terms.view(np.int64), repeats]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["item", "term", "repeats"])

    return items.select("item", "text").mapInArrow(cut, "item bigint, term bigint, repeats bigint")


def index(docs: DataFrame, terms: SortedTable) -> DataFrame:
    """Segments over ``docs`` (doc_id, text), stored: one row each.

    ``docs`` lists doc_id and n, the number of terms, in order of doc_id (null last).
    ``terms`` has the sorted terms of the queries that occur, ``starts`` where the entries
    of each begin in ``places`` (of documents, ascending) and ``counts``.  ``n_documents`` and
    ``n_terms`` count documents with a term, and all their terms with repeats.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        documents = entries = 0

        def segment() -> pa.RecordBatch:
            ids, sizes, term, place, count = zip(*held, strict=True)
            ids = pa.concat_arrays(ids)
            names = ids.to_pylist()
            order = sorted(range(len(names)), key=lambda k: (names[k] is None, 0 if names[k] is None else names[k]))
            order = np.array(order, np.int64)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            begins = np.cumsum([0, *map(len, sizes)])[:-1]
            sizes = np.concatenate(sizes)
            term, count = np.concatenate(term), np.concatenate(count)
            place = rank[np.concatenate([own + at for own, at in zip(place, begins.tolist(), strict=True)])]
            by = np.lexsort((place, term))
            term, place, count = term[by], place[by], count[by]
            distinct, starts = np.unique(term, return_index=True)
            listed = pa.StructArray.from_arrays([ids.take(pa.array(order)), pa.array(sizes[order])], names=["doc_id", "n"])
            blobs = [distinct, np.append(starts, len(term)).astype(np.int64), place.astype(np.int32), count.astype(np.int32)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed),
                    *(pa.array([blob.tobytes()], pa.binary()) for blob in blobs),
                    pa.array([int((sizes > 0).sum())]),
                    pa.array([int(sizes.sum())]),
                ],
                names=["docs", "terms", "starts", "places", "counts", "n_documents", "n_terms"],
            )

        for batch in batches:
            for block in blocks(batch):
                hashes, firsts = block.lowered().word_hashes(_BORDER)
                distinct, column = np.unique(hashes.view(np.int64), return_inverse=True)
                (known,) = terms.find(distinct)
                cell = column + np.repeat(np.arange(len(block)) * max(1, len(distinct)), np.diff(firsts))
                cell, count = np.unique(cell[known[column] > 0], return_counts=True)
                place, column = np.divmod(cell, max(1, len(distinct)))
                own = pa.array(np.arange(block.first, block.first + len(block)))
                held.append((batch.column("doc_id").take(own), np.diff(firsts), distinct[column], place, count))
                documents, entries = documents + len(block), entries + len(cell)
                if documents >= SEGMENT_DOCUMENTS or entries >= SEGMENT_ENTRIES:
                    yield segment()
                    held, documents, entries = [], 0, 0
        if held:
            yield segment()

    made = texts(docs).mapInArrow(
        build,
        f"docs array<struct<doc_id: {kind}, n: bigint>>, terms binary, starts binary, places binary, counts binary, "
        "n_documents bigint, n_terms bigint",
    )
    return keep(made, "lexical-segments")


def weights(segments: DataFrame, terms: DataFrame, documents: int) -> DataFrame:
    """(term, w) of the query terms that some document holds, by how many documents hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for term, starts in zip(batch.column("terms"), batch.column("starts"), strict=True):
                own = np.frombuffer(term.as_buffer(), "<i8")
                held = np.diff(np.frombuffer(starts.as_buffer(), "<i8"))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(held)], names=["term", "df"])

    held = segments.select("terms", "starts").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1).cast("double")
    return terms.join(held, "term").select("term", F.floor(1000 * F.log(ratio)).cast("bigint").alias("w"))


@dataclass
class Segment:
    """A segment in arrays, and what each of its entries adds per unit of weight."""

    ids: pa.Array
    terms: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    added: np.ndarray
    most: np.ndarray = field(init=False)

    def __post_init__(self):
        self.most = np.maximum.reduceat(self.added, self.starts[:-1]) if len(self.terms) else np.zeros(0, np.int64)


def _segment(batch: pa.RecordBatch, k: int, documents: int, terms: int) -> Segment:
    listed = batch.column("docs")[k].values
    arrays = [
        np.frombuffer(batch.column(name)[k].as_buffer(), kind)
        for name, kind in (("terms", "<i8"), ("starts", "<i8"), ("places", "<i4"), ("counts", "<i4"))
    ]
    sizes, own = np.unique(listed.field("n").to_numpy(), return_inverse=True)
    # Python integers, as 75 * n * N may leave 64 bits.
    m = np.array([25 + 75 * n * documents // max(1, terms) for n in sizes.tolist()], np.int64)[own]
    count = arrays[3].astype(np.int64)
    added = 1_000_000_000 * count // (1000 * count + 8 * m[arrays[2]])
    return Segment(listed.field("doc_id"), *arrays[:3], added)


def best_of(segment: Segment, terms: np.ndarray, factors: np.ndarray, best: int, floor: int = 1) -> list[tuple[int, int]]:
    """(score, place) of the best documents of a segment that score ``floor`` or more, best first, ties by place.

    ``terms`` are the item's distinct terms in ascending order, ``factors`` their weights
    times repeats.
    """
    at = np.searchsorted(segment.terms, terms)
    hit = np.flatnonzero(segment.terms[np.minimum(at, len(segment.terms) - 1)] == terms) if len(segment.terms) else at[:0]
    hit = hit[factors[hit] > 0]
    at, factors = at[hit], factors[hit]
    if not len(at) or int((segment.most[at] * factors).sum()) < floor:
        return []
    lists = [segment.places[segment.starts[t] : segment.starts[t + 1]] for t in at.tolist()]
    masks = np.zeros((len(segment.ids), -(-len(at) // 64)), np.uint64)
    for k, own in enumerate(lists):
        masks[own, k // 64] |= np.uint64(1 << k % 64)
    present = np.flatnonzero(masks.any(axis=1))
    masks = masks[present]
    if masks.shape[1] == 1:
        distinct, group = np.unique(masks[:, 0], return_inverse=True)
        distinct = distinct[:, None]
    else:
        distinct, group = np.unique(masks, axis=0, return_inverse=True)
    bound = np.zeros(len(distinct), np.int64)
    for k, t in enumerate(at.tolist()):
        bits = (distinct[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
        bound += bits.astype(np.int64) * (segment.most[t] * factors[k])
    order = np.argsort(-bound, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    by = np.argsort(rank[group], kind="stable")  # documents by mask, best bound first, then by place
    present, bound = present[by], bound[group[by]]
    kept_score, kept_place = np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = 0
    while begin < len(present):
        if bound[begin] < floor:
            break
        # Whole masks, and at least one step of documents.
        end = min(len(present), begin + STEP)
        end = len(bound) - int(np.searchsorted(bound[::-1], bound[end - 1], "left"))
        places = np.sort(present[begin:end])
        score = np.zeros(len(places), np.int64)
        for t, own, factor in zip(at.tolist(), lists, factors.tolist(), strict=True):
            where = np.minimum(np.searchsorted(own, places), len(own) - 1)
            same = own[where] == places
            score[same] += factor * segment.added[segment.starts[t] + where[same]]
        good = score >= floor
        kept_score = np.concatenate([kept_score, score[good]])
        kept_place = np.concatenate([kept_place, places[good]])
        first = np.lexsort((kept_place, -kept_score))[:best]
        kept_score, kept_place = kept_score[first], kept_place[first]
        if len(first) == best:
            floor = max(floor, int(kept_score[-1]))
        begin = end
    return list(zip(kept_score.tolist(), kept_place.tolist(), strict=True))


def _found(segments: DataFrame, queries: StoredBlocks, documents: int, terms: int, best: int, item_kind: str) -> DataFrame:
    """(item, item_id, doc_id, score): for each item the best documents of each lot of segments."""
    kind = segments.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot: list[Segment] = []
        entries = 0

        def answers() -> Iterator[pa.RecordBatch]:
            for _, table in queries:
                rows, ids, scores = [], [], []
                columns = [table.column(n).combine_chunks() for n in ("terms", "factors")]
                for row in range(table.num_rows):
                    own, factors = (column[row].values.to_numpy() for column in columns)
                    found, floor = [], 1
                    for number, segment in enumerate(lot):
                        more = [(score, number, place) for score, place in best_of(segment, own, factors, best, floor)]
                        found = sorted(found + more, key=lambda f: -f[0])
                        # Later segments have to reach the worst of the best; ties are settled by doc_id later.
                        if len(found) >= best:
                            floor = max(floor, found[best - 1][0])
                            found = [f for f in found if f[0] >= floor]
                    for score, number, place in found:
                        rows.append(row)
                        ids.append(lot[number].ids[place])
                        scores.append(score)
                if rows:
                    taken = table.select(["item", "item_id"]).take(rows).combine_chunks().to_batches()[0]
                    # Scalars of one type, so the type of the segments' ids holds.
                    ids = pa.array([x.as_py() for x in ids], lot[0].ids.type)
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, ids, pa.array(scores, pa.int64())], names=["item", "item_id", "doc_id", "score"]
                    )

        for batch in batches:
            for k in range(batch.num_rows):
                lot.append(_segment(batch, k, documents, terms))
                entries += len(lot[-1].places)
                if entries >= LOT_ENTRIES:
                    yield from answers()
                    lot, entries = [], 0
        if lot:
            yield from answers()

    used = segments.select("docs", "terms", "starts", "places", "counts")
    return used.mapInArrow(search, f"item bigint, item_id {item_kind}, doc_id {kind}, score bigint")


def search(docs: DataFrame, benchmark: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of ``docs`` (doc_id, text) for each item of ``benchmark`` (item_id, text).

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case.  With N
    documents that hold a term, L terms in all of them, n terms in a document, a term's
    weight is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and a document's m is
    ``25 + 75 n N div L``; it scores the sum over the item's terms, repeats included, of weight
    times ``1e9 tf div (1000 tf + 8 m)``.  Only scores above 0 count; ties go to the smaller
    doc_id, null last.  A null text has no terms; an item without terms, or whose terms no
    document holds, has no row.  Repeated documents rank each; an item_id with several
    different texts has a ranking for each of them.  Empty tables give no rows.

    ``docs`` is read once.  Queries are stored in files of bounded size, which every lot of
    segments reads one after the other, so neither side is held whole.
    """
    prepare(docs.sparkSession)
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates()
    items = keep(items.select(F.monotonically_increasing_id().alias("item"), "*"), "lexical-items")
    asked = keep(query_terms(items), "lexical-terms")
    distinct = asked.select("term").distinct()
    segments = index(docs, sorted_table(distinct.withColumn("asked", F.lit(1)), "term", "lexical-vocabulary"))
    total = segments.agg(F.sum("n_documents").alias("documents"), F.sum("n_terms").alias("terms")).first()
    documents, terms = total["documents"] or 0, total["terms"] or 0
    weighed = asked.join(weights(segments, distinct, documents), "term").where("w > 0")
    entry = F.struct("term", (F.col("w") * F.col("repeats")).alias("factor"))
    queries = weighed.groupBy("item").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    queries = items.select("item", "item_id").join(queries, "item")
    queries = queries.select("item", "item_id", F.col("entries.term").alias("terms"), F.col("entries.factor").alias("factors"))
    stored = stored_blocks(queries, "lexical-queries", ITEMS_PER_FILE)
    found = _found(segments, stored, documents, terms, best, dict(items.dtypes)["item_id"])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")


#: :func:`search` in SQL.
SEARCH_SQL = r"""
with texts as (
  select row_number() over () as d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents
),
held as (select d, doc_id, len(t)::bigint as n, t from texts where len(t) > 0),
totals as (select count(*)::bigint as documents, sum(n)::bigint as terms from held),
frequencies as (select d, term, count(*)::bigint as tf from (select d, unnest(t) as term from held) group by d, term),
found as (select term, count(*)::bigint as df from frequencies group by term),
items as (
  select item_id, text as asked, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select distinct item_id, text from benchmark)
),
scores as (
  select item_id, asked, d,
         sum(floor(1000 * ln((2 * documents + 2)::double / (2 * df + 1)::double))::bigint
             * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // terms))))::bigint as score
  from items join found using (term) join frequencies using (term) join held using (d), totals
  group by item_id, asked, d
),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id, asked order by score desc, doc_id nulls last)::int as rank
  from scores join held using (d) where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
