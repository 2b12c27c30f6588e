"""Audit of five text filters and how they interact, from a sparse document-term matrix.

Texts become shards of a CSR matrix: row i of a shard holds, for every distinct word of its
i-th document, a column and how often the word occurs.  Within a shard columns are local;
``columns`` maps them to the global numbers of the words, which come from one dictionary over
all shards.  Encoding shuffles the (word hash, shard) pairs once to rank the words and once
back, so no task ever reads the whole dictionary.  Row sums and nonzero counts of
the matrix decide the filters on length and repetition.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.blocks import BLOCK_BYTES, Block, blocks
from revloom.llm.shared import keep, prepare

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = "#$%&*|"
FILTERS = "ABCDE"
#: Text of a shard; a longer text is a shard of its own.
SHARD_BYTES = 16 << 20

_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[ord("A") : ord("Z") + 1] = 1
_POINT = np.ones(256, np.int64)
_POINT[0x80:0xC0] = 0
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1


def _sums(table: np.ndarray, block: Block) -> np.ndarray:
    """Per text the sum of ``table`` over its bytes."""
    total = np.concatenate([[0], np.cumsum(table[block.data])])
    return total[block.bounds[1:]] - total[block.bounds[:-1]]


def csr(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, columns, counts, hashes) of rows with so many word hashes each, columns in order of the word's hash."""
    hashes, column = np.unique(words, return_inverse=True)
    width = max(1, len(hashes))
    column += np.repeat(np.arange(len(lengths)) * width, lengths)
    cells, counts = np.unique(column, return_counts=True)
    starts = np.searchsorted(cells, np.arange(len(lengths) + 1) * width)
    return starts, (cells % width).astype(np.int32), counts.astype(np.int32), hashes.view(np.int64)


def _simple_flags(block: Block) -> np.ndarray:
    flags = 4 * (100 * _sums(_CAPITAL, block) > MAX_CAPITAL_PERCENT * _sums(_POINT, block))
    return (flags + 8 * (_sums(_SYMBOL, block) > 0)).astype(np.int32)


def _digests(block: Block) -> np.ndarray:
    places = zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), strict=True)
    pairs = [divmod(xxhash.xxh3_128_intdigest(block.data[b:e]), 1 << 64) for b, e in places]
    return np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)


def shards(docs: DataFrame) -> DataFrame:
    """(shard, docs, starts, columns, counts, hashes): the matrix with local columns, stored.

    ``docs`` lists doc_id, part, a 128-bit hash of the text, and flags of the filters that need
    no matrix: 4 (capital letters) and 8 (symbols).
    """
    rows = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            doc_id, part, words, lengths, digests, flags = zip(*held, strict=True)
            digest = np.concatenate(digests)
            fields = {
                "doc_id": pa.concat_arrays(doc_id),
                "part": pa.concat_arrays(part),
                "high": pa.array(digest[:, 0].copy()),
                "low": pa.array(digest[:, 1].copy()),
                "flags": pa.array(np.concatenate(flags)),
            }
            listed = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
            starts, columns, counts, hashes = csr(np.concatenate(words), np.concatenate(lengths))
            blobs = [pa.array([column.tobytes()], pa.binary()) for column in (starts.astype(np.int64), columns, counts)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | made]),
                    pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed),
                    *blobs,
                    pa.array([hashes], pa.list_(pa.int64())),
                ],
                names=["shard", "docs", "starts", "columns", "counts", "hashes"],
            )

        for batch in batches:
            for block in blocks(batch, limit=min(BLOCK_BYTES, SHARD_BYTES)):
                if held and size + len(block.data) > SHARD_BYTES:
                    yield shard()
                    made, held, size = made + 1, [], 0
                own = pa.array(np.arange(block.first, block.first + len(block)))
                words, firsts = block.word_hashes()
                # Copies, as the buffers of a batch go with it.
                taken = [batch.column(name).take(own) for name in ("doc_id", "part")]
                held.append((*taken, words, np.diff(firsts), _digests(block), _simple_flags(block)))
                size += len(block.data)
        if held:
            yield shard()

    made = rows.mapInArrow(
        build,
        f"shard bigint, docs array<struct<doc_id: {kind}, part: string, high: bigint, low: bigint, flags: int>>, "
        "starts binary, columns binary, counts binary, hashes array<bigint>",
    )
    return keep(made, "audit-shards")


def global_columns(matrix: DataFrame) -> DataFrame:
    """(shard, ids): for each shard the global numbers of its local columns, as 64-bit integers.

    Words are numbered 0, 1, 2, ... without gaps in order of their hash.  Hashes are cut into
    4,096 equal stretches, each ranked by itself and shifted by the words before it; the
    driver learns one count per stretch.
    """
    pairs = matrix.select("shard", F.posexplode("hashes").alias("local", "hash"))
    pairs = pairs.withColumn("stretch", F.shiftright("hash", 52).cast("int"))
    rank = F.dense_rank().over(Window.partitionBy("stretch").orderBy("hash")) - 1
    ranked = keep(pairs.select("shard", "local", "stretch", rank.alias("rank")), "audit-ranks")
    sizes = dict(ranked.groupBy("stretch").agg(F.max("rank") + 1).collect())
    shifts = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(-2048, 2048)])])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def row() -> pa.RecordBatch:
            blob = np.concatenate(held).astype(np.int64).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([here]), pa.array([blob], pa.binary())], names=["shard", "ids"])

        for batch in batches:
            own, stretch, ranks = (batch.column(name).to_numpy() for name in ("shard", "stretch", "rank"))
            numbers = shifts[stretch + 2048] + ranks
            cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
            for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)], strict=False):
                if own[begin] != here:
                    if held:
                        yield row()
                    here, held = int(own[begin]), []
                held.append(numbers[begin:end])
        if held:
            yield row()

    dealt = ranked.repartition("shard").sortWithinPartitions("shard", "local").select("shard", "stretch", "rank")
    return dealt.mapInArrow(gather, "shard bigint, ids binary")


def term_matrix(docs: DataFrame) -> DataFrame:
    """Shards as of :func:`shards`, with the global numbers of their columns as ``ids`` (null without a word)."""
    matrix = shards(docs)
    return matrix.join(global_columns(matrix), "shard", "left")


def dictionary(docs: DataFrame, matrix: DataFrame) -> DataFrame:
    """(id, word) of every word of the documents that ``matrix`` was made of."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                begin, end, _ = block.words()
                hashes, first = np.unique(block.hashes(block.prefix(), begin, end), return_index=True)
                raw = block.data.tobytes()
                words = [raw[b:e].decode() for b, e in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(words, pa.string())], names=["hash", "word"]
                )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, ids in zip(batch.column("hashes"), batch.column("ids"), strict=True):
                if ids.is_valid:
                    numbers = pa.array(np.frombuffer(ids.as_buffer(), "<i8"))
                    yield pa.RecordBatch.from_arrays([hashes.values, numbers], names=["hash", "id"])

    words = docs.select("text").mapInArrow(cut, "hash bigint, word string").dropDuplicates(["hash"])
    ids = matrix.select("hashes", "ids").mapInArrow(number, "hash bigint, id bigint").distinct()
    return words.join(ids, "hash").select("id", "word")


def measured(matrix: DataFrame) -> DataFrame:
    """doc_id, part, high, low (hash of the text), n_words, n_distinct and flags of every document of a matrix.

    n_words is the sum of a row, n_distinct how many of its columns are not zero; they add
    the flags 1 (too short) and 2 (too few distinct words).
    """
    kind = matrix.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                starts, counts = (np.frombuffer(batch.column(n)[k].as_buffer(), t) for n, t in (("starts", "<i8"), ("counts", "<i4")))
                local, docs = np.frombuffer(batch.column("columns")[k].as_buffer(), "<i4"), batch.column("docs")[k].values
                if len(local):
                    column = np.frombuffer(batch.column("ids")[k].as_buffer(), "<i8")[local]
                else:
                    column = np.zeros(0, np.int64)
                row = np.repeat(np.arange(len(docs)), np.diff(starts))
                # Zero cells and repeated columns are no entries, wherever a matrix comes from.
                order = np.lexsort((column, row))
                row, column, value = row[order], column[order], counts[order].astype(np.int64)
                new = np.append(True, (row[1:] != row[:-1]) | (column[1:] != column[:-1]))[: len(row)]
                distinct = np.bincount(row[new & (value > 0)], minlength=len(docs))
                sums = np.concatenate([[0], np.cumsum(value)])[starts]
                words = sums[1:] - sums[:-1]
                flags = docs.field("flags").to_numpy() + (words < MIN_WORDS)
                flags += 2 * (100 * distinct < MIN_DISTINCT_PERCENT * words)
                columns = [docs.field(n) for n in ("doc_id", "part", "high", "low")]
                columns += [pa.array(words, pa.int64()), pa.array(distinct, pa.int64()), pa.array(flags.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "part", "high", "low", "n_words", "n_distinct", "flags"]
                )

    used = matrix.select("docs", "starts", "columns", "counts", "ids")
    return used.mapInArrow(
        measure, f"doc_id {kind}, part string, high bigint, low bigint, n_words bigint, n_distinct bigint, flags int"
    )


def _masks(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per set of failed filters, copies (16) included.

    Rows with equal text have equal flags, so they are added up per text, part and label
    before they meet; of these sums at most one per part and label meets in a text's group.
    """
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    equal = rows.groupBy("doc_id", "part", "high", "low", "flags").agg(F.count("*").alias("n"))
    # Documents without an id have no label, and would all meet in one task of the join.
    known = equal.where("doc_id is not null").join(told, "doc_id", "left")
    unknown = equal.where("doc_id is null").select(*equal.columns, F.lit(None).cast("int"), F.lit(None).cast("int"))
    all_rows = known.union(unknown).fillna(0, ["good", "toxic"])
    sums = all_rows.groupBy("high", "low", "part", "flags", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
    )
    first = F.min("least").over(Window.partitionBy("high", "low"))
    own = sums.withColumn("first", first).withColumn(
        "firsts", F.col("unnamed") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    )
    either = F.explode(
        F.array(
            F.struct(F.col("flags").alias("mask"), F.col("firsts").alias("n")),
            F.struct((F.col("flags") + 16).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")),
        )
    )
    split = own.select("part", "good", "toxic", either.alias("e")).where("e.n > 0")
    return split.groupBy("part", F.col("e.mask").alias("mask")).agg(
        F.sum("e.n").alias("n"), F.sum(F.expr("e.n * good")).alias("good"), F.sum(F.expr("e.n * toxic")).alias("toxic")
    )


def interactions(masks: DataFrame) -> DataFrame:
    """The audit table from (part, mask, n, good, toxic): a part has at most 32 masks."""
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.lit(["".join(order) for order in permutations(FILTERS)])
    steps = parts.select("part", "masks", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.lit(list(range(1, len(FILTERS) + 1)))).alias("step"))
    bits = " + ".join(f"if(instr({{0}}, '{name}') > 0, {1 << k}, 0)" for k, name in enumerate(FILTERS))
    steps = steps.select(
        "*",
        F.expr(bits.format("substring(filter_order, step, 1)")).alias("own"),
        F.expr(bits.format("substring(filter_order, 1, step - 1)")).alias("before"),
    )

    def total(value: str, when: str) -> F.Column:
        return F.expr(f"aggregate(filter(masks, m -> {when}), 0L, (sum, m) -> sum + {value})")

    removed = "m.mask & own != 0 and m.mask & before = 0"
    # Of the filters a document fails, each comes first in as many of all orders.
    orders_first = f"m.n * ({len(list(permutations(FILTERS)))} div bit_count(m.mask))"
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total("m.n", "m.mask & (before | own) = 0").alias("kept"),
        total("m.n", removed).alias("removed"),
        total("m.n", "m.mask & own != 0 and m.mask & before != 0").alias("redundant"),
        total("m.n", "m.mask = own").alias("unique_fails"),
        total("m.good", removed).alias("good_lost"),
        total("m.toxic", removed).alias("toxic_lost"),
        total(orders_first, "m.mask & own != 0").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs`` has doc_id, text (null: empty) and source (the part; null: empty string),
    ``labels`` doc_id, quality and toxic.  Documents fail A below 200 words, B when under half
    of their words are distinct, C when over 2 % of their code points are in A-Z, D with one of
    ``#$%&*|``, E when a smaller doc_id has the same text.  Every part has a row for each
    step of each order of the filters.  Repeated rows count each; rows that share the
    least doc_id of a text are all firsts.  A null doc_id is neither smaller nor larger than any
    other, so it never fails E, and it has no label.  A document labelled twice is good or
    toxic if one label says so.  No documents give no rows.
    """
    prepare(docs.sparkSession)
    rows = keep(measured(term_matrix(docs)), "audit-rows")
    return interactions(_masks(rows, labels))


#: :func:`audit` in SQL.
AUDIT_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
),
flagged as (
  select doc_id, part,
         (len(w) < 200)::int
         + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int
         + 8 * regexp_matches(t, '[#$%&*|]')::int
         + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask
  from texts
),
told as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
),
masks as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from flagged left join told using (doc_id) group by part, mask
),
filters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from filters a, filters b, filters c, filters d, filters e
  where a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps as (
  select filter_order, step::int as step,
         (select sum(bit) from filters where f = substring(filter_order, step, 1))::int as own,
         (select coalesce(sum(bit), 0) from filters where contains(substring(filter_order, 1, step - 1), f))::int as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)
)
select part, filter_order, step,
       coalesce(sum(n) filter (mask & (before | own) = 0), 0)::bigint as kept,
       coalesce(sum(n) filter (mask & own <> 0 and mask & before = 0), 0)::bigint as removed,
       coalesce(sum(n) filter (mask & own <> 0 and mask & before <> 0), 0)::bigint as redundant,
       coalesce(sum(n) filter (mask = own), 0)::bigint as unique_fails,
       coalesce(sum(good) filter (mask & own <> 0 and mask & before = 0), 0)::bigint as good_lost,
       coalesce(sum(toxic) filter (mask & own <> 0 and mask & before = 0), 0)::bigint as toxic_lost,
       coalesce(sum(n * 120 // nullif(bit_count(mask), 0)) filter (mask & own <> 0), 0)::bigint as shapley
from masks, steps group by part, filter_order, step
"""
