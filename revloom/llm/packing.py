"""Mixture-controlled packing of documents into training sequences.

Documents wait in queues, one per source; only sources with less than a token per window,
which could not show in most windows, wait together in one.  Deficit round-robin serves the queues window by window: in every window a queue
earns its share of the window's tokens, gives out whole tokens, and carries the fraction it
could not give (its deficit) into the next window.  With shares that stay the same from
window to window, the tokens a queue has given out after window ``w`` are
``floor(total * w / windows)``: the carried deficits in closed form.  Any task can
therefore place any document without knowing what other tasks do, and deficits carry
across partitions as well as windows.

The windows form one gapless stream, which is cut into sequences.  Only the last sequence
can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from revloom.llm.blocks import blocks
from revloom.llm.shared import handing_back, join_rows, keep, prepare, texts
from revloom.llm.tokens import TOKEN_BLOCK, TOKENIZER_FILE, tokenizer

#: Tokens of all queues in a stretch of the order, about; and the least number of stretches, as a power of two.
STRETCH_TOKENS = 1 << 22
LEAST_BITS = 12


def encoded(docs: DataFrame, path: str, end_id: int, *columns: str) -> DataFrame:
    """``columns`` of each document with ``ids`` (little-endian, of the tokenizer's width) and ``n_ids``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path, end_id)
        for batch in batches:
            found, sizes = [], []
            for block in blocks(batch, limit=TOKEN_BLOCK):
                ids, bounds = encoder.encode(block, end_id)
                raw, bounds = ids.tobytes(), bounds * ids.itemsize
                found += [raw[begin:end] for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                sizes.append(np.diff(bounds) // ids.itemsize)
            out = [batch.column(name) for name in columns]
            out += [pa.array(found, pa.binary()), pa.array(np.concatenate([np.zeros(0, np.int64), *sizes]))]
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "ids", "n_ids"])

    kept = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)
    return docs.select(*columns, "text").mapInArrow(handing_back(encode), f"{kept}, ids binary, n_ids bigint")


class Mixture:
    """Token totals per queue, and where each queue's tokens lie in the stream."""

    def __init__(self, totals: list[int], weights: list[float], window: int):
        self.totals = np.array(totals, np.int64)
        self.window = window
        weights = np.where(self.totals > 0, np.array(weights, float), 0.0)
        # Queue by queue runs dry; between two such events the shares are constant.
        drain = np.divide(self.totals, weights, out=np.zeros(len(totals)), where=weights > 0)
        self.phases: list[tuple[np.ndarray, np.ndarray, int, int]] = []
        given, first = np.zeros(len(totals), np.int64), 0
        for time in np.unique(drain[self.totals > 0]):
            reach = np.where(drain <= time, self.totals, np.floor(weights * time).astype(np.int64))
            reach = np.maximum(np.minimum(reach, self.totals), given)
            amount = int((reach - given).sum())
            if amount:
                windows = -(-amount // window)
                self.phases.append((given.copy(), reach - given, windows, first))
                first += windows
                given = reach
        self.windows = first

    def _edge(self, phase: int, step: np.ndarray) -> np.ndarray:
        """Tokens given out by every queue after ``step`` windows of a phase; shape (steps, queues)."""
        given, amounts, windows, _ = self.phases[phase]
        # floor(amount * step / windows) without overflowing 64 bits
        whole, rest = np.divmod(amounts, windows)
        step = np.asarray(step, np.int64)[:, None]
        return given + whole * step + rest * step // windows

    def places(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Cut ``length`` tokens of a queue from position ``start``: (offset in them, length, place in the stream, window)."""
        at, stop = start, start + length
        for phase, (given, amounts, windows, first) in enumerate(self.phases):
            low, high = int(given[queue]), int(given[queue] + amounts[queue])
            while low <= at < min(high, stop):
                # The window that holds token ``at``: the least step whose edge passes it.
                step = ((at - low + 1) * windows + int(amounts[queue]) - 1) // int(amounts[queue]) - 1
                edges = self._edge(phase, [step, step + 1])
                while edges[1, queue] <= at:
                    step += 1
                    edges = self._edge(phase, [step, step + 1])
                while edges[0, queue] > at:
                    step -= 1
                    edges = self._edge(phase, [step, step + 1])
                end = min(stop, int(edges[1, queue]))
                place = int(edges[0].sum()) + int((edges[1, :queue] - edges[0, :queue]).sum()) + at - int(edges[0, queue])
                yield at - start, end - at, place, first + step
                at = end


def pack(
    docs: DataFrame,
    sequence: int = 4096,
    window_sequences: int = 16,
    weights: dict[str, float] | None = None,
    end_id: int = 2,
    path: str = TOKENIZER_FILE,
) -> DataFrame:
    """Pack every document's ids into sequences of ``sequence`` tokens; one row per piece.

    ``docs`` has doc_id, text and source.  A window spans ``window_sequences`` sequences at most: the tokens between
    two queues running dry are split evenly into windows.
    ``weights`` names sources and their shares; the other sources share what weight is left by
    their size.  Without weights every source's share is its share of all tokens, so all
    queues run dry together.  When a queue runs dry the others divide its share.  Null is a
    source of its own.  Sources that are not named and have fewer tokens than the stream has
    windows share one queue; so there are at most as many queues as a window has tokens, plus
    the named ones and that one.

    Within a queue, documents come in the order of a hash of doc_id and text; repeated rows
    stay next to each other.  A null text is empty and still has its end id.  An empty table
    gives an empty result.

    Columns: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    window_id, ids (the piece's ids as little-endian bytes of the tokenizer's width).
    """
    spark = docs.sparkSession
    prepare(spark)
    weights = weights or {}
    named = sorted(weights)
    window = sequence * window_sequences
    rows = texts(docs, "source").select(
        "doc_id", F.col("source").cast("string").alias("source"), "text", F.xxhash64("doc_id", "text").alias("order")
    )
    rows = keep(encoded(rows, path, end_id, "doc_id", "source", "order"), "packing-ids")

    sources = rows.groupBy("source").agg(F.sum("n_ids").alias("tokens"))
    all_tokens = sources.agg(F.sum("tokens")).first()[0] or 0
    windows = -(-all_tokens // window)
    # At most as many rows as a window has tokens, plus the named sources.
    large = sources.where((F.col("tokens") >= windows) | F.col("source").isin(named)).collect()
    sized = {row["source"]: row["tokens"] for row in large}
    own = named + sorted((name for name in sized if name not in weights), key=lambda name: (name is not None, name))
    totals = [sized.get(name, 0) for name in own]
    totals.append(all_tokens - sum(totals))  # the shared queue
    if weights:
        rest = sum(totals[len(named) :]) or 1
        left = max(0.0, 1.0 - sum(weights.values())) or 1e-9
        shares = [weights[name] for name in named] + [left * total / rest for total in totals[len(named) :]]
    else:
        shares = [float(total) for total in totals]
    mixture = Mixture(totals, shares, window)

    # Stretches are ranges of the order, so their number shows in no result.
    bits = max(LEAST_BITS, (all_tokens // STRETCH_TOKENS).bit_length())
    numbers = spark.createDataFrame([(name, number) for number, name in enumerate(own)], "source string, number int")
    queue = F.coalesce("number", F.lit(len(own))).alias("queue")
    rows = join_rows(rows, F.broadcast(numbers), ["source"], "left").select(
        "doc_id", "source", queue, F.shiftright("order", 64 - bits).alias("stretch"), "order", "ids", "n_ids"
    )
    # Where each stretch of a queue begins: a row that comes before its documents.
    sums = rows.groupBy("queue", "stretch").agg(F.sum("n_ids").alias("tokens"))
    before = Window.partitionBy("queue").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("queue", "stretch", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("begin"))

    kinds = dict(rows.dtypes)
    schema = (
        f"doc_id {kinds['doc_id']}, source string, start bigint, length bigint, ids_crc32 bigint, "
        "doc_tokens bigint, sequence_id bigint, offset bigint, window_id bigint, ids binary"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = tokenizer(path, end_id).dtype
        at = 0
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for row in batch.to_pylist():
                if row["begin"] is not None:
                    at = row["begin"]
                    continue
                ids, count = row["ids"], row["n_ids"]
                for offset, length, place, window in mixture.places(row["queue"], at, count):
                    done = 0
                    while done < length:
                        number, inside = divmod(place + done, sequence)
                        size = min(length - done, sequence - inside)
                        first = offset + done
                        part = ids[first * stored.itemsize : (first + size) * stored.itemsize]
                        crc = zlib.crc32(np.frombuffer(part, stored).astype("<u4").tobytes())
                        piece = (
                            row["doc_id"],
                            row["source"],
                            first,
                            size,
                            crc,
                            count,
                            number,
                            inside,
                            window,
                            part,
                        )
                        for column, value in zip(out, piece, strict=True):
                            column.append(value)
                        done += size
                at += count
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(out, fields, strict=True)], schema=fields
            )

    fields = pa.schema(
        [
            ("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)),
            ("source", pa.string()),
            *[(name, pa.int64()) for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window_id")],
            ("ids", pa.binary()),
        ]
    )
    # Named, not defaulted: a stretch must not be dealt to two tasks.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), all_tokens // (16 * STRETCH_TOKENS))
    every = rows.withColumn("begin", F.lit(None).cast("bigint")).unionByName(begins, allowMissingColumns=True)
    dealt = every.repartition(min(parts, 1 << bits), "stretch").sortWithinPartitions("queue", "stretch", F.col("begin").desc_nulls_last(), "order", "doc_id")
    return dealt.select("doc_id", "source", "queue", "begin", "ids", "n_ids").mapInArrow(handing_back(cut), schema)
