"""Token ids as Arrow IPC files with fixed-size rows.

The ids of all documents, in ascending ``doc_id`` order, form one stream.  Each task writes
one range of documents as one pair of files in the shared folder:

* ``<name>.arrow``: record batches of ``sequences_per_batch`` rows; ``input_ids`` is a
  fixed-size list of ``length`` unsigned integers, ``mask`` a fixed-size list of
  booleans (false only on the padding of a file's last row).  Batches before the last are
  equally long, so row r is a slice of batch ``r // sequences_per_batch``: a memory-mapped
  reader gets it without copying or scanning.
* ``<name>.index.arrow``: doc_id, and where the document begins in the file and how long it is.

A task that runs again writes files under a new name.  Which files count is decided by the
manifest, a Parquet table that Spark commits once all tasks have ended, so a lost executor
leaves at most unlisted files behind.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.blocks import blocks
from revloom.llm.shared import handing_back, open_folder, prepare, texts
from revloom.llm.tokens import TOKEN_BLOCK, TOKENIZER_FILE, tokenizer
from revloom.session import scratch_path

MANIFEST = "number int, path string, n_docs bigint, n_ids bigint, n_sequences bigint, first_doc bigint, last_doc bigint"


def write_files(
    docs: DataFrame,
    folder: str,
    length: int = 2048,
    sequences_per_batch: int = 128,
    end_id: int = 1,
    path: str = TOKENIZER_FILE,
    documents_per_file: int = 20_000,
) -> DataFrame:
    """Write ``docs`` (doc_id integer, text) below ``folder`` and return the committed manifest.

    A null text is an empty document: its end id alone.  Rows that repeat a doc_id are all
    written, next to each other, ordered by text hash.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    files = max(1, -(-rows.count() // documents_per_file))
    # Order the texts and encode while writing: the sampling for the ranges then encodes nothing.
    rows = rows.withColumn("order", F.xxhash64("text"))
    ordered = rows.repartitionByRange(files, "doc_id", "order").sortWithinPartitions("doc_id", "order")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path, end_id)
        dtype = encoder.dtype
        kind = pa.from_numpy_dtype(dtype)
        row_type = pa.list_(kind, length)
        schema = pa.schema([("input_ids", row_type), ("mask", pa.list_(pa.bool_(), length))])
        index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64())])
        name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
        _, place = open_folder(name)
        system, _ = open_folder(folder)
        sink = index_sink = writer = index = None
        waiting, n_ids, n_docs, n_rows = np.zeros(0, dtype), 0, 0, 0
        first = last = None
        size = length * sequences_per_batch

        def put(stream: np.ndarray) -> None:
            nonlocal n_rows
            rows = -(-len(stream) // length)
            real = np.ones(rows * length, bool)
            real[len(stream) :] = False
            full = np.zeros(rows * length, dtype)
            full[: len(stream)] = stream
            writer.write_batch(
                pa.RecordBatch.from_arrays(
                    [
                        pa.FixedSizeListArray.from_arrays(pa.array(full, kind), length),
                        pa.FixedSizeListArray.from_arrays(pa.array(real), length),
                    ],
                    schema=schema,
                )
            )
            n_rows += rows

        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(open_folder(folder)[1], recursive=True)
                sink, index_sink = system.open_output_stream(place + ".arrow"), system.open_output_stream(place + ".index.arrow")
                writer, index = pa.ipc.new_file(sink, schema), pa.ipc.new_file(index_sink, index_schema)
                first = batch.column("doc_id")[0].as_py()
            last = batch.column("doc_id")[-1].as_py()
            parts = [encoder.encode(block, end_id) for block in blocks(batch, limit=TOKEN_BLOCK)]
            counts = np.concatenate([np.diff(bounds) for _, bounds in parts])
            begins = n_ids + np.cumsum(counts) - counts
            index.write_batch(
                pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(begins), pa.array(counts)], schema=index_schema)
            )
            waiting = np.concatenate([waiting, *[ids for ids, _ in parts]])
            n_ids, n_docs = n_ids + int(counts.sum()), n_docs + batch.num_rows
            whole = len(waiting) // size * size
            for at in range(0, whole, size):
                put(waiting[at : at + size])
            waiting = waiting[whole:].copy()
        if writer is None:
            return
        if len(waiting):
            put(waiting)
        for open_file in (writer, index, sink, index_sink):
            open_file.close()
        yield pa.RecordBatch.from_pylist(
            [{"path": name, "n_docs": n_docs, "n_ids": n_ids, "n_sequences": n_rows, "first_doc": first, "last_doc": last}],
            schema=pa.schema(
                [("path", pa.string()), *[(c, pa.int64()) for c in ("n_docs", "n_ids", "n_sequences", "first_doc", "last_doc")]]
            ),
        )

    written = ordered.select("doc_id", "text").mapInArrow(
        handing_back(write), "path string, n_docs bigint, n_ids bigint, n_sequences bigint, first_doc bigint, last_doc bigint"
    )
    # The number of a file is that of its task: ranges ascend with it.
    manifest = written.select(F.spark_partition_id().alias("number"), "*")
    manifest.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")


def read_documents(manifest: DataFrame, path: str = TOKENIZER_FILE) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it in the whole stream), n_tokens, ids_crc32, file.

    Reads the files themselves, a batch at a time; a document may span many rows.
    """
    spark = manifest.sparkSession
    # One row per file, so a running total over them is small whatever the corpus.
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("number", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4096))
    out_schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("file", pa.string())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                system, place = open_folder(entry["path"])
                index = pa.ipc.open_file(system.open_input_file(place + ".index.arrow"))
                stream = _Stream(pa.ipc.open_file(system.open_input_file(place + ".arrow")))
                for number in range(index.num_record_batches):
                    docs = index.get_batch(number)
                    sums = [
                        zlib.crc32(stream.take(begin, count).astype("<u4").tobytes())
                        for begin, count in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            docs.column(0),
                            pa.array(docs.column(1).to_numpy() + entry["base"]),
                            docs.column(2),
                            pa.array(sums, pa.int64()),
                            pa.array([entry["path"]] * docs.num_rows),
                        ],
                        schema=out_schema,
                    )

    dealt = based.repartition(tasks, "number")
    return dealt.select("path", "base").mapInArrow(
        handing_back(read), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string"
    )


class _Stream:
    """The unpadded ids of a file; holds one batch."""

    def __init__(self, file: pa.ipc.RecordBatchFileReader):
        self.file, self.number = file, -1
        self.length = file.schema.field("input_ids").type.list_size
        self.per_batch = file.get_batch(0).num_rows * self.length

    def _ids(self, number: int) -> np.ndarray:
        if number != self.number:
            batch = self.file.get_batch(number)
            ids, mask = batch.column("input_ids").flatten(), batch.column("mask").flatten()
            self.ids = ids.to_numpy()[mask.to_numpy(zero_copy_only=False)]
            self.number = number
        return self.ids

    def take(self, begin: int, count: int) -> np.ndarray:
        parts = []
        while count:
            number, inside = divmod(begin, self.per_batch)
            part = self._ids(number)[inside : inside + count]
            parts.append(part)
            begin, count = begin + len(part), count - len(part)
        return np.concatenate(parts)


def sequence(path: str, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Row ``row`` of a local file, zero-copy for the ids: (ids, mask)."""
    file = pa.ipc.open_file(pa.memory_map(path))
    number, inside = divmod(row, file.get_batch(0).num_rows)
    batch = file.get_batch(number)
    ids = batch.column("input_ids")
    length = ids.type.list_size
    mask = batch.column("mask").slice(inside, 1).flatten().to_numpy(zero_copy_only=False)
    return ids.flatten().to_numpy()[inside * length : (inside + 1) * length], mask


def write_and_read(docs: DataFrame) -> DataFrame:
    """Write the files to the shared folder and read every document back."""
    prepare(docs.sparkSession)
    return read_documents(write_files(docs, scratch_path(docs.sparkSession, "stream-files")))
