"""Session settings, scratch tables and sorted lookup tables shared by the operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.blocks import forget_powers
from revloom.session import has_scratch, name_scratch_root, scratch_path

# Texts may be very long, so a batch for Python is bounded by bytes as well as by rows.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# Python workers live on between tasks: let them hand freed memory back.
WORKER_ENVIRONMENT = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(8 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
}


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, let Python workers import this package, settle the scratch folder."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    package_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", package_root)
    for key, value in WORKER_ENVIRONMENT.items():
        environment.setdefault(key, value)
    if not has_scratch(spark) and spark.sparkContext.master.startswith("local["):
        name_scratch_root(tempfile.mkdtemp(prefix="corpus-"))


Batches = Iterator[pa.RecordBatch]


def handing_back(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function`` for ``mapInArrow``, after which its worker hands back what it holds no longer.

    A worker lies idle between tasks, beside those of other stages, and freed memory between
    blocks in use stays with it until it is told to trim.
    """

    def run(batches: Batches) -> Batches:
        yield from function(batches)
        forget_powers()
        trim_memory()

    return run


def trim_memory() -> None:
    """Hand freed memory back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def keep(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that its lineage ends there."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def join_rows(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on ``names``, of which ``doc_id`` may be null: nulls are equal."""
    other = right.withColumnsRenamed({name: f"right {name}" for name in names})
    same = [F.col(name).eqNullSafe(F.col(f"`right {name}`")) for name in names]
    return left.join(other, same, how).drop(*(f"right {name}" for name in names))


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, the named columns, and ``text`` with nulls as empty texts."""
    return docs.select("doc_id", *columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def open_folder(path: str):
    """The file system and path behind a URI or plain path of the shared folder."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@dataclass
class SortedTable:
    """A lookup table of any size, in sorted files of bounded size in the shared folder.

    ``find`` takes sorted keys and walks the files whose range holds some of them, so a
    task holds one file at a time, plus those that fit in ``cached_bytes``.
    """

    paths: list[str]
    first: np.ndarray
    last: np.ndarray
    key: str
    values: list[str]
    cached_bytes: int = 128 << 20
    _files: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"_files": {}}

    def _load(self, number: int) -> list[np.ndarray]:
        if number not in self._files:
            system, path = open_folder(self.paths[number])
            table = pq.read_table(path, filesystem=system, columns=[self.key, *self.values], partitioning=None)
            columns = [table.column(name).to_numpy() for name in table.column_names]
            held = sum(c.nbytes for file in self._files.values() for c in file)
            if held + sum(c.nbytes for c in columns) > self.cached_bytes:
                return columns
            self._files[number] = columns
        return self._files[number]

    def find(self, keys: np.ndarray) -> list[np.ndarray]:
        """For each of the sorted keys its values, 0 where it is missing."""
        found = [np.zeros(len(keys)) for _ in self.values]
        begin = np.searchsorted(keys, self.first, "left")
        end = np.searchsorted(keys, self.last, "right")
        for number in np.flatnonzero(end > begin):
            part = slice(begin[number], end[number])
            stored, *columns = self._load(number)
            at = np.minimum(np.searchsorted(stored, keys[part]), len(stored) - 1)
            hit = stored[at] == keys[part]
            for out, column in zip(found, columns, strict=True):
                out[part] = np.where(hit, column[at], 0)
        return found


def sorted_table(frame: DataFrame, key: str, name: str, rows_per_file: int = 1 << 21) -> SortedTable:
    """Store ``frame`` (unique ``key``) as a :class:`SortedTable`.

    The driver learns only the file names and their key ranges: one row per
    ``rows_per_file`` rows.
    """
    spark = frame.sparkSession
    frame = keep(frame, f"{name}-rows")
    path = scratch_path(spark, name)
    files = max(1, -(-frame.count() // rows_per_file))
    if files == 1:
        ordered = frame.coalesce(1).sortWithinPartitions(key)
    else:
        ordered = frame.repartitionByRange(files, key).sortWithinPartitions(key)
    ordered.write.parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    ranges = stored.groupBy(F.input_file_name().alias("path")).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    rows = sorted(ranges.collect(), key=lambda row: row["first"])
    return SortedTable(
        [row["path"] for row in rows],
        np.array([row["first"] for row in rows], np.int64),
        np.array([row["last"] for row in rows], np.int64),
        key,
        [column for column in frame.columns if column != key],
    )


@dataclass
class StoredBlocks:
    """A table of any size in files of a bounded number of rows, which tasks read one at a time.

    Tasks hold the files that fit in ``cached_bytes`` and read the others again.
    """

    paths: list[str]
    cached_bytes: int = 64 << 20
    _files: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"_files": {}}

    def load(self, number: int):
        """One file as an Arrow table."""
        table = self._files.get(number)
        if table is None:
            system, path = open_folder(self.paths[number])
            table = pq.read_table(path, filesystem=system, partitioning=None)
            if sum(t.nbytes for t in self._files.values()) + table.nbytes <= self.cached_bytes:
                self._files[number] = table
        return table

    def __iter__(self):
        for number in range(len(self.paths)):
            yield number, self.load(number)


def stored_blocks(frame: DataFrame, name: str, rows: int) -> StoredBlocks:
    """Store ``frame`` in files of at most ``rows`` rows; the driver learns their names only."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("maxRecordsPerFile", rows).parquet(path)
    return StoredBlocks(sorted(frame.sparkSession.read.schema(frame.schema).parquet(path).inputFiles()))


@dataclass
class DealtTable:
    """A table of any size in a folder for each number, of which a task reads those of its own rows."""

    path: str
    number: str
    columns: list[str]

    def load(self, number: int) -> pa.Table | None:
        """The rows of a number, sorted by their first column; None if there are none."""
        system, path = open_folder(f"{self.path}/{self.number}={number}")
        files = system.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
        parts = [
            pq.read_table(file.path, filesystem=system, columns=self.columns, partitioning=None)
            for file in files
            if file.path.endswith(".parquet")
        ]
        if not parts:
            return None
        return pa.concat_tables(parts).sort_by(self.columns[0])


def dealt_table(frame: DataFrame, number: str, name: str) -> DealtTable:
    """Store ``frame`` as a :class:`DealtTable` by a column ``number``; the driver learns nothing of it."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame.repartition(parts, number).sortWithinPartitions(number).write.partitionBy(number).parquet(path)
    return DealtTable(path, number, [column for column in frame.columns if column != number])
