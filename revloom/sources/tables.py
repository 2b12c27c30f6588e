"""Table sinks: keyed parquet with merge, clustered parquet, catalog tables and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.operators.upsert import newer_than_target, upsert
from revloom.session import stored_copy

RAW_ENTITY_SCHEMA = (
    "hs_object_id string, properties variant, associations variant, "
    "created_at timestamp, updated_at timestamp, archived boolean, _loaded_at timestamp"
)


def raw_blob_schema(key: str) -> str:
    """Schema of the RAW tables without associations."""
    return f"{key} string, properties variant, _loaded_at timestamp"


class KeyedTable:
    """A parquet table with one row per key, merged bucket by bucket.

    Rows are partitioned by a hash of ``by`` (the key, if not given) into ``buckets`` folders.
    A merge stages its batch in scratch space, reads the buckets the batch touches and writes
    them anew by dynamic partition overwrite: Spark puts the new files aside and moves them in
    when all of them are written, so a merge that fails leaves the old rows, and buckets that
    are not touched are neither read nor written.  A merge is idempotent; one that stopped while
    files were moved is repeated.  A table takes one writer at a time, and a DataFrame
    read before a merge has to be read again after it, as with any parquet table.

    In a catalog with row-level operations :func:`merge_into` does the same.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str | T.StructType,
        keys: Sequence[str],
        buckets: int = 16,
        by: Sequence[str] | None = None,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys = list(keys)
        self.buckets = buckets
        self.by = list(by or keys)

    def read(self) -> DataFrame:
        """The rows.  Columns that old files lack are NULL; a table nobody wrote is empty."""
        return self._stored().drop("_bucket")

    def merge(
        self, source: DataFrame, latest_by: Sequence[Column] | None = None, keep_newer: str | None = None
    ) -> int:
        """Upsert ``source``; returns its row count.  An empty batch changes nothing.

        The batch is written down first: the merge reads it several times, and so parses
        its files or computes its plan once, and merges the same rows even if the source
        changes meanwhile.  Columns the table does not declare are refused.
        """
        self._checked(source)
        batch = stored_copy(source, "batch")
        counts = self._buckets_of(batch)
        if not counts:
            return 0
        stored = self.read_buckets(list(counts))
        self.write_buckets(list(counts), upsert(stored, batch, self.keys, latest_by, keep_newer))
        return sum(counts.values())

    def merge_new(
        self, source: DataFrame, mark: str = "_loaded_at", latest_by: Sequence[Column] | None = None
    ) -> int:
        """Upsert only the rows past the table's high-water mark."""
        return self.merge(newer_than_target(source, self.read(), mark), latest_by)

    def replace(self, df: DataFrame) -> None:
        """Make ``df``, which must not read this table, the whole content."""
        self._checked(df)
        self._bucketed(df).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "_bucket"
        ).parquet(self.path)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows with the columns ``by`` belong to; at most one value each reaches the driver."""
        return list(self._buckets_of(rows))

    def read_buckets(self, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets; no file of another one is opened."""
        return self._stored().where(F.col("_bucket").isin(list(buckets))).drop("_bucket")

    def write_buckets(self, buckets: Sequence[int], rows: DataFrame) -> None:
        """Replace the content of ``buckets`` by ``rows``, which may read this table and belong to these buckets."""
        if not buckets:
            return
        # A bucket that has become empty is only replaced if something is written to it: rows without a key,
        # which no reader sees.
        empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in self.schema.fields]
        marks = self.spark.createDataFrame([(b,) for b in buckets], "_bucket int").select(*empty, "_bucket")
        # One file per bucket, unless a bucket is large: the engine splits it then.
        self._bucketed(rows).unionByName(marks).hint("rebalance", "_bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("_bucket").parquet(self.path)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, rows: DataFrame) -> dict[int, int]:
        return dict(rows.groupBy(self._bucket().alias("b")).count().collect())

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names).withColumn("_bucket", self._bucket())

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType())])
        # A reader needs a folder; where there is one, this does nothing.
        self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy("_bucket").parquet(self.path)
        return self.spark.read.schema(schema).parquet(self.path).where(F.col(self.keys[0]).isNotNull())

    def _checked(self, df: DataFrame) -> None:
        unknown = [c for c in df.columns if c not in self.schema.names]
        if unknown:
            raise ValueError(f"columns the table does not declare: {', '.join(unknown)}")


#: Rows of a clustered file: few enough that a task sorts them in memory, whatever they weigh compressed.
ROWS_PER_FILE = 1 << 18


def write_clustered(df: DataFrame, path: str, by: Sequence[str], rows: int | None = None) -> None:
    """Full refresh, rows sorted by ``by`` across and within files.

    Readers that filter on the leading column skip files and row groups by their min/max.
    End ``by`` with a key: range boundaries then fall inside a value that many rows share.
    With their number given in ``rows``, a sort takes about :data:`ROWS_PER_FILE` of them.  Else the
    engine cuts by compressed size, and well compressed rows are sorted on disk.
    """
    files = [] if rows is None else [max(1, -(-rows // ROWS_PER_FILE))]
    ranged = df.repartitionByRange(*files, *by).sortWithinPartitions(*by)
    ranged.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_bucketed(
    df: DataFrame, name: str, by: Sequence[str], buckets: int, partition_by: Sequence[str] = ()
) -> None:
    """A new catalog table with ``buckets`` hash buckets of ``by``, sorted, one file each per partition.

    Tables with the same buckets are joined and grouped on ``by`` without an exchange.  A bucket is
    read by one task, so ``by`` should be close to a key of ``df``.
    """
    writer = (
        df.repartition(buckets, *by)
        .sortWithinPartitions(*partition_by, *by)
        .write.format("parquet")
        .bucketBy(buckets, *by)
        .sortBy(*by)
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, schema: str | T.StructType, path: str | None = None) -> None:
    """Create the catalog table if it is missing (at ``path``, if given), else add the columns it lacks."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not spark.catalog.tableExists(name):
        writer = spark.createDataFrame([], wanted).write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return
    have = set(spark.table(name).columns)
    missing = [f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields if f.name not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(missing)})")


def append_rows(df: DataFrame, name: str) -> None:
    """Append to a catalog table by column name; columns that ``df`` lacks are NULL, others are refused."""
    declared = df.sparkSession.table(name).schema.fields
    unknown = [c for c in df.columns if c not in [f.name for f in declared]]
    if unknown:
        raise ValueError(f"columns the table does not declare: {', '.join(unknown)}")
    filled = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in declared]
    df.select(*filled).write.insertInto(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Full refresh of a catalog table."""
    df.write.format("parquet").mode("overwrite").saveAsTable(name)


def publish(spark: SparkSession, database: str, folder: str, names: Sequence[str]) -> None:
    """Make the parquet tables ``folder/<name>`` the current ones of ``database``.

    The one step that counts is a single statement, which replaces the view ``refresh``
    that names the folder: :func:`published` shows all tables of one refresh, never of two.
    For SQL users a view per table follows.  The database is created if it is missing.
    """
    root = folder.rsplit("/", 1)[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.refresh AS SELECT '{folder}' AS folder")
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{folder}/{name}`")


def published(spark: SparkSession, database: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The current tables of ``database``, all of the same refresh."""
    if not spark.catalog.tableExists(f"{database}.refresh"):
        raise ValueError(f"nothing is published in {database}")
    folder = spark.table(f"{database}.refresh").first()["folder"]
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def merge_into(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Keyed merge in a catalog with row-level operations (plain parquet has none)."""
    matches = [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
