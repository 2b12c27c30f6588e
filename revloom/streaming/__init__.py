"""Continuous landing: files arrive, RAW tables are merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revloom.sources import landing
from revloom.sources.tables import KeyedTable


def total_order(df: DataFrame, by: Sequence[Column]) -> list[Column]:
    """``by``, then every column: rows that still tie are equal, so any of them will do."""
    kinds = {field.name: field.dataType.typeName() for field in df.schema.fields}
    return [*by, *[F.to_json(name) if kind in ("variant", "map") else F.col(name) for name, kind in kinds.items()]]


def stream_upsert(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    latest_by: Sequence[Column] | None = None,
    keep_newer: str | None = None,
) -> StreamingQuery:
    """Merge every micro-batch into ``table`` until the available input is used up.

    Within a micro-batch the row with the latest ``updated_at`` wins per key; ties are
    settled by the other columns.  A batch that is replayed after a failure therefore merges
    to the same content, and the result is exact even though the sink is only at-least-once.
    By default a later micro-batch always wins, as files are taken to arrive in order; with
    ``keep_newer`` (a column, such as ``updated_at``) a stored row that is newer stays, and the
    result no longer depends on how files fall into micro-batches.  ``checkpoint`` must be
    in shared storage.
    """
    order = list(latest_by) if latest_by else [F.col("updated_at")]

    def merge(batch: DataFrame, _batch_id: int) -> None:
        table.merge(batch, latest_by=total_order(batch, order), keep_newer=keep_newer)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_pages(
    spark: SparkSession,
    path: str,
    table: KeyedTable,
    checkpoint: str,
    loaded_at: Column,
    properties: Sequence[str] | None = None,
    associations: Sequence[str] | None = None,
    page_per_line: bool = False,
    remembered: str = "1 day",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge saved API pages into a RAW table as their files arrive.

    A record that was delivered before, in this or an earlier micro-batch, with the same content
    is dropped by the stream's state, so a page sent again rewrites no bucket.  The state
    holds a hash per record version for ``remembered``, counted from the arrival of a micro-batch:
    that clock never runs backwards, so no record is dropped for being late.  What the state
    has forgotten, and pages that arrive late with older versions, are settled by the merge: a
    stored row with a later ``updated_at`` stays.  The query goes on from ``checkpoint`` after
    a restart.  With many records use a state store on disk
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    records = landing.read_pages_stream(spark, path, properties, associations, page_per_line, files_per_batch)
    raw = landing.raw_envelope(records, loaded_at)
    content = F.xxhash64(F.to_json("properties"), F.to_json("associations"), "archived")
    fresh = (
        raw.withColumns({"_content": content, "_arrived": F.current_timestamp()})
        .withWatermark("_arrived", remembered)
        .dropDuplicatesWithinWatermark(["hs_object_id", "updated_at", "_content"])
        .drop("_content", "_arrived")
    )
    return stream_upsert(fresh, table, checkpoint, keep_newer="updated_at")
