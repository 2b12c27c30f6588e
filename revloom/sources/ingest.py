"""Landing files into stored RAW tables, one call per source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from revloom.operators.chain import whole_chain
from revloom.sources import landing
from revloom.sources.tables import RAW_ENTITY_SCHEMA, KeyedTable, raw_blob_schema
from revloom.vocab import ENTITY_ASSOCIATIONS, RAW_TABLES, tracked_names

SUBSCRIPTIONS_TABLE = "billing_subscriptions"
LIFECYCLE_TABLE = "hubspot_contact_lifecycle_history"


def raw_table(spark: SparkSession, root: str, entity: str) -> KeyedTable:
    """The stored RAW table of an entity, of ``subscriptions`` or of ``lifecycle``."""
    if entity == "subscriptions":
        key = "subscription_id"
        return KeyedTable(spark, f"{root}/{SUBSCRIPTIONS_TABLE}", raw_blob_schema(key), [key])
    if entity == "lifecycle":
        return KeyedTable(spark, f"{root}/{LIFECYCLE_TABLE}", raw_blob_schema("event_id"), ["event_id"])
    return KeyedTable(spark, f"{root}/{RAW_TABLES[entity]}", RAW_ENTITY_SCHEMA, ["hs_object_id"])


def ingest_entity(
    spark: SparkSession,
    entity: str,
    pages: str,
    root: str,
    loaded_at: Column,
    page_per_line: bool = False,
    whole: bool = True,
) -> int:
    """Merge an entity's saved pages into its RAW table; returns the records read.

    Only the tracked properties and associations are carried.  A lost, repeated or looping
    page fails the load before anything is written (:class:`BrokenChain`); ``whole=False``
    takes the pages as they are, for files without cursors.
    """
    if whole:
        whole_chain(landing.read_cursors(spark, pages, page_per_line))
    records = landing.read_pages(
        spark, pages, tracked_names(entity), ENTITY_ASSOCIATIONS[entity], page_per_line
    )
    raw = landing.raw_envelope(records, loaded_at)
    return raw_table(spark, root, entity).merge(raw)


def ingest_entities(
    spark: SparkSession,
    pages_root: str,
    root: str,
    loaded_at: Column,
    entities: Iterable[str] = tuple(RAW_TABLES),
) -> dict[str, int]:
    """Every entity from ``<pages_root>/<entity>``."""
    return {e: ingest_entity(spark, e, f"{pages_root}/{e}", root, loaded_at) for e in entities}


def ingest_subscriptions(
    spark: SparkSession, path: str, root: str, loaded_at: Column, record_per_line: bool = False
) -> int:
    raw = landing.read_subscriptions(spark, path, loaded_at, record_per_line)
    return raw_table(spark, root, "subscriptions").merge(raw)


def ingest_lifecycle(
    spark: SparkSession,
    path: str,
    id_map: DataFrame,
    root: str,
    loaded_at: Column,
    record_per_line: bool = False,
) -> tuple[int, int]:
    """(events merged, events left out because their contact has no id)."""
    history = landing.read_lifecycle_history(spark, path, record_per_line)
    # Both counts come from the one pass that stages the batch.
    loaded = Observation("lifecycle_load")
    raw = landing.raw_lifecycle(history, id_map, loaded_at, loaded)
    merged = raw_table(spark, root, "lifecycle").merge(raw)
    return merged, loaded.get["skipped"]
