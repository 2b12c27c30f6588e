"""Landing files to RAW rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revloom.vocab import STAGE_WON

PAGE_SCHEMA = (
    "results array<struct<id string, properties map<string, variant>, associations map<string, variant>, "
    "createdAt timestamp, updatedAt timestamp, archived boolean>>"
)
# What a saved page says of its place: the extract run it belongs to, the cursor it was asked for
# (absent on the first page) and the one that comes next (absent on the last).
CURSOR_SCHEMA = (
    "run string, after string, paging struct<next: struct<after: string>>, results array<struct<id string>>"
)
BILLING_SCHEMA = "subscriptions array<map<string, variant>>"
EVENT_SCHEMA = "_contact_id string, stage string, entered_at string"
LIFECYCLE_SCHEMA = f"lifecycle_history array<struct<{EVENT_SCHEMA}>>"
# A record that does not parse fails the read.  The default mode would turn it into NULLs and
# a torn file into an empty, seemingly successful load.
_STRICT = {"mode": "FAILFAST"}
STAGES_SCHEMA = (
    "results array<struct<id string, label string, stages array<struct<id string, label string, "
    "displayOrder int, metadata struct<probability string, isClosed string>>>>>"
)


def read_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    properties: Sequence[str] | None = None,
    associations: Sequence[str] | None = None,
    page_per_line: bool = False,
) -> DataFrame:
    """Saved API pages ``{"results": [...], "paging": ...}``: one row per record.

    A file is one page, or with ``page_per_line`` holds a page on every line, which lets
    the engine split large files.  ``properties`` and ``associations`` limit what is
    carried of the two blobs; None carries everything.  A torn page or a timestamp that
    does not parse fails the read.
    """
    pages = spark.read.schema(PAGE_SCHEMA).options(**_STRICT).option("multiLine", not page_per_line).json(path)
    return _project(pages.select(F.inline("results")), properties, associations)


def read_pages_stream(
    spark: SparkSession,
    path: str,
    properties: Sequence[str] | None = None,
    associations: Sequence[str] | None = None,
    page_per_line: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same over files as they arrive, at most ``files_per_batch`` of them in a micro-batch."""
    reader = spark.readStream.schema(PAGE_SCHEMA).options(**_STRICT).option("multiLine", not page_per_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _project(reader.json(path).select(F.inline("results")), properties, associations)


def read_cursors(spark: SparkSession, path: str | Sequence[str], page_per_line: bool = False) -> DataFrame:
    """(run, at, to, records) of every saved page; pages that name no run are one run."""
    pages = spark.read.schema(CURSOR_SCHEMA).options(**_STRICT).option("multiLine", not page_per_line).json(path)
    return pages.select(
        F.coalesce("run", F.lit("")).alias("run"),
        F.col("after").alias("at"),
        F.col("paging.next.after").alias("to"),
        F.coalesce(F.size("results"), F.lit(0)).cast("bigint").alias("records"),
    )


def _project(
    records: DataFrame, properties: Sequence[str] | None, associations: Sequence[str] | None
) -> DataFrame:
    def kept(blob: str, names: Sequence[str]) -> Column:
        wanted = list(names)
        return F.map_filter(blob, lambda k, _: k.isin(wanted))

    blobs = {"properties": properties, "associations": associations}
    return records.withColumns({b: kept(b, names) for b, names in blobs.items() if names is not None})


def raw_envelope(records: DataFrame, loaded_at: Column) -> DataFrame:
    """RAW rows of a batch: properties default to an empty object, an empty association
    list counts as none, archived defaults to false, and one load time for all rows."""
    empty = F.parse_json(F.lit("{}"))
    return records.select(
        F.col("id").alias("hs_object_id"),
        F.coalesce(F.to_variant_object("properties"), empty).alias("properties"),
        F.when(F.size("associations") > 0, F.to_variant_object("associations")).alias("associations"),
        F.col("createdAt").alias("created_at"),
        F.col("updatedAt").alias("updated_at"),
        F.coalesce("archived", F.lit(False)).alias("archived"),
        loaded_at.alias("_loaded_at"),
    )


def raw_from_text(rows: DataFrame, key: str) -> DataFrame:
    """RAW rows whose blobs arrived as JSON text columns; NULL text stays NULL."""
    blobs = [c for c in ("properties", "associations") if c in rows.columns]
    return rows.withColumns({c: F.parse_json(c) for c in blobs}).withColumn(key, F.col(key).cast("string"))


def read_subscriptions(
    spark: SparkSession, path: str | Sequence[str], loaded_at: Column, record_per_line: bool = False
) -> DataFrame:
    """Billing rows: key out, the rest as blob.

    A file is one document ``{"_meta": ..., "subscriptions": [...]}``, read by one task; a
    folder of documents is read by many.  With ``record_per_line`` every line is one
    subscription and large files split.  Malformed input fails the read.
    """
    key = "subscription_id"
    if record_per_line:
        lines = spark.read.text(path).where(F.trim("value") != "")
        rows = lines.select(F.from_json("value", "map<string, variant>", _STRICT).alias("s"))
    else:
        documents = spark.read.schema(BILLING_SCHEMA).options(**_STRICT).option("multiLine", True).json(path)
        rows = documents.select(F.explode("subscriptions").alias("s"))
    return rows.select(
        F.variant_get(F.col("s")[key], "$", "string").alias(key),
        F.to_variant_object(F.map_filter("s", lambda k, _: k != key)).alias("properties"),
        loaded_at.alias("_loaded_at"),
    )


def read_lifecycle_history(
    spark: SparkSession, path: str | Sequence[str], record_per_line: bool = False
) -> DataFrame:
    """History rows (_contact_id, stage, entered_at), from documents or one record per line."""
    if record_per_line:
        return spark.read.schema(EVENT_SCHEMA).options(**_STRICT).json(path)
    documents = spark.read.schema(LIFECYCLE_SCHEMA).options(**_STRICT).option("multiLine", True).json(path)
    return documents.select(F.inline("lifecycle_history"))


def raw_lifecycle(
    history: DataFrame, id_map: DataFrame, loaded_at: Column, loaded: Observation | None = None
) -> DataFrame:
    """RAW lifecycle rows; ``id_map`` is (_contact_id, contact_id), unique on the first.

    Events of unmapped contacts are left out (see :func:`unmapped_events`); ``loaded``
    observes how many events were ``skipped`` for that, and how many ``kept``, while the rows are
    computed.  A contact
    that reports a stage twice keeps the later entry, as a repeated merge would: later in
    time, however the two are written.  An entry without a time loses to any that has one;
    text that is no timestamp fails the load.
    """
    known = id_map.where(F.col("contact_id").isNotNull() & (F.col("contact_id") != ""))
    # Equal times written differently: the greater text, so that a rerun agrees.
    moment = F.struct(F.col("entered_at").cast("timestamp").alias("at"), "entered_at")
    latest = F.max("moment").alias("moment")
    # At most five rows per contact before the join, however often a stage was reported.
    entries = history.groupBy("_contact_id", "stage").agg(F.max(moment).alias("moment"), F.count(F.lit(1)).alias("n"))
    if loaded is None:
        mapped = entries.join(known, "_contact_id")
    else:
        mapped = entries.join(known, "_contact_id", "left").observe(
            loaded,
            F.coalesce(F.sum(F.when(F.col("contact_id").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("skipped"),
            F.coalesce(F.sum(F.when(F.col("contact_id").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("kept"),
        )
        mapped = mapped.where(F.col("contact_id").isNotNull())
    latest = mapped.groupBy("contact_id", "stage").agg(latest)
    latest = latest.withColumn("entered_at", F.col("moment.entered_at"))
    return latest.select(
        F.concat_ws("_", "contact_id", "stage").alias("event_id"),
        F.to_variant_object(F.struct("contact_id", "stage", "entered_at")).alias("properties"),
        loaded_at.alias("_loaded_at"),
    )


def unmapped_events(history: DataFrame, id_map: DataFrame) -> DataFrame:
    """One row: how many events have no mapped contact."""
    known = id_map.where(F.col("contact_id").isNotNull() & (F.col("contact_id") != ""))
    per_contact = history.groupBy("_contact_id").agg(F.count(F.lit(1)).alias("n"))
    orphans = per_contact.join(known, "_contact_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("skipped"))


def flatten_stages(pages: DataFrame) -> DataFrame:
    """Pipelines with nested stages to one row per stage, in display order."""
    return (
        pages.select(F.explode("results").alias("p"))
        .select(
            F.col("p.id").alias("pipeline_id"),
            F.col("p.label").alias("pipeline_label"),
            F.explode("p.stages").alias("s"),
        )
        .select(
            "pipeline_id",
            "pipeline_label",
            F.col("s.id").alias("stage_id"),
            F.col("s.label").alias("stage_label"),
            F.col("s.displayOrder").alias("display_order"),
            F.col("s.metadata.probability").alias("probability"),
            F.col("s.metadata.isClosed").alias("is_closed"),
        )
        .orderBy("pipeline_id", "display_order")
    )


def read_stages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    pages = spark.read.schema(STAGES_SCHEMA).options(**_STRICT).option("multiLine", True).json(path)
    return flatten_stages(pages)


def won_deals(raw_deals: DataFrame) -> DataFrame:
    """(deal_id, acv_usd, close_date) of won deals with an amount, straight off RAW.

    Negative amounts are kept here, unlike in the cleaned deals.
    """
    stage = F.variant_get("properties", "$.dealstage", "string")
    amount = F.variant_get("properties", "$.amount", "decimal(18,2)")
    return raw_deals.select(
        F.col("hs_object_id").alias("deal_id"),
        stage.alias("_stage"),
        amount.alias("acv_usd"),
        F.variant_get("properties", "$.closedate", "timestamp").alias("close_date"),
    ).where((F.col("_stage") == STAGE_WON) & F.col("acv_usd").isNotNull()).drop("_stage")
