"""Payloads that push account health back to the CRM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.operators import fixed_size_batches
from revloom.vocab import EXPORT_BATCH_SIZE


def export_scan(health: DataFrame) -> DataFrame:
    return health.select("company_id", "arr_usd", "open_pipeline_usd", "account_health_score")


def payloads(rows: DataFrame, synced_at: Column) -> DataFrame:
    """``(company_id, payload)``: one update document per account.

    Numbers go out as strings; only the sync time, in epoch milliseconds, is a number.
    """
    properties = F.struct(
        F.col("arr_usd").cast("string").alias("arr_usd"),
        F.col("open_pipeline_usd").cast("string").alias("open_pipeline_usd"),
        F.col("account_health_score").cast("string").alias("account_health_score"),
        F.unix_millis(synced_at).alias("last_synced_from_warehouse"),
    )
    document = F.to_json(F.struct(F.col("company_id").alias("id"), properties.alias("properties")))
    return rows.select("company_id", document.alias("payload"))


def payload_batches(documents: DataFrame, size: int = EXPORT_BATCH_SIZE) -> DataFrame:
    """``(batch_no, batch_size, body)``: request bodies of at most ``size`` documents."""
    batches = fixed_size_batches(documents, "company_id", "payload", size)
    body = F.concat(F.lit('{"inputs":['), F.concat_ws(",", "items"), F.lit("]}"))
    return batches.select("batch_no", "batch_size", body.alias("body"))
