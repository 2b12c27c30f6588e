"""Association lists to link tables.

Two families, same results:

* in the row: all associations of an id sit in its one RAW row, so pairs and the best
  target can be settled inside that row and nothing is shuffled.  This needs the id to be
  unique, which a merged RAW table guarantees and the ``unique`` checks assert;
* across rows: ordinary aggregates that make no such assumption, for append-only history
  or for link tables that arrive on their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.operators.keep_first import ascending, keep_first

RESULTS = "array<struct<id:string,type:string>>"


def link_results(raw: DataFrame, kind: str) -> Column:
    """``associations.<kind>.results`` of a VARIANT, or of a struct of the same shape."""
    if isinstance(raw.schema["associations"].dataType, T.VariantType):
        return F.variant_get("associations", f"$.{kind}.results", RESULTS)
    return F.col(f"associations.{kind}.results")


def _link_rows(links: DataFrame, to_id: str) -> DataFrame:
    """Unpack ``_link``."""
    ends = {to_id: "_link.id", "link_type": "_link.type"}
    unpacked = [F.col(path).cast("string").alias(name) for name, path in ends.items()]
    return links.select(links.columns[0], *unpacked, "_loaded_at")


def explode_links(
    raw: DataFrame, kind: str, from_id: str, to_id: str, key: str = "hs_object_id"
) -> DataFrame:
    """One row per element of the association list.

    A row without the blob, the list or any element gives no row.
    """
    present = raw.where(F.col("associations").isNotNull())
    exploded = present.select(
        F.col(key).cast("string").alias(from_id),
        F.explode(link_results(raw, kind)).alias("_link"),
        "_loaded_at",
    )
    return _link_rows(exploded, to_id)


def _rank(link_type: Column, label: str) -> Column:
    """0 for the labeled association, 1 for any other (including a missing type)."""
    return F.when(link_type == label, 0).otherwise(1)


# --- in the row ------------------------------------------------------------------------


def pairs_in_row(
    raw: DataFrame, kind: str, from_id: str, to_id: str, label: str, key: str = "hs_object_id"
) -> DataFrame:
    """One row per (from, to) pair, the labeled one when there is one; no shuffle."""
    ranked = F.transform(
        link_results(raw, kind),
        lambda link: F.struct(
            link["id"].alias("id"), _rank(link["type"], label).alias("rank"), link["type"].alias("type")
        ),
    )
    # sort_array compares natively; array_sort would run a comparator lambda.
    listed = raw.where(F.col("associations").isNotNull()).withColumn("_sorted", F.sort_array(ranked))
    first_of_id = F.filter(
        "_sorted",
        lambda link, i: (i == 0) | ~link["id"].eqNullSafe(F.get("_sorted", i - 1)["id"]),
    )
    # The outer form keeps the optimizer from testing the list for emptiness beforehand,
    # which would compute it twice; rows without a link are dropped here instead.
    exploded = listed.select(
        F.col(key).cast("string").alias(from_id), F.explode_outer(first_of_id).alias("_link"), "_loaded_at"
    ).where(F.col("_link").isNotNull())
    return _link_rows(exploded, to_id)


def best_in_row(raw: DataFrame, kind: str, label: str, labeled_only: bool = False) -> Column:
    """The one target of a row: labeled first, then the smallest id; NULL without any."""
    results = link_results(raw, kind)
    if labeled_only:
        results = F.filter(results, lambda link: link["type"] == label)
    ranked = F.transform(
        results,
        lambda link: F.struct(_rank(link["type"], label), link["id"].isNull(), link["id"].alias("id")),
    )
    return F.array_min(ranked)["id"]


# --- across rows -----------------------------------------------------------------------


def one_per_pair(links: DataFrame, from_id: str, to_id: str, label: str) -> DataFrame:
    """One row per (from, to) pair, the labeled one when there is one.

    Ties among equal labels are settled by type and load time, so reruns agree.
    """
    order = [_rank(F.col("link_type"), label), *ascending("link_type", "_loaded_at")]
    return keep_first(links, [from_id, to_id], order)


def labeled_pairs(links: DataFrame, from_id: str, to_id: str, label: str) -> DataFrame:
    """The labeled rows of :func:`one_per_pair`, without shuffling the unlabeled ones.

    A pair keeps its labeled row whenever it has one, so filtering first gives the same
    pairs.  Accepts exploded or already de-duplicated links.
    """
    labeled = links.where(F.col("link_type") == label).select(from_id, to_id, "_loaded_at")
    return labeled.groupBy(from_id, to_id).agg(F.min("_loaded_at").alias("_loaded_at"))


def best_target(links: DataFrame, from_id: str, to_id: str, label: str) -> DataFrame:
    """Exactly one target per source: labeled first, then the smallest id.

    The pair step in between changes nothing here (the best row of the best pair is the
    best row), so exploded links can be passed as they are, which saves a shuffle.
    """
    ranked = links.select(from_id, to_id, "_loaded_at", _rank(F.col("link_type"), label).alias("_rank"))
    order = [F.col("_rank"), *ascending(to_id, "_loaded_at")]
    return keep_first(ranked, [from_id], order).drop("_rank")
