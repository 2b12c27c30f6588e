"""Linked pages: is a chain whole, and where in it does each page stand?"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.session import stored_copy


class BrokenChain(ValueError):
    """Pages are missing, repeated or linked in a loop."""


def chain_faults(links: DataFrame) -> DataFrame:
    """(run, cursor, fault): what keeps the links (run, at, to) of a run from being one chain.

    ``at`` is the cursor a page was asked for (NULL for the first page of a run), ``to`` the
    one it names as next (NULL on the last).  In a chain every cursor is asked for once and named
    once, and NULL likewise.  One aggregate over cursors; loops apart from the chain pass here
    and are found by :func:`positions`.
    """
    one, none = F.lit(1), F.lit(0)
    ends = links.select("run", F.col("at").alias("cursor"), one.alias("asked"), none.alias("named"))
    ends = ends.union(links.select("run", "to", none, one))
    # A run in which no page is first or last still gets its NULL cursor.
    ends = ends.union(links.select("run", F.lit(None).cast("string"), none, none))
    sums = ends.groupBy("run", "cursor").agg(F.sum("asked").alias("asked"), F.sum("named").alias("named"))
    end = F.col("cursor").isNull()
    fault = (
        F.when(end & (F.col("asked") == 0), "no first page")
        .when(end & (F.col("asked") > 1), "several first pages")
        .when(end & (F.col("named") == 0), "no last page")
        .when(end & (F.col("named") > 1), "several last pages")
        .when(F.col("asked") == 0, "page missing")
        .when(F.col("asked") > 1, "page repeated")
        .when(F.col("named") == 0, "page not linked")
        .when(F.col("named") > 1, "page linked twice")
    )
    return sums.select("run", "cursor", fault.alias("fault")).where("fault is not null")


def positions(links: DataFrame) -> DataFrame:
    """``links`` with ``position``, 0 for the first page of its run, for links without :func:`chain_faults`.

    Each round every page looks as far again as it has looked so far, so a chain of n
    pages takes log2(n) rounds of one join over the links; a page that still sees no end
    then is in a loop, and :class:`BrokenChain` is raised.
    """
    seen = stored_copy(links.select("run", "at", "to", F.col("to").isNotNull().cast("bigint").alias("ahead")), "chain")
    longest = seen.groupBy("run").count().agg(F.max("count").alias("n")).first()["n"] or 1
    for _ in range(math.ceil(math.log2(longest)) + 1):
        further = seen.select(
            "run", F.col("at").alias("to"), F.col("to").alias("further"), F.col("ahead").alias("more")
        )
        seen = seen.join(further, ["run", "to"], "left").select(
            "run", "at", F.col("further").alias("to"), (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead")
        )
        seen = stored_copy(seen, "chain")
    lost = seen.where("to is not null").limit(1).collect()
    if lost:
        raise BrokenChain(f"run {lost[0]['run']!r}: a loop holds the page at cursor {lost[0]['at']!r}")
    lengths = seen.groupBy("run").agg((F.count(F.lit(1)) - 1).alias("last"))
    placed = seen.join(lengths, "run").select(
        F.col("run").alias("_run"), F.col("at").alias("_at"), (F.col("last") - F.col("ahead")).alias("position")
    )
    same = (F.col("run") == F.col("_run")) & F.col("at").eqNullSafe(F.col("_at"))
    return links.join(placed, same).drop("_run", "_at")


def whole_chain(links: DataFrame, shown: int = 20) -> DataFrame:
    """:func:`positions`, after a check that raises :class:`BrokenChain` with the first faults."""
    faults = chain_faults(links).orderBy("run", "cursor").limit(shown).collect()
    if faults:
        said = "; ".join(f"{f['fault']}: run {f['run']!r}, cursor {f['cursor']!r}" for f in faults)
        raise BrokenChain(said)
    return positions(links)
