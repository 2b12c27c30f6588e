"""Many-to-one joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of the rows.  So there are fewer than
# HOT_SHARE hot keys, whatever the data.
HOT_SHARE = 2000
# Counters of the sketch that finds them; far more than HOT_SHARE, so that its error is a
# small part of the share.
HOT_TRACKED = 65536
# Hot and NULL-key rows are spread over this many shuffle keys.
SPREAD = 1 << 20
_NESTED = ("variant", "map", "struct", "array")


def hot_keys(fact: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """The keys that hold more than 1/``share`` of the rows of ``fact``; fewer than ``share``.

    A job: one sketch per task, merged into one row; no row is shuffled.  Call it on a stored
    table and pass the answer to :func:`lookup_join`, whose plan then holds it as literals.
    Left in the plan the sketch could be evaluated more than once, merge in another order,
    and answer differently for a key at the limit; a row would then be sent one way and
    looked up the other.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {share}, {max(share, HOT_TRACKED)})")
    found = fact.where(F.col(key).isNotNull()).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    # At a limit of one row any key of a tiny table would count as hot.
    limit = max(found["n"] / share, 1)
    return [top["item"] for top in found["top"] if top["count"] > limit]


def lookup_join(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "left", hot: Sequence = ()
) -> DataFrame:
    """Join each row of ``fact`` to its one row of ``dim`` (``dim`` is unique on ``key``).

    Rows meet on (key, spread).  NULL-key rows of ``fact``, and those of the ``hot`` keys,
    carry a row hash as spread, the others 0, so no reduce task receives a whole such
    group.  The few rows of ``dim`` for hot keys (``hot`` is a bounded list, such as
    :func:`hot_keys` of a stored table) are broadcast.  Hot keys nobody named are left to
    the engine's skew handling.  Building the plan runs no job and asks for no estimate, so
    every size takes the same path.  ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join supports left and inner, not {how}")
    if len(hot) > HOT_SHARE:
        raise ValueError(f"at most {HOT_SHARE} hot keys, since their rows are broadcast")
    hot = list(hot)
    payload = [c for c in dim.columns if c != key]
    # A deterministic spread, so that a task run again sends each row the same way.  Facts
    # carry a unique id, so no large group of rows agrees in all plain columns.
    plain = [f.name for f in fact.schema.fields if f.dataType.typeName() not in _NESTED]
    found = F.lit(True).alias("_found")

    apart = F.col(key).isNull()
    if hot:
        apart = apart | F.col(key).isin(hot)
    # +1 keeps the spread of these rows away from 0, the spread of every row of dim.
    tagged = fact.withColumn(
        "_spread", F.when(apart, F.pmod(F.xxhash64(*plain), F.lit(SPREAD)) + 1).otherwise(0)
    )
    rest = dim.select(
        key,
        # Always 0, but not a constant to the optimizer, which would fold it into a filter
        # on fact and leave the spread out of the shuffle key.
        F.pmod(F.xxhash64(key), F.lit(1)).alias("_spread"),
        F.struct(found, *payload).alias("_rest"),
    )
    joined, row = tagged.join(rest, [key, "_spread"], "left"), F.col("_rest")
    if hot:
        few = dim.where(F.col(key).isin(hot)).select(key, F.struct(found, *payload).alias("_few"))
        # After the shuffle, so that it does not carry what the broadcast adds.
        joined, row = joined.join(F.broadcast(few), key, "left"), F.coalesce("_rest", "_few")
    if how == "inner":
        joined = joined.where(row["_found"].isNotNull())
    others = [c for c in fact.columns if c != key]
    return joined.select(key, *others, *[row[c].alias(c) for c in payload])
