"""Typed projection of a semi-structured blob."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Field:
    """One output column: property name in the blob, output name, SQL type.

    ``then`` narrows after the first cast: numbers are read as DECIMAL(38,0), which rounds
    half up, before they become integers.
    """

    source: str
    name: str
    data_type: str = "string"
    then: str | None = None

    def sql(self, blob: str, lenient: bool) -> str:
        """Read as text, then cast: the cast is compiled, while one inside ``variant_get``
        is set up anew for every value."""
        getter, cast = ("try_variant_get", "try_cast") if lenient else ("variant_get", "cast")
        value = f"{getter}({blob}, '$.{self.source}', 'string')"
        for target in (self.data_type, self.then):
            if target and target != "string":
                value = f"{cast}({value} as {target})"
        return value


def flatten(
    raw: DataFrame,
    key: tuple[str, str],
    fields: Sequence[Field],
    blob: str = "properties",
    lenient: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``key`` is (column in raw, output name); ``_loaded_at`` and ``keep`` are carried along.

    A missing or JSON-null property is NULL.  A value that does not cast raises, or is
    NULL when ``lenient``.
    """
    source_key, key_name = key
    values = [f"{field.sql(blob, lenient)} as `{field.name}`" for field in fields]
    return raw.selectExpr(f"cast(`{source_key}` as string) as `{key_name}`", *values, "_loaded_at", *keep)
