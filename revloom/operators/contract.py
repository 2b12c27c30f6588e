"""Schema contracts: one row per (object_type, name, type, field_type)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT_SCHEMA = "object_type string, name string, type string, field_type string"

BREAKING = "breaking"
INFORMATIONAL = "informational"
NONE = "none"
EXIT_CODES = {NONE: 0, BREAKING: 1, INFORMATIONAL: 2}


def contract_from_properties(
    spark: SparkSession, entities: Mapping[str, Sequence[tuple[str, str, str]]]
) -> DataFrame:
    """From ``{object: [(name, type, field type), ...]}``."""
    rows = [(entity, *prop) for entity, props in entities.items() for prop in props]
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def contract_from_catalog(catalog: DataFrame, tracked: DataFrame) -> DataFrame:
    """Normalize a property catalog ``(object_type, name, type, fieldType, ...)``.

    Keeps the tracked (object_type, name) pairs and the two contract fields; a tracked
    name the catalog lacks is simply absent.
    """
    kept = catalog.join(tracked.select("object_type", "name"), ["object_type", "name"], "left_semi")
    return kept.select("object_type", "name", "type", F.col("fieldType").alias("field_type"))


# Tells of a condition on the values at a path whether any value of a row meets it.
_Any = Callable[[Callable[[Column], Column]], Column]


def _paths(
    data_type: T.DataType, path: str, nullable: bool, any_value: _Any
) -> Iterator[tuple[str, str, bool, _Any]]:
    """``(path, type, nullable, any_value)`` of a type and all it holds.

    Fields follow a dot, array elements are ``[]``, keys and values of a map ``{key}`` and
    ``{value}``.  A container is named by its kind alone, so a change inside it shows at
    its own path and nowhere above.
    """
    kind = data_type.typeName() if isinstance(data_type, T.StructType | T.ArrayType | T.MapType) else None
    yield path, kind or data_type.simpleString(), nullable, any_value
    if isinstance(data_type, T.StructType):
        for field in data_type.fields:
            name = field.name if field.name.isidentifier() else f"`{field.name.replace('`', '``')}`"
            yield from _paths(field.dataType, f"{path}.{name}", field.nullable, _in_field(any_value, field.name))
    elif isinstance(data_type, T.ArrayType):
        yield from _paths(data_type.elementType, f"{path}[]", data_type.containsNull, _in_items(any_value, lambda v: v))
    elif isinstance(data_type, T.MapType):
        yield from _paths(data_type.keyType, f"{path}{{key}}", False, _in_items(any_value, F.map_keys))
        yield from _paths(
            data_type.valueType, f"{path}{{value}}", data_type.valueContainsNull, _in_items(any_value, F.map_values)
        )


def _in_field(outer: _Any, name: str) -> _Any:
    return lambda meets: outer(lambda value: value.isNotNull() & meets(value.getField(name)))


def _in_items(outer: _Any, items: Callable[[Column], Column]) -> _Any:
    return lambda meets: outer(lambda value: F.coalesce(F.exists(items(value), lambda item: meets(item)), F.lit(False)))


def _columns(df: DataFrame) -> Iterator[tuple[str, str, bool, _Any]]:
    for field in df.schema.fields:
        column = F.col(f"`{field.name.replace('`', '``')}`")
        yield from _paths(field.dataType, field.name, field.nullable, lambda meets, c=column: meets(c))


def contract_from_schema(df: DataFrame, object_type: str) -> DataFrame:
    """One row per column of any DataFrame and per path inside nested columns.

    Nullability plays the part of the field type.
    """
    rows = [
        (object_type, path, kind, "nullable" if nullable else "required") for path, kind, nullable, _ in _columns(df)
    ]
    return df.sparkSession.createDataFrame(rows, CONTRACT_SCHEMA)


def contract_from_rows(df: DataFrame, object_type: str) -> DataFrame:
    """The paths of :func:`contract_from_schema` with what all rows show of them, in one aggregate.

    The field type is ``required`` if every value a path could have is there, ``optional`` if some
    are NULL, and ``unseen`` if there is none: a field of a struct that is always NULL, the
    elements of arrays that are all empty, any path of an empty table.
    """
    paths = list(_columns(df))
    aggregates = []
    for i, (_, _, _, any_value) in enumerate(paths):
        aggregates.append(F.bool_or(any_value(lambda value: value.isNotNull())).alias(f"seen{i}"))
        aggregates.append(F.bool_or(any_value(lambda value: value.isNull())).alias(f"gaps{i}"))
    rows = [
        F.struct(
            F.lit(object_type).alias("object_type"),
            F.lit(path).alias("name"),
            F.lit(kind).alias("type"),
            F.when(~F.coalesce(f"seen{i}", F.lit(False)), "unseen")
            .when(F.col(f"gaps{i}"), "optional")
            .otherwise("required")
            .alias("field_type"),
        )
        for i, (path, kind, _, _) in enumerate(paths)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


#: Of a schema text, its names (quoted where they are not plain), kinds, brackets and separators.
_TOKENS = r"(?:`[^`]*`)+|[<>:,]|\([^)]*\)|[^`<>:,() ]+(?: [^`<>:,() ]+)*"


def _shape(blob: str) -> Column:
    """The schema of a blob as text, so that blobs of the same names and kinds have one text.

    A decimal counts whatever its precision; with a quoted name the text is left as it is,
    for the name might read like a type.
    """
    schema = F.schema_of_variant(blob)
    plain = schema.contains("(") & ~schema.contains("`")
    return F.when(plain, F.regexp_replace(schema, r"\([0-9]+,[0-9]+\)", "")).otherwise(schema)


def _properties(shape: Column) -> Column:
    """``array<struct<name, kind>>`` of the properties an object's shape holds at its top.

    The kind is that of a JSON value: string, number, boolean, object, array; NULL for a JSON null.
    """
    start = F.expr(
        "named_struct('depth', 0, 'name', cast(null as string), "
        "'found', cast(array() as array<struct<name:string,type:string>>))"
    )

    def step(state: Column, token: Column) -> Column:
        depth, name, found = state["depth"], state["name"], state["found"]
        mark = token.isin("<", ">", ":", ",") | token.startswith("(")
        word = (depth == 1) & ~mark
        pair = F.array(F.struct(name.alias("name"), token.alias("type")))
        return F.struct(
            (depth + F.when(token == "<", 1).when(token == ">", -1).otherwise(0)).alias("depth"),
            F.when(~word, name).when(name.isNull(), token).alias("name"),
            F.when(word & name.isNotNull(), F.concat(found, pair)).otherwise(found).alias("found"),
        )

    def typed(found: Column) -> Column:
        kind = (
            F.when(found["type"] == "VOID", F.lit(None))
            .when(found["type"].isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")
            .otherwise(F.lower(found["type"]))
        )
        quoted = F.replace(F.substring(found["name"], F.lit(2), F.length(found["name"]) - 2), F.lit("``"), F.lit("`"))
        name = F.when(found["name"].startswith("`"), quoted).otherwise(found["name"])
        return F.struct(name.alias("name"), kind.alias("kind"))

    found = F.aggregate(F.regexp_extract_all(shape, F.lit(_TOKENS), F.lit(0)), start, step, lambda state: state["found"])
    return (
        F.when(shape.startswith("OBJECT<"), F.transform(found, typed))
        .when(shape == "VOID", F.array().cast("array<struct<name:string,kind:string>>"))
        .otherwise(F.raise_error(F.concat(F.lit("a blob is not an object: "), shape)))
    )


def contract_from_blobs(
    raw: DataFrame, object_type: str, blob: str = "properties", tracked: Sequence[str] = ()
) -> DataFrame:
    """The contract a VARIANT column actually follows, from all its rows.

    The type is the kind of JSON value seen (string, number, boolean, ...), several joined
    by '|', 'unknown' when only nulls were seen; the field type tells whether the property
    was present in every row.

    Rows are counted by the shape of their blob, in one pass and without taking any apart;
    properties are read off the few shapes.  ``tracked`` names need no path of their own, so
    naming them changes nothing.
    """
    shapes = raw.where(F.col(blob).isNotNull()).select(_shape(blob).alias("shape"))
    shapes = shapes.groupBy("shape").agg(F.count(F.lit(1)).alias("n"))
    # A row without a name stands for the blobs themselves.
    whole = F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("kind")))
    parts = shapes.select("n", F.inline(F.concat(whole, _properties(F.col("shape")))))
    found = parts.groupBy("name").agg(F.collect_set("kind").alias("kinds"), F.sum("n").alias("n"))
    # One row per property: bounded by the width of the source.
    total = F.max(F.when(F.col("name").isNull(), F.col("n"))).over(Window.partitionBy(F.lit(object_type)))
    found = found.withColumn("total", total).where(F.col("name").isNotNull())
    kinds = F.concat_ws("|", F.array_sort("kinds"))
    return found.select(
        F.lit(object_type).alias("object_type"),
        "name",
        F.when(kinds == "", "unknown").otherwise(kinds).alias("type"),
        F.when(F.col("n") == F.col("total"), "required").otherwise("optional").alias("field_type"),
    )


def diff(baseline: DataFrame, live: DataFrame) -> DataFrame:
    """``(object_type, name, change, was_*, now_*)`` with change removed, changed or added.

    Only object types of the baseline are compared.
    """
    nothing = F.lit(None).cast("struct<type:string,field_type:string>")
    pair = F.struct("type", "field_type")
    sides = baseline.select("object_type", "name", pair.alias("was"), nothing.alias("now")).unionByName(
        live.select("object_type", "name", nothing.alias("was"), pair.alias("now"))
    )
    # One row per property, then the properties of an object together: both bounded by the
    # width of the sources, not by their rows.
    merged = sides.groupBy("object_type", "name").agg(F.max("was").alias("was"), F.max("now").alias("now"))
    watched = F.max(F.col("was").isNotNull()).over(Window.partitionBy("object_type"))
    change = (
        F.when(F.col("now").isNull(), "removed")
        .when(F.col("was").isNull(), "added")
        .when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    )
    return (
        merged.withColumn("_watched", watched)
        .withColumn("change", change)
        .where(F.col("_watched") & F.col("change").isNotNull())
        .select(
            "object_type",
            "name",
            "change",
            F.col("was.type").alias("was_type"),
            F.col("was.field_type").alias("was_field_type"),
            F.col("now.type").alias("now_type"),
            F.col("now.field_type").alias("now_field_type"),
        )
    )


def _severity(changes: DataFrame):
    """Over a group of changes: breaking beats informational beats none."""
    breaking = F.max(F.col("change").isin("removed", "changed"))
    return (
        F.when(F.coalesce(breaking, F.lit(False)), BREAKING)
        .when(F.count("change") > 0, INFORMATIONAL)
        .otherwise(NONE)
    )


def status(changes: DataFrame) -> DataFrame:
    """One row: ``(status, exit_code, removed, changed, added)``."""
    counted = changes.agg(
        _severity(changes).alias("status"),
        *[
            F.count_if(F.col("change") == c).cast("bigint").alias(c)
            for c in ("removed", "changed", "added")
        ],
    )
    code = F.when(F.col("status") == BREAKING, EXIT_CODES[BREAKING]).when(
        F.col("status") == INFORMATIONAL, EXIT_CODES[INFORMATIONAL]
    ).otherwise(EXIT_CODES[NONE])
    return counted.select("status", code.cast("int").alias("exit_code"), "removed", "changed", "added")


def report(baseline: DataFrame, changes: DataFrame) -> DataFrame:
    """Per object: ``(object_type, status, tracked, details)`` with status OK, WARN or FAIL.

    A changed property is listed with what it was and what it is now.
    """
    sides = F.concat(
        F.lit(" ("), F.concat_ws("/", "was_type", "was_field_type"),
        F.lit(" -> "), F.concat_ws("/", "now_type", "now_field_type"), F.lit(")"),
    )
    line = F.concat(
        F.upper("change"), F.lit(" "), F.col("name"), F.when(F.col("change") == "changed", sides).otherwise("")
    )
    per_object = changes.groupBy("object_type").agg(
        _severity(changes).alias("severity"),
        # Bounded by the number of properties an object has.
        F.concat_ws("; ", F.array_sort(F.collect_list(line))).alias("details"),
    )
    # The whole rows, as the comparison takes them: their plan is then the same as there and runs once.
    rows = F.collect_list(F.struct("name", "type", "field_type"))
    tracked = baseline.groupBy("object_type").agg(F.size(rows).cast("bigint").alias("tracked"))
    label = (
        F.when(F.col("severity") == BREAKING, "FAIL")
        .when(F.col("severity") == INFORMATIONAL, "WARN")
        .otherwise("OK")
    )
    return tracked.join(per_object, "object_type", "left").select(
        "object_type", label.alias("status"), "tracked", F.coalesce("details", F.lit("")).alias("details")
    )


def write_snapshot(contract: DataFrame, path: str) -> None:
    """Write the accepted contract, sorted, as JSON; missing parent folders are created.

    A contract is a schema: its size follows the number of properties, not of rows.
    """
    contract.coalesce(1).sortWithinPartitions("object_type", "name").write.mode("overwrite").json(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(CONTRACT_SCHEMA).json(path)
    except AnalysisException as error:
        raise FileNotFoundError(
            f"no contract at {path}; write a snapshot of the accepted contract first"
        ) from error
