"""Row shaping between reading and writing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.formats import parse_date, parse_timestamp
from tidemark.functions.names import quoted, require_distinct


def cast_declared(df: DataFrame, schema_doc: Sequence[Mapping[str, str]]) -> DataFrame:
    """Cast declared date and timestamp columns; text that does not parse becomes NULL."""
    casts = {}
    for column in schema_doc:
        name, word = column["column_name"], column["column_data_type"].lower()
        if word == "date":
            casts[name] = parse_date(quoted(name), column.get("data_format"))
        elif word == "timestamp":
            casts[name] = parse_timestamp(quoted(name), column.get("data_format"))
    return df.withColumns(casts) if casts else df


def scrub_null_token(df: DataFrame) -> DataFrame:
    """Replace the text ``null`` by empty text in string columns; NULL stays NULL."""
    return df.replace("null", "")


def flatten(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Expand structs to ``parent_child`` columns and arrays to rows until none is left.

    The first nested column is taken each time. Empty and NULL arrays keep their row.
    At the end the name of the very first nested column is taken off as a prefix,
    except from the columns named in ``keep``.
    """
    first = _first_nested(df)
    field = first
    while field is not None:
        if isinstance(field.dataType, T.StructType):
            children = [quoted(field.name, c).alias(f"{field.name}_{c}") for c in field.dataType.names]
            kept = [quoted(c) for c in df.columns if c != field.name]
            df = df.select(*kept, *children)
        else:
            df = df.withColumn(field.name, F.explode_outer(quoted(field.name)))
        field = _first_nested(df)
    if first is None:
        return df
    renamed = [c if c in keep else c.removeprefix(f"{first.name}_") for c in df.columns]
    require_distinct(df.columns, renamed)
    return df.toDF(*renamed)


def flatten_apart(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Expand structs to ``parent_child`` columns and arrays to rows, each array by itself.

    Where :func:`flatten` gives the product of arrays that stand side by side, here every element has a row of its own with the columns
    of its document, NULL in the columns of the other arrays: a document has as many rows as its arrays have elements
    together, and one if it has none. One pass, whatever the number of arrays. Names are as in :func:`flatten`.
    """
    first = _first_nested(df)
    while (field := _first_nested(df)) is not None:
        structs = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
        if structs:
            nested = {f.name: f for f in structs}
            columns = []
            for f in df.schema.fields:
                inner = nested[f.name].dataType.names if f.name in nested else None
                columns += [quoted(f.name)] if inner is None else [quoted(f.name, c).alias(f"{f.name}_{c}") for c in inner]
            df = df.select(*columns)
            continue
        arrays = [f for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
        if len(arrays) == 1:
            df = df.withColumn(field.name, F.explode_outer(quoted(field.name)))
            continue
        elements = [f.dataType.elementType for f in arrays]

        def alone(place: int):
            """An element of one array as a struct that has a place for each of them."""
            return lambda x: F.struct(
                *[(x if i == place else F.lit(None).cast(kind)).alias(f"e{i}") for i, kind in enumerate(elements)]
            )

        every = F.concat(
            *[F.coalesce(F.transform(quoted(f.name), alone(i)), F.array().cast(_places(elements))) for i, f in enumerate(arrays)]
        )
        at = {f.name: i for i, f in enumerate(arrays)}
        df = df.withColumn("__element", F.explode_outer(every)).select(
            *[F.col(f"__element.e{at[c]}").alias(c) if c in at else quoted(c) for c in df.columns]
        )
    if first is None:
        return df
    renamed = [c if c in keep else c.removeprefix(f"{first.name}_") for c in df.columns]
    require_distinct(df.columns, renamed)
    return df.toDF(*renamed)


def _places(elements: Sequence[T.DataType]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f"e{i}", kind) for i, kind in enumerate(elements)]))


def _first_nested(df: DataFrame) -> T.StructField | None:
    return next((f for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType))), None)


def dedup_within_file(df: DataFrame) -> DataFrame:
    """Drop rows that repeat another row of the same file in every column.

    The file's location is one of the columns, so equal rows of two files both stay. Columns that
    hold maps, which have no order of their own, are compared as sorted entries.
    """
    maps = [f for f in df.schema.fields if _has_map(f.dataType)]
    if not maps:
        return df.dropDuplicates()
    plain = [c for c in df.columns if c not in {f.name for f in maps}]
    keys = {f"__compared_{i}": _comparable(quoted(f.name), f.dataType) for i, f in enumerate(maps)}
    return df.withColumns(keys).dropDuplicates([*plain, *keys]).drop(*keys)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def _comparable(value: Column, kind: T.DataType) -> Column:
    """The value with its maps as arrays of entries in order of their keys."""
    if not _has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(e["key"].alias("key"), _comparable(e["value"], kind.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(value), entry), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _comparable(e, kind.elementType))
    fields = [_comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def gather(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one partition folder together before a partitioned write.

    Keeps a write after a shuffle from leaving a file per task in every folder. Spark
    sizes the pieces at run time and splits those of a hot value.
    """
    return df.hint("rebalance", *columns)


def all_strings(df: DataFrame) -> DataFrame:
    return df.select([quoted(c).cast("string").alias(c) for c in df.columns])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; missing ones are NULL, others are dropped."""
    have = {c.lower() for c in df.columns}
    return df.select(
        [
            (quoted(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
