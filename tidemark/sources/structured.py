"""JSON and Parquet files, and scans of partitioned folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import standardize_names
from tidemark.operators.schema import json_schema
from tidemark.operators.shape import flatten, flatten_apart
from tidemark.sources import storage, tasks
from tidemark.sources.delimited import LOCATION, with_location


#: Ways to make rows of nested arrays, by the words of a spec.
FLATTENERS = {"product": flatten, "apart": flatten_apart}


def read_json(
    spark: SparkSession,
    paths: Sequence[str],
    options: Mapping[str, str] | None = None,
    schema_doc: Mapping | Sequence | None = None,
    arrays: str = "product",
) -> DataFrame:
    """Nested documents as flat rows. Without a declared schema Spark infers one.

    ``arrays``: ``product`` gives a row for each combination of elements of arrays that stand side by side, ``apart`` one for each element.
    """
    reader = spark.read.options(**(options or {}))
    if schema_doc is not None:
        reader = reader.schema(json_schema(schema_doc))
    located = with_location(reader.json([storage.literal_path(p) for p in paths]))
    return standardize_names(FLATTENERS[arrays](standardize_names(located), keep=(LOCATION,)))


def read_parquet(
    spark: SparkSession,
    paths: Sequence[str],
    options: Mapping[str, str] | None = None,
    schema_mode: str = "latest",
) -> DataFrame | None:
    """Parquet files under the schema of the newest one, or of all with ``merge``.

    The newest file with rows decides. Tasks read the footers, in one job, and group the files by schema. While the types of equal
    names agree there is one read; where they differ, files of one schema are a read each, and their values become the newest
    type. A value that has no place in it is an error that names its file and column.
    """
    if not paths:
        return None
    full = [p if tasks.scheme(p) else storage.qualified(spark, p) for p in paths]
    reader = spark.read.options(**(options or {}))
    literal = [storage.literal_path(p) for p in full]
    if not tasks.reachable(full):
        return _read_parquet_alike(spark, reader, literal, schema_mode)
    groups = _schema_groups(spark, full)
    if not groups:
        return reader.parquet(*literal).transform(with_location).transform(standardize_names) if schema_mode == "merge" else None
    newest = groups[-1][0]
    known: dict[str, T.DataType] = {}
    agree = all(known.setdefault(f.name.lower(), f.dataType) == f.dataType for schema, _ in groups for f in schema.fields)
    if agree and schema_mode == "merge":
        return standardize_names(with_location(reader.option("mergeSchema", True).parquet(*literal)))
    if agree:
        return standardize_names(with_location(reader.schema(newest).parquet(*literal)))
    # Newest first: the first type of a name is the one that counts.
    types: dict[str, T.StructField] = {}
    for schema, _ in reversed(groups):
        for f in schema.fields:
            types.setdefault(f.name.lower(), f)
    wanted = list(types.values()) if schema_mode == "merge" else newest.fields
    parts = []
    for schema, own in groups:
        rows = with_location(reader.schema(schema).parquet(*[storage.literal_path(p) for p in own]))
        parts.append(rows.select(*[_converted(schema, f) for f in wanted], LOCATION))
    return standardize_names(reduce(DataFrame.union, parts))


def _schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Spark's schema of the files that share one, with their paths; the newest file with rows comes last.

    Schemas of files without rows only are left out, and so are those files.
    """
    found: dict[str, tuple[T.StructType, list[str], str]] = {}
    for newest, own in tasks.parquet_groups(spark, paths):
        if newest is None:
            continue
        schema = spark.read.parquet(storage.literal_path(newest)).schema
        # Footers may differ where Spark's types do not.
        _, others, latest = found.get(schema.json(), (schema, [], newest))
        age = max(latest, newest, key=lambda p: (p.rsplit("/", 1)[-1], p))
        found[schema.json()] = (schema, [*others, *own], age)
    ordered = sorted(found.values(), key=lambda g: (g[2].rsplit("/", 1)[-1], g[2]))
    return [(schema, sorted(own)) for schema, own, _ in ordered]


def _converted(schema: T.StructType, wanted: T.StructField) -> Column:
    """A column of a group in the wanted type: NULL where the group has none, an error for a value the type does not hold."""
    own = next((f for f in schema.fields if f.name.lower() == wanted.name.lower()), None)
    if own is None:
        return F.lit(None).cast(wanted.dataType).alias(wanted.name)
    value = F.col(f"`{own.name}`")
    if own.dataType == wanted.dataType:
        return value.alias(wanted.name)
    kind = wanted.dataType.simpleString()
    if not isinstance(own.dataType, T.AtomicType) or not isinstance(wanted.dataType, T.AtomicType):
        raise ValueError(f"column {own.name!r} is {own.dataType.simpleString()} in some files and {kind} in newer ones")
    cast = value.try_cast(wanted.dataType)
    told = F.concat(F.col(LOCATION), F.lit(f": column {own.name!r} has a value that is no {kind}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(told).cast(wanted.dataType)).otherwise(cast).alias(wanted.name)


def _read_parquet_alike(spark: SparkSession, reader, paths: Sequence[str], schema_mode: str) -> DataFrame | None:
    """For file systems that tasks cannot open: files whose types agree."""
    if schema_mode == "merge":
        return standardize_names(with_location(reader.option("mergeSchema", True).parquet(*paths)))
    held = with_location(spark.read.schema(T.StructType([])).parquet(*paths)).select(LOCATION)
    newest = held.agg(F.max(F.struct(storage.base_name(F.col(LOCATION)), LOCATION)).alias("newest")).first()["newest"]
    if newest is None:
        return None
    schema = spark.read.parquet(storage.literal_path(newest[LOCATION])).schema
    return standardize_names(with_location(reader.schema(schema).parquet(*paths)))


def scan_partitioned(
    spark: SparkSession, base: str, keys: Sequence[str], folders: Sequence[str] = (), merge_schema: bool = False
) -> DataFrame:
    """Parquet below ``base`` with the partition columns of its folder names, as strings.

    Left to itself Spark would turn dates and cycles into numbers and lose leading zeros.
    """
    paths = [f"{base}/{f}" for f in folders] or [base]
    reader = spark.read.option("basePath", base)
    found = reader.option("mergeSchema", merge_schema).parquet(*paths).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in keys else f for f in found.fields]
    return reader.schema(T.StructType(fields)).parquet(*paths)
