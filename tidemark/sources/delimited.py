"""CSV and delimited text, many files in one read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import require_distinct, standard_name, standardize_names
from tidemark.operators.schema import flat_schema
from tidemark.operators.shape import align, cast_declared
from tidemark.sources import storage, tasks

LOCATION = "source_file_location"


def with_location(df: DataFrame) -> DataFrame:
    """Add the path of the file each row came from. Call right after the read."""
    if LOCATION in (c.lower() for c in df.columns):
        raise ValueError(f"the files have a column {LOCATION!r}, which is the name of an audit column")
    return df.select("*", storage.plain_path(F.col("_metadata.file_path")).alias(LOCATION))


def read_declared(
    spark: SparkSession,
    paths: Sequence[str],
    schema_doc: Sequence[Mapping[str, str]],
    header: bool,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files of one declared schema; columns are taken by position."""
    reader = spark.read.options(**(options or {})).option("header", header).schema(flat_schema(schema_doc))
    typed = cast_declared(with_location(reader.csv([storage.literal_path(p) for p in paths])), schema_doc)
    return standardize_names(typed)


def header_groups(
    spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None
) -> list[tuple[list[str], list[str]]]:
    """Files grouped by header: ``(column names, paths)``, the greatest file name last.

    Spark takes the names of a multi-file read from one file and fills them by position,
    so files whose headers differ must not share a read. Tasks fetch the heads, in one job for all files.
    """
    options = dict(options or {})
    multiline = str(options.get("multiline", "false")).lower() == "true"
    how = (options.get("encoding", "UTF-8"), multiline, options.get("quote", '"'), options.get("escape", "\\"))
    named = {storage.qualified(spark, p): p for p in paths} if paths and not tasks.scheme(paths[0]) else {p: p for p in paths}
    if tasks.reachable(list(named)):
        groups = [[named[p] for p in group] for group in tasks.header_paths(spark, list(named), *how)] if paths else []
    else:
        by_head: dict[str, list[str]] = {}
        for path, head in storage.first_records(spark, paths, *how).items():
            if head is not None:
                by_head.setdefault(head, []).append(path)
        groups = list(by_head.values())
    ordered = sorted(groups, key=lambda group: max(p.rsplit("/", 1)[-1] for p in group))
    reader = spark.read.options(**options).option("header", True)
    return [(reader.csv(storage.literal_path(group[0])).columns, group) for group in ordered]


def read_header_strings(
    spark: SparkSession,
    paths: Sequence[str],
    options: Mapping[str, str] | None = None,
    schema_mode: str = "latest",
) -> DataFrame | None:
    """Files with a header and no schema: names from the header, every column a string.

    ``latest`` keeps the columns of the newest header, ``merge`` those of all headers.
    None when no file has a header line.
    """
    parts = []
    for raw_names, group in header_groups(spark, paths, options):
        names = [standard_name(n) for n in raw_names]
        require_distinct(raw_names, names)
        # Read under the final names: the header line is skipped and columns go by position.
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = spark.read.options(**(options or {})).option("header", True).schema(schema)
        parts.append(with_location(reader.csv([storage.literal_path(p) for p in group])))
    if len(parts) > 1:
        # Files with nothing but a header have no say in the columns.
        parts = [p for p in parts if not p.isEmpty()] or parts[-1:]
    return combine(parts, schema_mode)


def combine(parts: Sequence[DataFrame], schema_mode: str) -> DataFrame | None:
    """Union of reads with differing columns, oldest first."""
    if not parts:
        return None
    if schema_mode == "merge":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema_mode != "latest":
        raise ValueError(f"schema_mode must be 'latest' or 'merge', not {schema_mode!r}")
    latest = parts[-1].schema
    return reduce(DataFrame.union, [align(p, latest) for p in parts])
