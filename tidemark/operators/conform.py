"""Tables of different shape brought to one shape by mapping metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def conform(spark: SparkSession, mapping: DataFrame, config: DataFrame, dataset: str) -> DataFrame:
    """Union of all mapped sources as distinct, all-string rows in target column order.

    Only the mapping rows of the dataset, one per target column and source, come to the
    driver; the data itself is read, filtered and made distinct by Spark per source.
    """
    active = (F.col("dataset_name") == dataset) & (F.col("active_flag") == "Y")
    entries = (
        mapping.where(active)
        .select(
            "source_schema_name",
            "source_table_name",
            "source_column_name",
            "target_column_name",
            F.col("target_column_sequence").cast("int").alias("sequence"),
        )
        .distinct()
        .orderBy("sequence", "target_column_name")
        .collect()
    )
    if not entries:
        raise ValueError(f"no active mapping for dataset {dataset!r}")
    targets = list(dict.fromkeys(e.target_column_name for e in entries))
    filters = {
        (c.source_schema_name, c.source_table_name): c.clauses
        for c in config.where(active & (F.trim("where_clause") != ""))
        .groupBy("source_schema_name", "source_table_name")
        .agg(F.sort_array(F.collect_set(F.trim("where_clause"))).alias("clauses"))
        .collect()
    }
    sources: dict[tuple[str, str], dict[str, str | None]] = {}
    for e in entries:
        columns = sources.setdefault((e.source_schema_name, e.source_table_name), {})
        if columns.setdefault(e.target_column_name, e.source_column_name) != e.source_column_name:
            raise ValueError(f"{e.target_column_name!r} is mapped twice from {e.source_table_name!r}")
    parts = []
    for (schema, table), columns in sorted(sources.items(), key=lambda s: (s[0][0] or "", s[0][1])):
        rows = spark.table(f"{schema}.{table}" if schema else table)
        for clause in _single_clause(filters.get((schema, table), []), table):
            rows = rows.where(F.expr(clause))
        parts.append(
            rows.select(
                [(F.expr(columns[t]) if columns.get(t) else F.lit(None)).cast("string").alias(t) for t in targets]
            ).distinct()
        )
    return reduce(DataFrame.unionByName, parts)


def _single_clause(clauses: list[str], table: str) -> list[str]:
    if len(clauses) > 1:
        raise ValueError(f"several filters for source {table!r}: {clauses}")
    if clauses and clauses[0].lower().startswith("where"):
        raise ValueError(f"leave the word WHERE out of the filter for {table!r}")
    return clauses
