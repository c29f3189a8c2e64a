"""Reads of the newest partitions, and history built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.operators.tables import LakeTable

# Audit and partition columns that never belong to the data.
HISTORY_AUDIT = ("source_file_location", "processed_time", "execution_date", "execution_cycle_id", "source_file_name")
STAGING_AUDIT = ("execution_date", "execution_cycle_id", "pt_batch_id", "pt_cycle_id", "pt_file_id", "pt_data_dt")
FULL_LOAD = "full load"

Override = Mapping[str, str] | str | None


def override_for(document: Mapping | None, execution_date: str, dataset: str) -> Override:
    """The partition override of a dataset for one day: key values, ``"full load"`` or None."""
    return ((document or {}).get(execution_date) or {}).get(dataset) or None


def _is_full_load(override: Override) -> bool:
    return isinstance(override, str) and override.lower() == FULL_LOAD


def _pinned(keys: Sequence[str], override: Mapping[str, str]) -> Column:
    missing = [k for k in keys if k not in override]
    if missing:
        raise ValueError(f"the override gives no value for partition keys {missing}")
    return reduce(Column.__and__, [quoted(k) == F.lit(override[k]) for k in keys])


def _partition_keys(spark: SparkSession, table: str) -> list[str]:
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).isTemporary:
        return []
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _newest(rows: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> Column:
    """Equality with the greatest listed key combination that has rows.

    Walks down from the greatest and stops at the first with data, which is nearly
    always the first: only a partition registered without rows is passed over.
    """
    key = F.struct(*[quoted(k) for k in keys])
    listed = candidates.where(reduce(Column.__and__, [quoted(k).isNotNull() for k in keys])).select(*keys).distinct()
    below = F.lit(True)
    while True:
        top = listed.where(below).agg(F.max(key).alias("top")).first()["top"]
        if top is None:
            return F.lit(False)
        hit = reduce(Column.__and__, [quoted(k) == F.lit(top[k]) for k in keys])
        if not rows.where(hit).isEmpty():
            return hit
        below = key < F.struct(*[F.lit(top[k]).alias(k) for k in keys])


def newest_rows(spark: SparkSession, table: str, keys: Sequence[str], mode: str = "independent") -> DataFrame:
    """Rows at the greatest key values.

    ``independent`` takes the maximum of each key by itself, ``tuple`` the greatest
    combination. Partition keys are looked up without opening a data file, in the folder names of their own levels where
    lower keys follow and else in the catalog, and prune the scan as constants; other columns use a scalar subquery.
    """
    if not keys:
        raise ValueError("no keys given")
    rows = spark.table(table)
    partitioned = _partition_keys(spark, table)
    groups = [list(keys)] if mode == "tuple" else [[k] for k in keys]
    if mode not in ("independent", "tuple"):
        raise ValueError(f"mode must be 'independent' or 'tuple', not {mode!r}")
    depth = max((partitioned.index(k) + 1 for group in groups for k in group if k in partitioned), default=0)
    listing = None
    tests = []
    for group in groups:
        if all(k in partitioned for k in group):
            if listing is None:
                lake = LakeTable(spark, *_split(spark, table), "", tuple(partitioned))
                # The last level of keys is as long as there are files; above it folder names say enough.
                listing = lake.leading(depth) if depth < len(partitioned) else None
                listing = lake.partitions() if listing is None else listing
            tests.append(_newest(rows, listing, group))
        else:
            key = quoted(group[0]) if len(group) == 1 else F.struct(*[quoted(k) for k in group])
            tests.append(key == spark.table(table).agg(F.max(key).alias("top")).scalar())
    return rows.where(reduce(Column.__and__, tests))


def _split(spark: SparkSession, table: str) -> tuple[str, str]:
    found = spark.catalog.getTable(table)
    return found.namespace[-1], found.name


def previous_history(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    staging_table: str | None = None,
    staging_keys: Sequence[str] = (),
    drop: Sequence[str] = (),
    override: Override = None,
    mode: str = "independent",
) -> DataFrame:
    """Data columns of the newest (or pinned) history partitions.

    An override of ``"full load"`` gives no rows. Where the history does not exist yet,
    the result has the staging table's columns and no rows.
    """
    if not keys:
        raise ValueError("no partition keys of the history table given")
    unwanted = [*keys, *staging_keys, *HISTORY_AUDIT, *drop]
    if not spark.catalog.tableExists(table):
        if not staging_table or not staging_keys:
            raise ValueError(f"{table} does not exist; a staging table and its keys are needed for the structure")
        return spark.table(staging_table).limit(0).drop(*unwanted)
    return _selected_history(spark, table, keys, override, mode).drop(*unwanted)


def previous_history_dw(
    spark: SparkSession, table: str, keys: Sequence[str], drop: Sequence[str] = (), override: Override = None
) -> DataFrame:
    """Like :func:`previous_history`, but a missing table is an error."""
    if not keys:
        raise ValueError("no partition keys of the history table given")
    return _selected_history(spark, table, keys, override, "independent").drop(*keys, *HISTORY_AUDIT, *drop)


def _selected_history(spark, table: str, keys: Sequence[str], override: Override, mode: str) -> DataFrame:
    if not override:
        return newest_rows(spark, table, keys, mode)
    if _is_full_load(override):
        return spark.table(table).limit(0)
    if isinstance(override, str):
        raise ValueError(f"override {override!r} is neither key values nor {FULL_LOAD!r}")
    return spark.table(table).where(_pinned(keys, override))


def latest_staging(
    spark: SparkSession,
    table: str,
    load_type: str | None = "",
    keys: Sequence[str] = (),
    drop: Sequence[str] = (),
    override: Override = None,
    history_override: Override = None,
    mode: str = "independent",
) -> DataFrame:
    """Data columns of the staging rows a run works on.

    ``load_type``: blank for the newest value of every key or the pinned values, ``full``,
    ``latest_cycle`` or ``latest_date``. A history override of ``"full load"`` forces ``full``.
    """
    rows = spark.table(table)
    kind = "full" if _is_full_load(history_override) else (load_type or "").lower()
    if kind == "full" or (kind == "" and _is_full_load(override)):
        chosen = rows
    elif kind == "":
        chosen = rows.where(_pinned(keys, override)) if override else newest_rows(spark, table, keys, mode)
    elif kind in ("latest_cycle", "latest_date"):
        wanted = ("execution_cycle_id", "pt_cycle_id") if kind == "latest_cycle" else ("execution_date",)
        present = next((c for c in wanted if c in rows.columns), None)
        chosen = newest_rows(spark, table, [present] if present else keys, "independent" if present else mode)
    else:
        raise ValueError(f"load type {load_type!r} is not one of '', full, latest_cycle, latest_date")
    return chosen.drop(*keys, *STAGING_AUDIT, *drop)


def append_history(history: DataFrame, staging: DataFrame, load_column: str, load_time: Column) -> DataFrame:
    """History with the distinct staging rows appended, stamped with their load time.

    History that has no load time yet gets the same one. Columns go by name, and one that
    is missing on a side is NULL there.
    """
    if load_column not in history.columns:
        history = history.withColumn(load_column, load_time)
    fresh = staging.drop(load_column).distinct().withColumn(load_column, load_time)
    return history.unionByName(fresh, allowMissingColumns=True)
