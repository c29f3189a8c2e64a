"""Forced reloading of files that were loaded before."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import SKIPPED
from tidemark.operators.tables import LakeTable, TempTables
from tidemark.sources import storage
from tidemark.sources.listing import without

FORCED = "file_name string, input_location_prefix string"


@dataclass(frozen=True)
class ReprocessPlan:
    """What the reprocess document asks for: everything, or some files, or nothing."""

    everything: bool = False
    files: list[tuple[str, str | None]] = field(default_factory=list)
    skipped_too: bool = False

    @property
    def empty(self) -> bool:
        return not (self.everything or self.files)


def plan_for(document: Mapping | None, execution_date: str, dataset: str) -> ReprocessPlan:
    """Read the entry of a dataset for one day.

    Entries of ``file_name`` are names, or ``{name, prefix}`` with one name or a list.
    ``includes_skipped_files`` counts beside the dataset or inside it.
    """
    day = (document or {}).get(execution_date) or {}
    entry = day.get(dataset)
    if not isinstance(entry, Mapping):
        return ReprocessPlan()
    wanted = entry.get("file_name") or []
    if isinstance(wanted, str):
        return ReprocessPlan(everything=wanted.lower() == "all")
    files: list[tuple[str, str | None]] = []
    for item in wanted:
        if isinstance(item, str):
            files.append((item, None))
            continue
        names = [item["name"]] if isinstance(item["name"], str) else item["name"]
        files.extend((name, item.get("prefix") or None) for name in names)
    files = [(name, prefix) for name, prefix in files if name]
    skipped = str(entry.get("includes_skipped_files", day.get("includes_skipped_files", "N"))).upper() == "Y"
    return ReprocessPlan(files=files, skipped_too=skipped and bool(files))


def forced_files(spark: SparkSession, plan: ReprocessPlan, done: DataFrame) -> DataFrame:
    """Files to load again, whatever the ledger says. A NULL prefix stands for any folder."""
    rows = [(n, storage.qualified(spark, p).rstrip("/") + "/" if p else None) for n, p in plan.files]
    forced = spark.createDataFrame(rows, FORCED)
    if plan.skipped_too:
        forced = forced.union(done.where(F.col("status") == SKIPPED).select("file_name", "input_location_prefix"))
    return forced.distinct()


def clean_staged(
    table: LakeTable, execution_date: str, cycle_id: str, forced: DataFrame, listed: DataFrame | None = None
) -> list[str]:
    """Remove what other dates and cycles than the given one hold of forced files.

    ``forced`` has ``file_name`` and ``input_location_prefix``, where NULL stands for any folder. Where everything is
    reloaded, ``listed`` has all files that were there to load: only those of them that are not forced keep
    their old rows. Runs after the new rows have landed, so files that failed, were skipped or are illegal keep their old ones.
    Partitions that hold rows of other files too are rewritten without the old rows; the rest is dropped.
    """
    if not table.exists():
        return []
    now = (F.col("execution_date") == execution_date) & (F.col("execution_cycle_id") == cycle_id)
    names = forced.select(F.col("file_name").alias("source_file_name")).distinct()
    parts = table.partitions().where(~now)
    hit = parts if listed is not None else parts.join(names, "source_file_name", "left_semi")
    doomed = {r["partition"]: tuple(r[k] for k in table.keys) for r in hit.collect()}
    if not doomed:
        return []
    here = table.read().where(~now)
    placed = here.withColumn("__folder", storage.folder_name(F.col("source_file_location")))
    with TempTables(table.spark, "kept-rows") as temp:
        if listed is None:
            kept = placed.join(names, "source_file_name", "left_semi")
        else:
            there = listed.select(F.col("file_name").alias("source_file_name"), F.col("input_location_prefix").alias("__folder"))
            kept = placed.join(there, ["source_file_name", "__folder"], "left_semi")
        kept = temp.keep(without(kept, forced, "source_file_name", "__folder").select(*here.columns), "others")
        stay = {tuple(r) for r in kept.select(*table.keys).distinct().collect()}
        if stay:
            table.land(kept)
        drop = [folder for folder, keys in doomed.items() if keys not in stay]
        if drop:
            table.purge(F.col("partition").isin(drop))
    return drop


def take_back(table: LakeTable, execution_date: str, cycle_id: str, files: DataFrame) -> list[str]:
    """Remove what a cycle holds of ``files`` (``source_path, file_name``), whether the landing was complete or not.

    Partition folders that a broken write left outside the catalog are taken up first, so their rows do not come back with the
    next repair. Rows of other files of the same name stay. Returns the partitions dropped.
    """
    if not table.exists():
        return []
    cycle = {"execution_date": execution_date, "execution_cycle_id": cycle_id}
    names = sorted(r.file_name for r in files.select("file_name").distinct().collect())
    known = {r["source_file_name"]: r["partition"] for r in table.partitions(cycle).collect()}
    folder = "/".join([table.location, *(f"{k}={v}" for k, v in cycle.items())])
    there = {p.rsplit("/", 1)[-1] for p in storage.children(table.spark, folder)}
    for name in names:
        if name not in known and f"source_file_name={name}" in there:
            table.add_partition({**cycle, "source_file_name": name})
            known[name] = "/".join(f"{k}={v}" for k, v in {**cycle, "source_file_name": name}.items())
    hit = [n for n in names if n in known]
    if not hit:
        return []
    table.spark.catalog.refreshTable(table.name)
    with TempTables(table.spark, "kept-rows") as temp:
        paths = files.select(F.col("source_path").alias("__path"))
        rows = table.slices(cycle, "source_file_name", hit)
        kept = temp.keep(rows.join(paths, F.col("source_file_location") == F.col("__path"), "left_anti"), "others")
        stay = {r[0] for r in kept.select("source_file_name").distinct().collect()}
        if stay:
            table.land(kept)
    drop = [known[n] for n in hit if n not in stay]
    if drop:
        table.purge(F.col("partition").isin(drop))
    return drop


def clean_cycle(table: LakeTable, execution_date: str, cycle_id: str) -> list[str]:
    """Remove what a failed run left behind."""
    return table.purge(
        (F.col("execution_date") == execution_date) & (F.col("execution_cycle_id") == cycle_id), depth=2
    )
