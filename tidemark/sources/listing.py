"""Which files a run has to load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import masks
from tidemark.session import scratch_path
from tidemark.sources import storage, tasks

LISTING = "source_path string, input_location_prefix string, file_name string"


def source_files(spark: SparkSession, prefixes: str | Sequence[str], keep=None) -> DataFrame:
    """One row per file below the prefix or prefixes, files without bytes included.

    Tasks list the folders (``tasks.files_below``), so the driver's part does not grow with the files. ``keep`` stores a
    DataFrame under a name; without one the listing is stored until the application ends.
    """
    folders = [prefixes] if isinstance(prefixes, str) else list(prefixes)
    if not folders:
        raise ValueError("no source prefix given")
    full = {storage.qualified(spark, f).rstrip("/"): f for f in folders}
    if not tasks.reachable(list(full)):
        return _listed_by_driver(spark, folders)
    if keep is None:
        root = scratch_path(spark, "listing")
        storage.delete_at_exit(spark, root)

        def keep(rows: DataFrame, name: str) -> DataFrame:
            rows.write.parquet(f"{root}/{name}")
            return spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    found = tasks.files_below(spark, list(full), keep)
    # One row per prefix.
    empty = set(full) - {r.root for r in found.select("root").distinct().collect()}
    if empty:
        raise FileNotFoundError(f"no files in source location {', '.join(sorted(full[f] for f in empty))}")
    path = F.col("source_path")
    # Prefixes may lie within each other.
    paths = found.select(F.col("path").alias("source_path"))
    paths = paths.distinct() if len(full) > 1 else paths
    return paths.select(path, storage.folder_name(path).alias("input_location_prefix"), storage.base_name(path).alias("file_name"))


def _listed_by_driver(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """For file systems that only Spark's own classes can open."""
    paths = []
    for folder in folders:
        found = storage.leaf_files(spark, folder)
        if not found:
            raise FileNotFoundError(f"no files in source location {folder}")
        paths.extend(found)
    return listing_frame(spark, sorted(set(paths)))


def listing_frame(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = [(p, p[: p.rindex("/") + 1], p[p.rindex("/") + 1 :]) for p in paths]
    return spark.createDataFrame(rows, LISTING)


def static_file(spark: SparkSession, prefixes: str | Sequence[str], name: str) -> DataFrame:
    """The one file with exactly this name, in each prefix. It never meets the ledger."""
    folders = [prefixes] if isinstance(prefixes, str) else prefixes
    return listing_frame(spark, [storage.qualified(spark, f"{f.rstrip('/')}/{name}") for f in folders])


def masked(listing: DataFrame, mask: str | None, custom: bool = False, tokens=masks.CUSTOM_TOKENS) -> DataFrame:
    name = F.col("file_name")
    if mask and custom:
        return listing.where(masks.custom_mask_matches(name, mask, tokens))
    return listing.where(masks.mask_matches(name, mask))


def checked_paths(listing: DataFrame) -> list[str]:
    """Paths of the listed files, for Spark's readers. Raises when a name is not allowed."""
    name = F.col("file_name")
    found = listing.select("source_path", "file_name", masks.legal_name(name).alias("legal")).collect()
    offenders = sorted(r.file_name for r in found if not r.legal)
    if offenders:
        raise ValueError(f"{len(offenders)} file names with characters that are not allowed: {offenders[:20]}")
    return sorted(r.source_path for r in found)


#: What tells files apart, by the words of a spec: the name alone, or with the folder.
IDENTITIES = {"name": ["file_name"], "path": ["input_location_prefix", "file_name"]}


def pending(listing: DataFrame, done: DataFrame, identity: Sequence[str], forced: DataFrame | None = None) -> DataFrame:
    """Listed files that the ledger does not hold, forced ones included again.

    ``done`` has the ledger's ``file_name`` and ``input_location_prefix``; ``forced`` has
    the same columns, and a NULL prefix there stands for any folder.
    """
    if forced is not None:
        done = without(done, forced)
    todo = listing.join(done.select(*identity), list(identity), "left_anti")
    if "input_location_prefix" in identity:
        # A ledger taken over from the former layout knows no folders.
        todo = todo.join(done.where("input_location_prefix = ''").select("file_name"), "file_name", "left_anti")
    return todo


def without(rows: DataFrame, forced: DataFrame, name: str = "file_name", prefix: str = "input_location_prefix") -> DataFrame:
    """Rows whose file is not forced.

    Two joins on equal keys, with and without folder: one join on the name alone would
    compare all files of one name with each other.
    """
    f_name, f_prefix = F.col("file_name").alias("f_name"), F.col("input_location_prefix").alias("f_prefix")
    placed = forced.where("input_location_prefix IS NOT NULL").select(f_name, f_prefix)
    anywhere = forced.where("input_location_prefix IS NULL").select(f_name)
    rest = rows.join(placed, (F.col(name) == F.col("f_name")) & (F.col(prefix) == F.col("f_prefix")), "left_anti")
    return rest.join(anywhere, F.col(name) == F.col("f_name"), "left_anti")
