"""Run ledgers: what was loaded, when, and with which outcome."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import LOCATED_QUALITY_LOG, SKIPPED
from tidemark.operators.shape import align, scrub_null_token
from tidemark.operators.tables import LakeTable
from tidemark.sources import storage
from tidemark.sources.structured import scan_partitioned

# The file log names the file in a column: a partition per source file would leave one
# tiny file per source file, and every run reads this ledger.
RUN_LOG_KEYS = ("dataset_name", "execution_date", "execution_cycle_id")
OLD_KEYS = ("execution_date", "execution_cycle_id", "source_file_name")
QUALITY_LOG_KEYS = ("dataset_name", "ingestion_cycle_id", "stage")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _fields(text: str) -> T.StructType:
    kinds = {"string": T.StringType(), "bigint": T.LongType(), "array<string>": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(n, kinds[kind]) for n, kind in (c.split() for c in text.split(", "))])


# Counts are bigint: one file may hold more rows than an int can count.
# Columns of the run ledgers, in their order.
FILE_LOG = _fields(
    "table_name string, run_id string, input_location_prefix string, file_name string, file_type string, "
    "record_count bigint, execution_start_time string, execution_end_time string, ingestion_status string, "
    "source_file_name string"
)
INGESTION_LOG = _fields(
    "table_name string, run_id string, application string, source_files array<string>, static_file_pattern string, "
    "source_file_pattern string, file_type string, encoding string, escape string, multiline string, "
    "delimiter string, table_location string, target_schema string, target_table string, record_count bigint, "
    "execution_start_datetime string, execution_end_time string"
)
PROCESS_LOG = _fields(
    "application string, table_location string, table_schema string, table_name string, "
    "processed_table_record_count bigint, publish_table_schema string, publish_table_name string, "
    "publish_table_record_count bigint, execution_start_time string, execution_end_time string"
)

#: File names in one row of the run ledger. A run of more files has more rows.
NAMES_PER_ROW = 10_000


@dataclass(frozen=True)
class Ledgers:
    """The ledger tables of one application, all in one schema and below one location."""

    spark: SparkSession
    schema: str
    location: str
    application: str = "app"

    def _table(self, kind: str, keys: tuple[str, ...]) -> LakeTable:
        name = f"{kind}_{self.application}".replace("-", "_").lower()
        return LakeTable(self.spark, self.schema, name, f"{self.location.rstrip('/')}/{name}", keys)

    @property
    def file_log(self) -> LakeTable:
        return self._table("file_log", RUN_LOG_KEYS)

    @property
    def ingestion_log(self) -> LakeTable:
        return self._table("ingestion_log", RUN_LOG_KEYS)

    @property
    def process_log(self) -> LakeTable:
        return self._table("processed_table_log", RUN_LOG_KEYS)

    @property
    def quality_log(self) -> LakeTable:
        return self._table("quality_log", QUALITY_LOG_KEYS)


def write(
    table: LakeTable, schema: T.StructType, rows: DataFrame, partition: Mapping[str, str], name: str | None = None
) -> None:
    """Add rows to one partition of a ledger, keeping those that are there.

    The rows are written to a folder of their own, and the complete files, whose names are
    unique, are moved into the partition. Nothing that is there is read or replaced, so runs of one
    dataset and cycle may log side by side. With a ``name``, rows written a second time under it replace the first ones.
    A ledger made when file names were one text gets them as JSON.
    """
    if not table.exists():
        table.register(schema)
    wanted = T.StructType(table.data_schema().fields + _strings(*table.keys))
    texts = {f.name for f in wanted.fields if isinstance(f.dataType, T.StringType)}
    lists = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType) and f.name in texts]
    rows = rows.withColumns({n: F.to_json(n) for n in lists}) if lists else rows
    fresh = align(scrub_null_token(rows).withColumns({k: F.lit(v) for k, v in partition.items()}), wanted)
    table.add_files(fresh, partition, name)


def write_quality_log(
    table: LakeTable, rows: DataFrame, dataset: str, cycle_id: str, stage: str, name: str | None = None
) -> None:
    everything = rows.sparkSession.createDataFrame([], LOCATED_QUALITY_LOG).schema
    schema = T.StructType([f for f in everything.fields if f.name not in table.keys])
    write(table, schema, rows, {"dataset_name": dataset, "ingestion_cycle_id": cycle_id, "stage": stage}, name)


def one_row(spark: SparkSession, **values) -> DataFrame:
    """A single ledger row; the types follow from the values."""
    kinds = {int: T.LongType()}
    schema = T.StructType([T.StructField(k, kinds.get(type(v), T.StringType())) for k, v in values.items()])
    return spark.createDataFrame([tuple(values.values())], schema)


def run_rows(files: DataFrame, number: int, **values) -> DataFrame:
    """Rows of one run for the run ledger, with the names of its ``number`` files (``file_name``) in lots of about ``NAMES_PER_ROW``.

    All rows have the run's values, but the record count is in one of them only, so that sums over the ledger are right.
    """
    lots = max(1, -(-number // NAMES_PER_ROW))
    # Names may repeat from folder to folder, so the folder is part of the key.
    lot = F.pmod(F.xxhash64("input_location_prefix", "file_name"), F.lit(lots)) if lots > 1 else F.lit(0)
    first = files.agg(F.min(lot)).first()[0] if lots > 1 else 0
    named = files.groupBy(lot.alias("lot")).agg(F.sort_array(F.collect_list("file_name")).alias("source_files"))
    counts = {k: F.when(F.col("lot") == first, v).otherwise(0).cast("long") for k, v in values.items() if isinstance(v, int)}
    return named.withColumns(counts | {k: F.lit(v).cast("string") for k, v in values.items() if k not in counts}).drop("lot")


def file_log_rows(
    listing: DataFrame, counts: DataFrame, statuses: DataFrame | None, ingested: str, literals: dict[str, str]
) -> DataFrame:
    """One row per file of a run. A file without landed rows was skipped.

    ``counts`` has ``source_file_location, record_count``; ``statuses`` has the gate's
    ``gated_file, ingestion_status`` and is None without a gate.
    """
    rows = listing.join(counts, F.col("source_path") == F.col("source_file_location"), "left")
    landed = F.coalesce(F.col("record_count"), F.lit(0))
    if statuses is None:
        status = F.when(landed > 0, ingested).otherwise(SKIPPED)
    else:
        gate = statuses.select("gated_file", F.col("ingestion_status").alias("gate_status"))
        rows = rows.join(gate, F.col("source_path") == F.col("gated_file"), "left")
        status = F.coalesce("gate_status", F.lit(SKIPPED))
    return rows.select(
        "input_location_prefix",
        "file_name",
        F.col("file_name").alias("source_file_name"),
        landed.alias("record_count"),
        status.alias("ingestion_status"),
        *[F.lit(v).alias(k) for k, v in literals.items()],
    )


def done_files(file_log: LakeTable, dataset: str) -> DataFrame:
    """Files the ledger holds for a dataset with their last status; empty before the first run.

    Skipped files are among them: they are not tried again unless forced.
    """
    if not file_log.exists():
        return file_log.spark.createDataFrame([], "input_location_prefix string, file_name string, status string")
    latest = F.max_by("ingestion_status", F.struct("execution_date", "execution_cycle_id", "execution_end_time"))
    return (
        file_log.read()
        .where(F.col("dataset_name") == dataset)
        .groupBy("input_location_prefix", "file_name")
        .agg(latest.alias("status"))
    )


def migrate_file_log(old_location: str, table: LakeTable, remove_old: bool = False) -> int:
    """Move a ledger of the former layout into the present one. Returns the partitions added.

    The former ``dataset_name`` becomes ``table_name``; a missing run id becomes ``NA``.
    """
    old = scan_partitioned(table.spark, old_location, OLD_KEYS)
    rows = old.withColumnRenamed("dataset_name", "table_name").withColumns(
        {
            "dataset_name": F.col("table_name"),
            "run_id": F.coalesce(F.col("run_id"), F.lit("NA")) if "run_id" in old.columns else F.lit("NA"),
            "input_location_prefix": F.lit(""),
        }
    )
    return _migrate(rows, FILE_LOG, table, old_location, remove_old)


def migrate_ingestion_log(old_location: str, table: LakeTable, remove_old: bool = False) -> int:
    old = scan_partitioned(table.spark, old_location, OLD_KEYS)
    rows = old.withColumnRenamed("dataset_name", "table_name").withColumn("dataset_name", F.col("table_name"))
    if dict(rows.dtypes).get("source_files") == "string":
        # A printed list of names, in either kind of quotes; other text is one name.
        names = F.from_json("source_files", "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
        one = F.when(F.length("source_files") > 0, F.array("source_files"))
        rows = rows.withColumn("source_files", F.coalesce(names, one))
    return _migrate(rows, INGESTION_LOG, table, old_location, remove_old)


def _migrate(rows: DataFrame, schema: T.StructType, table: LakeTable, old_location: str, remove_old: bool) -> int:
    wanted = T.StructType(schema.fields + _strings(*table.keys))
    if not table.exists():
        table.register(schema)
    before = table.partitions().count()
    table.land(align(rows, wanted))
    if remove_old:
        storage.delete(table.spark, [old_location])
    return table.partitions().count() - before
