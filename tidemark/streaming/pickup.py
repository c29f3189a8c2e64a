"""Each new file once, by a file stream that runs until nothing is left and stops."""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import standardize_names
from tidemark.operators import ledger, quality
from tidemark.operators.tables import LakeTable
from tidemark.plans.ingest import land_staged, landed_counts
from tidemark.plans.spec import RunContext
from tidemark.sources import listing, storage
from tidemark.sources.delimited import LOCATION, with_location

# Spark's file source forgets files older than this beside the newest one, and would leave them out for good.
NO_AGE_LIMIT = f"{(1 << 63) // 10**6 // 3600}h"


def pick_up_available(
    spark: SparkSession,
    folder: str,
    file_format: str,
    schema: T.StructType,
    table: LakeTable,
    run: RunContext,
    checkpoint: str,
    options: dict[str, str] | None = None,
    max_files_per_batch: int = 10_000,
    ledgers: ledger.Ledgers | None = None,
    dataset: str | None = None,
) -> None:
    """Load all files the checkpoint has not seen into the staging table.

    All batches of a run land in its one cycle, a partition per file, so the newest cycle is the whole
    run whatever the number of batches. Before a batch lands, its date and cycle are noted beside the
    checkpoint; a batch repeated after a failure, by a later run too, lands there again and replaces its
    own rows. Files are picked up however old they are.

    With ``ledgers`` and ``dataset`` the files are logged, so ``ingest`` passes them over, and files
    that the ledger holds already are passed over here.
    """
    if (ledgers is None) != (dataset is None):
        raise ValueError("ledgers and dataset go together")
    reader = (
        spark.readStream.format(file_format)
        .options(**(options or {}))
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", NO_AGE_LIMIT)
        .option("recursiveFileLookup", "true")
        .schema(schema)
    )
    located = standardize_names(with_location(reader.load(folder)))
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def land(batch: DataFrame, batch_id: int) -> None:
        note = f"{checkpoint.rstrip('/')}/landed_cycles/{batch_id}.json"
        if storage.exists(spark, note):
            noted = json.loads(storage.read_text(spark, note))
            own = replace(run, execution_date=noted["execution_date"], cycle_id=noted["cycle_id"])
        else:
            own = run
            storage.write_text(spark, note, json.dumps({"execution_date": run.execution_date, "cycle_id": run.cycle_id}))
        if ledgers is not None:
            done = _done_elsewhere(ledgers, dataset, own)
            batch = batch.join(done, F.col(LOCATION) == F.col("__done"), "left_anti")
        # At most as many as a batch has files.
        paths = sorted(r[0] for r in batch.select(LOCATION).distinct().collect())
        if not paths:
            return
        started = own.now()
        land_staged(table, batch, own, paths)
        if ledgers is not None:
            _log(table, own, ledgers, dataset, file_format, paths, started, f"{stream}-{batch_id}")

    query = (
        located.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(land)
        .start()
    )
    query.awaitTermination()


def _done_elsewhere(ledgers: ledger.Ledgers, dataset: str, run: RunContext) -> DataFrame:
    """Paths that the ledger holds from other cycles. Those of this cycle may be a repeated batch's own."""
    log = ledgers.file_log
    if not log.exists():
        return log.spark.createDataFrame([], "__done string")
    own = (F.col("execution_date") == run.execution_date) & (F.col("execution_cycle_id") == run.cycle_id)
    rows = log.read().where((F.col("dataset_name") == dataset) & ~own)
    return rows.select(F.concat("input_location_prefix", "file_name").alias("__done")).distinct()


def _log(table, run: RunContext, ledgers, dataset: str, file_format: str, paths, started: str, name: str) -> None:
    """Log the batch's files, under a name of the batch: one that is repeated replaces its own rows."""
    literals = {
        "table_name": table.table,
        "run_id": run.run_id,
        "file_type": file_format,
        "execution_start_time": started,
        "execution_end_time": run.now(),
    }
    found = listing.listing_frame(table.spark, paths)
    rows = ledger.file_log_rows(found, landed_counts(table, run, paths), None, quality.INGESTED, literals)
    ledger.write(ledgers.file_log, ledger.FILE_LOG, rows, run.partition(dataset), name)
