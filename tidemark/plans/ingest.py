"""Files to staging table: discover, read, shape, gate, land, log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import masks
from tidemark.operators import ledger, quality, reprocess
from tidemark.operators.shape import align, dedup_within_file, gather, scrub_null_token
from tidemark.operators.tables import STAGING_KEYS, LakeTable, TempTables
from tidemark.plans import intent as intents
from tidemark.plans.spec import IngestSpec, RunContext
from tidemark.sources import delimited, listing, storage, structured, workbook
from tidemark.sources.delimited import LOCATION


class NothingToIngest(RuntimeError):
    """No file is left to load, or none of the files had a row to keep."""


@dataclass(frozen=True)
class IngestResult:
    record_count: int
    loaded_files: int
    skipped_files: int


def staging_table(spark: SparkSession, spec: IngestSpec) -> LakeTable:
    return LakeTable(spark, spec.target_schema, spec.target_table, spec.target_location, STAGING_KEYS)


def candidates(spark: SparkSession, spec: IngestSpec, tokens=masks.CUSTOM_TOKENS, keep=None) -> DataFrame:
    """Files the spec names, before the ledger is asked."""
    if spec.static_file:
        return listing.static_file(spark, spec.source_prefixes, spec.mask)
    found = listing.source_files(spark, spec.source_prefixes, keep)
    return listing.masked(found, spec.mask, spec.custom_mask, tokens)


def read_files(spark: SparkSession, spec: IngestSpec, paths: Sequence[str]) -> DataFrame | None:
    """All files in one read (one per distinct header where names come from headers)."""
    if spec.file_type in ("csv", "txt"):
        if spec.schema_doc is not None:
            return delimited.read_declared(spark, paths, spec.schema_doc, spec.header, spec.options)
        return delimited.read_header_strings(spark, paths, spec.options, spec.schema_mode)
    if spec.file_type == "excel":
        return workbook.read_workbooks(
            spark, paths, spec.sheet, spec.start_cell, spec.header, spec.schema_doc, spec.schema_mode
        )
    if spec.file_type == "json":
        return structured.read_json(spark, paths, spec.options, spec.schema_doc, spec.arrays)
    return structured.read_parquet(spark, paths, spec.options, spec.schema_mode)


def staged_rows(rows: DataFrame, run: RunContext) -> DataFrame:
    """Data columns, audit columns and partition keys, ready for the staging table."""
    data = [c for c in rows.columns if c != LOCATION]
    clash = {c.lower() for c in data} & {"processed_time", *STAGING_KEYS}
    if clash:
        raise ValueError(f"the files have columns with names of audit columns: {sorted(clash)}")
    return scrub_null_token(rows.select(*[F.col(f"`{c}`") for c in data], LOCATION)).withColumns(
        {
            "processed_time": F.lit(run.processed_time),
            "execution_date": F.lit(run.execution_date),
            "execution_cycle_id": F.lit(run.cycle_id),
            "source_file_name": storage.base_name(F.col(LOCATION)),
        }
    )


def land_staged(table: LakeTable, rows: DataFrame, run: RunContext, paths: Sequence[str]) -> None:
    """Land rows of the files at ``paths`` in the run's date and cycle, a partition per file name.

    Rows that the cycle holds already of files with the same name in other folders stay: they are
    written again with the new ones. Only partitions of the files' names are looked at, whatever else the cycle holds.
    """
    staged = staged_rows(rows, run)
    table.register(staged.drop(*table.keys).schema)
    here = landed_files(table, run, paths)
    own = table.spark.createDataFrame([(p,) for p in paths], "__path string")
    others = here.join(own, F.col(LOCATION) == F.col("__path"), "left_anti")
    if not here.isEmpty() and not others.isEmpty():
        staged = staged.unionByName(others, allowMissingColumns=True)
    table.land(staged)


def landed(table: LakeTable, run: RunContext) -> DataFrame:
    return table.read().where(
        (F.col("execution_date") == run.execution_date) & (F.col("execution_cycle_id") == run.cycle_id)
    )


def landed_files(table: LakeTable, run: RunContext, paths: Sequence[str]) -> DataFrame:
    """What the run's cycle holds under the names of the files at ``paths``."""
    cycle = {"execution_date": run.execution_date, "execution_cycle_id": run.cycle_id}
    return table.slices(cycle, "source_file_name", [storage.name_of(p) for p in paths])


def landed_counts(table: LakeTable, run: RunContext, paths: Sequence[str]) -> DataFrame:
    """Rows that have landed of each file, read back from the files' own partitions."""
    if not table.exists():
        return table.spark.createDataFrame([], f"{LOCATION} string, record_count bigint")
    return landed_files(table, run, paths).groupBy(LOCATION).agg(F.count(F.lit(1)).alias("record_count"))


def pending_files(
    spark: SparkSession,
    spec: IngestSpec,
    run: RunContext,
    file_log: LakeTable,
    reprocess_doc: Mapping | None = None,
    tokens=masks.CUSTOM_TOKENS,
    again: DataFrame | None = None,
    keep=None,
) -> DataFrame:
    """Candidates the ledger does not hold, those the reprocess document forces, and those whose ``source_path`` is in ``again``."""
    found = candidates(spark, spec, tokens, keep)
    if spec.static_file:
        return found
    plan = reprocess.plan_for(reprocess_doc, run.execution_date, spec.dataset)
    if plan.everything:
        return found
    done = ledger.done_files(file_log, spec.dataset)
    forced = None if plan.empty else reprocess.forced_files(spark, plan, done)
    todo = listing.pending(found, done, listing.IDENTITIES[spec.file_identity], forced)
    if again is not None:
        todo = todo.unionByName(found.join(again.select("source_path"), "source_path", "left_semi").select(*todo.columns)).distinct()
    return todo


def ingest(
    spark: SparkSession,
    spec: IngestSpec,
    run: RunContext,
    ledgers: ledger.Ledgers,
    rules: Sequence[quality.Rule] = (),
    post_rules: Sequence[quality.Rule] = (),
    reprocess_doc: Mapping | None = None,
    tokens=masks.CUSTOM_TOKENS,
) -> IngestResult | None:
    """Load the pending files of a dataset. None for a dataset that is switched off.

    A run that broke off is dealt with first: one that had landed all its rows is logged and finished under its own date and cycle, one
    that had not is taken back, and its files are loaded with this run's. Where there is nothing else to load, the
    finished run's figures are returned. Runs of one dataset go one after another.
    """
    if not spec.active:
        return None
    if (spec.gated and not rules) or (spec.checked_after and not post_rules):
        raise ValueError(f"the spec of {spec.dataset!r} names a quality config, but no rules are given")
    reprocess_doc = spec.reprocess_doc if reprocess_doc is None else reprocess_doc
    started = run.now()
    table = staging_table(spark, spec)
    finished, broken = _recover(table, spec, run, ledgers)
    again = _files_again(table, spec, ledgers, broken)
    with TempTables(spark, "listing") as temp:
        todo = pending_files(spark, spec, run, ledgers.file_log, reprocess_doc, tokens, again, temp.keep)
        # The paths of what is to be loaded have to come to the driver, once: Spark's readers take them from there.
        paths = listing.checked_paths(todo)
    if not paths:
        for intent in broken:
            intent.close()
        if finished is not None:
            return finished
        raise NothingToIngest(f"no files to load for dataset {spec.dataset!r}")

    plan = reprocess.plan_for(reprocess_doc, run.execution_date, spec.dataset)
    if spec.static_file or (plan.empty and again is None):
        replaced = intents.REPLACE_NONE
    else:
        replaced = intents.REPLACE_ALL if plan.everything else intents.REPLACE_FILES
    with TempTables(spark, "ingest") as temp:
        load = _gated_rows if rules else _plain_rows
        rows, verdicts, checks = load(spark, spec, paths, run, rules, temp)
        intent = intents.open_intent(ledgers, spec.dataset, run, started, paths, replaced, verdicts, checks)
        # From here on this run's intent tells of the files of the broken ones.
        for old in broken:
            old.close()
        if rows is not None:
            land_staged(table, rows, run, paths)
        intent.mark_landed()
    result = _finish(table, spec, ledgers, intent, paths)

    if post_rules:
        if result.loaded_files == 0:
            raise NothingToIngest(f"every file of dataset {spec.dataset!r} was skipped")
        check = quality.post_load_log(landed(table, run), post_rules, spec.dataset, run.cycle_id, spec.target_table)
        ledger.write_quality_log(ledgers.quality_log, check, spec.dataset, run.cycle_id, "post_load")
        if result.record_count == 0:
            raise NothingToIngest(f"no records loaded for dataset {spec.dataset!r}")
    return result


def _recover(table, spec: IngestSpec, run: RunContext, ledgers) -> tuple[IngestResult | None, list[intents.Intent]]:
    """Finish the runs that had landed, take the others back. The totals of the first, and the intents of the others."""
    done, broken = [], []
    for intent in intents.open_intents(ledgers, spec.dataset, run):
        if intent.landed:
            done.append(_finish(table, spec, ledgers, intent, intent.paths()))
        else:
            reprocess.take_back(table, intent.run.execution_date, intent.run.cycle_id, intent.files)
            broken.append(intent)
    if not done:
        return None, broken
    return IngestResult(*(sum(column) for column in zip(*(astuple(r) for r in done)))), broken


def _files_again(table, spec: IngestSpec, ledgers, broken: Sequence[intents.Intent]) -> DataFrame | None:
    """Files that broken runs were to load, and those whose rows went with the partition that a broken write was replacing."""
    if not broken:
        return None
    again = reduce(DataFrame.unionByName, [i.files.select("source_path") for i in broken])
    log = ledgers.file_log
    if log.exists():
        for intent in broken:
            logged = log.read().where((F.col("dataset_name") == spec.dataset) & (F.col("record_count") > 0))
            logged = logged.where(
                (F.col("execution_date") == intent.run.execution_date) & (F.col("execution_cycle_id") == intent.run.cycle_id)
            )
            logged = logged.join(intent.files.select("file_name"), "file_name", "left_semi")
            logged = logged.select(F.concat("input_location_prefix", "file_name").alias("source_path"))
            counts = landed_counts(table, intent.run, intent.paths()).select(F.col(LOCATION).alias("source_path"))
            again = again.unionByName(logged.join(counts, "source_path", "left_anti"))
    return again.distinct()


def _finish(table, spec: IngestSpec, ledgers, intent: intents.Intent, paths: Sequence[str]) -> IngestResult:
    """Everything after the landing. Each step may be done again without harm, so a run that breaks off here is finished by the next one."""
    run = intent.run
    if table.exists():
        _replace_forced(table, run, intent)
    if intent.checks is not None:
        ledger.write_quality_log(ledgers.quality_log, intent.checks, spec.dataset, run.cycle_id, "pre_load", intent.name)
    result = _log_files(table, spec, ledgers, intent, paths)
    _log_run(spec, ledgers, intent, paths, result.record_count, table)
    # Older cycles go only when this one has landed rows, so a run without any leaves the table as it was.
    if spec.archive and spec.load_type in ("FULL", "ROLLING") and result.record_count:
        table.archive(run.cycle_id, spec.archive_location, run.execution_date if spec.archive_today_only else None)
        if spec.load_type == "FULL":
            table.detach(F.col("execution_cycle_id") != run.cycle_id)
    intent.close()
    return result


def _replace_forced(table, run: RunContext, intent: intents.Intent) -> None:
    """Old rows of forced files go once their new ones are there."""
    if intent.replace == intents.REPLACE_NONE:
        return
    files = intent.files
    present = landed(table, run).select(F.col(LOCATION).alias("source_path")).distinct()
    fresh = files.join(present, "source_path", "left_semi")
    everything = files if intent.replace == intents.REPLACE_ALL else None
    reprocess.clean_staged(table, run.execution_date, run.cycle_id, fresh, everything)


def _read_once(spark, spec: IngestSpec, paths, temp: TempTables) -> DataFrame | None:
    """Rows of the files. Those of workbooks are stored: parsing one takes longer than reading its rows back, which happens several times."""
    rows = read_files(spark, spec, paths)
    return temp.keep(rows, "sheet-rows") if spec.file_type == "excel" and rows is not None else rows


def _plain_rows(spark, spec: IngestSpec, paths, run: RunContext, rules, temp: TempTables) -> tuple[DataFrame | None, None, None]:
    """All rows of the files; None when there is no row, so that no table is made or changed."""
    rows = _read_once(spark, spec, paths, temp)
    if rows is None or rows.isEmpty():
        return None, None, None
    return (gather(dedup_within_file(rows), LOCATION) if spec.drop_duplicates else rows), None, None


def _gated_rows(
    spark, spec: IngestSpec, paths, run: RunContext, rules, temp: TempTables
) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """Rows that pass the gate, the verdict per file, and the rows of the quality log.

    Rules see the columns of all files. They are evaluated twice, once for the totals and
    once for the rows of the files that are kept, which is cheaper than storing every row
    in between. Rows that come out of a shuffle are stored once and read twice instead.
    """
    wide = replace(spec, schema_mode="merge")
    rows = _read_once(spark, wide, paths, temp)
    if rows is None or rows.isEmpty():
        return None, None, None

    def flag(rows: DataFrame) -> DataFrame:
        return quality.flag_failures(dedup_within_file(rows) if spec.drop_duplicates else rows, rules, LOCATION)

    flagged = flag(rows)
    stored = spec.drop_duplicates or any(r.unique_columns for r in rules)
    if stored:
        flagged = temp.keep(gather(flagged, LOCATION), "flagged-rows")
    totals = quality.rule_totals(flagged, rules, LOCATION)
    verdicts = temp.keep(
        quality.route(totals, spec.skip_file, spec.skip_on_non_critical, spec.write_valid), "file-verdicts"
    )
    file_name = storage.base_name(F.col("gated_file"))
    folder = storage.folder_name(F.col("gated_file"))
    log = quality.quality_log(verdicts, rules, spec.dataset, run.cycle_id, file_name, folder)
    # As many verdicts as there are paths, which are on the driver already.
    passed = {r.gated_file for r in verdicts.where(F.col("ingestion_status") != quality.SKIPPED).collect()}
    kept = [p for p in paths if p in passed]
    if not kept:
        return None, verdicts, log
    # Skipped files are not read again, unless their schema would have to be inferred again.
    fixed_schema = spec.schema_doc is not None or spec.file_type in ("csv", "txt", "parquet")
    if not stored and fixed_schema and spec.file_type != "excel":
        flagged = flag(read_files(spark, wide, kept))
    rows = quality.admitted(flagged, verdicts, LOCATION)
    if fixed_schema:
        rows = align(rows, read_files(spark, spec, kept).schema)
    return rows, verdicts, log


def _log_files(table, spec: IngestSpec, ledgers, intent: intents.Intent, paths: Sequence[str]) -> IngestResult:
    """Write the file log; the totals of the run are observed on the way."""
    run = intent.run
    rows = ledger.file_log_rows(
        intent.files,
        landed_counts(table, run, paths),
        intent.verdicts,
        quality.INGESTED,
        {
            "table_name": spec.target_table,
            "run_id": run.run_id,
            "file_type": spec.file_type,
            "execution_start_time": intent.started,
            "execution_end_time": run.now(),
        },
    )
    skipped = F.count_if(F.col("ingestion_status") == quality.SKIPPED)
    seen = Observation()
    observed = rows.observe(
        seen,
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
        (F.count(F.lit(1)) - skipped).alias("loaded"),
        skipped.alias("skipped"),
    )
    ledger.write(ledgers.file_log, ledger.FILE_LOG, observed, run.partition(spec.dataset), intent.name)
    return IngestResult(seen.get["records"], seen.get["loaded"], seen.get["skipped"])


def _log_run(spec: IngestSpec, ledgers, intent: intents.Intent, paths: Sequence[str], records: int, table) -> None:
    run = intent.run
    rows = ledger.run_rows(
        intent.files,
        len(paths),
        table_name=spec.target_table,
        run_id=run.run_id,
        application=ledgers.application,
        static_file_pattern="Y" if spec.static_file else "N",
        source_file_pattern=spec.mask,
        file_type=spec.file_type,
        encoding=spec.options.get("encoding"),
        escape=spec.options.get("escape"),
        multiline=spec.options.get("multiline"),
        delimiter=spec.options.get("delimiter"),
        table_location=spec.target_location,
        target_schema=spec.target_schema,
        target_table=spec.target_table,
        record_count=records,
        execution_start_datetime=intent.started,
        execution_end_time=run.now(),
    )
    ledger.write(ledgers.ingestion_log, ledger.INGESTION_LOG, rows, run.partition(spec.dataset), intent.name)
