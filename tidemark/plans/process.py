"""A result to processed table and published snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import lowercase_names
from tidemark.operators import ledger, quality
from tidemark.operators.tables import CYCLE_KEYS, LakeTable, publish
from tidemark.plans.spec import ProcessSpec, RunContext
from tidemark.sources import storage


@dataclass(frozen=True)
class ProcessResult:
    processed_records: int
    published_records: int


def processed_table(spark: SparkSession, spec: ProcessSpec, user_keys: Sequence[str] = ()) -> LakeTable:
    keys = (*CYCLE_KEYS, *user_keys)
    return LakeTable(spark, spec.processed_schema, spec.processed_table, spec.processed_location, keys)


def publish_table(spark: SparkSession, spec: ProcessSpec, user_keys: Sequence[str] = ()) -> LakeTable:
    keys = (*CYCLE_KEYS, *user_keys)
    return LakeTable(spark, spec.publish_schema, spec.publish_table, spec.publish_location, keys)


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """One SQL statement over whatever the session's catalog holds."""
    statement = query.replace("\r", "").strip().rstrip(";")
    if not statement:
        raise ValueError("the SQL text is blank")
    return spark.sql(statement)


def run_sql_script(spark: SparkSession, path: str) -> DataFrame:
    if not path.endswith(".sql"):
        raise ValueError(f"{path!r} is not a .sql file")
    return run_sql(spark, storage.read_text(spark, path))


def process(
    spark: SparkSession,
    spec: ProcessSpec,
    run: RunContext,
    ledgers: ledger.Ledgers,
    result: DataFrame | None = None,
    user_keys: Mapping[str, str] | None = None,
    post_rules: Sequence[quality.Rule] = (),
) -> ProcessResult | None:
    """Write a result as the run's partition, publish it, log it, archive older cycles.

    Without a result the spec's SQL script gives one. The plan behind the result is
    executed once: its row count is observed while it is written.
    """
    if not spec.active:
        return None
    if spec.checked_after and not post_rules:
        raise ValueError(f"the spec of {spec.dataset!r} names a quality config, but no rules are given")
    started = run.now()
    user_keys = {k: str(v) for k, v in (user_keys or {}).items()}
    if result is not None:
        result = lowercase_names(result)
    elif spec.sql_script:
        result = run_sql_script(spark, spec.sql_script)
    else:
        raise ValueError(f"neither a result nor a SQL script for dataset {spec.dataset!r}")

    table = processed_table(spark, spec, tuple(user_keys))
    where = {"execution_date": run.execution_date, "execution_cycle_id": run.cycle_id, **user_keys}
    records = table.land_partition(result, where)
    published = 0
    if spec.publish:
        published = publish(table, publish_table(spark, spec, tuple(user_keys)), where, tuple(user_keys))

    row = ledger.one_row(
        spark,
        application=ledgers.application,
        table_location=spec.processed_location,
        table_schema=spec.processed_schema,
        table_name=spec.processed_table,
        processed_table_record_count=records,
        publish_table_schema=spec.publish_schema,
        publish_table_name=spec.publish_table,
        publish_table_record_count=published,
        execution_start_time=started,
        execution_end_time=run.now(),
    )
    ledger.write(ledgers.process_log, ledger.PROCESS_LOG, row, run.partition(spec.dataset))

    if spec.archive:
        table.archive(run.cycle_id, spec.archive_location)
    if post_rules:
        rows = table.read().where(
            (F.col("execution_date") == run.execution_date) & (F.col("execution_cycle_id") == run.cycle_id)
        )
        check = quality.post_load_log(rows, post_rules, spec.dataset, run.cycle_id, spec.processed_table)
        ledger.write_quality_log(ledgers.quality_log, check, spec.dataset, run.cycle_id, "post_load")
    return ProcessResult(records, published)
