"""Queries over table sinks, registration and the partition lifecycle."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ledger, reprocess
from tidemark.operators.shape import gather
from tidemark.operators.tables import CYCLE_KEYS, STAGING_KEYS, TempTables
from tidemark.plans.ingest import ingest, staging_table
from tidemark.plans.process import process, processed_table, publish_table
from tidemark.plans.spec import ProcessSpec
from tidemark.sources import listing
from tidemark.sources.delimited import LOCATION
from tidemark.sources.structured import scan_partitioned
from tidemark.workloads.bench import CYCLE, DATASET, DATE, TIME, Bench, query

ORDER_DOC = [
    {"column_name": "o_orderkey", "column_data_type": "long"},
    {"column_name": "o_custkey", "column_data_type": "long"},
    {"column_name": "o_orderstatus", "column_data_type": "string"},
    {"column_name": "o_totalprice", "column_data_type": "decimal", "data_format": "18,2"},
    {"column_name": "o_orderdate", "column_data_type": "date", "data_format": "YYYY-MM-DD"},
    {"column_name": "o_orderpriority", "column_data_type": "string"},
]
ORDERS_SQL = """o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
                CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority"""
YEAR_SQL = "strftime(o_orderdate, '%Y')"


def export_orders(bench: Bench) -> str:
    """All orders as CSV files with a header, in one folder per order status."""
    return bench.export(bench.orders(), "o_orderstatus", header=True)


def order_spec(bench: Bench, **changes):
    return bench.spec(schema_doc=ORDER_DOC, header=True, mask="*.csv", **changes)


def split_of(column: str):
    """Which exported folder a file path lies in."""
    return F.regexp_extract(column, "split=([^/]*)", 1)


@query(
    f"""SELECT {ORDERS_SQL}, '{TIME}' AS processed_time, '{DATE}' AS execution_date,
               '{CYCLE}' AS execution_cycle_id, o_orderstatus AS source_folder FROM orders"""
)
def staging_sink(bench: Bench) -> DataFrame:
    """Rows landed twice under one cycle are there once."""
    export_orders(bench)
    spec = order_spec(bench)
    ingest(bench.spark, spec, bench.run, bench.ledgers)
    again = replace(spec, dataset="second_feed")
    ingest(bench.spark, again, bench.run, bench.ledgers)
    rows = staging_table(bench.spark, spec).read()
    return rows.withColumn("source_folder", split_of(LOCATION)).drop(LOCATION, "source_file_name")


def _process_spec(bench: Bench, **changes) -> ProcessSpec:
    settings = {
        "dataset": "orders_mart",
        "active": True,
        "processed_schema": bench.schema,
        "processed_table": "orders_mart",
        "processed_location": f"{bench.root}/mart",
        "publish": True,
        "publish_schema": bench.schema,
        "publish_table": "orders_published",
        "publish_location": f"{bench.root}/published",
    }
    return ProcessSpec(**{**settings, **changes})


def _cycle(bench: Bench, n: int):
    return replace(bench.run, cycle_id=f"{bench.run.cycle_id[:-1]}{n}")


@query(
    f"""SELECT o_orderkey, o_custkey, '{DATE}' AS execution_date, '{CYCLE}' AS execution_cycle_id,
               o_orderstatus AS region FROM orders"""
)
def processed_sink(bench: Bench) -> DataFrame:
    """Slices of one cycle under a partition key of the user's own; columns lower-cased."""
    spec = _process_spec(bench, publish=False)
    rows = bench.read("orders")
    for status in ("F", "O", "P"):
        part = rows.where(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").alias("O_OrderKey"), F.col("o_custkey").alias("O_CUSTKEY")
        )
        process(bench.spark, spec, bench.run, bench.ledgers, part, {"region": status})
    return processed_table(bench.spark, spec, ("region",)).read()


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus AS execution_date, o_orderpriority AS execution_cycle_id
       FROM orders"""
)
def register_table(bench: Bench) -> DataFrame:
    """Files written by someone else, registered by one repair; adding a known partition again is fine."""
    rows = bench.read("orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderstatus").alias("execution_date"),
        F.col("o_orderpriority").alias("execution_cycle_id"),
    )
    table = bench.lake("registered")
    gather(rows, *CYCLE_KEYS).write.partitionBy(*CYCLE_KEYS).parquet(table.location)
    table.register(rows.drop(*CYCLE_KEYS).schema)
    table.add_partition({"execution_date": "F", "execution_cycle_id": "1-URGENT"})
    return table.read()


@query(
    f"""SELECT 'attached' AS side, {YEAR_SQL} || '0101' AS execution_date, count(*) AS orders FROM orders
        WHERE {YEAR_SQL} > '1997' GROUP BY 2
        UNION ALL
        SELECT 'on disk', {YEAR_SQL} || '0101', count(*) FROM orders GROUP BY 2"""
)
def detach_partitions(bench: Bench) -> DataFrame:
    """Detached partitions leave the table; their files stay."""
    table = bench.yearly_orders()
    table.detach(F.col("execution_date") < "19980101")
    disk = scan_partitioned(bench.spark, table.location, table.keys)
    return (
        table.read()
        .select(F.lit("attached").alias("side"), "execution_date")
        .union(disk.select(F.lit("on disk"), "execution_date"))
        .groupBy("side", "execution_date")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN {YEAR_SQL} >= '1998' THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN {YEAR_SQL} >= '1998' THEN o_orderstatus || '!' END AS note,
               CASE WHEN {YEAR_SQL} >= '1998' THEN 'new' ELSE 'old' END AS execution_date FROM orders"""
)
def schema_evolution(bench: Bench) -> DataFrame:
    """The newest columns win: old partitions show NULL for new columns and lose dropped ones."""
    rows = bench.read("orders").withColumn("new", F.date_format("o_orderdate", "yyyy") >= "1998")
    table = bench.lake("evolving", ("execution_date",))
    old = rows.where("NOT new").select("o_orderkey", "o_custkey")
    fresh = rows.where("new").select("o_orderkey", "o_orderpriority", F.concat("o_orderstatus", F.lit("!")).alias("note"))
    table.land_partition(old, {"execution_date": "old"})
    table.land_partition(fresh, {"execution_date": "new"})
    return table.read()


@query("SELECT o_orderstatus, count(*) AS orders, min(o_orderkey) AS first_key FROM orders GROUP BY o_orderstatus")
def temp_materialize(bench: Bench) -> DataFrame:
    view = f"{bench.schema}_kept"
    temp = TempTables(bench.spark, bench.label)
    temp.keep(bench.read("orders").select("o_orderkey", "o_orderstatus"), "orders", view)
    return bench.spark.sql(
        f"SELECT o_orderstatus, count(*) AS orders, min(o_orderkey) AS first_key FROM {view} GROUP BY o_orderstatus"
    )


FILE_LOG_SQL = f"""SELECT o_orderstatus AS source_folder, 'STAGED' AS table_name, 'run-1' AS run_id, 'csv' AS file_type,
    'Ingested' AS ingestion_status, '{TIME}' AS execution_start_time, '{DATASET}' AS dataset_name,
    '{DATE}' AS execution_date, '{CYCLE}' AS execution_cycle_id, CAST(count(*) AS BIGINT) AS record_count
    FROM orders GROUP BY o_orderstatus"""


@query(FILE_LOG_SQL)
def file_log(bench: Bench) -> DataFrame:
    export_orders(bench)
    ingest(bench.spark, order_spec(bench), bench.run, bench.ledgers)
    logged = bench.ledgers.file_log.read().withColumn("source_folder", split_of("input_location_prefix"))
    keys = ["source_folder", "table_name", "run_id", "file_type", "ingestion_status", "execution_start_time"]
    return logged.groupBy(*keys, "dataset_name", "execution_date", "execution_cycle_id").agg(
        F.sum("record_count").alias("record_count")
    )


@query(
    f"""SELECT 'STAGED' AS table_name, 'run-1' AS run_id, 'bench' AS application, 'N' AS static_file_pattern,
               '*.csv' AS source_file_pattern, 'csv' AS file_type, ',' AS delimiter, count(*) AS record_count,
               'csv' AS source_files, CAST(0 AS BIGINT) AS differing_names,
               '{TIME}' AS execution_start_datetime, '{TIME}' AS execution_end_time, '{DATASET}' AS dataset_name,
               '{DATE}' AS execution_date, '{CYCLE}' AS execution_cycle_id FROM orders"""
)
def ingestion_log(bench: Bench) -> DataFrame:
    export_orders(bench)
    ingest(bench.spark, order_spec(bench), bench.run, bench.ledgers)
    unstable = ("table_location", "target_schema", "target_table", "encoding", "escape", "multiline")
    logged = bench.ledgers.ingestion_log.read().drop(*unstable)
    # Which names the files get is up to the writer; that they are the file log's is not.
    written = bench.ledgers.file_log.read().select("file_name").distinct()
    names = logged.select(F.explode("source_files").alias("file_name")).distinct()
    differing = names.exceptAll(written).unionAll(written.exceptAll(names)).count()
    return logged.withColumns({"source_files": F.transform("source_files", lambda n: F.regexp_extract(n, "[.]([^.]*)$", 1))}).withColumns(
        {"source_files": F.array_join(F.array_distinct("source_files"), ","), "differing_names": F.lit(differing).cast("long")}
    )


@query(
    f"""SELECT 'orders_mart' AS dataset_name, 'bench' AS application, 'orders_mart' AS table_name,
               'orders_published' AS publish_table_name, count(*) AS processed_table_record_count,
               count(*) AS publish_table_record_count, '{DATE}' AS execution_date, '{CYCLE}' AS execution_cycle_id
        FROM orders"""
)
def processed_log(bench: Bench) -> DataFrame:
    process(bench.spark, _process_spec(bench), bench.run, bench.ledgers, bench.orders())
    times = ("execution_start_time", "execution_end_time", "table_location", "table_schema", "publish_table_schema")
    return bench.ledgers.process_log.read().drop(*times)


@query(
    f"""SELECT o_orderkey, o_custkey, '{DATE}' AS execution_date, substr('{CYCLE}', 1, 19) || '2' AS execution_cycle_id
        FROM orders WHERE o_orderstatus <> 'P'"""
)
def publish_snapshot(bench: Bench) -> DataFrame:
    """The first cycle publishes everything, the second replaces it."""
    spec = _process_spec(bench)
    rows = bench.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    process(bench.spark, spec, _cycle(bench, 1), bench.ledgers, rows.drop("o_orderstatus"))
    second = rows.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    process(bench.spark, spec, _cycle(bench, 2), bench.ledgers, second)
    return publish_table(bench.spark, spec).read()


@query(
    f"""SELECT o_orderkey, o_custkey, '{DATE}' AS execution_date, substr('{CYCLE}', 1, 19) || '2' AS execution_cycle_id,
               o_orderstatus AS status, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'shut' END AS state
        FROM orders WHERE o_orderstatus <> 'P'"""
)
def publish_slices(bench: Bench) -> DataFrame:
    """Slices of one cycle add up under two user keys; those of the cycle before are gone."""
    spec = _process_spec(bench)
    rows = bench.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for cycle, status, state in ((1, "P", "shut"), (2, "O", "open"), (2, "F", "shut")):
        part = rows.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
        user_keys = {"status": status, "state": state}
        process(bench.spark, spec, _cycle(bench, cycle), bench.ledgers, part, user_keys)
    return publish_table(bench.spark, spec, ("status", "state")).read()


@query(
    f"""SELECT CASE WHEN {YEAR_SQL} = (SELECT max({YEAR_SQL}) FROM orders) THEN 'live' ELSE 'archive' END AS side,
               {YEAR_SQL} || '0101' AS execution_date, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY 1, 2"""
)
def archive_cycles(bench: Bench) -> DataFrame:
    """All cycles but the newest move to the archive with their partition folders."""
    table = bench.yearly_orders()
    newest = table.partitions().agg(F.max("execution_cycle_id")).first()[0]
    table.archive(newest, f"{bench.root}/archive")
    live = scan_partitioned(bench.spark, table.location, table.keys).withColumn("side", F.lit("live"))
    old = scan_partitioned(bench.spark, f"{bench.root}/archive", table.keys).withColumn("side", F.lit("archive"))
    return (
        live.unionByName(old)
        .groupBy("side", "execution_date")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total"))
    )


@query(
    f"""SELECT o_orderkey, o_custkey, 'orders_' || {YEAR_SQL} || '.csv' AS source_file_name FROM orders
        WHERE {YEAR_SQL} NOT IN ('1996', '1999')"""
)
def reprocess_cleanup(bench: Bench) -> DataFrame:
    """Staged rows of two listed files go from every date and cycle."""
    table = bench.yearly_orders("staged", STAGING_KEYS)
    document = {DATE: {DATASET: {"file_name": ["orders_1996.csv", {"name": ["orders_1999.csv", "unknown.csv"]}]}}}
    reprocess.clean_staged(table, bench.run.execution_date, bench.run.cycle_id, _forced(bench, document))
    return table.read().select("o_orderkey", "o_custkey", "source_file_name")


def _forced(bench: Bench, document: dict) -> DataFrame:
    plan = reprocess.plan_for(document, DATE, DATASET)
    done = bench.spark.createDataFrame([], "input_location_prefix string, file_name string, status string")
    return reprocess.forced_files(bench.spark, plan, done)


@query(
    """SELECT o_custkey AS file_key, count(*) AS seen FROM orders GROUP BY o_custkey
       HAVING bool_or(o_orderstatus = 'F') OR min(o_orderpriority) = '5-LOW'"""
)
def reprocess_plan(bench: Bench) -> DataFrame:
    """A ledger with one row per customer file. Files skipped last time come back."""
    files = bench.read("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("seen"),
        F.bool_or(F.col("o_orderstatus") == "F").alias("skipped"),
        (F.min("o_orderpriority") == "5-LOW").alias("unlogged"),
    )
    named = files.withColumn("file_name", F.concat(F.lit("c_"), F.col("o_custkey"))).withColumn(
        "input_location_prefix", F.lit("file:/in/")
    )
    done = named.where("NOT unlogged").select(
        "file_name",
        "input_location_prefix",
        F.when(F.col("skipped"), "File Skipped").otherwise("Ingested").alias("status"),
    )
    document = {DATE: {DATASET: {"file_name": ["no_such_file"]}, "includes_skipped_files": "Y"}}
    plan = reprocess.plan_for(document, DATE, DATASET)
    forced = reprocess.forced_files(bench.spark, plan, done)
    return listing.pending(named, done, ["file_name"], forced).select(F.col("o_custkey").alias("file_key"), "seen")


@query(
    f"""SELECT 'T_' || o_orderstatus AS table_name, 'T_' || o_orderstatus AS dataset_name,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'NA' ELSE o_orderpriority END AS run_id,
               '' AS input_location_prefix, {YEAR_SQL} || '0101' AS execution_date,
               count(*) AS record_count FROM orders GROUP BY ALL"""
)
def ledger_migration(bench: Bench) -> DataFrame:
    """A ledger of the former layout, one row per status, priority and year."""
    year = F.date_format("o_orderdate", "yyyy")
    counted = bench.read("orders").groupBy("o_orderstatus", "o_orderpriority", year.alias("year")).count()
    former = counted.select(
        F.concat(F.lit("T_"), "o_orderstatus").alias("dataset_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("run_id"),
        F.concat("o_orderstatus", F.lit(".csv")).alias("file_name"),
        F.lit("csv").alias("file_type"),
        F.col("count").cast("int").alias("record_count"),
        F.lit(TIME).alias("execution_start_time"),
        F.lit(TIME).alias("execution_end_time"),
        F.lit("Ingested").alias("ingestion_status"),
        F.concat("year", F.lit("0101")).alias("execution_date"),
        F.lit(CYCLE).alias("execution_cycle_id"),
        F.concat("o_orderstatus", F.lit(".csv")).alias("source_file_name"),
    )
    former.write.partitionBy("execution_date", "execution_cycle_id", "source_file_name").parquet(f"{bench.root}/former")
    table = bench.ledgers.file_log
    ledger.migrate_file_log(f"{bench.root}/former", table)
    return table.read().select(
        "table_name", "dataset_name", "run_id", "input_location_prefix", "execution_date", "record_count"
    )
