"""Queries over data quality, whole runs and the file stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import incremental, quality
from tidemark.operators.tables import CYCLE_KEYS, STAGING_KEYS
from tidemark.plans import intent as intents
from tidemark.plans.ingest import ingest, land_staged, pending_files, read_files, staging_table
from tidemark.plans.process import process, publish_table
from tidemark.plans.spec import ProcessSpec
from tidemark.sources import listing, storage, structured
from tidemark.sources.delimited import LOCATION
from tidemark.streaming.pickup import pick_up_available
from tidemark.workloads.bench import CYCLE, DATASET, DATE, TIME, Bench, query
from tidemark.workloads.tables import ORDER_DOC, ORDERS_SQL, export_orders, order_spec, split_of

FLAGS = ("A", "N", "R")
RULES = [
    quality.in_range("q1", "l_quantity", 1, 45, criticality="non-critical", message="quantity", threshold=5),
    quality.in_list("q2", "l_linestatus", ["O", "F"], criticality="critical", message="status"),
    quality.matches("q3", "l_returnflag", "^[AN]$", criticality="critical", message="flag", threshold=50),
    quality.not_null("q4", "l_shipdate", criticality="critical", message="ship date"),
    quality.Rule("q5", "l_discount <= l_tax + 0.05", criticality="non-critical", message="discount", threshold=100),
]
BAD_SQL = {
    "q1": "NOT (l_quantity BETWEEN 1 AND 45)",
    "q2": "l_linestatus NOT IN ('O', 'F')",
    "q3": "l_returnflag NOT IN ('A', 'N')",
    "q4": "l_shipdate IS NULL",
    "q5": "NOT (l_discount <= l_tax + 0.05)",
}
THRESHOLDS = {"q1": 5, "q2": 0, "q3": 50, "q4": 0, "q5": 100}
ANY_BAD_SQL = " OR ".join(BAD_SQL.values())
TOTALS_SQL = f"""SELECT l_returnflag AS file, count(*) AS n, sum(CASE WHEN {ANY_BAD_SQL} THEN 0 ELSE 1 END) AS valid,
    {', '.join(f"sum(CASE WHEN {b} THEN 1 ELSE 0 END) AS {q}" for q, b in BAD_SQL.items())}
    FROM lineitem GROUP BY l_returnflag"""


def _lines(bench: Bench) -> DataFrame:
    return bench.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_linestatus",
        "l_shipdate",
        "l_returnflag",
        F.col("l_returnflag").alias(LOCATION),
    )


@query(
    f"""WITH t AS ({TOTALS_SQL}),
    g AS (SELECT *, CASE WHEN valid = 0 OR 100.0 * q2 / n > 0 OR 100.0 * q4 / n > 0 THEN 'none'
                         WHEN 100.0 * q3 / n > 50 THEN 'valid' ELSE 'all' END AS route FROM t)
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem JOIN g ON file = l_returnflag
    WHERE route = 'all' OR (route = 'valid' AND NOT ({ANY_BAD_SQL}))"""
)
def dq_gate(bench: Bench) -> DataFrame:
    """One file per return flag. Rows of a file pass all, as valid rows only, or not at all."""
    flagged = quality.flag_failures(_lines(bench), RULES, LOCATION)
    verdicts = quality.route(quality.rule_totals(flagged, RULES, LOCATION), write_valid=True)
    return quality.admitted(flagged, verdicts, LOCATION).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )


@query(
    f"""WITH t AS ({TOTALS_SQL})
    SELECT file, CAST(n AS BIGINT) AS total_records, CAST(valid AS BIGINT) AS valid_records,
      CAST((100.0*q1/n > 5)::INT + (q2 > 0)::INT + (100.0*q3/n > 50)::INT + (q4 > 0)::INT AS INT) AS failed_checks,
      CAST((q2 > 0)::INT + (100.0*q3/n > 50)::INT + (q4 > 0)::INT AS INT) AS critical_failed_checks,
      CASE WHEN valid = 0 OR q2 > 0 OR 100.0*q3/n > 50 OR q4 > 0 OR 100.0*q1/n > 5
           THEN 'File Skipped' ELSE 'Ingested' END AS strict_status FROM t"""
)
def dq_file_totals(bench: Bench) -> DataFrame:
    """Failed checks per file and the verdict under the strictest flags."""
    flagged = quality.flag_failures(_lines(bench), RULES, LOCATION)
    verdicts = quality.route(quality.rule_totals(flagged, RULES, LOCATION), skip_file=True, skip_on_non_critical=True)
    return verdicts.select(
        F.col("gated_file").alias("file"),
        "total_records",
        "valid_records",
        "failed_checks",
        "critical_failed_checks",
        F.col("ingestion_status").alias("strict_status"),
    )


@query(
    """WITH d AS (SELECT l_returnflag, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)
       SELECT l_returnflag AS file, CAST(sum(n) AS BIGINT) AS total_records,
              CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS valid_records FROM d GROUP BY l_returnflag"""
)
def dq_unique(bench: Bench) -> DataFrame:
    """Order keys that occur once in their file, counted per file."""
    rules = [quality.unique("u1", "l_orderkey")]
    totals = quality.rule_totals(quality.flag_failures(_lines(bench), rules, LOCATION), rules, LOCATION)
    return totals.select(F.col("gated_file").alias("file"), "total_records", "valid_records")


POST_RULES = [
    quality.in_list("p1", "o_orderstatus", ["O", "F"], message="closed or open", threshold=20),
    quality.Rule("p2", "o_totalprice > 0", criticality="non-critical", message="price"),
]


@query(
    f"""WITH t AS (SELECT count(*) AS n, sum(CASE WHEN o_orderstatus IN ('O', 'F') THEN 0 ELSE 1 END) AS e1,
                          sum(CASE WHEN o_totalprice > 0 THEN 0 ELSE 1 END) AS e2 FROM orders),
    c AS (SELECT 'p1' AS qc_id, 'critical' AS criticality, 'closed or open' AS message, 20.0 AS limit_, n, e1 AS e FROM t
          UNION ALL SELECT 'p2', 'non-critical', 'price', 0.0, n, e2 FROM t)
    SELECT '{DATASET}' AS dataset_name, qc_id, criticality, 'STAGED' AS pre_ingestion_dqm_file,
           n AS total_record_count, CAST(n - e AS BIGINT) AS validated_record_count,
           CAST(e AS BIGINT) AS errored_record_count, message, round(100.0 * CAST(e AS DOUBLE) / n, 2) AS error_percentage,
           CAST(limit_ AS DOUBLE) AS threshold,
           CASE WHEN 100.0 * e / n <= limit_ THEN 'Y' ELSE 'N' END AS qc_passed_flag,
           '{CYCLE}' AS ingestion_cycle_id FROM c"""
)
def dq_post_load(bench: Bench) -> DataFrame:
    """The partition just landed, checked as a whole in one aggregate."""
    export_orders(bench)
    ingest(bench.spark, order_spec(bench), bench.run, bench.ledgers, post_rules=POST_RULES)
    return bench.ledgers.quality_log.read().drop("stage", "input_location_prefix")


@query(
    f"""WITH t AS ({TOTALS_SQL}),
    c AS ({' UNION ALL '.join(f"SELECT file, n, '{q}' AS qc_id, {q} AS e, {t} AS limit_ FROM t" for q, t in THRESHOLDS.items())})
    SELECT CASE WHEN file = 'N' THEN NULL ELSE file END AS file_name, qc_id, CAST(n AS BIGINT) AS total_record_count,
           CASE WHEN file = 'N' THEN NULL ELSE CAST(n AS BIGINT) END AS record_count,
           CAST(n - e AS BIGINT) AS validated_record_count, CAST(e AS BIGINT) AS errored_record_count,
           limit_ || '.0%' AS threshold, CAST(round(100.0 * CAST(e AS DOUBLE) / n, 2) AS VARCHAR) || '%' AS error_percentage,
           CASE WHEN 100.0 * e / n <= limit_ THEN 'Y' ELSE 'N' END AS qc_passed_flag,
           CASE WHEN file = 'N' THEN NULL ELSE 'Ingested' END AS ingestion_status FROM c"""
)
def dq_report(bench: Bench) -> DataFrame:
    """Quality log with each file's outcome; the ledger does not know the file of flag N."""
    lines = _lines(bench)
    totals = quality.rule_totals(quality.flag_failures(lines, RULES, LOCATION), RULES, LOCATION)
    log = quality.quality_log(totals, RULES, DATASET, CYCLE, F.col("gated_file"))
    files = (
        lines.where("l_returnflag <> 'N'")
        .groupBy(F.col(LOCATION).alias("file_name"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(
            "*",
            F.lit(DATASET).alias("dataset_name"),
            F.lit(CYCLE).alias("execution_cycle_id"),
            F.lit(TIME).alias("execution_start_time"),
            F.lit(TIME).alias("execution_end_time"),
            F.lit("Ingested").alias("ingestion_status"),
        )
    )
    return quality.report(log, files, DATASET, CYCLE).drop(
        "message", "criticality", "execution_start_time", "execution_end_time"
    )


@query(
    f"""SELECT event_id, user_id, event_type, '{TIME}' AS processed_time, '{DATE}' AS execution_date,
               CASE WHEN event_type = 'error' THEN 'second' ELSE 'first' END AS pickup FROM events"""
)
def incremental_available_now(bench: Bench) -> DataFrame:
    """Two runs of the file stream: the second finds the files that came in between, and only those."""
    events = bench.read("events").select("event_id", "user_id", "event_type")
    table = bench.lake("picked", STAGING_KEYS)
    second = replace(bench.run, cycle_id=f"{CYCLE[:-1]}2")
    for run, arriving in ((bench.run, "event_type <> 'error'"), (second, "event_type = 'error'")):
        events.where(arriving).repartition(3).write.mode("append").parquet(f"{bench.root}/arrivals")
        pick_up_available(
            bench.spark, f"{bench.root}/arrivals", "parquet", events.schema, table, run, f"{bench.root}/checkpoint",
            max_files_per_batch=1,
        )
    pickup = F.when(F.col("execution_cycle_id") == CYCLE, "first").otherwise("second").alias("pickup")
    return table.read().select("event_id", "user_id", "event_type", "processed_time", "execution_date", pickup)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority < '3' THEN 'a' ELSE 'b' END AS folder FROM orders"""
)
def ingest_same_names(bench: Bench) -> DataFrame:
    """Two folders with files of the same names, loaded by two runs of one cycle: all rows stay."""
    rows = bench.orders().withColumn("half", F.when(F.col("o_orderpriority") < "3", "a").otherwise("b"))
    # A file name of its own per status, the same in both folders.
    spec = order_spec(bench, source_prefixes=[f"{bench.root}/named/a", f"{bench.root}/named/b"])
    for half in ("a", "b"):
        bench.export(rows.where(F.col("half") == half).drop("half"), "o_orderstatus", folder=f"made/{half}", header=True)
        made = storage.leaf_files(bench.spark, f"{bench.root}/made/{half}")
        by_status = [(p, p.rsplit("split=", 1)[1].split("/")[0], n) for n, p in enumerate(made) if p.endswith(".csv")]
        numbers: dict[str, int] = {}
        moves = []
        for path, status, _ in by_status:
            numbers[status] = numbers.get(status, 0) + 1
            moves.append((path, f"{bench.root}/named/{half}/{status}_{numbers[status]}.csv"))
        storage.move(bench.spark, moves)
        if half == "a":
            storage.write_text(bench.spark, f"{bench.root}/named/b/empty.csv", "")
        ingest(bench.spark, spec, bench.run, bench.ledgers)
    folder = F.element_at(F.split(LOCATION, "/"), -2).alias("folder")
    return staging_table(bench.spark, spec).read().select("o_orderkey", "o_custkey", "o_orderstatus", folder)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'third' ELSE 'second' END AS cycle,
              CAST(1 AS BIGINT) AS times_logged FROM orders"""
)
def ingest_after_failures(bench: Bench) -> DataFrame:
    """The first run breaks off in the middle of landing, the third when it has landed: the runs after them leave each order once,
    and each file logged once."""
    rows, spec = bench.orders(), order_spec(bench)
    table = staging_table(bench.spark, spec)

    def cycle(n: int):
        return replace(bench.run, cycle_id=f"{CYCLE[:-1]}{n}")

    def broken(run, share: int) -> intents.Intent:
        """What a run leaves that stops when it has landed a part of its files."""
        paths = listing.checked_paths(pending_files(bench.spark, spec, run, bench.ledgers.file_log))
        intent = intents.open_intent(bench.ledgers, spec.dataset, run, run.now(), paths, intents.REPLACE_NONE)
        some = paths[: max(1, len(paths) // share)]
        land_staged(table, read_files(bench.spark, spec, some), run, some)
        return intent

    bench.export(rows.where("o_orderstatus = 'F'"), "o_orderstatus", header=True)
    broken(cycle(1), 2)
    bench.export(rows.where("o_orderstatus = 'O'"), "o_orderstatus", header=True)
    ingest(bench.spark, spec, cycle(2), bench.ledgers)
    bench.export(rows.where("o_orderstatus = 'P'"), "o_orderstatus", header=True)
    broken(cycle(3), 1).mark_landed()
    ingest(bench.spark, spec, cycle(4), bench.ledgers)
    log = bench.ledgers.file_log.read().groupBy(F.concat("input_location_prefix", "file_name").alias(LOCATION))
    names = {f"{CYCLE[:-1]}{n}": name for n, name in ((1, "first"), (2, "second"), (3, "third"), (4, "fourth"))}
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("execution_cycle_id")].alias("cycle")
    staged = table.read().join(log.agg(F.count(F.lit(1)).alias("times_logged")), LOCATION)
    return staged.select("o_orderkey", "o_custkey", "o_orderstatus", named, "times_logged")


@query(
    """SELECT o_orderkey, o_custkey, 'now' AS place FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_custkey, 'archive' FROM orders WHERE o_orderstatus <> 'F'"""
)
def full_load_archive(bench: Bench) -> DataFrame:
    """A full load with archive: the second cycle's rows are in the table, the first one's in the archive."""
    rows = bench.orders()
    spec = order_spec(bench, load_type="FULL", archive=True, archive_location=f"{bench.root}/archive")
    for n, arriving in ((1, "o_orderstatus <> 'F'"), (2, "o_orderstatus = 'F'")):
        bench.export(rows.where(arriving), "o_orderstatus", header=True)
        ingest(bench.spark, spec, replace(bench.run, cycle_id=f"{CYCLE[:-1]}{n}"), bench.ledgers)
    now = staging_table(bench.spark, spec).read().select("o_orderkey", "o_custkey", F.lit("now").alias("place"))
    old = structured.scan_partitioned(bench.spark, f"{bench.root}/archive", STAGING_KEYS)
    return now.unionByName(old.select("o_orderkey", "o_custkey", F.lit("archive").alias("place")))


FEED_RULES = [
    quality.in_list("f1", "o_orderstatus", ["O", "F"], message="status"),
    quality.in_range("f2", "o_totalprice", 0, 450000, criticality="non-critical", message="price", threshold=100),
]


@query(
    f"""SELECT {ORDERS_SQL}, CASE WHEN o_orderstatus = 'F' THEN 'second' ELSE 'first' END AS cycle FROM orders
        WHERE o_orderstatus <> 'P'"""
)
def ingest_end_to_end(bench: Bench) -> DataFrame:
    """Two runs over growing folders: files of status P fail a critical rule and are skipped,
    files loaded before are not loaded again, and forced files replace their earlier rows."""
    rows = bench.orders()
    bench.export(rows.where("o_orderstatus <> 'F'"), "o_orderstatus", header=True)
    spec = order_spec(bench, skip_file=True)
    ingest(bench.spark, spec, bench.run, bench.ledgers, rules=FEED_RULES)
    bench.export(rows.where("o_orderstatus = 'F'"), "o_orderstatus", header=True)
    second = replace(bench.run, cycle_id=f"{CYCLE[:-1]}2")
    ingest(bench.spark, spec, second, bench.ledgers, rules=FEED_RULES)
    return (
        staging_table(bench.spark, spec)
        .read()
        .withColumn("cycle", F.when(F.col("execution_cycle_id") == CYCLE, "first").otherwise("second"))
        .drop(LOCATION, "processed_time", *STAGING_KEYS)
    )


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, 'second' AS cycle FROM orders"""
)
def ingest_reprocess(bench: Bench) -> DataFrame:
    """Everything is loaded, then forced again: each order is there once, in the second cycle."""
    export_orders(bench)
    spec = order_spec(bench)
    ingest(bench.spark, spec, bench.run, bench.ledgers)
    second = replace(bench.run, cycle_id=f"{CYCLE[:-1]}2")
    document = {DATE: {DATASET: {"file_name": "all"}}}
    ingest(bench.spark, spec, second, bench.ledgers, reprocess_doc=document)
    cycle = F.when(F.col("execution_cycle_id") == CYCLE, "first").otherwise("second").alias("cycle")
    return staging_table(bench.spark, spec).read().select("o_orderkey", "o_custkey", "o_orderstatus", cycle)


@query(
    """SELECT o_orderkey AS order_key, o_orderstatus AS status, o_custkey AS customer, NULL AS note FROM orders
       WHERE o_orderstatus = 'F'
       UNION ALL
       SELECT o_orderkey, o_orderstatus, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"""
)
def ingest_differing_headers(bench: Bench) -> DataFrame:
    """Files of two headers, in another order and with a new column, in one run."""
    rows = bench.orders()
    older = rows.where("o_orderstatus = 'F'").select(
        F.col("o_orderstatus").alias("Status"), F.col("o_custkey").alias("Customer"), F.col("o_orderkey").alias("Order Key")
    )
    newer = rows.where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("note"),
    )
    older.write.option("header", True).csv(f"{bench.root}/src/older")
    newer.write.option("header", True).csv(f"{bench.root}/src/newer")
    spec = bench.spec(schema_mode="merge")
    ingest(bench.spark, spec, bench.run, bench.ledgers)
    staged = staging_table(bench.spark, spec).read()
    return staged.select(
        F.col("order_key").cast("bigint").alias("order_key"),
        "status",
        F.col("customer").cast("bigint").alias("customer"),
        "note",
    )


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'load 1' ELSE 'load 2' END AS loaded
       FROM orders"""
)
def process_publish_end_to_end(bench: Bench) -> DataFrame:
    """Two cycles from files to the published snapshot: staging, history append, publish."""
    rows = bench.orders()
    spec = order_spec(bench)
    mart = ProcessSpec(
        dataset="orders_hist",
        active=True,
        processed_schema=bench.schema,
        processed_table="orders_hist",
        processed_location=f"{bench.root}/hist",
        publish=True,
        publish_schema=bench.schema,
        publish_table="orders_now",
        publish_location=f"{bench.root}/now",
    )
    staged_name = staging_table(bench.spark, spec).name
    unwanted = [LOCATION, "processed_time", "o_totalprice", "o_orderdate", "o_orderpriority"]
    for n, arriving in ((1, "o_orderstatus = 'F'"), (2, "o_orderstatus <> 'F'")):
        bench.export(rows.where(arriving), "o_orderstatus", header=True)
        run = replace(bench.run, cycle_id=f"{CYCLE[:-1]}{n}")
        ingest(bench.spark, spec, run, bench.ledgers)
        history = incremental.previous_history(
            bench.spark, f"{bench.schema}.orders_hist", list(CYCLE_KEYS), staged_name, STAGING_KEYS, unwanted
        )
        staged = incremental.latest_staging(bench.spark, staged_name, "latest_cycle", STAGING_KEYS, unwanted)
        appended = incremental.append_history(history, staged, "loaded", F.lit(f"load {n}"))
        process(bench.spark, mart, run, bench.ledgers, appended)
    return publish_table(bench.spark, mart).read().drop(*CYCLE_KEYS)
