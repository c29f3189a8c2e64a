"""Queries over history, newest staging rows, conformed sources and SQL scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import conform, incremental
from tidemark.operators.shape import gather
from tidemark.operators.tables import CYCLE_KEYS, STAGING_KEYS
from tidemark.plans.process import process, processed_table
from tidemark.plans.spec import ProcessSpec
from tidemark.sources import storage
from tidemark.workloads.bench import DATE, Bench, query

KEYS = list(CYCLE_KEYS)
DATA_SQL = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice"
STAGED_SQL = f"{DATA_SQL}, 'file:/in/orders.csv' AS source_file_location, '2024-06-01 12:00:00' AS processed_time"
YEAR_SQL = "strftime(o_orderdate, '%Y')"
NEWEST_SQL = f"{YEAR_SQL} = (SELECT max({YEAR_SQL}) FROM orders)"


@query(f"SELECT {DATA_SQL} FROM orders WHERE {NEWEST_SQL}")
def hist_latest(bench: Bench) -> DataFrame:
    return incremental.previous_history(bench.spark, bench.yearly_orders().name, KEYS)


@query(f"SELECT {DATA_SQL} FROM orders WHERE {NEWEST_SQL}")
def hist_latest_dw(bench: Bench) -> DataFrame:
    return incremental.previous_history_dw(bench.spark, bench.yearly_orders().name, KEYS)


@query(f"SELECT {DATA_SQL} FROM orders WHERE {YEAR_SQL} = '1997'")
def hist_pinned_partition(bench: Bench) -> DataFrame:
    document = {DATE: {"orders_hist": {"execution_date": "19970101", "execution_cycle_id": "19970101000000000000"}}}
    override = incremental.override_for(document, DATE, "orders_hist")
    return incremental.previous_history(bench.spark, bench.yearly_orders().name, KEYS, override=override)


@query(f"SELECT {DATA_SQL} FROM orders WHERE false UNION ALL SELECT {DATA_SQL} FROM orders WHERE {NEWEST_SQL}")
def hist_full_reload(bench: Bench) -> DataFrame:
    """A full load starts from no history: only the rows put after it are there."""
    table = bench.yearly_orders().name
    nothing = incremental.previous_history(bench.spark, table, KEYS, override="Full Load")
    return nothing.unionByName(incremental.previous_history(bench.spark, table, KEYS))


@query(f"SELECT {DATA_SQL} FROM orders")
def hist_bootstrap(bench: Bench) -> DataFrame:
    """No history table yet: structure from staging, then everything is staged."""
    staged = bench.yearly_orders("staged", STAGING_KEYS)
    history = incremental.previous_history(bench.spark, f"{bench.schema}.no_history", KEYS, staged.name, STAGING_KEYS)
    fresh = incremental.latest_staging(
        bench.spark, staged.name, "full", STAGING_KEYS, ["source_file_location", "processed_time"]
    )
    return history.unionByName(fresh)


STATUS_CYCLES_SQL = "SELECT o_orderkey, o_orderstatus AS d, CASE WHEN o_orderstatus = 'P' THEN '2' ELSE left(o_orderpriority, 1) END AS c FROM orders"


@query(
    f"""WITH t AS ({STATUS_CYCLES_SQL})
    SELECT o_orderkey, 'independent' AS mode FROM t WHERE d = (SELECT max(d) FROM t) AND c = (SELECT max(c) FROM t)
    UNION ALL
    SELECT o_orderkey, 'tuple' FROM t WHERE (d || '/' || c) = (SELECT max(d || '/' || c) FROM t)"""
)
def hist_latest_modes(bench: Bench) -> DataFrame:
    """The last date has no partition of the greatest cycle: each key's own maximum gives no row, the greatest
    existing pair does."""
    table = bench.lake("by_status")
    last = F.col("o_orderstatus") == "P"
    rows = bench.read("orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("execution_date"),
        F.when(last, "2").otherwise(F.substring("o_orderpriority", 1, 1)).alias("execution_cycle_id"),
    )
    table.register(rows.drop(*table.keys).schema)
    table.land(gather(rows, *table.keys))
    parts = [
        incremental.newest_rows(bench.spark, table.name, KEYS, mode).select("o_orderkey", F.lit(mode).alias("mode"))
        for mode in ("independent", "tuple")
    ]
    return parts[0].unionByName(parts[1])


@query(f"SELECT {STAGED_SQL} FROM orders WHERE {NEWEST_SQL}")
def stg_default(bench: Bench) -> DataFrame:
    return incremental.latest_staging(bench.spark, bench.yearly_orders().name, "", KEYS)


@query(f"SELECT {STAGED_SQL} FROM orders WHERE {YEAR_SQL} = '1996'")
def stg_pinned_partition(bench: Bench) -> DataFrame:
    pinned = {"execution_date": "19960101", "execution_cycle_id": "19960101000000000000"}
    return incremental.latest_staging(bench.spark, bench.yearly_orders().name, "", KEYS, override=pinned)


@query(
    f"""WITH newest AS (SELECT {YEAR_SQL} AS y, o_orderpriority AS p FROM orders ORDER BY y DESC, p DESC LIMIT 1)
        SELECT o_orderkey, o_custkey FROM orders, newest WHERE {YEAR_SQL} = y AND o_orderpriority = p"""
)
def hist_latest_tuple(bench: Bench) -> DataFrame:
    """The greatest combination of year and priority that exists, not each maximum by itself."""
    table = bench.lake("by_year_and_priority")
    rows = bench.read("orders").select(
        "o_orderkey",
        "o_custkey",
        F.date_format("o_orderdate", "yyyy").alias("execution_date"),
        F.col("o_orderpriority").alias("execution_cycle_id"),
    )
    table.register(rows.drop(*KEYS).schema)
    table.land(gather(rows, *KEYS))
    return incremental.previous_history(bench.spark, table.name, KEYS, mode="tuple")


@query(f"SELECT {STAGED_SQL} FROM orders")
def stg_full(bench: Bench) -> DataFrame:
    """A history override of full load turns any load type into a full one."""
    return incremental.latest_staging(
        bench.spark, bench.yearly_orders().name, "latest_date", KEYS, history_override="full load"
    )


@query(f"SELECT {STAGED_SQL} FROM orders WHERE {NEWEST_SQL}")
def stg_latest_cycle(bench: Bench) -> DataFrame:
    """Cycle kept in an ordinary column of a view: no partition to prune by."""
    view = f"{bench.schema}_view"
    renamed = bench.yearly_orders().read().withColumnRenamed("execution_cycle_id", "pt_cycle_id")
    renamed.drop("execution_date").createOrReplaceTempView(view)
    return incremental.latest_staging(bench.spark, view, "latest_cycle")


@query(f"SELECT {STAGED_SQL} FROM orders WHERE {NEWEST_SQL}")
def stg_latest_date(bench: Bench) -> DataFrame:
    return incremental.latest_staging(bench.spark, bench.yearly_orders().name, "latest_date", KEYS)


@query(
    f"""SELECT o_custkey, o_orderstatus, 'before' AS load_time FROM orders WHERE {YEAR_SQL} = '1999'
        UNION ALL
        SELECT DISTINCT o_custkey, o_orderstatus, 'now' FROM orders WHERE {NEWEST_SQL}"""
)
def hist_append(bench: Bench) -> DataFrame:
    """Pinned history, distinct newest staging rows, written back into the table that is read."""
    table = bench.lake("customer_hist")
    past = bench.read("orders").where(F.date_format("o_orderdate", "yyyy") == "1999")
    table.land_partition(
        past.select("o_custkey", "o_orderstatus", F.lit("before").alias("load_time")),
        {"execution_date": "19990101", "execution_cycle_id": "19990101000000000000"},
    )
    history = incremental.previous_history(bench.spark, table.name, KEYS)
    unwanted = ["o_orderkey", "o_totalprice", "source_file_location", "processed_time"]
    staged = incremental.latest_staging(bench.spark, bench.yearly_orders().name, "latest_cycle", KEYS, unwanted)
    spec = ProcessSpec("customer_hist", True, bench.schema, "customer_hist", table.location)
    appended = incremental.append_history(history, staged, "load_time", F.lit("now"))
    process(bench.spark, spec, bench.run, bench.ledgers, appended)
    return incremental.previous_history(bench.spark, table.name, KEYS)


@query(
    """SELECT DISTINCT c_name AS party_name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment,
              CASE WHEN c_acctbal < 0 THEN 'owing' ELSE 'fine' END AS standing FROM customer
       WHERE c_nationkey <> 7 OR c_mktsegment = 'BUILDING'
       UNION ALL
       SELECT DISTINCT s_name, CAST(s_nationkey AS VARCHAR), NULL, NULL FROM supplier"""
)
def conform_union(bench: Bench) -> DataFrame:
    """Customers and suppliers as one all-string party table."""
    for name in ("customer", "supplier"):
        bench.spark.sql(f"CREATE TABLE `{bench.schema}`.{name} USING parquet LOCATION '{bench.sf_dir}/{name}.parquet'")
    mapped = [
        ("customer", "c_name", "party_name", "1"),
        ("customer", "c_nationkey", "nation", "2"),
        ("customer", "c_mktsegment", "segment", "3"),
        ("customer", "CASE WHEN c_acctbal < 0 THEN 'owing' ELSE 'fine' END", "standing", "10"),
        ("supplier", "s_name", "party_name", "1"),
        ("supplier", "s_nationkey", "nation", "2"),
        ("supplier", "", "segment", "3"),
    ]
    mapping = bench.spark.createDataFrame(
        [("party", bench.schema, t, s, target, seq, "full", "erp", "Y") for t, s, target, seq in mapped]
        + [("party", bench.schema, "nation", "n_name", "party_name", "1", "full", "erp", "N")],
        "dataset_name string, source_schema_name string, source_table_name string, source_column_name string, "
        "target_column_name string, target_column_sequence string, load_type string, source string, active_flag string",
    )
    config = bench.spark.createDataFrame(
        [("party", bench.schema, "customer", "c_nationkey <> 7 OR c_mktsegment = 'BUILDING'", None, "Y")],
        "dataset_name string, source_schema_name string, source_table_name string, where_clause string, "
        "join_statement string, active_flag string",
    )
    return conform.conform(bench.spark, mapping, config, "party")


@query(
    f"""SELECT o_custkey, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders
        WHERE {NEWEST_SQL} GROUP BY o_custkey"""
)
def sql_script_processed(bench: Bench) -> DataFrame:
    """A script over the newest cycle becomes the processed table."""
    source = bench.yearly_orders()
    script = f"""-- orders per customer in the newest cycle
        SELECT o_custkey, count(*) AS orders, CAST(sum(o_totalprice) AS DECIMAL(28,2)) AS total FROM {source.name}
        WHERE execution_cycle_id IN (SELECT max(execution_cycle_id) FROM {source.name})
        GROUP BY o_custkey;"""
    path = f"{bench.root}/per_customer.sql"
    storage.write_text(bench.spark, path, script)
    spec = ProcessSpec(
        "per_customer", True, bench.schema, "per_customer", f"{bench.root}/per_customer", sql_script=path
    )
    process(bench.spark, spec, bench.run, bench.ledgers)
    return processed_table(bench.spark, spec).read().drop(*KEYS)
