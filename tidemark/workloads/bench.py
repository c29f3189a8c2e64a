"""Shared ground of the registered queries: inputs, working folders, registration."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ledger import Ledgers
from tidemark.operators.shape import gather
from tidemark.operators.tables import CYCLE_KEYS, LakeTable
from tidemark.plans.spec import IngestSpec, RunContext
from tidemark.session import scratch_path
from tidemark.sources import storage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of a :class:`Bench` as a query under its own name."""

    def register(function: Callable[[Bench], DataFrame]) -> Callable[[Bench], DataFrame]:
        name = function.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Bench(spark, sf_dir, name))

        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return function

    return register


DATE = "20240601"
CYCLE = "20240601120000000000"
TIME = "2024-06-01 12:00:00"
DATASET = "orders_feed"

# An order year as execution date and cycle: newer orders came in later cycles.
ORDER_YEAR = "date_format(o_orderdate, 'yyyy')"
YEAR_DATE = f"{ORDER_YEAR} || '0101'"
YEAR_CYCLE = f"{ORDER_YEAR} || '0101000000000000'"


@dataclass
class Bench:
    """One call of a query: its input tables and a catalog schema and folder of its own."""

    spark: SparkSession
    sf_dir: str
    label: str

    def __post_init__(self) -> None:
        self.root = scratch_path(self.spark, self.label)
        storage.delete_at_exit(self.spark, self.root)
        self.run = RunContext(DATE, CYCLE, TIME, run_id="run-1")

    @cached_property
    def schema(self) -> str:
        """A catalog schema of this call's own, made when first asked for."""
        name = f"{self.label}_{uuid.uuid4().hex[:8]}"
        self.spark.sql(f"CREATE DATABASE `{name}` LOCATION '{self.root}/catalog'")
        return name

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def orders(self) -> DataFrame:
        """Orders with types that survive a trip through text files."""
        return self.read("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
            "o_orderpriority",
        )

    def lake(self, name: str, keys: Sequence[str] = CYCLE_KEYS) -> LakeTable:
        return LakeTable(self.spark, self.schema, name, f"{self.root}/{name}", tuple(keys))

    @property
    def ledgers(self) -> Ledgers:
        return Ledgers(self.spark, self.schema, f"{self.root}/logs", "bench")

    def yearly_orders(self, name: str = "orders_by_year", keys: Sequence[str] = CYCLE_KEYS) -> LakeTable:
        """All orders as a table with one partition per order year."""
        table = self.lake(name, keys)
        rows = self.read("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            F.lit("file:/in/orders.csv").alias("source_file_location"),
            F.lit(TIME).alias("processed_time"),
            F.expr(YEAR_DATE).alias("execution_date"),
            F.expr(YEAR_CYCLE).alias("execution_cycle_id"),
            *[F.expr(f"'orders_' || {ORDER_YEAR} || '.csv'").alias(k) for k in keys if k not in CYCLE_KEYS],
        )
        table.register(rows.drop(*keys).schema)
        table.land(gather(rows, *keys))
        return table

    def export(self, df: DataFrame, split: str, file_format: str = "csv", folder: str = "src", **options) -> str:
        """Write rows as source files below one folder per value of ``split``."""
        path = f"{self.root}/{folder}"
        kept = df.withColumn("split", F.col(split))
        gather(kept, "split").write.mode("append").partitionBy("split").options(**options).format(file_format).save(path)
        return path

    def spec(self, **changes) -> IngestSpec:
        settings = {
            "dataset": DATASET,
            "load_type": "INCREMENTAL",
            "active": True,
            "source_prefixes": f"{self.root}/src",
            "file_type": "csv",
            "target_schema": self.schema,
            "target_table": "STAGED",
            "target_location": f"{self.root}/staged",
            "options": {"delimiter": ","},
        }
        return IngestSpec(**{**settings, **changes})
