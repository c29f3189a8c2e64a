"""Parquet files whose types changed between deliveries."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans.ingest import ingest, staging_table
from tidemark.sources import storage, structured


def put(lake, name, rows):
    """One Parquet file with this name."""
    rows.coalesce(1).write.parquet(f"{lake.root}/made-{name}")
    found = [p for p in storage.leaf_files(lake.spark, f"{lake.root}/made-{name}") if p.endswith(".parquet")]
    os.makedirs(lake.src, exist_ok=True)
    storage.move(lake.spark, [(found[0], f"{lake.src}/{name}.parquet")])


def read(lake, **more):
    return structured.read_parquet(lake.spark, storage.leaf_files(lake.spark, lake.src), **more)


def test_int_then_string_loads(lake):
    put(lake, "a", lake.spark.sql("SELECT 1 AS id, 7 AS code, 'x' AS gone"))
    put(lake, "b", lake.spark.sql("SELECT 2L AS id, 'A7' AS code, 1.5D AS amount"))
    put(lake, "c", lake.spark.sql("SELECT 3L AS id, 'B' AS code, 2.5D AS amount"))
    spec = lake.spec(file_type="parquet", options={})
    assert ingest(lake.spark, spec, lake.run("1"), lake.ledgers).record_count == 3
    got = staging_table(lake.spark, spec).read().select("id", "code", "amount", "source_file_name")
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "7", None, "a.parquet"), (2, "A7", 1.5, "b.parquet"), (3, "B", 2.5, "c.parquet"),
    ]
    assert dict(got.dtypes)["id"] == "bigint"
    merged = read(lake, schema_mode="merge")
    assert {"id", "code", "amount", "gone"} <= set(merged.columns) and merged.where("gone = 'x'").count() == 1


def test_a_value_without_a_place_names_its_file_and_column(lake):
    put(lake, "a", lake.spark.sql("SELECT '12' AS code UNION ALL SELECT 'x' UNION ALL SELECT NULL"))
    put(lake, "b", lake.spark.sql("SELECT 5 AS code"))
    with pytest.raises(Exception, match="(?s)a.parquet: column 'code' has a value that is no int: x"):
        read(lake).collect()
    put(lake, "a2", lake.spark.sql("SELECT '12' AS code"))
    os.remove(f"{lake.src}/a.parquet")
    assert sorted(r.code for r in read(lake).collect()) == [5, 12]


def test_nested_types_that_differ_are_an_error(lake):
    put(lake, "a", lake.spark.sql("SELECT named_struct('x', 1) AS code"))
    put(lake, "b", lake.spark.sql("SELECT 5 AS code"))
    with pytest.raises(ValueError, match="column 'code' is struct<x:int> in some files and int in newer ones"):
        read(lake)


def test_files_without_rows_have_no_say(lake):
    put(lake, "a", lake.spark.sql("SELECT 1 AS id"))
    put(lake, "z", lake.spark.sql("SELECT 'x' AS id").limit(0))
    rows = read(lake)
    assert dict(rows.dtypes)["id"] == "int" and rows.count() == 1
    os.remove(f"{lake.src}/a.parquet")
    assert read(lake) is None


def test_one_read_where_types_agree(lake):
    put(lake, "a", lake.spark.range(3).select("id"))
    put(lake, "b", lake.spark.range(3).select("id", F.lit("x").alias("name")))
    plan = read(lake)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
