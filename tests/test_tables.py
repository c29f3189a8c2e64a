import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import incremental, ledger
from tidemark.operators.conform import conform
from tidemark.operators.tables import STAGING_KEYS, LakeTable, TempTables, publish

KEYS = ("execution_date", "execution_cycle_id")


def table(lake, name="t", keys=KEYS) -> LakeTable:
    return LakeTable(lake.spark, lake.schema, name, f"{lake.root}/{name}", keys)


def fill(lake, name="t", cells=((1, "20240101", "01"), (2, "20240102", "02"), (3, "20240102", "03"))):
    t = table(lake, name)
    df = lake.spark.createDataFrame(list(cells), "n int, execution_date string, execution_cycle_id string")
    t.register(df.drop(*KEYS).schema)
    t.land(df)
    return t


def test_landing_replaces_only_its_partitions(spark, lake, rows):
    t = fill(lake)
    again = spark.createDataFrame([(9, "20240102", "03")], "n int, execution_date string, execution_cycle_id string")
    t.land(again)
    assert rows(t.read()) == [(1, "20240101", "01"), (2, "20240102", "02"), (9, "20240102", "03")]
    with_static_session = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert with_static_session.lower() == "static", "the table's option decides, not the session"


def test_table_made_by_someone_else(spark, lake, rows):
    t = table(lake, keys=("d",))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.schema}")
    spark.sql(f"CREATE TABLE {t.name} (n int, d string) USING parquet PARTITIONED BY (d) LOCATION '{t.location}'")
    spark.sql(f"INSERT INTO {t.name} VALUES (1, 'a'), (2, 'b')")
    t.land_partition(spark.createDataFrame([(3,)], "n int"), {"d": "b"})
    t.land_partition(spark.createDataFrame([(4,)], "n int"), {"d": "c"})
    assert rows(t.read()) == [(1, "a"), (3, "b"), (4, "c")]
    altered = spark.sql(f"DESCRIBE TABLE EXTENDED {t.name}").where("data_type LIKE '%partitionOverwriteMode%'")
    assert altered.count() == 1


def test_odd_partition_values(spark, lake, rows):
    t = table(lake, keys=("part",))
    values = ["a b", "a/b", "a:b", "50%", "x'y", "a+b", "k=v", "ü", "back\\slash"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, part string")
    t.register(df.drop("part").schema)
    t.land(df)
    assert sorted(r.part for r in t.partitions().collect()) == sorted(values)
    assert t.read().count() == len(values)
    assert t.land_partition(df.where("n < 3"), {"part": "a/b"}) == 3
    assert t.partitions().count() == len(values)
    for i, value in enumerate(values):
        t.purge(F.col("part") == value)
    assert t.read().count() == 0
    assert [d for d in os.listdir(t.location) if d.startswith("part=")] == []


def test_empty_result_replaces_partition(spark, lake):
    t = table(lake)
    spec = {"execution_date": "d", "execution_cycle_id": "c"}
    df = spark.createDataFrame([(1,)], "n int")
    assert t.land_partition(df, spec) == 1
    assert t.land_partition(df.where("n > 1"), spec) == 0
    assert t.read().count() == 0 and t.partitions().count() == 1


def test_latest_schema_wins_in_name_type_and_order(spark, lake, rows):
    t = table(lake, keys=("d",))
    t.land_partition(spark.createDataFrame([(1, "x")], "a int, b string"), {"d": "1"})
    assert t.register(T.StructType().add("A", T.IntegerType()).add("B", T.StringType())) == "unchanged"
    t.land_partition(spark.createDataFrame([("y", 2.5)], "b string, c double"), {"d": "2"})
    assert rows(t.read(), "b", "c", "d") == [("x", None, "1"), ("y", 2.5, "2")]
    assert "a" not in t.read().columns
    with pytest.raises(ValueError, match="partitioned"):
        LakeTable(spark, lake.schema, "t", t.location, ("other",)).register(t.data_schema())
    with pytest.raises(ValueError, match="partition keys"):
        table(lake, "u", ("n",)).register(T.StructType().add("N", T.IntegerType()))


def test_detach_keeps_files_and_repair_brings_them_back(lake, rows):
    t = fill(lake)
    assert len(t.detach(F.col("execution_date") == "20240102")) == 2
    assert rows(t.read(), "n") == [(1,)]
    t.repair()
    assert rows(t.read(), "n") == [(1,), (2,), (3,)]
    t.add_partition({"execution_date": "20240101", "execution_cycle_id": "01"})


def test_archive_keeps_columns_the_table_lost(spark, lake, rows):
    t = table(lake)
    t.land_partition(spark.createDataFrame([(1, "old")], "n int, gone string"), {"execution_date": "d1", "execution_cycle_id": "1"})
    t.land_partition(spark.createDataFrame([(2,)], "n int"), {"execution_date": "d2", "execution_cycle_id": "2"})
    t.land_partition(spark.createDataFrame([(3,)], "n int"), {"execution_date": "d2", "execution_cycle_id": "3"})
    assert t.archive("3", f"{lake.root}/arch", only_date="d2") == 1
    assert rows(t.read(), "n") == [(1,), (3,)]
    assert t.archive("3", f"{lake.root}/arch") == 1
    assert t.archive("3", f"{lake.root}/arch") == 0
    kept = spark.read.option("mergeSchema", True).parquet(f"{lake.root}/arch")
    assert rows(kept, "n", "gone") == [(1, "old"), (2, None)]
    assert os.listdir(t.location) != [] and not os.path.exists(f"{t.location}/execution_date=d2/execution_cycle_id=2")


def test_publish_snapshot_replaces_also_other_dates(spark, lake, rows):
    processed, target = table(lake, "p"), table(lake, "pub")
    for date, cycle in (("d1", "1"), ("d2", "1"), ("d2", "2")):
        spec = {"execution_date": date, "execution_cycle_id": cycle}
        processed.land_partition(spark.createDataFrame([(date + cycle,)], "s string"), spec)
        publish(processed, target, spec)
    assert rows(target.read()) == [("d22", "d2", "2")]


def test_temp_tables(spark):
    with TempTables(spark) as temp:
        temp.keep(spark.range(10).where("id > 3"), "t", "kept_view")
        assert spark.sql("SELECT count(*) FROM kept_view").first()[0] == 6
        assert os.path.exists(temp.root.removeprefix("file:"))
    assert not os.path.exists(temp.root.removeprefix("file:"))


def test_partition_rewritten_from_itself_with_new_columns(spark, lake, rows):
    t = table(lake, keys=("d",))
    t.land_partition(spark.createDataFrame([(1,), (2,)], "n int"), {"d": "1"})
    grown = t.read().where("d = '1'").select("n", (F.col("n") * 10).alias("m"))
    assert t.land_partition(grown, {"d": "1"}) == 2
    assert t.land_partition(t.read().where("n = 2"), {"d": "1"}) == 1
    assert rows(t.read()) == [(2, 20, "1")]


def test_failed_write_leaves_the_partition(spark, lake, rows):
    t = fill(lake)
    broken = spark.range(100, numPartitions=4).select(F.expr("IF(id = 99, raise_error('no'), cast(id AS int))").alias("n"))
    with pytest.raises(Exception, match="no"):
        t.land_partition(broken, {"execution_date": "20240101", "execution_cycle_id": "01"})
    assert rows(t.read(), "n") == [(1,), (2,), (3,)]


# -- newest partitions ---------------------------------------------------------


def test_independent_and_tuple_maxima(lake, rows):
    t = fill(lake, cells=((1, "20240101", "09"), (2, "20240102", "02")))
    independent = incremental.newest_rows(lake.spark, t.name, KEYS)
    assert rows(independent) == []
    assert rows(incremental.newest_rows(lake.spark, t.name, KEYS, "tuple"), "n") == [(2,)]


def test_partition_without_rows_is_not_the_newest(spark, lake, rows):
    t = fill(lake)
    t.land_partition(spark.createDataFrame([], "n int"), {"execution_date": "20240109", "execution_cycle_id": "09"})
    assert rows(incremental.newest_rows(spark, t.name, KEYS), "n") == [(3,)]
    assert rows(incremental.newest_rows(spark, t.name, KEYS, "tuple"), "n") == [(3,)]


def test_newest_prunes_by_constants(lake):
    t = fill(lake)
    df = incremental.newest_rows(lake.spark, t.name, KEYS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Subquery" not in plan
    assert len(df.inputFiles()) == 1


def test_history_modes(lake, rows):
    spark, t = lake.spark, fill(lake)
    history = incremental.previous_history
    assert rows(history(spark, t.name, KEYS)) == [(3,)]
    pinned = {"execution_date": "20240101", "execution_cycle_id": "01"}
    assert rows(history(spark, t.name, KEYS, override=pinned)) == [(1,)]
    assert rows(history(spark, t.name, KEYS, override="FULL LOAD")) == []
    assert history(spark, f"{lake.schema}.none", KEYS, t.name, KEYS).columns == ["n"]
    with pytest.raises(ValueError, match="execution_cycle_id"):
        history(spark, t.name, KEYS, override={"execution_date": "20240101"})
    with pytest.raises(ValueError, match="staging"):
        history(spark, f"{lake.schema}.none", KEYS)
    with pytest.raises(Exception, match="none"):
        incremental.previous_history_dw(spark, f"{lake.schema}.none", KEYS)


def test_staging_modes(lake, rows):
    spark, t = lake.spark, fill(lake)
    latest = incremental.latest_staging
    assert rows(latest(spark, t.name, None, KEYS)) == [(3,)]
    assert rows(latest(spark, t.name, "Latest_Date")) == [(2,), (3,)]
    assert rows(latest(spark, t.name, "latest_cycle")) == [(3,)]
    assert rows(latest(spark, t.name, "full")) == [(1,), (2,), (3,)]
    assert rows(latest(spark, t.name, "", KEYS, history_override="full load")) == [(1,), (2,), (3,)]
    pinned = {"execution_date": "20240102", "execution_cycle_id": "02"}
    assert rows(latest(spark, t.name, "", KEYS, override=pinned)) == [(2,)]
    with pytest.raises(ValueError, match="load type"):
        latest(spark, t.name, "weekly", KEYS)
    spark.createDataFrame([(1, "a"), (2, "b")], "n int, batch string").createOrReplaceTempView("plain_staging")
    assert rows(latest(spark, "plain_staging", "latest_cycle", ["batch"])) == [(2,)]


def test_override_document():
    document = {"20240601": {"h": {"k": "v"}, "g": "full load"}}
    assert incremental.override_for(document, "20240601", "h") == {"k": "v"}
    assert incremental.override_for(document, "20240601", "g") == "full load"
    assert incremental.override_for(document, "20240602", "h") is None
    assert incremental.override_for(None, "20240601", "h") is None


def test_append_history_by_name(spark, rows):
    history = spark.createDataFrame([("h", 1, "t0")], "s string, n int, loaded string")
    staged = spark.createDataFrame([(2, "x"), (2, "x")], "n int, s string")
    got = incremental.append_history(history, staged, "loaded", F.lit("t1"))
    assert rows(got, "s", "n", "loaded") == [("h", 1, "t0"), ("x", 2, "t1")]
    unstamped = incremental.append_history(history.select("s"), staged, "loaded", F.lit("t1"))
    assert rows(unstamped, "s", "n", "loaded") == [("h", None, "t1"), ("x", 2, "t1")]


# -- conform -------------------------------------------------------------------

MAPPING = (
    "dataset_name string, source_schema_name string, source_table_name string, source_column_name string, "
    "target_column_name string, target_column_sequence string, active_flag string"
)
CONFIG = "dataset_name string, source_schema_name string, source_table_name string, where_clause string, active_flag string"


def conformed(lake, where):
    spark = lake.spark
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string").createOrReplaceTempView("left_src")
    spark.createDataFrame([(7,)], "key long").createOrReplaceTempView("right_src")
    mapping = spark.createDataFrame(
        [
            ("d", "", "left_src", "v", "Value", "10", "Y"),
            ("d", "", "left_src", "id", "Id", "9", "Y"),
            ("d", "", "right_src", "key", "Id", "9", "Y"),
            ("d", "", "right_src", None, "Value", "10", "Y"),
            ("x", "", "right_src", "key", "Other", "1", "Y"),
        ],
        MAPPING,
    )
    config = spark.createDataFrame([("d", "", "left_src", w, "Y") for w in where], CONFIG)
    return conform(spark, mapping, config, "d")


def test_conform(lake, rows):
    got = conformed(lake, [" id < 2 "])
    assert got.dtypes == [("Id", "string"), ("Value", "string")]
    assert rows(got) == [("1", "a"), ("7", None)]
    assert rows(conformed(lake, [None])) == [("1", "a"), ("2", "b"), ("7", None)]
    with pytest.raises(ValueError, match="WHERE"):
        conformed(lake, ["where id < 2"])
    with pytest.raises(ValueError, match="several"):
        conformed(lake, ["id < 2", "id < 3"])


# -- ledger migration ------------------------------------------------------------


def test_migrations(spark, lake, rows):
    old = spark.createDataFrame(
        [("A", None, "a.csv", "csv", 3, "s", "e", "Ingested", "d", "c", "a.csv")],
        "dataset_name string, run_id string, file_name string, file_type string, record_count int, "
        "execution_start_time string, execution_end_time string, ingestion_status string, "
        "execution_date string, execution_cycle_id string, source_file_name string",
    )
    old.write.partitionBy("execution_date", "execution_cycle_id", "source_file_name").parquet(f"{lake.root}/old")
    assert ledger.migrate_file_log(f"{lake.root}/old", lake.ledgers.file_log, remove_old=True) == 1
    got = lake.ledgers.file_log.read().first()
    assert (got.table_name, got.run_id, got.input_location_prefix, got.source_file_name) == ("A", "NA", "", "a.csv")
    assert not os.path.exists(f"{lake.root}/old")
    assert rows(ledger.done_files(lake.ledgers.file_log, "A")) == [("", "a.csv", "Ingested")]

    runs = spark.createDataFrame([("B", "r", str(["b.csv", "it's.csv"]), 5, "d", "c")], "dataset_name string, run_id string, source_files string, record_count int, execution_date string, execution_cycle_id string")
    runs.write.partitionBy("execution_date", "execution_cycle_id").parquet(f"{lake.root}/old_runs")
    assert ledger.migrate_ingestion_log(f"{lake.root}/old_runs", lake.ledgers.ingestion_log) == 1
    assert rows(lake.ledgers.ingestion_log.read(), "dataset_name", "table_name", "record_count", "source_files") == [("B", "B", 5, ["b.csv", "it's.csv"])]


def statements(monkeypatch, spark):
    """SQL texts that the session is given from here on."""
    said, plain = [], type(spark).sql

    def sql(self, text, *args, **kwargs):
        said.append(text)
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    return said


def test_newest_rows_do_not_list_partitions_per_file(lake, monkeypatch):
    """Dates and cycles come from folder names; what is not registered, or has no rows, is passed over."""
    table = LakeTable(lake.spark, lake.schema, "many", f"{lake.root}/many", STAGING_KEYS)
    rows = lake.spark.range(60).select(
        "id",
        F.format_string("2024060%d", F.col("id") % 2 + 1).alias("execution_date"),
        (F.col("id") % 3).cast("string").alias("execution_cycle_id"),
        F.format_string("f%d.csv", "id").alias("source_file_name"),
    )
    table.register(rows.select("id").schema)
    table.land(rows)
    table.add_partition({"execution_date": "20240609", "execution_cycle_id": "0", "source_file_name": "none.csv"})
    os.makedirs(f"{lake.root}/many/execution_date=20240608/execution_cycle_id=9/source_file_name=x.csv")
    said = statements(monkeypatch, lake.spark)
    tops = incremental.newest_rows(lake.spark, table.name, ["execution_date", "execution_cycle_id"])
    combined = incremental.newest_rows(lake.spark, table.name, ["execution_date", "execution_cycle_id"], "tuple")
    want = rows.where("execution_date = '20240602' AND execution_cycle_id = '2'")
    assert sorted(r.id for r in tops.collect()) == sorted(r.id for r in combined.collect()) == sorted(r.id for r in want.collect())
    assert not [s for s in said if "SHOW PARTITIONS" in s]
    # All keys, and tables that others laid out, ask the catalog.
    lake.spark.sql(f"ALTER TABLE {table.name} UNSET TBLPROPERTIES ('tidemark.partitions.in.folders')")
    again = incremental.newest_rows(lake.spark, table.name, ["execution_date"])
    assert again.count() == 30 and [s for s in said if "SHOW PARTITIONS" in s]


def test_columns_added_at_the_end_list_no_folder(lake, monkeypatch):
    table = LakeTable(lake.spark, lake.schema, "wider", f"{lake.root}/wider")
    keys = [F.lit("20240601").alias("execution_date"), F.lit("1").alias("execution_cycle_id")]
    table.register(lake.spark.range(1).schema)
    table.land(lake.spark.range(3).select("id", *keys))
    said = statements(monkeypatch, lake.spark)
    wide = lake.spark.range(2).select("id", F.lit("x").alias("New Name"), F.lit(1.5).alias("amount"), *keys[:1], F.lit("2").alias("execution_cycle_id"))
    assert table.register(wide.drop(*table.keys).schema) == "extended"
    assert not [s for s in said if "DROP" in s or "MSCK" in s]
    table.land(wide)
    got = sorted((r["id"], r["New Name"], r["amount"], r["execution_cycle_id"]) for r in table.read().where("execution_cycle_id = '2'").collect())
    assert got == [(0, "x", 1.5, "2"), (1, "x", 1.5, "2")]
    assert table.read().where("amount IS NULL").count() == 3
    assert table.register(lake.spark.range(1).selectExpr("'a' AS id").schema) == "recreated"
