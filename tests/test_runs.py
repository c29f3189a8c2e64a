import gzip
import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ledger, quality, reprocess
from tidemark.plans.ingest import NothingToIngest, ingest, landed, staging_table
from tidemark.plans.process import process, processed_table, publish_table, run_sql, run_sql_script
from tidemark.plans.spec import IngestSpec, ProcessSpec
from tidemark.sources import delimited, listing, storage
from tidemark.streaming.pickup import pick_up_available

DOC = [
    {"column_name": "Id", "column_data_type": "int"},
    {"column_name": "Day", "column_data_type": "date", "data_format": "YYYY-MM-DD"},
]


def staged(lake, *columns, spec=None):
    table = staging_table(lake.spark, spec or lake.spec())
    return sorted(tuple(r) for r in table.read().select(*columns).collect())


def statuses(lake):
    log = lake.ledgers.file_log.read().select("execution_cycle_id", "file_name", "record_count", "ingestion_status")
    return sorted(tuple(r) for r in log.collect())


def test_three_cycles_with_new_header_and_empty_files(lake):
    spark, spec = lake.spark, lake.spec()
    lake.put("a.csv", "Id,Name\n1,x\n2,null\n")
    lake.put("empty.csv", "")
    lake.put("header_only.csv", "Id,Name\n")
    result = ingest(spark, spec, lake.run("1"), lake.ledgers)
    assert (result.record_count, result.loaded_files, result.skipped_files) == (2, 1, 2)
    assert staged(lake, "id", "name", "source_file_name") == [("1", "x", "a.csv"), ("2", "", "a.csv")]
    assert statuses(lake) == [
        ("1", "a.csv", 2, "Ingested"),
        ("1", "empty.csv", 0, "File Skipped"),
        ("1", "header_only.csv", 0, "File Skipped"),
    ]
    # Nothing new: skipped files count as done too.
    with pytest.raises(NothingToIngest):
        ingest(spark, spec, lake.run("2"), lake.ledgers)
    # A new header: its columns win, old rows are NULL in the new one.
    lake.put("b.csv", "Name,City\ny,Rome\n")
    ingest(spark, spec, lake.run("2"), lake.ledgers)
    assert staged(lake, "name", "execution_cycle_id") == [("", "1"), ("x", "1"), ("y", "2")]
    assert "id" not in staging_table(spark, spec).read().columns
    row = landed(staging_table(spark, spec), lake.run("2")).first()
    assert row.city == "Rome" and row.processed_time == "2024-06-01 12:00:00"
    assert row.source_file_location.endswith("/src/b.csv")
    run_log = lake.ledgers.ingestion_log.read().where("execution_cycle_id = '2'").first()
    assert run_log.source_files == ["b.csv"] and run_log.record_count == 1 and run_log.delimiter == ","
    assert lake.ledgers.file_log.table == "file_log_my_app"


def test_file_names_of_a_run_come_in_lots(lake, monkeypatch):
    """No cell grows with the run; the record count is there once."""
    monkeypatch.setattr(ledger, "NAMES_PER_ROW", 2)
    for n in range(7):
        lake.put(f"f{n}.csv", f"Id\n{n}\n")
    ingest(lake.spark, lake.spec(), lake.run("1"), lake.ledgers)
    logged = lake.ledgers.ingestion_log.read().collect()
    assert len(logged) > 1 and sum(r.record_count for r in logged) == 7
    assert sorted(n for r in logged for n in r.source_files) == [f"f{n}.csv" for n in range(7)]
    assert {r.run_id for r in logged} == {lake.run("1").run_id}


def test_ledger_of_text_lists_gets_json(spark, lake):
    """A run ledger made before names were an array keeps its column."""
    log = lake.ledgers.ingestion_log
    log.register(T.StructType([T.StructField(f.name, T.StringType() if f.name == "source_files" else f.dataType) for f in ledger.INGESTION_LOG]))
    files = spark.createDataFrame([("s/", "a.csv"), ("s/", "it's.csv")], "input_location_prefix string, file_name string")
    ledger.write(log, ledger.INGESTION_LOG, ledger.run_rows(files, 2, record_count=3), lake.run("1").partition("d"))
    row = log.read().first()
    assert (row.source_files, row.record_count) == ('["a.csv","it\'s.csv"]', 3)


def test_differing_headers_in_one_run(lake):
    lake.put("a.csv", "Id,Name\n1,x\n")
    lake.put("b.csv", "Name,Id\ny,2\n")
    lake.put("c d+e%.csv", "Name,Id,Extra\nz,3,e\n")
    paths = storage.leaf_files(lake.spark, lake.src)
    assert len(delimited.header_groups(lake.spark, paths)) == 3
    with pytest.raises(ValueError, match="not allowed"):
        ingest(lake.spark, lake.spec(), lake.run(), lake.ledgers)
    os.rename(f"{lake.src}/c d+e%.csv", f"{lake.src}/c d+e [1].csv")
    result = ingest(lake.spark, lake.spec(), lake.run(), lake.ledgers)
    assert result.record_count == 3
    assert staged(lake, "id", "name", "source_file_name") == [("1", "x", "a.csv"), ("2", "y", "b.csv"), ("3", "z", "c d+e [1].csv")]
    merged = delimited.read_header_strings(lake.spark, storage.leaf_files(lake.spark, lake.src), schema_mode="merge")
    assert sorted(merged.columns) == ["extra", "id", "name", "source_file_location"]


def test_quoted_line_breaks_and_compressed_files(lake):
    lake.put("a.csv", '"Id","Long\nname"\n1,"say ""hi""\nthere"\n')
    options = {"multiline": "true", "escape": '"', "delimiter": ","}
    ingest(lake.spark, lake.spec(options=options), lake.run(), lake.ledgers)
    assert staged(lake, "id", "long_name") == [("1", 'say "hi"\nthere')]
    with gzip.open(f"{lake.src}/z.csv.gz", "wt") as file:
        file.write("Id,Long name\n7,q\n")
    ingest(lake.spark, lake.spec(options=options), lake.run("2"), lake.ledgers)
    assert staged(lake, "id", "execution_cycle_id") == [("1", "1"), ("7", "2")]


def test_declared_schema_and_bad_dates(lake):
    lake.put("a.txt", "1|2024-01-31\n2|2024-02-31\n")
    spec = lake.spec(file_type="txt", header=False, schema_doc=DOC, options={"delimiter": "|"}, mask="*.txt")
    ingest(lake.spark, spec, lake.run(), lake.ledgers)
    assert [(i, str(d)) for i, d in staged(lake, "id", "day")] == [(1, "2024-01-31"), (2, "None")]


def test_encoding_and_declared_json(lake):
    path = lake.put("a.csv", "")
    with open(path, "wb") as file:
        file.write("Größe;Ort\n1;Köln\n".encode("iso-8859-1"))
    spec = lake.spec(options={"encoding": "ISO-8859-1", "delimiter": ";"}, mask="a.csv")
    ingest(lake.spark, spec, lake.run(), lake.ledgers)
    assert staged(lake, "gr__e", "ort") == [("1", "Köln")]
    lake.put("doc.json", '[\n{"id": 1, "lines": [{"p": 1.005}]},\n{"id": 2, "unknown": 5}\n]')
    spec = lake.spec(
        dataset="docs", file_type="json", mask="*.json", options={"multiline": "true"}, target_table="J",
        target_location=f"{lake.root}/j", schema_doc={"id": "long", "lines": [{"p": "decimal|6,3"}]},
    )
    ingest(lake.spark, spec, lake.run(), lake.ledgers)
    assert sorted(((i, str(p)) for i, p in staged(lake, "id", "p", spec=spec))) == [(1, "1.005"), (2, "None")]


def test_duplicates_within_a_file(lake):
    lake.put("a.csv", "Id\n1\n1\n2\n")
    lake.put("b.csv", "Id\n1\n")
    assert ingest(lake.spark, lake.spec(drop_duplicates=True), lake.run(), lake.ledgers).record_count == 3


def test_prefix_list_keeps_same_names_apart(lake):
    lake.put("p1/a.csv", "Id\n1\n")
    lake.put("p2/a.csv", "Id\n2\n")
    prefixes = [f"{lake.src}/p1", f"{lake.src}/p2/"]
    spec = lake.spec(source_prefixes=prefixes)
    ingest(lake.spark, spec, lake.run(), lake.ledgers)
    assert staged(lake, "id", "source_file_name") == [("1", "a.csv"), ("2", "a.csv")]
    lake.put("p3/a.csv", "Id\n3\n")
    ingest(lake.spark, lake.spec(source_prefixes=[*prefixes, f"{lake.src}/p3"]), lake.run("2"), lake.ledgers)
    assert staged(lake, "id", "execution_cycle_id") == [("1", "1"), ("2", "1"), ("3", "2")]
    # Forcing one of them leaves the rows of the others where they are.
    lake.put("p2/a.csv", "Id\n22\n")
    document = {"20240601": {"feed": {"file_name": [{"name": "a.csv", "prefix": f"{lake.src}/p2"}]}}}
    ingest(lake.spark, spec, lake.run("3"), lake.ledgers, reprocess_doc=document)
    assert staged(lake, "id", "execution_cycle_id") == [("1", "1"), ("22", "3"), ("3", "2")]


def test_identity_does_not_follow_from_the_listing(lake):
    """A flat folder that gets its first sub-folder loads what is new, and nothing again."""
    lake.put("a.csv", "Id\n1\n")
    assert ingest(lake.spark, lake.spec(), lake.run("1"), lake.ledgers).record_count == 1
    lake.put("sub/src/a.csv", "Id\n2\n")
    assert ingest(lake.spark, lake.spec(), lake.run("2"), lake.ledgers).record_count == 1
    assert staged(lake, "id", "execution_cycle_id") == [("1", "1"), ("2", "2")]
    with pytest.raises(FileNotFoundError):
        listing.source_files(lake.spark, f"{lake.src}/missing")
    # By name alone the file in the sub-folder is the one that was loaded, and so is one of a folder that moved.
    by_name = lake.spec(file_identity="name", source_prefixes=f"{lake.src}/sub")
    with pytest.raises(NothingToIngest):
        ingest(lake.spark, by_name, lake.run("3"), lake.ledgers)
    with pytest.raises(ValueError, match="file_identity"):
        lake.spec(file_identity="folder")


def test_static_file_is_always_read_again(lake):
    lake.put("fixed.csv", "Id\n1\n")
    spec = lake.spec(static_file=True, mask="fixed.csv")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    ingest(lake.spark, spec, lake.run("2"), lake.ledgers)
    assert staged(lake, "id", "execution_cycle_id") == [("1", "1"), ("1", "2")]


def test_reprocess_some_skipped_and_all(lake):
    spark, spec = lake.spark, lake.spec()
    for name in ("a", "b"):
        lake.put(f"{name}.csv", f"Id\n{name}\n")
    lake.put("late.csv", "")
    ingest(spark, spec, lake.run("1"), lake.ledgers)
    lake.put("a.csv", "Id\na2\n")
    lake.put("late.csv", "Id\nlate\n")
    document = {"20240601": {"feed": {"file_name": ["a.csv"], "includes_skipped_files": "Y"}}}
    ingest(spark, spec, lake.run("2"), lake.ledgers, reprocess_doc=document)
    assert staged(lake, "id", "execution_cycle_id") == [("a2", "2"), ("b", "1"), ("late", "2")]
    # A file that was skipped once and loaded since is not a skipped file any more.
    ingest(spark, spec, lake.run("21"), lake.ledgers, reprocess_doc=document)
    assert staged(lake, "id", "execution_cycle_id") == [("a2", "21"), ("b", "1"), ("late", "2")]
    ingest(spark, spec, lake.run("3"), lake.ledgers, reprocess_doc={"20240601": {"feed": {"file_name": "ALL"}}})
    assert staged(lake, "id", "execution_cycle_id") == [("a2", "3"), ("b", "3"), ("late", "3")]
    with pytest.raises(NothingToIngest):
        ingest(spark, spec, lake.run("4"), lake.ledgers, reprocess_doc={"20240602": {"feed": {"file_name": "all"}}})
    reprocess.clean_cycle(staging_table(spark, spec), "20240601", "3")
    assert staged(lake, "id") == []


def test_reprocess_documents():
    plan = reprocess.plan_for({"d": {"x": {"file_name": [{"name": "", "prefix": ""}]}, "includes_skipped_files": "Y"}}, "d", "x")
    assert plan.empty
    plan = reprocess.plan_for({"d": {"x": {"file_name": [{"name": ["a", "b"], "prefix": "p/"}, "c"]}}}, "d", "x")
    assert plan.files == [("a", "p/"), ("b", "p/"), ("c", None)] and not plan.skipped_too
    plan = reprocess.plan_for({"d": {"x": {"file_name": ["a"]}, "includes_skipped_files": "Y"}}, "d", "x")
    assert plan.skipped_too
    assert reprocess.plan_for({"d": {"x": "full load"}}, "d", "x").empty


RULES = [
    quality.matches("num", "id", "^[0-9]+$", message="number"),
    quality.not_null("named", "name", criticality="non-critical"),
]


def gate_files(lake):
    lake.put("good.csv", "Id,Name\n1,x\n2,y\n")
    lake.put("mixed.csv", "Id,Name\n3,x\nbad,y\n")
    lake.put("bad.csv", "Id,Name\nno,x\n")
    lake.put("minor.csv", "Id,Name\n4,x\n5,\n")
    lake.put("empty.csv", "")


@pytest.mark.parametrize(
    "flags, expected",
    [
        ({}, {"good": (2, "Ingested"), "mixed": (2, "Ingested"), "bad": (0, "File Skipped"), "minor": (2, "Ingested")}),
        (
            {"write_valid": True},
            {"good": (2, "Ingested"), "mixed": (1, "Ingested Valid Data"), "bad": (0, "File Skipped"), "minor": (2, "Ingested")},
        ),
        (
            {"skip_file": True, "skip_on_non_critical": True, "drop_duplicates": True},
            {"good": (2, "Ingested"), "mixed": (0, "File Skipped"), "bad": (0, "File Skipped"), "minor": (0, "File Skipped")},
        ),
    ],
)
def test_gate_routes_files(lake, flags, expected):
    gate_files(lake)
    ingest(lake.spark, lake.spec(**flags), lake.run(), lake.ledgers, rules=RULES)
    got = {name[:-4]: (n, status) for _, name, n, status in statuses(lake)}
    assert got == {**expected, "empty": (0, "File Skipped")}
    landed_rows = staging_table(lake.spark, lake.spec()).read().groupBy("source_file_name").count().collect()
    assert {r.source_file_name[:-4]: r["count"] for r in landed_rows} == {k: n for k, (n, _) in expected.items() if n}
    report = quality.report(lake.ledgers.quality_log.read(), lake.ledgers.file_log.read(), "feed", "1").collect()
    assert [(r.file_name, r.qc_id) for r in report] == [
        (f, q) for f in ("bad.csv", "good.csv", "minor.csv", "mixed.csv") for q in ("named", "num")
    ]
    assert [r.error_percentage for r in report if r.file_name == "mixed.csv"] == ["0.0%", "50.0%"]


def test_post_load_checks(lake):
    lake.put("a.csv", "Id,Name\n1,x\nbad,y\n")
    ingest(lake.spark, lake.spec(), lake.run(), lake.ledgers, post_rules=RULES)
    log = {r.qc_id: (r.errored_record_count, r.qc_passed_flag, r.stage) for r in lake.ledgers.quality_log.read().collect()}
    assert log == {"num": (1, "N", "post_load"), "named": (0, "Y", "post_load")}
    lake.put("b.csv", "")
    with pytest.raises(NothingToIngest, match="skipped"):
        ingest(lake.spark, lake.spec(), lake.run("2"), lake.ledgers, post_rules=RULES)
    with pytest.raises(ValueError, match="no rules"):
        ingest(lake.spark, lake.spec(gated=True), lake.run("2"), lake.ledgers)


def test_full_load_with_archive(lake):
    spec = lake.spec(load_type="FULL", archive=True, archive_location=f"{lake.root}/arch")
    lake.put("a.csv", "Id\n1\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    lake.put("b.csv", "Id\n2\n")
    ingest(lake.spark, spec, lake.run("2", "20240602"), lake.ledgers)
    assert staged(lake, "id", "execution_cycle_id") == [("2", "2")]
    archived = lake.spark.read.parquet(f"{lake.root}/arch")
    assert [(r.id, r.source_file_name) for r in archived.collect()] == [("1", "a.csv")]


def test_inactive_dataset(lake):
    assert ingest(lake.spark, lake.spec(active=False), lake.run(), lake.ledgers) is None


def test_json_and_parquet_files(lake, spark):
    lake.put("a.json", '{"Doc": {"Id": 1, "Tags": [{"t": "x"}, {"t": "y"}]}}\n{"Doc": {"Id": 2, "Tags": []}}\n')
    spec = lake.spec(file_type="json", options={}, mask="*.json")
    ingest(spark, spec, lake.run(), lake.ledgers)
    assert sorted(staged(lake, "id", "tags_t"), key=repr) == [(1, "x"), (1, "y"), (2, None)]

    spark.createDataFrame([(1, "x")], "`A b` int, c string").coalesce(1).write.parquet(f"{lake.root}/one")
    spark.createDataFrame([(2,)], "`A b` int").coalesce(1).write.parquet(f"{lake.root}/two")
    for n, folder in ((1, "one"), (2, "two")):
        part = next(f for f in os.listdir(f"{lake.root}/{folder}") if f.endswith(".parquet"))
        os.makedirs(f"{lake.root}/pq", exist_ok=True)
        shutil.copy(f"{lake.root}/{folder}/{part}", f"{lake.root}/pq/f{n}.parquet")
    settings = {"file_type": "parquet", "options": {}, "target_table": "PQ", "target_location": f"{lake.root}/pq_staged"}
    spec = lake.spec(source_prefixes=f"{lake.root}/pq", dataset="pq", **settings)
    ingest(spark, spec, lake.run(), lake.ledgers)
    assert staged(lake, "a_b", spec=spec) == [(1,), (2,)]
    assert "c" not in staging_table(spark, spec).read().columns
    merged = replace(spec, dataset="pq2", target_table="PQ2", target_location=f"{lake.root}/pq2", schema_mode="merge")
    ingest(spark, merged, lake.run(), lake.ledgers)
    assert sorted(staged(lake, "a_b", "c", spec=merged), key=repr) == [(1, "x"), (2, None)]


def test_spec_documents(lake):
    document = {
        "dataset_name": "d",
        "load_type": "incremental",
        "active": "Y",
        "source_bucket": "RAW",
        "source_prefix": "in/feed/",
        "static_file_pattern": "N",
        "source_file_pattern": "",
        "file_type": "csv",
        "header": "true",
        "infer_schema": "",
        "escape": '"',
        "encoding": "",
        "multiline": "",
        "delimiter": "",
        "target_bucket": "CURATED",
        "target_prefix": "staging/d",
        "target_schema": "STAGING_SCHEMA",
        "target_table": "d_table",
        "archive": "N",
        "skip_file": "Y",
    }
    aliases = {"RAW": "s3a://raw/", "CURATED": "s3a://curated", "STAGING_SCHEMA": "stg"}
    spec = IngestSpec.from_document(document, aliases)
    assert spec.source_prefixes == "s3a://raw/in/feed" and spec.target_location == "s3a://curated/staging/d"
    assert (spec.target_schema, spec.target_table, spec.load_type) == ("stg", "D_TABLE", "INCREMENTAL")
    assert spec.options == {"escape": '"', "multiline": "true", "delimiter": ","} and spec.skip_file and spec.mask is None
    several = IngestSpec.from_document({**document, "source_prefix": ["a/", "/b"]}, aliases)
    assert several.source_prefixes == ["s3a://raw/a", "s3a://raw/b"]
    without = {k: v for k, v in document.items() if k != "multiline"}
    assert "multiline" not in IngestSpec.from_document(without, aliases).options
    nested = {**document, "file_type": "json", "schema_location_key": "s.json"}
    assert IngestSpec.from_document(nested, aliases, lambda key: {"a": "int"}).schema_doc is None
    assert IngestSpec.from_document({**nested, "infer_schema": "n"}, aliases, lambda key: {"a": "int"}).schema_doc == {"a": "int"}
    declared = {**document, "header": "false", "schema_location_key": "s.json"}
    assert IngestSpec.from_document(declared, aliases, lambda key: DOC).schema_doc == DOC
    for change, message in [
        ({"header": "false", "infer_schema": "Y"}, "header"),
        ({"header": None}, "header"),
        ({"infer_schema": "N"}, "schema_location_key"),
        ({"infer_schema": "N", "schema_location_key": "s.txt"}, "json"),
        ({"file_type": "txt"}, "delimiter"),
        ({"file_type": "xml"}, "xml"),
        ({"target_table": "x" * 81}, "80"),
        ({"source_prefix": []}, "source_prefix"),
    ]:
        with pytest.raises(ValueError, match=message):
            IngestSpec.from_document({**document, **change}, aliases, lambda key: DOC)


def test_process_publish_and_script(lake, spark):
    document = {
        "dataset_name": "mart",
        "active": "Y",
        "processed_location_bucket": "P",
        "processed_location_prefix": "mart/",
        "processed_schema": lake.schema,
        "processed_table": "mart",
        "publish_flag": "Y",
        "publish_location_bucket": "P",
        "publish_location_prefix": "pub/",
        "publish_schema": lake.schema,
        "publish_table": "pub",
        "archive": "Y",
        "archive_location_bucket": "P",
        "archive_location_prefix": "arch",
        "sql_script_path": f"{lake.root}/q.sql",
    }
    spec = ProcessSpec.from_document(document, {"P": lake.root})
    executions = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            executions.add(len(batch))
            yield batch

    source = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, Name string").mapInPandas(counted, "ID int, Name string")
    result = process(spark, spec, lake.run("1"), lake.ledgers, source)
    assert (result.processed_records, result.published_records) == (2, 2)
    assert executions.value == 2, "the plan behind a result runs once"
    assert processed_table(spark, spec).read().columns == ["id", "name", "execution_date", "execution_cycle_id"]
    storage.write_text(spark, f"{lake.root}/q.sql", "-- all\r\nSELECT 7 AS Id,\r\n 'x' AS Name;\n")
    process(spark, spec, lake.run("2"), lake.ledgers)
    assert [tuple(r) for r in publish_table(spark, spec).read().collect()] == [(7, "x", "20240601", "2")]
    assert processed_table(spark, spec).read().count() == 1, "older cycles went to the archive"
    assert spark.read.parquet(f"{lake.root}/arch").count() == 2
    log = lake.ledgers.process_log.read().orderBy("execution_cycle_id").collect()
    assert [(r.processed_table_record_count, r.publish_table_name) for r in log] == [(2, "pub"), (1, "pub")]
    assert process(spark, replace(spec, active=False), lake.run("3"), lake.ledgers) is None
    with pytest.raises(ValueError, match="neither"):
        process(spark, replace(spec, sql_script=None), lake.run("3"), lake.ledgers)
    with pytest.raises(ValueError, match="sql"):
        ProcessSpec.from_document({**document, "sql_script_path": "q.txt"}, {"P": lake.root})
    with pytest.raises(ValueError, match=".sql"):
        run_sql_script(spark, "q.txt")
    with pytest.raises(ValueError, match="blank"):
        run_sql(spark, " ;\n")


def test_stream_repeats_nothing(lake, spark, rows):
    from tidemark.operators.tables import STAGING_KEYS, LakeTable

    table = LakeTable(spark, lake.schema, "picked", f"{lake.root}/picked", STAGING_KEYS)
    schema = spark.createDataFrame([], "Id int, Name string").schema
    for n in (1, 2, 3):
        if n < 3:
            lake.put(f"f{n}.csv", f"{n},x\n")
        pick_up_available(spark, lake.src, "csv", schema, table, lake.run(str(n)), f"{lake.root}/ckpt")
    assert rows(table.read().where(F.col("execution_date") == "20240601"), "id", "source_file_name") == [
        (1, "f1.csv"),
        (2, "f2.csv"),
    ]


def stream_table(lake):
    from tidemark.operators.tables import STAGING_KEYS, LakeTable

    return LakeTable(lake.spark, lake.schema, "picked", f"{lake.root}/picked", STAGING_KEYS)


def test_stream_takes_old_files_and_many_batches(lake, spark, rows):
    import os

    table, schema = stream_table(lake), "Id int"
    schema = spark.createDataFrame([], schema).schema
    for n in range(5):
        lake.put(f"f{n}.csv", f"{n}\n")
    lake.put("sub/f0.csv", "50\n")
    pick_up_available(spark, lake.src, "csv", schema, table, lake.run("1"), f"{lake.root}/ckpt", max_files_per_batch=2)
    assert rows(table.read().where("execution_cycle_id = '1'"), "id") == [(0,), (1,), (2,), (3,), (4,), (50,)]
    old = lake.put("old.csv", "99\n")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    pick_up_available(spark, lake.src, "csv", schema, table, lake.run("2"), f"{lake.root}/ckpt", max_files_per_batch=2)
    assert rows(table.read().where("execution_cycle_id = '2'"), "id") == [(99,)]


def test_stream_failure_after_landing_repeats_nothing(lake, spark, rows, monkeypatch):
    from tidemark.streaming import pickup

    table, schema = stream_table(lake), spark.createDataFrame([], "Id int").schema
    for n in range(3):
        lake.put(f"f{n}.csv", f"{n}\n")
    plain = pickup.land_staged

    def fails(*args):
        plain(*args)
        raise RuntimeError("after landing")

    monkeypatch.setattr(pickup, "land_staged", fails)
    with pytest.raises(Exception, match="after landing"):
        pick_up_available(spark, lake.src, "csv", schema, table, lake.run("1"), f"{lake.root}/ckpt")
    monkeypatch.setattr(pickup, "land_staged", plain)
    lake.put("late.csv", "9\n")
    pick_up_available(spark, lake.src, "csv", schema, table, lake.run("2"), f"{lake.root}/ckpt")
    assert rows(table.read(), "id") == [(0,), (1,), (2,), (9,)]


def test_stream_and_ingest_share_a_ledger(lake, spark):
    spec = lake.spec(header=False, schema_doc=[{"column_name": "Id", "column_data_type": "int"}])
    table, schema = staging_table(spark, spec), spark.createDataFrame([], "Id int").schema
    lake.put("a.csv", "1\n")
    ingest(spark, spec, lake.run("1"), lake.ledgers)
    lake.put("b.csv", "2\n")
    share = {"ledgers": lake.ledgers, "dataset": spec.dataset}
    pick_up_available(spark, lake.src, "csv", schema, table, lake.run("2"), f"{lake.root}/ckpt", **share)
    assert staged(lake, "id", "execution_cycle_id") == [(1, "1"), (2, "2")]
    lake.put("c.csv", "3\n")
    ingest(spark, spec, lake.run("3"), lake.ledgers)
    assert staged(lake, "id", "execution_cycle_id") == [(1, "1"), (2, "2"), (3, "3")]


def test_same_name_in_one_cycle(lake, spark):
    """Two folders, one file name, two runs of one cycle: both stay, and the report tells them apart."""
    rules = [quality.not_null("n", "id")]
    spec = lake.spec(source_prefixes=[f"{lake.src}/a", f"{lake.src}/b"])
    lake.put("a/x.csv", "Id\n1\n2\n3\n")
    lake.put("b/other.csv", "Id\n8\n")
    ingest(spark, spec, lake.run("1"), lake.ledgers, rules=rules)
    lake.put("b/x.csv", "Id\n9\n")
    ingest(spark, spec, lake.run("1"), lake.ledgers, rules=rules)
    assert [r[0] for r in staged(lake, "id")] == ["1", "2", "3", "8", "9"]
    found = quality.report(lake.ledgers.quality_log.read(), lake.ledgers.file_log.read(), "feed", "1").collect()
    assert sorted((r.file_name, r.record_count, r.total_record_count) for r in found) == [
        ("other.csv", 1, 1),
        ("x.csv", 1, 1),
        ("x.csv", 3, 3),
    ]


def test_failed_reprocess_keeps_old_rows(lake, spark, monkeypatch):
    from tidemark.operators.tables import LakeTable

    spec = lake.spec(source_prefixes=[f"{lake.src}/a", f"{lake.src}/b"], skip_file=True)
    for folder in "ab":
        lake.put(f"{folder}/x.csv", f"Id\n{folder}1\n")
    rules = [quality.matches("m", "id", "^[ab]")]
    ingest(spark, spec, lake.run("1"), lake.ledgers, rules=rules)
    force = {"20240601": {"feed": {"file_name": [{"name": "x.csv", "prefix": f"{lake.src}/a"}]}}}
    before = [("a1", "1"), ("b1", "1")]
    with monkeypatch.context() as patch:
        patch.setattr(LakeTable, "land", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest(spark, spec, lake.run("2"), lake.ledgers, rules=rules, reprocess_doc=force)
    assert staged(lake, "id", "execution_cycle_id") == before
    lake.put("a/x.csv", "Id\n?\n")
    ingest(spark, spec, lake.run("3"), lake.ledgers, rules=rules, reprocess_doc=force)
    assert staged(lake, "id", "execution_cycle_id") == before
    lake.put("a/x.csv", "Id\na2\n")
    ingest(spark, spec, lake.run("4"), lake.ledgers, rules=rules, reprocess_doc=force)
    assert staged(lake, "id", "execution_cycle_id") == [("a2", "4"), ("b1", "1")]


def test_full_load_without_rows_keeps_the_table(lake):
    spec = lake.spec(load_type="FULL", archive=True, archive_location=f"{lake.root}/arch", skip_file=True)
    rules = [quality.matches("m", "id", "^[0-9]+$")]
    lake.put("a.csv", "Id\n1\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers, rules=rules)
    with pytest.raises(NothingToIngest):
        ingest(lake.spark, spec, lake.run("2"), lake.ledgers, rules=rules)
    lake.put("b.csv", "Id\nbad\n")
    assert ingest(lake.spark, spec, lake.run("3"), lake.ledgers, rules=rules).skipped_files == 1
    assert staged(lake, "id", "execution_cycle_id") == [("1", "1")]


def test_audit_names_are_refused(lake):
    lake.put("a.csv", "Id,Processed Time\n1,2\n")
    with pytest.raises(ValueError, match="processed_time"):
        ingest(lake.spark, lake.spec(), lake.run("1"), lake.ledgers)
    lake.put("p/x.csv", "Source_File_Location\n1\n")
    with pytest.raises(ValueError, match="source_file_location"):
        ingest(lake.spark, lake.spec(source_prefixes=f"{lake.src}/p"), lake.run("1"), lake.ledgers)


def test_header_with_escaped_quote(lake):
    lake.put("a.csv", '"size 5\\" wide",Id\n1,2\n"3",4\n')
    spec = lake.spec(options={"delimiter": ",", "multiline": "true", "escape": "\\"})
    assert ingest(lake.spark, spec, lake.run("1"), lake.ledgers).record_count == 2


def test_runs_of_one_cycle_log_side_by_side(lake, spark):
    from concurrent.futures import ThreadPoolExecutor


    log = lake.ledgers.process_log
    log.register(ledger.PROCESS_LOG)

    def write(n):
        ledger.write(log, ledger.PROCESS_LOG, ledger.one_row(spark, table_name=str(n)), lake.run("1").partition("d"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(6)))
    assert sorted(r.table_name for r in log.read().collect()) == [str(n) for n in range(6)]


def test_duplicates_with_maps(spark):
    from tidemark.operators.shape import dedup_within_file

    df = spark.sql("SELECT * FROM VALUES (1, map('a', 1, 'b', 2)), (1, map('b', 2, 'a', 1)), (1, map('a', 2)), (1, NULL) AS t(id, m)")
    assert dedup_within_file(df).count() == 3 and dedup_within_file(df).columns == ["id", "m"]


def test_jobs_do_not_grow_with_files(lake, spark):
    def jobs(dataset, count):
        for n in range(count):
            lake.put(f"{dataset}/f{n}.csv", f"Id\n{n}\n")
        spec = lake.spec(
            dataset=dataset,
            source_prefixes=f"{lake.src}/{dataset}",
            target_table=dataset,
            target_location=f"{lake.root}/{dataset}",
        )
        spark.sparkContext.setJobGroup(f"{lake.schema}-{dataset}", dataset)
        try:
            assert ingest(spark, spec, lake.run(), lake.ledgers).record_count == count
        finally:
            spark.sparkContext.setJobGroup("other", "other")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{lake.schema}-{dataset}"))

    jobs("warm", 1)  # creates the ledgers
    # Spark lists more than 32 paths in a job of its own, whatever their number.
    assert jobs("many", 60) <= jobs("few", 3) + 3


def test_repeated_cycle_of_a_history_job(lake, spark):
    from tidemark.operators import incremental
    from tidemark.operators.tables import CYCLE_KEYS

    spec = ProcessSpec("h", True, lake.schema, "h", f"{lake.root}/h")
    for n in (1, 2, 2):
        name = f"{lake.schema}.h"
        staged_rows = spark.createDataFrame([(n,)], "n int")
        if processed_table(spark, spec).exists():
            history = incremental.previous_history(spark, name, CYCLE_KEYS)
            staged_rows = history.unionByName(staged_rows).distinct()
        process(spark, spec, lake.run(str(n)), lake.ledgers, staged_rows)
    newest = incremental.previous_history(spark, f"{lake.schema}.h", CYCLE_KEYS)
    assert sorted(r.n for r in newest.collect()) == [1, 2]


def test_files_without_rows_do_not_change_the_table(lake):
    lake.put("a.csv", "Id,Name\n1,x\n")
    lake.put("z.csv", "Other\n")
    ingest(lake.spark, lake.spec(), lake.run("1"), lake.ledgers)
    assert staged(lake, "id", "name") == [("1", "x")]
    lake.put("zz.csv", "Another\n")
    ingest(lake.spark, lake.spec(), lake.run("2"), lake.ledgers)
    assert staged(lake, "id", "name") == [("1", "x")]
    lake.put("e.json", "")
    spec = lake.spec(dataset="j", file_type="json", mask="*.json", options={})
    assert ingest(lake.spark, spec, lake.run("3"), lake.ledgers).skipped_files == 1
    assert staged(lake, "id", "name") == [("1", "x")]


def test_skipped_files_do_not_change_the_table(lake):
    lake.put("a.csv", "Id,Name\n1,x\n")
    lake.put("b.csv", "Id,Name,More\nbad,x,y\n")
    rules = [quality.matches("num", "id", "^[0-9]+$")]
    ingest(lake.spark, lake.spec(skip_file=True), lake.run("1"), lake.ledgers, rules=rules)
    assert staged(lake, "id", "name") == [("1", "x")]
    assert "more" not in staging_table(lake.spark, lake.spec()).read().columns
    # Rules see columns that only older headers have; the newest kept header decides the table.
    lake.put("c.csv", "Id,Name\n2,y\n")
    lake.put("d.csv", "Id\n3\n")
    rules.append(quality.not_null("named", "name", criticality="non-critical"))
    ingest(lake.spark, lake.spec(write_valid=True), lake.run("2"), lake.ledgers, rules=rules)
    assert staged(lake, "id", "source_file_name") == [("1", "a.csv"), ("2", "c.csv")]
    assert [s for s in statuses(lake) if s[0] == "2"] == [("2", "c.csv", 1, "Ingested"), ("2", "d.csv", 0, "File Skipped")]


def test_gate_on_nested_files(lake):
    lake.put("a.json", '{"id": 1, "lines": [{"n": 5}, {"n": 6}]}\n')
    lake.put("b.json", '{"id": 2, "lines": [{"n": -1}, {"n": 7}]}\n')
    lake.put("c.json", '{"id": 3, "lines": [{"n": -1}]}\n')
    spec = lake.spec(file_type="json", mask="*.json", options={}, write_valid=True)
    rules = [quality.in_range("r", "n", 0, 9)]
    ingest(lake.spark, spec, lake.run(), lake.ledgers, rules=rules)
    assert staged(lake, "id", "n", spec=spec) == [(1, 5), (1, 6), (2, 7)]
    assert [s[1:] for s in statuses(lake)] == [
        ("a.json", 2, "Ingested"),
        ("b.json", 1, "Ingested Valid Data"),
        ("c.json", 0, "File Skipped"),
    ]


def test_gate_with_unique_rule_and_duplicates(lake):
    lake.put("a.csv", "Id,Name\n1,x\n1,x\n2,y\n2,z\n")
    lake.put("b.csv", "Id,Name\n1,x\n")
    rules = [quality.unique("u", "id", threshold=70)]
    spec = lake.spec(drop_duplicates=True)
    assert ingest(lake.spark, spec, lake.run(), lake.ledgers, rules=rules).record_count == 4
    log = {r.pre_ingestion_dqm_file: r.errored_record_count for r in lake.ledgers.quality_log.read().collect()}
    assert log == {"a.csv": 2, "b.csv": 0}


def test_datasets_of_one_cycle_side_by_side(lake):
    from concurrent.futures import ThreadPoolExecutor

    names = [f"side{n}" for n in range(6)]
    for name in names:
        lake.put(f"{name}/a.csv", f"Id\n{name}\n")
    lake.put("first/a.csv", "Id\n0\n")

    def load(name):
        spec = lake.spec(
            dataset=name, source_prefixes=f"{lake.src}/{name}", target_table=name, target_location=f"{lake.root}/{name}"
        )
        return ingest(lake.spark, spec, lake.run(), lake.ledgers).record_count

    load("first")
    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(load, names)) == [1] * 6
    for log in (lake.ledgers.file_log, lake.ledgers.ingestion_log):
        assert sorted(r.dataset_name for r in log.read().collect()) == sorted([*names, "first"])


def test_one_big_file_is_read_by_many_tasks(lake, spark):
    lake.put("big.csv", "Id,Name\n" + "".join(f"{i},name {i}\n" for i in range(40_000)))
    lake.put("small.csv", "Id,Name\n-1,x\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        paths = storage.leaf_files(spark, lake.src)
        assert delimited.read_header_strings(spark, paths).rdd.getNumPartitions() > 5
        assert ingest(spark, lake.spec(), lake.run(), lake.ledgers).record_count == 40_001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    folder = f"{lake.root}/staged/execution_date=20240601/execution_cycle_id=1/source_file_name=big.csv"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 5, "each task wrote what it read"
