"""Listing, heads of files and copies that tasks make."""

import bz2
import gzip
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.tables import LakeTable
from tidemark.plans.ingest import pending_files
from tidemark.sources import delimited, listing, storage, tasks


def jobs_of(spark, run):
    """Result and number of Spark jobs of a call."""
    context, group = spark.sparkContext, f"count-{id(run)}"
    context.setJobGroup(group, group)
    try:
        result = run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return result, len(context.statusTracker().getJobIdsForGroup(group))


def names(rows):
    return sorted(r.source_path.rsplit("/src/", 1)[1] for r in rows.collect())


def test_listing_has_empty_files_and_no_hidden_ones(lake):
    for name in ("a.csv", "x/b c+%41.csv", "x/y/z/ü.csv", "_hidden.csv", "x/.part.csv", "_temporary/c.csv", ".tmp/d.csv"):
        lake.put(name, "Id\n1\n")
    lake.put("empty.csv", "")
    os.makedirs(f"{lake.src}/no_files")
    found = listing.source_files(lake.spark, lake.src)
    assert names(found) == ["a.csv", "empty.csv", "x/b c+%41.csv", "x/y/z/ü.csv"]
    assert sorted(r.source_path for r in found.collect()) == storage.leaf_files(lake.spark, lake.src)
    # Prefixes within each other give a file once.
    assert listing.source_files(lake.spark, [lake.src, f"{lake.src}/x"]).count() == 4
    with pytest.raises(FileNotFoundError, match="no_files"):
        listing.source_files(lake.spark, [lake.src, f"{lake.src}/no_files"])


def test_large_trees_are_listed_in_rounds(lake, monkeypatch):
    for n in range(40):
        lake.put(f"d{n % 5}/e{n % 10}/f{n}.csv", "")
    small, few = jobs_of(lake.spark, lambda: listing.source_files(lake.spark, lake.src))
    monkeypatch.setattr(tasks, "ENTRIES", 3)
    large, many = jobs_of(lake.spark, lambda: listing.source_files(lake.spark, lake.src))
    assert names(small) == names(large) and small.count() == 40
    assert few < many


def test_pending_files_of_real_folders(lake):
    """Only what is pending reaches Python: a blank mask takes all names, a static file is taken whatever the ledger says."""
    lake.put("a.csv", "Id\n1\n")
    lake.put("s/b.csv", "")
    log, run = lake.ledgers.file_log, lake.run("1")
    assert names(pending_files(lake.spark, lake.spec(mask=""), run, log)) == ["a.csv", "s/b.csv"]
    static = lake.spec(static_file=True, mask="a.csv")
    assert names(pending_files(lake.spark, static, run, log)) == ["a.csv"]


HEADS = [
    ("a.csv", "Id,Name\n1,x\n"),
    ("b.csv", "\n  \nId,Name\r\n1,x\r\n"),
    ("c.csv", 'Id,"Na\nme"\n1,x\n'),
    ("e.csv", ""),
    ("f.csv", " \n\n"),
    ("g.csv", "Id,Name"),
]


def test_files_are_grouped_by_header_in_one_job(lake):
    for name, text in HEADS:
        lake.put(name, text)
    with gzip.open(lake.put("h.csv.gz", ""), "wt") as file:
        file.write("Id,Name\n7,z\n")
    with bz2.open(lake.put("i.csv.bz2", ""), "wt") as file:
        file.write("Other\n7\n")
    paths = storage.leaf_files(lake.spark, lake.src)

    def grouped(multiline):
        found = tasks.header_paths(lake.spark, paths, "UTF-8", multiline, '"', "\\")
        return sorted([p.rsplit("/", 1)[1] for p in group] for group in found)

    plain, jobs = jobs_of(lake.spark, lambda: grouped(False))
    assert plain == [["a.csv", "b.csv", "g.csv", "h.csv.gz"], ["c.csv"], ["i.csv.bz2"]]
    assert grouped(True) == plain
    for n in range(60):
        lake.put(f"more{n}.csv", "Id,Name\n")
    paths = storage.leaf_files(lake.spark, lake.src)
    assert jobs_of(lake.spark, lambda: grouped(False))[1] == jobs


def test_multiline_header_is_one_record(lake):
    lake.put("a.csv", 'Id,"Na\nme"\n1,x\n')
    lake.put("b.csv", 'Id,"Na\nother"\n2,y\n')
    options = {"multiline": "true"}
    groups = delimited.header_groups(lake.spark, [f"{lake.src}/a.csv", f"{lake.src}/b.csv"], options)
    assert [columns for columns, _ in groups] == [["Id", "Na\nme"], ["Id", "Na\nother"]]
    assert [paths for _, paths in groups] == [[f"{lake.src}/a.csv"], [f"{lake.src}/b.csv"]]


def test_encodings_of_heads(lake):
    for name, text in (("a.csv", "Größe\n1\n"), ("b.csv", "Grösse\n1\n")):
        with open(lake.put(name, ""), "w", encoding="iso-8859-1") as file:
            file.write(text)
    rows = delimited.read_header_strings(lake.spark, [f"{lake.src}/a.csv", f"{lake.src}/b.csv"], {"encoding": "ISO-8859-1"}, "merge")
    assert rows.count() == 2 and len(rows.columns) == 3




def test_moves_between_file_systems_are_copied_by_tasks(lake, monkeypatch):
    """An archive in another file system: tasks copy, sizes are compared, sources go at the end."""
    table = LakeTable(lake.spark, lake.schema, "hist", f"{lake.root}/hist")
    rows = lake.spark.range(90).select(
        "id", F.lit("20240601").alias("execution_date"), (F.col("id") % 3).cast("string").alias("execution_cycle_id")
    )
    table.register(rows.select("id").schema)
    table.land(rows)
    monkeypatch.setattr(storage, "_same_system", lambda *_: False)
    assert table.archive("2", f"{lake.root}/archive") == 2
    old = lake.spark.read.parquet(f"{lake.root}/archive")
    assert old.count() == 60 and table.read().count() == 30
    assert not os.path.exists(f"{lake.root}/hist/execution_date=20240601/execution_cycle_id=0")
    # The archive has the cycle already: its partitions are replaced.
    table.land(rows.where("execution_cycle_id = '1'").limit(5))
    assert table.archive("2", f"{lake.root}/archive") == 1
    assert lake.spark.read.parquet(f"{lake.root}/archive").count() == 35


def test_a_failed_copy_removes_nothing(lake):
    lake.put("a.txt", "some text")
    with pytest.raises(Exception, match="missing"):
        tasks.copy_folders(lake.spark, [(f"file:{lake.src}/a.txt", f"file:{lake.root}/to/a.txt"), (f"file:{lake.src}/missing", f"file:{lake.root}/to/b")])
    assert os.path.exists(f"{lake.src}/a.txt")
    done = tasks.copy_folders(lake.spark, [(f"file:{lake.src}", f"file:{lake.root}/to")])
    assert done == 9 and open(f"{lake.root}/to/a.txt").read() == "some text"


def test_paths_that_tasks_can_open():
    assert tasks.reachable(["file:/a", "s3a://b/c", "hdfs://n/d"]) and not tasks.reachable(["file:/a", "viewfs://x/y"])
    assert tasks.opened("file:/a/b")[1] == tasks.opened("file:///a/b")[1] == "/a/b"
