"""Runs that break off at any point, and the run that follows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import ingest as plan
from tidemark.plans import intent as intents
from tidemark.plans.ingest import NothingToIngest, ingest, land_staged, landed_counts, staging_table
from tidemark.streaming.pickup import pick_up_available


class Crash(RuntimeError):
    pass


def staged(lake, spec):
    rows = staging_table(lake.spark, spec).read().select("id", "source_file_name", "execution_cycle_id")
    return sorted(tuple(r) for r in rows.collect())


def logged(lake):
    log = lake.ledgers.file_log.read().select("file_name", "execution_cycle_id", "record_count", "ingestion_status")
    return sorted(tuple(r) for r in log.collect())


def left_open(lake):
    return glob.glob(f"{lake.root}/logs/open_runs_*/*/*")


def crash_at(monkeypatch, step, after):
    """Make a step of the run fail, before it does anything or when it is done."""
    plain = getattr(plan, step)

    def fails(*args, **kwargs):
        if after:
            plain(*args, **kwargs)
        raise Crash(step)

    monkeypatch.setattr(plan, step, fails)
    return lambda: monkeypatch.setattr(plan, step, plain)


STEPS = [("land_staged", False), ("land_staged", True), ("_replace_forced", True), ("_log_files", True), ("_log_run", True)]


@pytest.mark.parametrize(("step", "after"), STEPS)
@pytest.mark.parametrize("cycle", ["1", "2"])
def test_each_row_once_after_a_crash(lake, monkeypatch, step, after, cycle):
    """The run after a broken one, in its cycle or another: each row and each ledger entry is there once."""
    spec, rules = lake.spec(), [quality.not_null("q", "id", message="id")]
    lake.put("a.csv", "Id\n1\n2\n")
    lake.put("b.csv", "Id\n3\n")
    mend = crash_at(monkeypatch, step, after)
    with pytest.raises(Crash):
        ingest(lake.spark, spec, lake.run("1"), lake.ledgers, rules=rules)
    mend()
    lake.put("c.csv", "Id\n4\n")
    had_landed = step != "land_staged"
    assert ingest(lake.spark, spec, lake.run(cycle), lake.ledgers, rules=rules).record_count == (1 if had_landed else 4)
    first = "1" if had_landed else cycle
    assert staged(lake, spec) == [("1", "a.csv", first), ("2", "a.csv", first), ("3", "b.csv", first), ("4", "c.csv", cycle)]
    assert logged(lake) == [("a.csv", first, 2, "Ingested"), ("b.csv", first, 1, "Ingested"), ("c.csv", cycle, 1, "Ingested")]
    assert lake.ledgers.ingestion_log.read().count() == (2 if had_landed else 1)
    checks = lake.ledgers.quality_log.read().groupBy("pre_ingestion_dqm_file", "qc_id").count()
    assert checks.where("count > 1").count() == 0 and checks.count() == 3
    assert left_open(lake) == []
    with pytest.raises(NothingToIngest):
        ingest(lake.spark, spec, lake.run("9"), lake.ledgers, rules=rules)


def test_a_finished_run_is_reported_where_nothing_is_new(lake, monkeypatch):
    spec = lake.spec()
    lake.put("a.csv", "Id\n1\n")
    mend = crash_at(monkeypatch, "_log_files", False)
    with pytest.raises(Crash):
        ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    mend()
    assert ingest(lake.spark, spec, lake.run("2"), lake.ledgers).record_count == 1
    assert logged(lake) == [("a.csv", "1", 1, "Ingested")]


def test_crash_of_a_forced_reload_keeps_one_copy(lake, monkeypatch):
    """Old rows of a forced file go once, though the run that follows knows of no reprocess document."""
    spec = lake.spec()
    lake.put("a.csv", "Id\n1\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    document = {"20240601": {"feed": {"file_name": ["a.csv"]}}}
    for cycle, (step, after) in enumerate((("land_staged", True), ("_replace_forced", False)), 2):
        lake.put("a.csv", f"Id\n{cycle}\n")
        mend = crash_at(monkeypatch, step, after)
        with pytest.raises(Crash):
            ingest(lake.spark, spec, lake.run(str(cycle)), lake.ledgers, reprocess_doc=document)
        mend()
        ingest(lake.spark, spec, lake.run(f"{cycle}5"), lake.ledgers)
        assert staged(lake, spec) == [(str(cycle), "a.csv", "25" if cycle == 2 else "3")]


def test_rows_of_other_files_survive_a_broken_landing(lake, monkeypatch):
    """A landing that broke off has left a partition outside the catalog and lost one that it was replacing."""
    spec = lake.spec(source_prefixes=[f"{lake.src}/x", f"{lake.src}/y"])
    lake.put("x/a.csv", "Id\n1\n")
    lake.put("y/b.csv", "Id\n2\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    lake.put("y/a.csv", "Id\n3\n")
    lake.put("y/new.csv", "Id\n4\n")
    plain = plan.land_staged

    def breaks(table, rows, run, paths):
        plain(table, rows, run, paths)
        table.spark.sql(f"ALTER TABLE {table.name} DROP PARTITION (execution_date='20240601', execution_cycle_id='1', source_file_name='new.csv')")
        for file in glob.glob(f"{lake.root}/staged/*/*/source_file_name=a.csv/*"):
            os.remove(file)
        raise Crash

    monkeypatch.setattr(plan, "land_staged", breaks)
    with pytest.raises(Crash):
        ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    monkeypatch.setattr(plan, "land_staged", plain)
    ingest(lake.spark, spec, lake.run("2"), lake.ledgers)
    staging_table(lake.spark, spec).repair()
    assert staged(lake, spec) == [("1", "a.csv", "2"), ("2", "b.csv", "1"), ("3", "a.csv", "2"), ("4", "new.csv", "2")]


def test_a_full_load_that_broke_off_is_archived_by_the_next_run(lake, monkeypatch):
    spec = lake.spec(load_type="FULL", archive=True, archive_location=f"{lake.root}/archive")
    lake.put("a.csv", "Id\n1\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    lake.put("b.csv", "Id\n2\n")
    mend = crash_at(monkeypatch, "_log_run", False)
    with pytest.raises(Crash):
        ingest(lake.spark, spec, lake.run("2"), lake.ledgers)
    mend()
    ingest(lake.spark, spec, lake.run("3"), lake.ledgers)
    assert staged(lake, spec) == [("2", "b.csv", "2")]
    assert os.listdir(f"{lake.root}/archive/execution_date=20240601") == ["execution_cycle_id=1"]


def test_an_intent_without_its_document_says_nothing(lake):
    spec = lake.spec()
    lake.put("a.csv", "Id\n1\n")
    intent = intents.open_intent(lake.ledgers, "feed", lake.run("1"), "now", [f"{lake.src}/a.csv"], intents.REPLACE_ALL)
    os.remove(f"{intent.folder}/intent.json")
    assert ingest(lake.spark, spec, lake.run("2"), lake.ledgers).record_count == 1
    assert left_open(lake) == []


def spoil(lake, name):
    """Make the landed rows of a file unreadable."""
    for path in glob.glob(f"{lake.root}/staged/*/*/source_file_name={name}/*.parquet"):
        with open(path, "wb") as file:
            file.write(b"no parquet")
        for check in glob.glob(os.path.join(os.path.dirname(path), ".*.crc")):
            os.remove(check)


def test_a_landing_reads_partitions_of_its_own_files_only(lake):
    spec = lake.spec()
    table = staging_table(lake.spark, spec)
    lake.put("a.csv", "Id\n1\n")
    lake.put("b.csv", "Id\n2\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    spoil(lake, "a.csv")
    lake.put("c.csv", "Id\n3\n")
    # Rows and counts of a second run of the cycle, which would fail on the first one's file.
    assert ingest(lake.spark, spec, lake.run("1"), lake.ledgers).record_count == 1
    counts = landed_counts(table, lake.run("1"), [f"file:{lake.src}/c.csv", f"file:{lake.src}/b.csv"])
    assert sorted(r.record_count for r in counts.collect()) == [1, 1]
    with pytest.raises(Exception, match="a.csv"):
        table.read().collect()


def test_a_stream_batch_reads_partitions_of_its_own_files_only(lake):
    spec, schema = lake.spec(), lake.spark.createDataFrame([], "id string").schema
    table = staging_table(lake.spark, spec)
    for n, name in enumerate(("a.csv", "b.csv"), 1):
        lake.put(name, f"{n}\n")
        pick_up_available(
            lake.spark, lake.src, "csv", schema, table, lake.run("1"), f"{lake.root}/checkpoint",
            ledgers=lake.ledgers, dataset="feed",
        )
        spoil(lake, name)
    assert [row[:2] for row in logged(lake)] == [("a.csv", "1"), ("b.csv", "1")]


def test_very_many_names_become_a_join(lake, monkeypatch):
    from tidemark.operators import tables

    spec = lake.spec()
    for n in range(4):
        lake.put(f"it's {n}.csv", f"Id\n{n}\n")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    table, paths = staging_table(lake.spark, spec), [f"{lake.src}/it's {n}.csv" for n in (1, 3)]
    few = landed_counts(table, lake.run("1"), paths)
    monkeypatch.setattr(tables, "CONSTANTS", 1)
    many = landed_counts(table, lake.run("1"), paths)
    assert few.count() == many.count() == 2 and landed_counts(table, lake.run("1"), []).count() == 0


def test_landing_keeps_rows_of_the_same_name_in_other_folders(lake):
    spec = lake.spec(source_prefixes=[f"{lake.src}/x", f"{lake.src}/y"])
    table = staging_table(lake.spark, spec)
    lake.put("x/a.csv", "Id\n1\n")
    lake.put("y/other.csv", "")
    ingest(lake.spark, spec, lake.run("1"), lake.ledgers)
    rows = table.read().select("id", F.lit("file:/other/a.csv").alias("source_file_location"))
    land_staged(table, rows, lake.run("1"), ["file:/other/a.csv"])
    land_staged(table, rows.limit(1), lake.run("1"), ["file:/other/a.csv"])
    assert table.read().count() == 2
