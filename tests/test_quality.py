import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q


def totals(spark, valid, failed, critical):
    return spark.createDataFrame(
        [("f", valid, failed, critical)],
        "gated_file string, valid_records long, failed_checks int, critical_failed_checks int",
    )


@pytest.mark.parametrize(
    "valid, failed, critical, flags, status",
    [
        (5, 0, 0, {}, q.INGESTED),
        (0, 1, 0, {}, q.SKIPPED),
        (5, 1, 1, {}, q.INGESTED),
        (5, 1, 1, {"skip_file": True}, q.SKIPPED),
        (5, 1, 0, {"skip_file": True}, q.INGESTED),
        (5, 1, 0, {"skip_file": True, "skip_on_non_critical": True}, q.SKIPPED),
        (5, 1, 0, {"skip_on_non_critical": True}, q.INGESTED),
        (5, 1, 1, {"write_valid": True}, q.INGESTED_VALID),
        (5, 1, 0, {"write_valid": True}, q.INGESTED),
        (5, 1, 1, {"write_valid": True, "skip_file": True}, q.SKIPPED),
        (0, 1, 1, {"write_valid": True}, q.SKIPPED),
    ],
)
def test_gate_truth_table(spark, valid, failed, critical, flags, status):
    assert q.route(totals(spark, valid, failed, critical), **flags).first().ingestion_status == status


RULES = q.rules_from_document(
    [
        {"qc_id": "a", "kind": "not_null", "column": "s", "threshold": 50},
        {"qc_id": "b", "kind": "in_range", "column": "n", "low": 0, "high": 9, "criticality": "non-critical"},
        {"qc_id": "c", "kind": "unique", "columns": ["k"]},
        {"qc_id": "d", "kind": "matches", "column": "s", "regex": "^[a-z'\\\\]+$", "threshold": 100},
        {"qc_id": "e", "kind": "in_list", "column": "s", "values": ["x", "it's"], "threshold": 100},
        {"qc_id": "f", "kind": "expression", "condition": "n + k > 0", "threshold": 100},
    ]
)
DATA = [("x", 1, 1, "f1"), (None, 2, 2, "f1"), ("it's", 99, 3, "f2"), ("x", 1, 7, "f2"), ("y", 1, 7, "f2"), ("x", 1, None, "f2")]


def frame(spark):
    return spark.createDataFrame(DATA, "s string, n int, k int, file string")


def test_totals_and_log(spark, rows):
    flagged = q.flag_failures(frame(spark), RULES, "file")
    got = q.rule_totals(flagged, RULES, "file")
    assert rows(got, "gated_file", "total_records", "valid_records", "failed_checks", "critical_failed_checks") == [
        ("f1", 2, 1, 0, 0),
        ("f2", 4, 0, 2, 1),
    ]
    log = q.quality_log(got, RULES, "ds", "c1", F.col("gated_file"))
    assert log.columns == [c.split()[0] for c in q.QUALITY_LOG.split(", ")]
    assert rows(log.where("qc_id IN ('b', 'c')"), "pre_ingestion_dqm_file", "qc_id", "errored_record_count", "error_percentage", "qc_passed_flag") == [
        ("f1", "b", 0, 0.0, "Y"),
        ("f1", "c", 0, 0.0, "Y"),
        ("f2", "b", 1, 25.0, "N"),
        ("f2", "c", 2, 50.0, "N"),
    ]


def test_admitted_rows(spark, rows):
    rules = [q.not_null("a", "s")]
    flagged = q.flag_failures(frame(spark), rules, "file")
    verdicts = q.route(q.rule_totals(flagged, rules, "file"), write_valid=True)
    assert q.admitted(flagged, verdicts, "file").count() == 5
    assert q.admitted(flagged, verdicts, "file").columns == ["s", "n", "k", "file"]
    skipping = q.route(q.rule_totals(flagged, rules, "file"), skip_file=True)
    assert rows(q.admitted(flagged, skipping, "file").select("file").distinct()) == [("f2",)]


def test_unique_rule_with_one_hot_key(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), F.lit("f").alias("file"))
    rules = [q.unique("u", "k")]
    for hot_rows in (2, 1000, 10**6):
        flagged = q.flag_failures(hot, rules, "file", salts=7, hot_rows=hot_rows)
        row = q.rule_totals(flagged, rules, "file").first()
        assert (row.total_records, row.valid_records) == (3000, 2000)
        assert flagged.columns == ["k", "file", q.FAILED]


def test_unknown_rule_kind():
    with pytest.raises(ValueError, match="odd"):
        q.rules_from_document([{"qc_id": "z", "kind": "odd"}])


def test_report_formats(spark):
    log = spark.createDataFrame(
        [("ds", "1", "critical", "f", 4, 4, 0, "m", None, None, "Y", "c"), ("ds", "2", "critical", "g", 4, 3, 1, "m", 25.0, 5.0, "N", "c")],
        q.QUALITY_LOG,
    )
    files = spark.createDataFrame(
        [("ds", "f", 4, "s", "e", "Ingested", "c"), ("ds", "g", 9, "s", "e", "Ingested", "other cycle")],
        "dataset_name string, file_name string, record_count long, execution_start_time string, "
        "execution_end_time string, ingestion_status string, execution_cycle_id string",
    )
    got = q.report(log, files, "ds", "c").collect()
    assert [(r.file_name, r.qc_id, r.threshold, r.error_percentage, r.record_count) for r in got] == [
        (None, "2", "5.0%", "25.0%", None),
        ("f", "1", "", "0%", 4),
    ]
