"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from tools import check_oracle
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR).startswith(("ok", "rows-only"))


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_oracle_is_sql_for_every_kind_of_query():
    assert all(isinstance(sql, str) for sql in contract.oracle_sql().values())
    assert set(check_oracle.QUERIES) == set(contract.queries()) and check_oracle.ORACLE == contract.oracle_sql()


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_parts_can_be_left_out(tmp_path, left_out):
    """A copy without the language-model folders, with or without the pipeline, imports and keeps its other queries."""
    home, copy = os.path.dirname(os.path.abspath(contract.__file__)), str(tmp_path / "copy")
    shutil.copytree(home, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
    say = "import __spark_entry__ as c; print(*sorted(c.queries()))"
    done = subprocess.run([sys.executable, "-c", say], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    kept = set(done.stdout.split())
    gone = set(contract.queries()) - kept
    assert "ingest_end_to_end" in kept and "pipeline" in gone
    assert all(q == "pipeline" or q.startswith("op") for q in gone) and (len(gone) > 1) == ("llm" in left_out)
