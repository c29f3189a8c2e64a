"""Registered queries, each with the SQL that gives the same answer where SQL can."""

from tidemark.workloads import history, runs, sources, tables  # noqa: F401  (they register)
from tidemark.workloads.bench import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
