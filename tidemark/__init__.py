"""Tidemark: configuration-driven lake loading on plain PySpark."""

import sys

from pyspark import cloudpickle

from tidemark.plans.ingest import ingest
from tidemark.plans.process import process
from tidemark.plans.spec import IngestSpec, ProcessSpec, RunContext

__all__ = ["IngestSpec", "ProcessSpec", "RunContext", "ingest", "process"]

# The few functions that run in Python workers travel with their code, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
