from __future__ import annotations

import os
import sys
import uuid
from dataclasses import dataclass, field

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.operators.ledger import Ledgers  # noqa: E402
from tidemark.plans.spec import IngestSpec, RunContext  # noqa: E402
from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tidemark-tests", cores=4)
    yield session
    session.stop()


@dataclass
class Lake:
    """A schema and a folder of its own, with a source folder to drop files into."""

    spark: object
    root: str
    schema: str = field(default_factory=lambda: f"t_{uuid.uuid4().hex[:10]}")

    def __post_init__(self):
        self.src = os.path.join(self.root, "src")
        self.ledgers = Ledgers(self.spark, self.schema, f"{self.root}/logs", "my-app")

    def put(self, name: str, text: str) -> str:
        path = os.path.join(self.src, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", newline="") as file:
            file.write(text)
        return path

    def spec(self, **changes) -> IngestSpec:
        settings = {
            "dataset": "feed",
            "load_type": "INCREMENTAL",
            "active": True,
            "source_prefixes": self.src,
            "file_type": "csv",
            "target_schema": self.schema,
            "target_table": "STAGED",
            "target_location": f"{self.root}/staged",
            "options": {"delimiter": ","},
        }
        return IngestSpec(**{**settings, **changes})

    def run(self, cycle: str = "1", date: str = "20240601") -> RunContext:
        return RunContext(date, cycle, "2024-06-01 12:00:00", run_id="r")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        selected = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in selected.collect()), key=repr)

    return collect
