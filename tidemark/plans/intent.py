"""What a run is about to land, written down first, so that the next run can finish it or take it back.

A run writes its files, and what the gate said of them, to a folder beside the ledgers before it lands a row, marks the folder when all
rows have landed, and deletes it when the ledgers are written. A folder that is still there belongs to a run that broke off: with the
mark it is finished, without it is taken back and its files are loaded again. Runs of one dataset go one after
another, as a run takes an open folder for a broken one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.ledger import Ledgers
from tidemark.plans.spec import RunContext
from tidemark.sources import listing, storage

#: Which older rows the landed ones replace: none, those of the run's files, or those of all files listed.
REPLACE_NONE, REPLACE_FILES, REPLACE_ALL = "none", "files", "all"


@dataclass
class Intent:
    spark: SparkSession
    folder: str
    run: RunContext
    started: str
    replace: str = REPLACE_NONE
    landed: bool = False
    _kept: dict[str, DataFrame | None] = field(default_factory=dict)

    @property
    def name(self) -> str:
        """Tells the run apart from every other; its ledger rows go into files of this name, so writing them twice is writing them once."""
        return self.folder.rsplit("/", 1)[-1]

    def _part(self, kind: str) -> DataFrame | None:
        if kind not in self._kept:
            path = f"{self.folder}/{kind}"
            self._kept[kind] = self.spark.read.parquet(path) if storage.exists(self.spark, path) else None
        return self._kept[kind]

    def paths(self) -> list[str]:
        return sorted(r.source_path for r in self._part("files").select("source_path").collect())

    @property
    def files(self) -> DataFrame:
        """The run's files as a listing."""
        return self._part("files")

    @property
    def verdicts(self) -> DataFrame | None:
        return self._part("verdicts")

    @property
    def checks(self) -> DataFrame | None:
        """Rows for the quality log."""
        return self._part("checks")

    def mark_landed(self) -> None:
        storage.write_text(self.spark, f"{self.folder}/landed.json", "{}")
        self.landed = True

    def close(self) -> None:
        # The document goes first: a folder without it says nothing.
        storage.delete(self.spark, [f"{self.folder}/intent.json"])
        storage.delete(self.spark, [self.folder])


def _root(ledgers: Ledgers, dataset: str) -> str:
    return f"{ledgers.location.rstrip('/')}/open_runs_{ledgers.application}/{quote(dataset, safe='')}"


def open_intent(
    ledgers: Ledgers,
    dataset: str,
    run: RunContext,
    started: str,
    paths: Sequence[str],
    replace: str,
    verdicts: DataFrame | None = None,
    checks: DataFrame | None = None,
) -> Intent:
    """Write down what a run is about to land. The document comes last, so a folder that has it is complete."""
    spark = ledgers.spark
    intent = Intent(spark, f"{_root(ledgers, dataset)}/{uuid.uuid4().hex}", run, started, replace)
    parts = {"files": listing.listing_frame(spark, paths), "verdicts": verdicts, "checks": checks}
    for kind, rows in parts.items():
        if rows is not None:
            rows.write.parquet(f"{intent.folder}/{kind}")
    document = {
        "execution_date": run.execution_date,
        "cycle_id": run.cycle_id,
        "processed_time": run.processed_time,
        "run_id": run.run_id,
        "started": started,
        "replace": replace,
    }
    storage.write_text(spark, f"{intent.folder}/intent.json", json.dumps(document))
    return intent


def open_intents(ledgers: Ledgers, dataset: str, run: RunContext) -> list[Intent]:
    """Intents that earlier runs left. The clock is that of the run that asks."""
    spark, found = ledgers.spark, []
    for folder in storage.children(spark, _root(ledgers, dataset)):
        names = {p.rsplit("/", 1)[-1] for p in storage.children(spark, folder)}
        if "intent.json" not in names:
            # Nothing has landed without the document.
            storage.delete(spark, [folder])
            continue
        doc = json.loads(storage.read_text(spark, f"{folder}/intent.json"))
        own = RunContext(doc["execution_date"], doc["cycle_id"], doc["processed_time"], doc["run_id"], run.clock)
        found.append(Intent(spark, folder, own, doc["started"], doc["replace"], "landed.json" in names))
    return sorted(found, key=lambda i: (i.run.execution_date, i.run.cycle_id, i.name))
