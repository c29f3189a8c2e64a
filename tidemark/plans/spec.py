"""Ingest and process specs: the JSON documents users write, checked and with defaults."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

FILE_TYPES = ("csv", "txt", "excel", "json", "parquet")
MAX_TABLE_NAME = 80


@dataclass(frozen=True)
class RunContext:
    """What identifies a run. Several jobs may share one cycle."""

    execution_date: str
    cycle_id: str
    processed_time: str
    run_id: str = "NA"
    clock: Callable[[], str] | None = None

    def partition(self, dataset: str) -> dict[str, str]:
        """The ledger partition of a dataset in this run."""
        return {
            "dataset_name": dataset,
            "execution_date": self.execution_date,
            "execution_cycle_id": self.cycle_id,
        }

    def now(self) -> str:
        return self.clock() if self.clock else self.processed_time


def _flag(doc: Mapping, key: str) -> bool:
    return str(doc.get(key) or "N").upper() == "Y"


def _required(doc: Mapping, key: str):
    value = doc.get(key)
    if value is None or value == "":
        raise ValueError(f"{key} is missing from the spec of {doc.get('dataset_name')!r}")
    return value


def _table_name(name: str) -> str:
    if len(name) > MAX_TABLE_NAME:
        raise ValueError(f"table name {name!r} is longer than {MAX_TABLE_NAME} characters")
    return name


def _location(doc: Mapping, aliases: Mapping[str, str], bucket: str, prefix: str) -> str:
    root = _required(doc, bucket)
    return f"{aliases.get(root, root).rstrip('/')}/{str(doc.get(prefix) or '').strip('/')}".rstrip("/")


def _archive_location(doc: Mapping, aliases: Mapping[str, str]) -> str:
    """Without a bucket of its own the archive is in the source bucket."""
    bucket = "archive_location_bucket" if doc.get("archive_location_bucket") else "source_bucket"
    _required(doc, "archive_location_prefix")
    return _location(doc, aliases, bucket, "archive_location_prefix")


def _reprocess_document(doc: Mapping, load_document: Callable[[str], object] | None) -> Mapping | None:
    key = doc.get("reprocess_master_file_s3_key")
    if not key:
        return None
    if load_document is None:
        raise ValueError(f"no loader for the reprocess document {key!r}")
    return load_document(key)


@dataclass(frozen=True)
class IngestSpec:
    dataset: str
    load_type: str
    active: bool
    source_prefixes: str | list[str]
    file_type: str
    target_schema: str
    target_table: str
    target_location: str
    mask: str | None = None
    static_file: bool = False
    custom_mask: bool = False
    header: bool = True
    schema_doc: Sequence | Mapping | None = None
    options: dict[str, str] = field(default_factory=dict)
    sheet: str | None = None
    start_cell: str = "A1"
    archive: bool = False
    archive_location: str | None = None
    archive_today_only: bool = False
    gated: bool = False
    checked_after: bool = False
    skip_file: bool = False
    skip_on_non_critical: bool = False
    write_valid: bool = False
    drop_duplicates: bool = False
    schema_mode: str = "latest"
    reprocess_doc: Mapping | None = None
    #: What tells files apart in the ledger, which holds both: ``path``, or ``name`` alone. It never follows from what is listed.
    file_identity: str = "path"
    #: Rows of nested documents whose arrays stand side by side: their ``product``, or each array ``apart``.
    arrays: str = "product"

    def __post_init__(self) -> None:
        if self.arrays not in ("product", "apart"):
            raise ValueError(f"arrays must be 'product' or 'apart', not {self.arrays!r}")
        if self.file_identity not in ("path", "name"):
            raise ValueError(f"file_identity must be 'path' or 'name', not {self.file_identity!r}")

    @classmethod
    def from_document(
        cls,
        doc: Mapping,
        aliases: Mapping[str, str] | None = None,
        load_document: Callable[[str], object] | None = None,
    ) -> IngestSpec:
        """Check a spec document. ``aliases`` maps bucket and schema words to places,
        ``load_document`` fetches the schema document a key names."""
        aliases = aliases or {}
        file_type = _required(doc, "file_type").lower()
        if file_type not in FILE_TYPES:
            raise ValueError(f"file type {file_type!r} is not one of {FILE_TYPES}")
        prefixes = doc.get("source_prefix")
        if not prefixes:
            raise ValueError("source_prefix is empty")
        root = aliases.get(_required(doc, "source_bucket"), doc["source_bucket"]).rstrip("/")
        if isinstance(prefixes, str):
            sources: str | list[str] = f"{root}/{prefixes.strip('/')}"
        else:
            sources = [f"{root}/{p.strip('/')}" for p in prefixes]
        header, schema_doc = True, None
        if file_type in ("csv", "txt", "excel"):
            header = str(_required(doc, "header")).lower() == "true"
            schema_doc = cls._flat_document(doc, header, load_document)
        elif file_type == "json" and str(doc.get("infer_schema")).upper() == "N":
            schema_doc = cls._document(doc, load_document)
        address = doc.get("excel_data_address") or {}
        archive = _flag(doc, "archive")
        schema = _required(doc, "target_schema")
        return cls(
            dataset=_required(doc, "dataset_name"),
            load_type=_required(doc, "load_type").upper(),
            active=_flag(doc, "active"),
            source_prefixes=sources,
            file_type=file_type,
            target_schema=aliases.get(schema, schema),
            target_table=_table_name(_required(doc, "target_table")).upper(),
            target_location=_location(doc, aliases, "target_bucket", "target_prefix"),
            mask=doc.get("source_file_pattern") or None,
            static_file=_flag(doc, "static_file_pattern") and bool(doc.get("source_file_pattern")),
            custom_mask=_flag(doc, "custom_pattern"),
            header=header,
            schema_doc=schema_doc,
            options=cls._options(doc, file_type),
            sheet=_required(address, "sheet_name") if file_type == "excel" else None,
            start_cell=address.get("starting_cell_id") or "A1",
            archive=archive,
            archive_location=_archive_location(doc, aliases) if archive else None,
            archive_today_only=_flag(doc, "archive_today_only"),
            gated=bool(doc.get("pre_ingestion_dqm_config")),
            checked_after=bool(doc.get("dqm_config_s3_key")),
            skip_file=_flag(doc, "skip_file"),
            skip_on_non_critical=_flag(doc, "skip_file_on_non_critical_failure"),
            write_valid=_flag(doc, "write_valid_data"),
            drop_duplicates=_flag(doc, "drop_duplicate_records"),
            schema_mode=doc.get("schema_mode") or "latest",
            reprocess_doc=_reprocess_document(doc, load_document),
            file_identity=doc.get("file_identity") or "path",
            arrays=doc.get("arrays") or "product",
        )

    @classmethod
    def _flat_document(cls, doc: Mapping, header: bool, load_document) -> Sequence | None:
        infer = str(doc.get("infer_schema") or ("Y" if header else "N")).upper() == "Y"
        if not infer:
            return cls._document(doc, load_document)
        if not header:
            raise ValueError("files without a header need a schema document (infer_schema = N)")
        return None

    @staticmethod
    def _document(doc: Mapping, load_document):
        key = _required(doc, "schema_location_key")
        if not key.endswith(".json"):
            raise ValueError(f"schema_location_key {key!r} is not a .json file")
        if load_document is None:
            raise ValueError("no loader for schema documents given")
        return load_document(key)

    @staticmethod
    def _options(doc: Mapping, file_type: str) -> dict[str, str]:
        options = {k: doc[k] for k in ("encoding", "escape") if doc.get(k)}
        # Absent means off; present but blank means on.
        if doc.get("multiline") is not None and str(doc["multiline"]).lower() in ("", "true"):
            options["multiline"] = "true"
        if file_type == "csv":
            options["delimiter"] = doc.get("delimiter") or ","
        elif file_type == "txt":
            options["delimiter"] = _required(doc, "delimiter")
        return options


@dataclass(frozen=True)
class ProcessSpec:
    dataset: str
    active: bool
    processed_schema: str
    processed_table: str
    processed_location: str
    publish: bool = False
    publish_schema: str | None = None
    publish_table: str | None = None
    publish_location: str | None = None
    archive: bool = False
    archive_location: str | None = None
    sql_script: str | None = None
    checked_after: bool = False

    @classmethod
    def from_document(cls, doc: Mapping, aliases: Mapping[str, str] | None = None) -> ProcessSpec:
        aliases = aliases or {}
        publish, archive = _flag(doc, "publish_flag"), _flag(doc, "archive")
        script = doc.get("sql_script_path") or None
        if script and not script.endswith(".sql"):
            raise ValueError(f"sql_script_path {script!r} is not a .sql file")
        schema = _required(doc, "processed_schema")
        publish_schema = _required(doc, "publish_schema") if publish else None
        return cls(
            dataset=_required(doc, "dataset_name"),
            active=_flag(doc, "active"),
            processed_schema=aliases.get(schema, schema),
            processed_table=_table_name(_required(doc, "processed_table")),
            processed_location=_location(doc, aliases, "processed_location_bucket", "processed_location_prefix"),
            publish=publish,
            publish_schema=aliases.get(publish_schema, publish_schema),
            publish_table=_table_name(_required(doc, "publish_table")) if publish else None,
            publish_location=(
                _location(doc, aliases, "publish_location_bucket", "publish_location_prefix") if publish else None
            ),
            archive=archive,
            archive_location=(
                _location(doc, aliases, "archive_location_bucket", "archive_location_prefix") if archive else None
            ),
            sql_script=script,
            checked_after=bool(doc.get("dqm_config_s3_key")),
        )
