"""File work that tasks do, so that the driver's part does not grow with files or bytes: listing, reading heads, copying.

Tasks open files through Arrow's file systems (local, HDFS, S3, Google and Azure storage), with the access settings that Spark has for
S3. Other schemes are known to Spark's own file systems only; ``reachable`` tells, and ``storage`` does their work from the driver.
"""

from __future__ import annotations

import io
import re
import shutil
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyarrow import parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMES = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "abfs", "abfss")
#: Entries a task lists before it hands the folders it has not opened to others.
ENTRIES = 20_000
COPY_BYTES = 4 << 20
#: Characters of a head kept as one line or record at most; longer ones are cut, which tells headers apart all the same.
HEAD_CHARACTERS = 1 << 20

S3_SETTINGS = {
    "access_key": "fs.s3a.access.key",
    "secret_key": "fs.s3a.secret.key",
    "session_token": "fs.s3a.session.token",
    "endpoint_override": "fs.s3a.endpoint",
    "region": "fs.s3a.endpoint.region",
}


def scheme(path: str) -> str:
    """Scheme of a full path, blank for a plain one."""
    found = re.match("^([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found.group(1).lower() if found else ""


def reachable(paths: Sequence[str]) -> bool:
    """Whether tasks can open the paths, which are full ones."""
    return all(scheme(p) in SCHEMES for p in paths)


def settings(spark: SparkSession) -> dict[str, str]:
    """What tasks need to know of Spark's own access to S3; without keys Arrow finds its own credentials."""
    conf = spark._jsc.hadoopConfiguration()
    found = {name: conf.get(key) for name, key in S3_SETTINGS.items()}
    return {name: value for name, value in found.items() if value}


def opened(path: str, s3: dict[str, str] | None = None) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system of a path as Spark writes it, and the path there."""
    kind = scheme(path)
    if kind in ("", "file"):
        return arrow_fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    if kind in ("s3", "s3a", "s3n"):
        if s3:
            return arrow_fs.S3FileSystem(**s3), re.sub("^s3[an]?://", "", path)
        return arrow_fs.FileSystem.from_uri(re.sub("^s3[an]?://", "s3://", path))
    return arrow_fs.FileSystem.from_uri(path)


def _frame(columns: Sequence[Sequence], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


# -- listing --------------------------------------------------------------------


def list_folders(folders: DataFrame, s3: dict[str, str]) -> DataFrame:
    """``root, path, is_folder`` of what is below ``folders`` (``root, path``).

    Each task goes through its folders breadth first, as deep as they are, until it has seen ``ENTRIES`` entries; folders it has not
    opened by then come back as such. Hidden files and folders are left out as Spark's readers leave them out.
    """
    limit = ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["root", "path", "is_folder"], [pa.string(), pa.string(), pa.bool_()]
        open_ = deque()
        for batch in batches:
            open_.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        seen, found = 0, []
        while open_ and seen < limit:
            root, folder = open_.popleft()
            system, place = opened(folder, s3)
            for info in system.get_file_info(arrow_fs.FileSelector(place, allow_not_found=True)):
                seen += 1
                if info.base_name.startswith(("_", ".")):
                    continue
                path = f"{folder.rstrip('/')}/{info.base_name}"
                if info.type == arrow_fs.FileType.Directory:
                    open_.append((root, path))
                elif info.type == arrow_fs.FileType.File:
                    found.append((root, path, False))
            if len(found) >= 10_000:
                yield _frame(list(zip(*found)), names, types)
                found = []
        found.extend((root, folder, True) for root, folder in open_)
        if found:
            yield _frame(list(zip(*found)), names, types)

    return folders.select("root", "path").mapInArrow(run, "root string, path string, is_folder boolean")


def files_below(spark: SparkSession, folders: Sequence[str], keep) -> DataFrame:
    """``root, path`` of all files below the folders, those without bytes too.

    ``keep`` stores a DataFrame and gives it back. A round is one job; a tree of less than ``ENTRIES`` entries takes one round,
    larger ones are dealt out to all tasks with the next. Nothing but a flag per round reaches the driver.
    """
    s3 = settings(spark)
    frontier = spark.createDataFrame([(f, f) for f in folders], "root string, path string")
    files, n = None, 0
    while True:
        found = keep(list_folders(frontier, s3), f"listing-{n}")
        own = found.where("NOT is_folder").select("root", "path")
        files = own if files is None else files.unionByName(own)
        frontier = found.where("is_folder").select("root", "path")
        if frontier.isEmpty():
            return files
        frontier, n = frontier.repartition(spark.sparkContext.defaultParallelism * 4), n + 1


# -- heads ----------------------------------------------------------------------


def open_quote(text: str, quote: str = '"', escape: str = "\\") -> bool:
    """Whether a quoted value is still open at the end of the text."""
    if escape and escape != quote:
        text = text.replace(escape + escape, "").replace(escape + quote, "")
    return text.count(quote) % 2 == 1


def first_record(lines: io.TextIOBase, multiline: bool, quote: str, escape: str) -> str | None:
    """First line that is not blank; with ``multiline`` the whole quoted record that it starts."""
    line = lines.readline(HEAD_CHARACTERS)
    while line and not line.strip():
        line = lines.readline(HEAD_CHARACTERS)
    if not line:
        return None
    record = [line.rstrip("\r\n")]
    if multiline and quote:
        is_open, size = open_quote(record[0], quote, escape), len(line)
        while is_open and size < HEAD_CHARACTERS:
            more = lines.readline(HEAD_CHARACTERS)
            if not more:
                break
            record.append(more.rstrip("\r\n"))
            is_open ^= open_quote(record[-1], quote, escape)
            size += len(more)
    return "\n".join(record)


def header_paths(
    spark: SparkSession, paths: Sequence[str], encoding: str, multiline: bool, quote: str, escape: str
) -> list[list[str]]:
    """Paths of files that share a header, one list per header; files without any line are in none.

    One job: tasks fetch the heads of their files, and one row per header comes back.
    """
    s3 = settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, place = opened(path, s3)
                with system.open_input_stream(place, compression="detect", buffer_size=1 << 16) as stream:
                    with io.TextIOWrapper(stream, encoding, errors="replace", newline=None) as lines:
                        found.append((path, first_record(lines, multiline, quote, escape)))
            if found:
                yield _frame(list(zip(*found)), ["path", "head"], [pa.string(), pa.string()])

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    heads = listed.mapInArrow(run, "path string, head string").where("head IS NOT NULL")
    return [r["paths"] for r in heads.groupBy("head").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()]


# -- Parquet footers --------------------------------------------------------------


def parquet_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str | None, list[str]]]:
    """Files that share a footer schema: ``(newest file with rows or None, paths)``, one row per schema, in one job.

    Tasks read footers only.
    """
    s3 = settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, place = opened(path, s3)
                with system.open_input_file(place) as file:
                    footer = parquet.read_metadata(file)
                # Without the object's address and the root's name.
                fields = str(footer.schema).split("\n", 2)[2]
                found.append((path, path.rsplit("/", 1)[-1], footer.num_rows > 0, fields))
            if found:
                yield _frame(list(zip(*found)), ["path", "name", "filled", "fields"], [pa.string(), pa.string(), pa.bool_(), pa.string()])

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    footers = listed.mapInArrow(run, "path string, name string, filled boolean, fields string")
    newest = F.max(F.when(F.col("filled"), F.struct("name", "path")))["path"]
    groups = footers.groupBy("fields").agg(newest.alias("newest"), F.sort_array(F.collect_list("path")).alias("paths"))
    return [(r["newest"], r["paths"]) for r in groups.collect()]


# -- copies ---------------------------------------------------------------------


def copy_folders(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> int:
    """Copy files, or all files below folders, from the first to the second path of each pair. Returns the bytes.

    The bytes go through the tasks. Each copy is compared with its source in size; one that differs fails the job, and
    nothing has been removed by then. A file that stands at a target is replaced, so a repeated task copies anew; nothing is
    deleted here, as a repeated task could take away what others have copied.
    """
    s3 = settings(spark)

    def copy(source: str, target: str) -> int:
        (source_fs, a), (target_fs, b) = opened(source, s3), opened(target, s3)
        target_fs.create_dir(b.rsplit("/", 1)[0], recursive=True)
        with source_fs.open_input_stream(a, compression=None) as read, target_fs.open_output_stream(b, compression=None) as write:
            shutil.copyfileobj(read, write, COPY_BYTES)
        sizes = [system.get_file_info(place).size for system, place in ((source_fs, a), (target_fs, b))]
        if sizes[0] != sizes[1]:
            raise OSError(f"{target} has {sizes[1]} bytes, {source} has {sizes[0]}")
        return sizes[0]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for source, target in zip(*(batch.column(i).to_pylist() for i in range(2))):
                system, place = opened(source, s3)
                if system.get_file_info(place).type != arrow_fs.FileType.Directory:
                    found.append((source, target))
                    continue
                for info in system.get_file_info(arrow_fs.FileSelector(place, recursive=True)):
                    if info.type == arrow_fs.FileType.File:
                        own = info.path[len(place.rstrip("/")) + 1 :]
                        found.append((f"{source.rstrip('/')}/{own}", f"{target.rstrip('/')}/{own}"))
            if found:
                yield _frame(list(zip(*found)), ["source", "target"], [pa.string(), pa.string()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [copy(*pair) for pair in zip(*(batch.column(i).to_pylist() for i in range(2)))]
            yield _frame([sizes], ["bytes"], [pa.int64()])

    listed = spark.createDataFrame(list(pairs), "source string, target string").mapInArrow(expand, "source string, target string")
    # Files of one folder are dealt out as well.
    dealt = listed.repartition(spark.sparkContext.defaultParallelism * 4, "source")
    return dealt.mapInArrow(run, "bytes long").agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
