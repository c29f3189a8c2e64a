"""Small metadata calls on the file system that Spark itself is configured for."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import tasks
from tidemark.sources.tasks import open_quote

# Each call is a short wait on the file system, so many may be under way at once.
IO_THREADS = 48


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    return _file_system(spark, path).makeQualified(_path(spark, path)).toString()


def children(spark: SparkSession, folder: str) -> list[str]:
    """Files and folders right below a folder; none where there is no such folder."""
    if not exists(spark, folder):
        return []
    return sorted(s.getPath().toString() for s in _file_system(spark, folder).listStatus(_path(spark, folder)))


def matching(spark: SparkSession, folder: str, levels: Sequence[str]) -> list[str]:
    """Folders below a folder whose names match one pattern per level. One call, and one listing per folder above the last level."""
    base = _path(spark, folder)
    names = "/".join(levels)
    found = _file_system(spark, folder).globStatus(spark._jvm.org.apache.hadoop.fs.Path(base, names))
    told = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(found)
    return sorted(re.findall(r"\bpath=(.*?); isDirectory=true", told, re.DOTALL))


def leaf_files(spark: SparkSession, folder: str) -> list[str]:
    """All files below a folder, hidden ones left out as Spark's readers leave them out.

    The listing crosses to Python in one call per folder, whatever the number of files.
    """
    if not exists(spark, folder):
        return []
    jvm = spark._jvm
    statuses = jvm.org.apache.hadoop.util.functional.RemoteIterators.toList(
        _file_system(spark, folder).listFiles(_path(spark, folder), True)
    )
    root = qualified(spark, folder).rstrip("/") + "/"
    joined = jvm.org.apache.commons.lang3.StringUtils.join(statuses, "\0")
    paths = [re.search(r"path=(.*); isDirectory=", s, re.DOTALL).group(1) for s in joined.split("\0") if s]
    visible = [p for p in paths if not any(part.startswith(("_", ".")) for part in p[len(root) :].split("/"))]
    return sorted(visible)


def read_text(spark: SparkSession, path: str) -> str:
    """Whole text of a small document such as a SQL script."""
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Store a small document, replacing one of the same name."""
    stream = _file_system(spark, path).create(_path(spark, path), True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def first_records(
    spark: SparkSession,
    paths: Sequence[str],
    encoding: str = "UTF-8",
    multiline: bool = False,
    quote: str = '"',
    escape: str = "\\",
) -> dict[str, str | None]:
    """First non-blank line of each file (the whole quoted record with ``multiline``).

    Only the head of each file is fetched. None stands for a file without any line. Quotes are
    counted as the reader's own ``quote`` and ``escape`` options have it.
    """
    jvm = spark._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())

    def head(path: str) -> str | None:
        hadoop_path = _path(spark, path)
        stream = _file_system(spark, path).open(hadoop_path)
        try:
            codec = codecs.getCodec(hadoop_path)
            plain = stream if codec is None else codec.createInputStream(stream)
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, encoding))
            line = lines.readLine()
            while line is not None and not line.strip():
                line = lines.readLine()
            if line is None or not multiline or not quote:
                return line
            record, is_open = [line], open_quote(line, quote, escape)
            while is_open:
                more = lines.readLine()
                if more is None:
                    break
                record.append(more)
                is_open ^= open_quote(more, quote, escape)
            return "\n".join(record)
        finally:
            stream.close()

    with ThreadPoolExecutor(IO_THREADS) as pool:
        return dict(zip(paths, pool.map(head, paths)))


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    def remove(path: str) -> None:
        _file_system(spark, path).delete(_path(spark, path), True)

    with ThreadPoolExecutor(IO_THREADS) as pool:
        list(pool.map(remove, paths))


def _same_system(spark: SparkSession, source: str, target: str) -> bool:
    return _file_system(spark, source).getUri().equals(_file_system(spark, target).getUri())


def move(spark: SparkSession, moves: Iterable[tuple[str, str]], missing_ok: bool = False) -> None:
    """Move files or folders as they are; what stands at the target is replaced.

    A rename within a file system. Between two, tasks copy the bytes (``tasks.copy_folders``), and the sources go when all copies are
    complete; file systems that tasks cannot open are copied by the driver. ``missing_ok`` passes over sources that are not there.
    """
    moves = list(moves)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def one(pair: tuple[str, str]) -> tuple[str, str] | None:
        """Rename, or say what has to be copied."""
        source, target = (_path(spark, p) for p in pair)
        source_fs, target_fs = (_file_system(spark, p) for p in pair)
        if missing_ok and not source_fs.exists(source):
            return None
        target_fs.mkdirs(target.getParent())
        target_fs.delete(target, True)
        if not _same_system(spark, *pair):
            return source_fs.makeQualified(source).toString(), target_fs.makeQualified(target).toString()
        if not source_fs.rename(source, target):
            raise OSError(f"cannot move {pair[0]} to {pair[1]}")
        return None

    def copy(pair: tuple[str, str]) -> None:
        source, target = (_path(spark, p) for p in pair)
        source_fs, target_fs = (_file_system(spark, p) for p in pair)
        if not jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, source, target_fs, target, True, conf):
            raise OSError(f"cannot move {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(IO_THREADS) as pool:
        far = [pair for pair in pool.map(one, moves) if pair is not None]
        if far and not tasks.reachable([p for pair in far for p in pair]):
            list(pool.map(copy, far))
            return
    if far:
        tasks.copy_folders(spark, far)
        delete(spark, [source for source, _ in far])


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Make a folder, if need be, that is deleted when the application ends."""
    system = _file_system(spark, folder)
    system.mkdirs(_path(spark, folder))
    system.deleteOnExit(_path(spark, folder))


def literal_path(path: str) -> str:
    """A path for Spark's readers, which would take brackets in a file name for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def plain_path(encoded: Column) -> Column:
    """Undo the URL encoding that file metadata columns use (a ``+`` stays a ``+``)."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    plain = F.when(encoded.contains("%"), decoded).otherwise(encoded)
    # The regular expression is only paid for by local files.
    return F.when(encoded.startswith("file://"), F.regexp_replace(plain, "^file:/+", "file:/")).otherwise(plain)


def name_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """Everything up to and including the last slash."""
    return F.regexp_extract(path, "(?s)^(.*/)", 1)
