"""WARC archives: writing, normalising monolithic gzip streams, and reading by offset.

*Write.* Tasks write pages as records of ordinary crawl archives: one gzip stream over the whole file, a new file after ``ROLL`` bytes.
Of pages with equal payloads of ``REVISIT`` bytes or more, that with the largest id is written in full and the others as revisit
records, which refer to it and have no payload.

*Normalise.* A whole-file stream can only be read from its start. One pass inflates each archive once, writes every record anew
as a gzip member of its own, and beside the archive a sidecar index with the offset and length of every member. Blocks are
copied in pieces, so memory does not depend on a record's length. Archives whose records are members already come out the same.

*Read.* The sidecars are a table; its rows are dealt out by archive and offset, and tasks seek to their members and inflate
those only, so an archive is read by many tasks. Digests are computed anew from what was read.

Files are in the folder all executors share. A task's files have names of their own, and only those that a finished task has
reported count, so an attempt that was lost or repeated leaves nothing but files nobody reads; they go with the folder at the
end of the application.

Defined results: a null html is an empty payload; html of any bytes, invalid UTF-8 too, is kept byte by byte; texts of any
length are one record; control characters and blanks in a url are percent-encoded, a null url is left out. Rows that repeat a
page (id and html) are records of their own with one record id; where they have the largest id of their payload, each of them is a
response. A null id is smaller than any other; with null ids only, all are responses. An empty table makes no archive and gives
an empty result. A truncated archive or one that is no WARC is an error that names it. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_back, partitions, stored, table
from tidemark.session import scratch_path
from tidemark.sources import storage

#: Fixed value: payloads of fewer bytes are always written in full.
REVISIT = 1000
ROLL = 256 << 20
PIECE = 1 << 20
#: Bytes of payload in one Arrow batch of a read.
BATCH_BYTES = 16 << 20
#: Names of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = "archive string, offset long, length long, type string, record_id string, uri string"
RECORD = "page_id long, type string, record_id string, uri string, refers_to string, payload_bytes long, payload_digest string, intact boolean"


def opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path there, for a path as Spark writes it."""
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    if "://" not in path:
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


def shared_folder(spark: SparkSession, folder: str) -> str:
    """Full name of a folder, made if need be."""
    full = storage.qualified(spark, folder)
    system, place = opened(full)
    system.create_dir(place, recursive=True)
    return full


def header(fields: list[tuple[str, str]]) -> bytes:
    return b"\r\n".join([VERSION, *(f"{name}: {value}".encode() for name, value in fields), b"", b""])


def base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, record_id: str, refers_to: str | None) -> tuple[bytes, bytes]:
    """Head and block of a page's record; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base32(digest)}"))
    if refers_to:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return header(fields), block


def info_record(name: str) -> bytes:
    block = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    number = uuid.uuid5(uuid.NAMESPACE_URL, name)
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{number}>"), ("WARC-Date", DATE), ("WARC-Filename", name)]
    return header([*fields, ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


class Stream:
    """An archive written as one gzip stream."""

    def __init__(self, folder: str, name: str):
        system, place = opened(f"{folder}/{name}")
        self.out, self.squeeze, self.size, self.records = system.open_output_stream(place, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
        self.path = f"{folder}/{name}"
        self.write(info_record(name))

    def write(self, *parts: bytes) -> None:
        for part in parts:
            self.out.write(self.squeeze.compress(part))
            self.size += len(part)

    def close(self) -> tuple[str, int]:
        self.out.write(self.squeeze.flush())
        self.out.close()
        return self.path, self.records


def read_head(stream: io.BufferedIOBase) -> tuple[bytes, dict[str, str]] | None:
    """The next record's head as it stands and its fields (names in lower case); None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record starts with {line[:40]!r}")
    raw, fields, name = [line], {}, None
    while True:
        line = stream.readline()
        if not line:
            raise ValueError("the archive ends within a head")
        raw.append(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return b"".join(raw), fields
        if text[0] in " \t" and name:
            fields[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()


def members(source: io.RawIOBase, sink) -> Iterator[dict]:
    """Rewrite every record of a gzip stream as a member of ``sink``; the index entry of each."""
    stream, offset = io.BufferedReader(gzip.GzipFile(fileobj=source, mode="rb"), PIECE), 0
    while (head := read_head(stream)) is not None:
        raw, fields = head
        squeeze, length = zlib.compressobj(6, zlib.DEFLATED, 31), 0
        left = int(fields["content-length"])
        piece = raw
        while piece:
            length += sink.write(squeeze.compress(piece)) or 0
            piece = stream.read(min(left, PIECE))
            if left and not piece:
                raise ValueError("the archive ends within a block")
            left -= len(piece)
        end = squeeze.compress(b"\r\n\r\n") + squeeze.flush()
        length += sink.write(end) or 0
        yield {
            "offset": offset,
            "length": length,
            "type": fields.get("warc-type"),
            "record_id": fields.get("warc-record-id", "").strip("<>") or None,
            "uri": fields.get("warc-target-uri"),
        }
        offset += length


class Counted:
    """A sink that says how many bytes it took."""

    def __init__(self, out):
        self.out = out

    def write(self, data: bytes) -> int:
        if data:
            self.out.write(data)
        return len(data)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of one record."""
    stream = io.BytesIO(gzip.decompress(member))
    head = read_head(stream)
    if head is None:
        raise ValueError("an empty member")
    return head[1], stream.read(int(head[1]["content-length"]))


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    return head, payload


def _urn(*parts: str) -> Column:
    """A record id that depends on the values only."""
    hexed = F.sha1(F.concat_ws(":", *[F.col(p).cast("string") for p in parts]))
    cut = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, record_id and, for revisits, refers_to."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    long = rows.filter(F.length("payload") >= REVISIT)
    groups = long.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("copies")).filter("copies > 1")
    groups = stored(groups, "equal-payloads")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    # At most a thousand of them.
    hot = F.broadcast(groups.filter(F.col("copies") * 1000 >= total).select("digest", F.col("top").alias("hot")))
    rest = groups.filter(F.col("copies") * 1000 < total).select("digest", "top")
    known = rows.join(hot, "digest", "left")
    warm = known.filter("hot IS NOT NULL").withColumnRenamed("hot", "top")
    cold = known.filter("hot IS NULL").drop("hot").join(rest, "digest", "left")
    # Equal digests of shorter payloads have no group.
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return warm.unionByName(cold).select(
        F.col("page_id").cast("long"), "url", "payload", "digest", _urn("page_id", "digest").alias("record_id"),
        F.when(again, _urn("top", "digest")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages (page_id, url, html) as monolithic archives below ``folder``: path and records of each."""
    folder = shared_folder(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        done, stream = [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if stream is None:
                        stream = Stream(folder, f"crawl-{names}-{len(done):04d}.warc.gz")
                    url = row["url"].decode("utf-8", "backslashreplace") if row["url"] is not None else None
                    head, block = page_record(row["page_id"], url, *(row[c] for c in ("payload", "digest", "record_id", "refers_to")))
                    stream.write(head, block, b"\r\n\r\n")
                    stream.records += 1
                    if stream.size >= ROLL:
                        done.append(stream.close())
                        stream = None
        if stream is not None:
            done.append(stream.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "records"])

    rows = planned(pages).withColumn("url", F.col("url").cast("binary"))
    return stored(rows.mapInArrow(run, "path string, records long"), "archives")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite the archives named in ``path`` below ``folder``, one member per record, each with its sidecar index. The index rows."""
    spark = archives.sparkSession
    folder = shared_folder(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column(0).to_pylist():
                name = f"{path.rsplit('/', 1)[-1].split('.')[0]}-{uuid.uuid4().hex[:12]}.warc.gz"
                (source_fs, source), (fs, target) = opened(path), opened(f"{folder}/{name}")
                try:
                    with source_fs.open_input_stream(source, compression=None) as raw, fs.open_output_stream(target, compression=None) as out:
                        with fs.open_output_stream(f"{target}.idx.json", compression=None) as side:
                            n = 0
                            for entry in members(raw, Counted(out)):
                                side.write(json.dumps({"archive": f"{folder}/{name}", **entry}).encode() + b"\n")
                                n += 1
                except (ValueError, KeyError, EOFError, OSError, zlib.error) as error:
                    raise ValueError(f"{path}: {error}") from error
                made.append((f"{folder}/{name}", n))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], ["archive", "records"])

    # A file is a task's work of minutes, so each one goes by itself.
    each = archives.select("path").repartition(partitions(spark), "path")
    done = stored(each.mapInArrow(run, "archive string, records long"), "normalised")
    index = spark.read.schema(INDEX).option("pathGlobFilter", "*.idx.json").json(folder)
    return index.join(done.select("archive"), "archive", "left_semi")


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Page records of an index, as ``RECORD`` has them (and payload): each member is read at its offset and checked.

    ``payload_digest`` and ``payload_bytes`` of a response are those of the payload read; a revisit has the ones it states.
    """
    columns = [c.split()[0] for c in RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in RECORD.split(", ")] + [pa.binary()] * with_payload
    names = [*columns, *["payload"] * with_payload]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, rows, held = None, None, [], 0
        for batch in batches:
            for entry in batch.to_pylist():
                if entry["archive"] != path:
                    if file is not None:
                        file.close()
                    path = entry["archive"]
                    system, place = opened(path)
                    file = system.open_input_file(place)
                file.seek(entry["offset"])
                fields, block = parsed(file.read(entry["length"]))
                head, payload = http_parts(block)
                stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if entry["type"] == "revisit":
                    size, digest, payload = int(re.search(rb"(?im)^content-length:\s*(\d+)", head).group(1)), stated, None
                else:
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                page = fields.get("x-page-id")
                refers = fields.get("warc-refers-to", "").strip("<>") or None
                row = (int(page) if page else None, entry["type"], entry["record_id"], entry["uri"], refers, size, digest, digest == stated)
                rows.append((*row, payload) if with_payload else row)
                held += len(payload or b"") if with_payload else 0
                if len(rows) >= 10_000 or held >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
        if file is not None:
            file.close()
        if rows:
            yield batch_of(rows)

    wanted = index.filter(F.col("type").isin("response", "revisit")).select("archive", "offset", "length", "type", "record_id", "uri")
    dealt = wanted.repartitionByRange(partitions(index.sparkSession), "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(run, RECORD + (", payload binary" if with_payload else ""))


def resolved(records: DataFrame) -> DataFrame:
    """Page records, stored, where revisits have page, size and digest of the response they refer to.

    A record that many revisits refer to is broadcast (``common.join_back``). A revisit without its response is left out.
    """
    full = records.filter("type = 'response'")
    again = records.filter("type = 'revisit'").drop("payload_bytes", "payload_digest")
    asked = again.groupBy("refers_to").agg(F.count("*").alias("n"))
    source = full.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("refers_page"), "payload_bytes", "payload_digest").distinct()
    found = join_back(again, stored(source.join(asked, "refers_to"), "responses"), ["refers_to"], "n").drop("n")
    return full.withColumn("refers_page", F.lit(None).cast("long")).unionByName(found)


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """Write, normalise and read back ``pages``; the page records."""
    index = normalise(write_archives(pages, f"{folder}/crawl"), f"{folder}/members")
    return resolved(stored(read_records(index), "page-records"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    storage.delete_at_exit(spark, folder)
    found = archived(table(spark, sf_dir, "pages"), folder)
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_page").alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
     q AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
                  max(page_id) OVER (PARTITION BY payload) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT} AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT} AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM q
"""
