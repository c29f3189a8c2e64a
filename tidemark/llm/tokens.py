"""BPE encoding and decoding through a table of distinct words.

A byte-level BPE never merges across the pieces its pattern cuts a text into, so a piece has the
same ids wherever it stands. ``encode_distinct``, which the query uses, has three steps:

1. Tasks cut texts into pieces, ``CHUNK_BYTES`` of text at a time. A chunk keeps its positions as places in its own
   list of distinct pieces, and the list is dealt out to shards by the hash of the piece.
2. A shard encodes each distinct piece once and answers every chunk that asked for it. A piece reaches its shard once per
   chunk, however often it occurs, so a very frequent word makes no hot key. The number of shards grows with the bytes of the texts.
3. The answers meet their chunk again, and ids are joined back by position.

``encode``, which the pipeline uses, gives the same ids without a shuffle, from a table of pieces in each Python worker that is
emptied when it reaches ``TABLE_ROWS``; a piece is encoded anew in another worker.

Decoding looks ids up in the table of id and bytes, which has the size of the vocabulary and travels with the tasks.

Defined results: null counts as empty; an empty text has no ids and decodes to the empty text; bytes that are not UTF-8
count as U+FFFD, as Python's "replace" has it; special tokens in a text become their own id, as the library has it; a text
longer than a chunk is a chunk of its own; rows stay as they are, with repeats, null ids and ties included; an empty table
gives an empty result; columns not named are not read, and named ones may have any name and type.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.anchors import pack, unpack
from tidemark.llm.common import bytes_of, partitions, raw, table

#: Pieces a worker of ``encode`` keeps before it starts its table anew.
TABLE_ROWS = 300_000
#: Text of one chunk.
CHUNK_BYTES = 2_000_000
#: Text per shard; its distinct pieces are about a sixth of that at most, and fewer as they meet again.
SHARD_BYTES = 64_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for
    themselves, the rest are numbered from 256 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tables:
    """What one Python worker needs: the cutting pattern, the merges, and id to bytes."""

    _of: dict[str, Tables] = {}

    def __init__(self, description: str):
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(description)
        spec["truncation"] = spec["padding"] = None
        letters = _byte_letters()
        pieces = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {text: [i] for text, i in special.items()}
        self.bytes_of = np.empty(max([*pieces.values(), *special.values()]) + 1, object)
        for piece, i in [*pieces.items(), *((text.encode(), i) for text, i in special.items())]:
            self.bytes_of[i] = piece
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split
        if _in_id_order(spec["model"]):
            # The same merges as ranks; several times faster on single pieces.
            self._encode = tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=pieces, special_tokens={}).encode_ordinary
        else:
            whole = Tokenizer.from_str(json.dumps(spec))
            self._encode = lambda piece: whole.encode(piece, add_special_tokens=False).ids
        self.ids_of: dict[str, bytes] = {}

    @classmethod
    def get(cls, description: str) -> Tables:
        key = hashlib.sha256(description.encode()).hexdigest()
        if key not in cls._of:
            cls._of[key] = cls(description)
        return cls._of[key]

    def pieces(self, text: str) -> list[str]:
        if not any(mark in text for mark in self.special):
            return self.cut(text)
        found: list[str] = []
        for part in self.split_special(text):
            found += [part] if part in self.special else self.cut(part)
        return found

    def coded(self, piece: str) -> list[int]:
        """Ids of one piece."""
        return self.special.get(piece) or self._encode(piece)

    def encode(self, text: str) -> bytes:
        """Packed ids: each piece that is new to the table is encoded once, then all are joined by position."""
        pieces = self.pieces(text)
        new = {p for p in pieces if p not in self.ids_of}
        if len(self.ids_of) + len(new) > TABLE_ROWS:
            self.ids_of, new = {}, set(pieces)
        for piece in new:
            self.ids_of[piece] = np.array(self.coded(piece), "<i4").tobytes()
        return b"".join(map(self.ids_of.__getitem__, pieces))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.bytes_of[ids].tolist()).decode("utf-8", errors="replace")


def _in_id_order(model: dict) -> bool:
    """Whether the n-th merge makes the n-th id after the single bytes, so that ids are ranks."""
    made = [a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    return all(model["vocab"].get(piece) == 256 + i for i, piece in enumerate(made))


def read_description(path: str) -> str:
    """The tokenizer file as text; it is read on the driver and travels with the tasks (about 1.5 MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of batches, so that few long texts are in memory as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.StructArray, list[bytes]]]:
    """Rows of a partition in lots of about ``CHUNK_BYTES`` of text, the last column: the other columns, and the texts."""
    kept, texts, size = [], [], 0
    for batch in small(batches):
        own = [raw(t) for t in bytes_of(batch.column(batch.num_columns - 1))]
        others = pa.StructArray.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
        start = 0
        for i, text in enumerate(own):
            if size and size + len(text) > CHUNK_BYTES:
                kept.append(others[start:i])
                yield pa.concat_arrays(kept), texts
                kept, texts, size, start = [], [], 0, i
            texts.append(text)
            size += len(text)
        kept.append(others[start:])
    if texts:
        yield pa.concat_arrays(kept), texts


def _pieces_packed(pieces: list[str]) -> bytes:
    data = [p.encode() for p in pieces]
    return pack(np.array([len(d) for d in data], np.int32), np.frombuffer(b"".join(data), np.uint8))


def _pieces_unpacked(block: bytes) -> list[str]:
    sizes, data = unpack(block)
    data, ends = data.tobytes(), np.cumsum(sizes).tolist()
    return [data[a:b].decode() for a, b in zip([0, *ends], ends)]


def _by_place(values: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` in the order of ``place``; stretch i has ``sizes[i]`` values."""
    starts, taken = np.cumsum(sizes) - sizes, sizes[place]
    first = np.cumsum(taken) - taken
    return values[np.repeat(starts[place] - first, taken) + np.arange(int(taken.sum()))]


def _home(chunk: int) -> int:
    """Key of a chunk's own row; shards have keys from 0."""
    return -1 - chunk


def answers_to(blocks: Iterable[bytes], tables: Tables) -> Iterator[bytes]:
    """For each block of pieces, how many ids each has, and the ids; a piece that comes again is not encoded again."""
    ids_of: dict[str, list[int]] = {}
    for block in blocks:
        pieces = _pieces_unpacked(block)
        for piece in pieces:
            if piece not in ids_of:
                ids_of[piece] = tables.coded(piece)
        own = [ids_of[p] for p in pieces]
        yield pack(np.array([len(x) for x in own], np.int32), np.array([i for x in own for i in x], np.int32))


def encode_distinct(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), tokenizer: str | None = None) -> DataFrame:
    """Return ``keep`` and ids (array of int), by one table of distinct words. ``docs`` has to be a scan, so that a repeated task makes the same chunks."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_description(tokenizer or default_tokenizer()))
    size = docs.agg(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    shards = max(2 * partitions(spark), -(-size // SHARD_BYTES))
    used = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").cast("binary").alias("_text"))
    kinds = [kind for _, kind in used.drop("_text").dtypes]
    kept = f"array<struct<{', '.join(f'k{i}:{kind}' for i, kind in enumerate(kinds))}>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, number = Tables.get(shared.value), TaskContext.get().partitionId() << 32
        for rows, texts in _chunks(batches):
            found: dict[str, int] = {}
            places, counts = [], []
            for data in texts:
                pieces = tables.pieces(data.decode("utf-8", "replace"))
                places.append(np.array([found.setdefault(p, len(found)) for p in pieces], np.int32))
                counts.append(len(pieces))
            own = list(found)
            shard = np.array([zlib.crc32(p.encode()) % shards for p in own], np.int64)
            # Within a shard pieces stand in order, which packs better; answers come in order of shard and piece.
            order = np.array(sorted(range(len(own)), key=lambda i: (shard[i], own[i])), np.int64)
            at = np.empty(len(own), np.int32)
            at[order] = np.arange(len(own), dtype=np.int32)
            names, starts = np.unique(shard[order], return_index=True)
            ends = [*starts[1:].tolist(), len(own)]
            sent = [{"shard": int(n), "pieces": _pieces_packed([own[i] for i in order[a:b]])} for n, a, b in zip(names, starts, ends)]
            code = pack(np.array(counts, np.int64), at[np.concatenate(places)])
            yield rows_of([_home(number)], [number], [code], rows)
            yield rows_of(names, [number] * len(names), [_pieces_packed([own[i] for i in order[a:b]]) for a, b in zip(starts, ends)], rows[:0])
            number += 1

    def rows_of(keys, numbers, blocks, kept: pa.StructArray) -> pa.RecordBatch:
        """Rows of (key, chunk, block, kept); the first one has all of ``kept``."""
        lists = pa.ListArray.from_arrays(pa.array([0] + [len(kept)] * len(keys), pa.int32()), kept)
        arrays = [pa.array(keys, pa.int64()), pa.array(numbers, pa.int64()), pa.array(blocks, pa.binary()), lists]
        return pa.RecordBatch.from_arrays(arrays, ["key", "chunk", "block", "kept"])

    def answer(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            asked = asked[:0]
        homes = [_home(n) for n in asked.column("chunk").to_pylist()]
        made = list(answers_to((b.as_py() for b in asked.column("block")), Tables.get(shared.value)))
        arrays = [pa.array(homes, pa.int64()), asked.column("key"), pa.array(made, pa.binary())]
        return pa.Table.from_arrays(arrays, ["home", "shard", "ids"])

    def join(chunk: pa.Table, answered: pa.Table) -> pa.Table:
        names = [*(f"k{i}" for i in range(len(keep))), "ids"]
        if not chunk.num_rows or chunk.column("key")[0].as_py() >= 0:
            none = pa.concat_arrays(chunk.column("kept").chunks).flatten()[:0] if chunk.num_rows else None
            rows = none.flatten() if none is not None else [pa.nulls(0) for _ in keep]
            return pa.Table.from_arrays([*rows, pa.array([], pa.list_(pa.int32()))], names)
        counts, place = unpack(chunk.column("block")[0].as_py())
        blocks = [unpack(b) for b in answered.sort_by("shard").column("ids").to_pylist()]
        sizes = np.concatenate([b[0] for b in blocks]) if blocks else np.zeros(0, np.int32)
        values = np.concatenate([b[1] for b in blocks]) if blocks else np.zeros(0, np.int32)
        ids = _by_place(values, sizes.astype(np.int64), place)
        before = np.append(0, np.cumsum(sizes[place], dtype=np.int64))
        ends = before[np.append(0, np.cumsum(counts))]
        rows = pa.concat_arrays(chunk.column("kept").chunks).flatten()
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        return pa.Table.from_arrays([*rows.flatten(), lists], names)

    # Rows for shards and rows of chunks go through one exchange, which both readers share, so texts are cut once and no
    # position is written twice. Each reader passes over the other's groups itself: a filter would part the exchange in two.
    sent = used.mapInArrow(cut, f"key long, chunk long, block binary, kept {kept}")
    answers = sent.groupBy("key").applyInArrow(answer, "home long, shard long, ids binary")
    fields = ", ".join(f"k{i} {kind}" for i, kind in enumerate(kinds))
    coded = sent.groupBy("key").cogroup(answers.groupBy("home")).applyInArrow(join, f"{fields}, ids array<int>")
    return coded.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "ids")


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), tokenizer: str | None = None):
    """Return ``keep`` and ids (array of int), by a table of pieces in each Python worker."""
    shared = docs.sparkSession.sparkContext.broadcast(read_description(tokenizer or default_tokenizer()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables.get(shared.value)
        for batch in small(batches):
            packed = [tables.encode(raw(t).decode("utf-8", "replace")) for t in bytes_of(batch.column(len(keep)))]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, ids], [*keep, "ids"])

    used = docs.select(*keep, F.col(text).alias("_text"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in used.drop("_text").dtypes)
    return used.mapInArrow(run, f"{fields}, ids array<int>")


def decode(coded: DataFrame, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), tokenizer: str | None = None):
    """Return ``keep`` and decoded."""
    shared = coded.sparkSession.sparkContext.broadcast(read_description(tokenizer or default_tokenizer()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables.get(shared.value)
        for batch in small(batches):
            lists = batch.column(len(keep))
            texts = [tables.decode(x.values.to_numpy() if x.is_valid else np.zeros(0, int)) for x in lists]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keep, "decoded"])

    used = coded.select(*keep, F.col(ids).alias("_ids"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in used.drop("_ids").dtypes)
    return used.mapInArrow(run, f"{fields}, decoded string")


def digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.array_join(ids, ","), 256)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_distinct(table(spark, sf_dir, "documents"))
    back = decode(coded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("sha", digest(F.col("ids"))), keep=("doc_id", "n_tokens", "sha"))
    return back.select(
        "doc_id", "n_tokens", F.col("sha").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
