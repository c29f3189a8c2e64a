"""Finding repeated windows of a corpus without moving every window.

A window is ``length`` consecutive symbols (bytes, or word hashes) of one document. Each window
names an anchor: the position of the smallest hash among its ``gram``-symbol grams, leftmost on
ties. The choice depends on the window's content only, so equal windows have equal anchors at
equal offsets. Consecutive windows with one anchor form a run; about one run starts every
``(length - gram) / 2`` symbols.

1. *Sieve.* Each run is sent to the shard of its anchor's gram as two hashes: of the gram, and of the
   whole run. A gram met once means its windows repeat nowhere. Equal runs are repeats in full. Only
   runs whose gram is known and whose own content is not stay open.
2. *Resolve.* Open runs are sent as texts, again by gram, and a method given by the caller decides each window
   exactly. Equal windows always meet, as they have equal grams.
3. *Finish.* What was found goes back to the documents.

Documents travel in chunks of about 2 MB. Within a chunk only the first of equal runs is sent, so a
passage that a third of all documents share arrives once per chunk. A gram that has many
different runs in one chunk (the edge of such a passage) is *crowded*: its runs skip the sieve, one of
them stands in for the rest, and their windows are dealt out by their own hash, which splits them over
all shards. All hashes have 64 bits, and a run is equal only if both of its hashes are.

Rows are told apart by their place in the table, so the input has to be a scan whose rows come
in the same order when a task is repeated, such as a table read from Parquet.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, partitions, stored

CHUNK_BYTES = 2_000_000
#: Windows looked at in one go.
PIECE = 1 << 20
#: Different runs of one gram in a chunk from which the gram is crowded.
CROWDED = 16
#: Where rows without an id stand in the order: last.
NO_ID = np.iinfo(np.int64).max

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        steps = np.full(n, _BASE if which == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = _powers[which] = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Sums:
    """Hashes of any stretch of a sequence of symbols, from one running sum."""

    def __init__(self, symbols: np.ndarray):
        self.total = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + _U(1)) * _power("up", len(symbols)), out=self.total[1:])
        self.down = _power("down", len(symbols) + 1)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.down[start])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block; bytes of equal weight stand together, which is what compresses."""
    head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode() + b"\n"
    body = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T) for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *body]))


def unpack(block: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    at = data.index(b"\n") + 1
    arrays = []
    for kind, n in json.loads(data[:at]):
        dtype = np.dtype(kind)
        raw = np.frombuffer(data, np.uint8, n * dtype.itemsize, at)
        arrays.append(np.ascontiguousarray(raw.reshape(dtype.itemsize, n).T).view(dtype).ravel())
        at += n * dtype.itemsize
    return arrays


@dataclass
class Chunk:
    """Some documents: ids, sorted, null ones (``known`` is false) last, ties as in the table; their bytes, one after another; row numbers."""

    ids: np.ndarray
    ends: np.ndarray
    data: bytes
    rows: np.ndarray
    known: np.ndarray

    def pack(self) -> bytes:
        return pack(self.ids, self.ends, np.frombuffer(self.data, np.uint8), self.rows, self.known)

    @staticmethod
    def unpack(block: bytes) -> Chunk:
        ids, ends, data, rows, known = unpack(block)
        return Chunk(ids, ends, data.tobytes(), rows, known)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)


def chunked(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[int, Chunk]]:
    """Chunks of a partition's rows (doc_id, text, row) and their numbers; the same ones whenever it is read."""
    first = TaskContext.get().partitionId() << 32
    ids: list = []
    rows: list[int] = []
    texts: list[bytes] = []
    size = made = 0
    most = most or CHUNK_BYTES

    def close() -> tuple[int, Chunk]:
        keys = np.array([NO_ID if i is None else i for i in ids], np.int64)
        known = np.array([i is not None for i in ids], bool)
        order = np.lexsort((~known, keys))
        ends = np.cumsum([len(texts[i]) for i in order], dtype=np.int64)
        return first + made, Chunk(keys[order], ends, b"".join([texts[i] for i in order]), np.array(rows, np.int64)[order], known[order])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts_of = part.column(1).cast(pa.binary()).to_pylist()
            for i, text, row in zip(part.column(0).to_pylist(), texts_of, part.column(2).to_pylist()):
                ids.append(i)
                rows.append(row)
                texts.append(text or b"")
                size += len(texts[-1]) + 16
                if size >= most:
                    yield close()
                    ids, rows, texts, size, made = [], [], [], 0, made + 1
    if ids:
        yield close()


@dataclass
class Sequence:
    """A chunk as symbols: documents are ``starts[i]:ends[i]``."""

    symbols: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


@dataclass
class Runs:
    """Runs of windows with one anchor: first window, number of windows, hash of the gram, hash of all."""

    start: np.ndarray
    n: np.ndarray
    gram: np.ndarray
    whole: np.ndarray
    first: np.ndarray  # whether the run is the first with its hashes in the chunk
    twice: np.ndarray  # whether the chunk has another with its hashes
    crowded: np.ndarray


def find_runs(seq: Sequence, length: int, gram: int) -> Runs:
    """All runs of a chunk, in order."""
    parts = []
    n = len(seq.symbols)
    valid = np.zeros(n + 1, np.int8)
    long = seq.ends - seq.starts >= length
    np.add.at(valid, seq.starts[long], 1)
    np.add.at(valid, seq.ends[long] - length + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    opens = np.zeros(n, bool)
    opens[seq.starts[seq.starts < n]] = True
    span = length - gram + 1
    for low in range(0, max(0, n - length + 1), PIECE):
        high = min(low + PIECE, n - length + 1)
        fit = valid[low:high]
        if not fit.any():
            continue
        sums = Sums(seq.symbols[low : high + length - 1])
        grams = high - low + span - 1
        at = np.arange(grams)
        hashed = sums.hashes(at, at + gram)
        packed = (hashed >> _U(22) << _U(22)) | at.astype(np.uint64)
        padded = np.full(-(-(grams + 1) // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:grams] = packed
        square = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(square, axis=1).ravel()
        back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[: high - low], ahead[span - 1 : span - 1 + high - low])
        anchor = (least & _U((1 << 22) - 1)).astype(np.int64)
        new = np.ones(high - low, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~fit[:-1] | opens[low + 1 : high]
        begin = np.flatnonzero(new & fit)
        stops = np.append(np.flatnonzero(new | ~fit), high - low)
        stop = stops[np.searchsorted(stops, begin, "right")]
        count, where = stop - begin, anchor[begin]
        content = sums.hashes(begin, stop - 1 + length)
        shape = mix(((where - begin) * (2 * length) + count).astype(np.uint64))
        parts.append((begin + low, count, hashed[where], mix(content ^ shape)))
    if not parts:
        none, zero = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return Runs(none, none, zero, zero, none > 0, none > 0, none > 0)
    start, count, grams_, whole = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((np.arange(len(start)), whole, grams_))
    same = np.zeros(len(start), bool)
    same[1:] = (grams_[order][1:] == grams_[order][:-1]) & (whole[order][1:] == whole[order][:-1])
    first = np.ones(len(start), bool)
    first[order[same]] = False
    twice = np.zeros(len(start), bool)
    twice[order[same]] = True
    twice[order[np.flatnonzero(same) - 1]] = True
    classes, place, size = np.unique(grams_[first], return_inverse=True, return_counts=True)
    crowded = np.zeros(len(start), bool)
    crowded[np.flatnonzero(first)[size[place] >= CROWDED]] = True
    return Runs(start, count, grams_, whole, first, twice, crowded)


def owners(starts: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the document that holds each position; ``starts`` may repeat where documents are empty."""
    return np.searchsorted(starts, positions, "right") - 1


def shards_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(hashes ^ _U(0x5851F42D4C957F2D)) % _U(shards)).astype(np.int64)


def by_shard(shard: np.ndarray, chunk: int, *columns: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), chunk, pack(*(c[part] for c in columns))


def _blocks(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    if rows:
        shard, chunk, block = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(chunk, pa.int64()), pa.array(block, pa.binary())], ["shard", "chunk", "block"])


class Method:
    """What the caller of ``repeated`` brings along."""

    length: int
    gram: int
    #: The first of equal windows counts as new, in order of document id and place.
    first_is_new: bool

    def sequence(self, chunk: Chunk) -> Sequence:
        raise NotImplementedError

    def segment(self, chunk: Chunk, seq: Sequence, start: int, n: int) -> bytes:
        """Text of ``n`` windows from ``start``."""
        raise NotImplementedError

    def resolve(self, texts: list[bytes], n: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
        """For each segment, which of its ``n`` windows are repeats; ``order`` sorts segments from first to last."""
        raise NotImplementedError

    def finish(self, chunk: Chunk, seq: Sequence, repeats: np.ndarray) -> pd.DataFrame:
        """Rows of the result; ``repeats`` has the positions of windows that are repeats."""
        raise NotImplementedError


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text, _row: what ``chunked`` reads."""
    used = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return numbered(used, "_row")


def repeated(docs: DataFrame, method: Method, schema: str) -> DataFrame:
    """Run the three steps over ``docs`` (doc_id, text); ``schema`` is that of ``method.finish``."""
    shards = 4 * partitions(docs.sparkSession)
    used = scanned(docs)

    def texts(batches):
        for number, chunk in chunked(batches):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([chunk.pack()], pa.binary())], ["chunk", "block"])

    def entries(batches):
        for number, chunk in chunked(batches):
            seq = method.sequence(chunk)
            runs = find_runs(seq, method.length, method.gram)
            send = runs.first & ~runs.crowded
            # One run stands in for all of a crowded gram.
            crowd = np.flatnonzero(runs.crowded)
            _, one = np.unique(runs.gram[crowd], return_index=True)
            send[crowd[one]] = True
            index = np.flatnonzero(send)
            ids = chunk.ids[owners(seq.starts, runs.start[index])]
            order = np.argsort(runs.gram[index], kind="stable")
            index, ids = index[order], ids[order]
            flags = runs.twice[index].astype(np.uint8) + 2 * runs.crowded[index].astype(np.uint8)
            yield from _blocks(
                by_shard(shards_of(runs.gram[index], shards), number, runs.gram[index], runs.whole[index], index.astype(np.uint32), ids, flags)
            )

    def sift(rows: pd.DataFrame) -> pd.DataFrame:
        """Verdicts per chunk on the runs of one shard: repeat, open, or open and crowded."""
        rows = rows.sort_values("chunk")
        parts = [unpack(b) for b in rows["block"]]
        chunk = np.repeat(rows["chunk"].to_numpy(), [len(p[0]) for p in parts])
        gram, whole, index, ids, flags = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((index, chunk, ids, whole, gram)) if method.first_is_new else np.lexsort((whole, gram))
        gram, whole = gram[order], whole[order]
        new_gram, new = np.ones(len(gram), bool), np.ones(len(gram), bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        new[1:] = new_gram[1:] | (whole[1:] != whole[:-1])
        group = np.cumsum(new_gram) - 1
        crowded = np.bincount(group, (flags[order] & 2) > 0)[group] > 0
        many = (np.bincount(group, new)[group] > 1) | crowded
        if method.first_is_new:
            repeat = ~new
        else:
            kind = np.cumsum(new) - 1
            repeat = (np.bincount(kind)[kind] > 1) | ((flags[order] & 1) > 0)
            # All runs of a kind are repeats, and one of them stands for the kind where other kinds are compared.
            many &= new | ~repeat | crowded
        # A stand-in for a crowded gram is open as the rest of its gram.
        repeat &= (flags[order] & 2) == 0
        stay = many & ~repeat if method.first_is_new else many
        verdict = np.where(stay, np.where(crowded, 3, 2), 0) + np.where(repeat & ~stay, 1, 0) + np.where(repeat & stay, 4, 0)
        keep = verdict > 0
        chunk, index, verdict = chunk[order][keep], index[order][keep], verdict[keep].astype(np.uint8)
        made = []
        back = np.lexsort((index, chunk))
        for part in np.split(back, np.flatnonzero(np.diff(chunk[back])) + 1):
            if len(part):
                made.append((int(chunk[part[0]]), pack(index[part], verdict[part])))
        return pd.DataFrame(made, columns=["chunk", "block"])

    def cut(texts: pd.DataFrame, verdicts: pd.DataFrame) -> pd.DataFrame:
        """Texts of the open runs of one chunk."""
        if not len(texts):
            return pd.DataFrame({"shard": [], "chunk": [], "block": []})
        number, chunk = int(texts["chunk"].iloc[0]), Chunk.unpack(texts["block"].iloc[0])
        seq = method.sequence(chunk)
        runs = find_runs(seq, method.length, method.gram)
        verdict = _verdicts(runs, verdicts["block"])
        rows = []
        plain = np.flatnonzero((verdict == 2) | (verdict == 6))
        start, n, route = runs.start[plain], runs.n[plain], shards_of(runs.gram[plain], shards)
        crowd = np.flatnonzero((verdict == 3) | (verdict == 7))
        if len(crowd):
            each = np.concatenate([np.arange(s, s + k) for s, k in zip(runs.start[crowd], runs.n[crowd])])
            hashes = window_hashes(seq, each, method.length)
            _, one = np.unique(hashes, return_index=True)
            start = np.concatenate([start, each[one]])
            n = np.concatenate([n, np.ones(len(one), np.int64)])
            route = np.concatenate([route, shards_of(hashes[one], shards)])
        texts_ = [method.segment(chunk, seq, int(s), int(k)) for s, k in zip(start, n)]
        ids = chunk.ids[owners(seq.starts, start)] if len(start) else np.zeros(0, np.int64)
        order = np.argsort(route, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(route[order])) + 1):
            if len(part):
                sizes = np.array([len(texts_[i]) for i in part], np.int64)
                data = np.frombuffer(b"".join([texts_[i] for i in part]), np.uint8)
                rows.append((int(route[part[0]]), number, pack(start[part], n[part].astype(np.uint16), ids[part], sizes, data)))
        return pd.DataFrame(rows, columns=["shard", "chunk", "block"])

    def resolve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        parts = [unpack(b) for b in rows["block"]]
        chunk = np.repeat(rows["chunk"].to_numpy(), [len(p[0]) for p in parts])
        start, n, ids, sizes = (np.concatenate(x) for x in list(zip(*parts))[:4])
        texts: list[bytes] = []
        for p in parts:
            data, ends = p[4].tobytes(), np.cumsum(p[3])
            texts += [data[e - s : e] for s, e in zip(p[3], ends)]
        found = method.resolve(texts, n.astype(np.int64), np.lexsort((start, chunk, ids)))
        made = []
        counts = np.array([f.sum() for f in found])
        hit = np.flatnonzero(counts)
        at = np.concatenate([start[i] + np.flatnonzero(found[i]) for i in hit]) if len(hit) else np.zeros(0, np.int64)
        of = np.repeat(chunk[hit], counts[hit])
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(of)) + 1):
            if len(part):
                made.append((int(of[part[0]]), pack(at[part])))
        return pd.DataFrame(made, columns=["chunk", "block"])

    def finish(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame()
        chunk = Chunk.unpack(texts["block"].iloc[0])
        seq = method.sequence(chunk)
        runs = find_runs(seq, method.length, method.gram)
        verdict = _verdicts(runs, found["block"][found["kind"] == 0])
        # Runs repeated within the chunk share what is known of the first; they are repeats themselves.
        repeat = (verdict == 1) | (verdict >= 4) | (~runs.first if method.first_is_new else runs.twice)
        windows = [np.arange(s, s + k) for s, k in zip(runs.start[repeat], runs.n[repeat])]
        windows += [unpack(b)[0] for b in found["block"][found["kind"] == 1]]
        crowd = np.flatnonzero((verdict == 3) | (verdict == 7))
        at = np.concatenate([np.zeros(0, np.int64), *windows])
        if len(crowd):
            each = np.concatenate([np.arange(s, s + k) for s, k in zip(runs.start[crowd], runs.n[crowd])])
            hashes = window_hashes(seq, each, method.length)
            _, one, place, size = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            if method.first_is_new:
                again = np.ones(len(each), bool)
                again[one] = False
            else:
                again = (size > 1)[place] | np.isin(each[one], at)[place]
            at = np.concatenate([at, each[again]])
        return method.finish(chunk, seq, np.unique(at))

    held = used.mapInArrow(texts, "chunk long, block binary")
    verdicts = stored(
        used.mapInArrow(entries, "shard long, chunk long, block binary").groupBy("shard").applyInPandas(sift, "chunk long, block binary"),
        "verdicts",
    )
    found = (
        held.groupBy("chunk")
        .cogroup(verdicts.groupBy("chunk"))
        .applyInPandas(cut, "shard long, chunk long, block binary")
        .groupBy("shard")
        .applyInPandas(resolve, "chunk long, block binary")
    )
    both = verdicts.withColumn("kind", F.lit(0)).unionByName(found.withColumn("kind", F.lit(1)))
    return held.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(finish, schema)


def _verdicts(runs: Runs, blocks: pd.Series) -> np.ndarray:
    """0 nothing, 1 repeat, 2 open, 3 open and crowded; 4 more if open and repeat."""
    verdict = np.where(runs.crowded, 3, 0).astype(np.uint8)
    for block in blocks:
        index, value = unpack(block)
        own = ~runs.crowded[index]
        verdict[index[own]] = value[own]
    return verdict


def window_hashes(seq: Sequence, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window; ``at`` is sorted."""
    out = np.zeros(len(at), np.uint64)
    for low in range(0, int(at[-1]) + 1, PIECE) if len(at) else ():
        a, b = np.searchsorted(at, [low, low + PIECE])
        if b > a:
            sums = Sums(seq.symbols[low : low + PIECE + length])
            out[a:b] = sums.hashes(at[a:b] - low, at[a:b] - low + length)
    return out
