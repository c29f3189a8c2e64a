"""SimHash near-duplicates, linked with the pigeonring filter.

Two fingerprints at most ``bits`` apart are cut into ``bits + 1`` segments on a ring. Then some
segment starts a chain in which the first l segments differ in at most ``l * bits / (bits + 1)``
bits, for every l. So the first one is equal, the first two differ in one bit at most, and so on.

Candidates come from the start of the chain: rows are grouped by (segment, its value), or, for
``chain=2`` and for crowded groups, by that and the next segment with one bit left out. Within a
group the rest of the chain is checked segment by segment, then the whole distance. Groups
stream through sorted partitions; what leaves a task is a forest of links, never all pairs, so
a clique of near-copies costs as many rows as it has members.

Documents with one fingerprint are one node. Components are by star contraction.

With a similarity to reach, nodes are distinct shingle sets (by a 64-bit hash of the set) instead, fingerprints count each
shingle once, and links are decided on the sets, those of nodes with one fingerprint too. Of the candidates of a task a forest is checked first. Nodes of candidates outside the forests are grouped again, with bitmaps
of their sets, which bound from above what two sets share: in the tasks they rule out pairs that cannot be that similar, and
none that are. Every candidate pair that is left and that checked links have not joined by then is checked too. So the classes are those of all
candidate pairs, however they fall into tasks. Set sizes go with the nodes: pairs whose sizes rule the similarity out are
no candidates. A pair counts in the first group that it shares only.

Defined results: a null or empty text has fingerprint zero and is linked like any other; a
null id never is a component's name unless all ids of the component are null; rows with one
id or text stay rows of their own; texts are words of any bytes, so what is no UTF-8 is hashed as it stands; texts of any
length are whole; columns not named here are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Sealed, bytes_of, numbered, partitions, raw, stored, table
from tidemark.llm.components import components

#: Fixed value: the seed of the shingle hash.
SEED = 42
WIDTH = 64
#: A group of more fingerprints than this is dealt out again by the next segment of the chain.
CROWDED = 200_000
#: The same inside a task, where no shuffle is needed for it.
CROWDED_IN_TASK = 1024
#: Links held in a task before they are reduced to a forest.
LINKS_HELD = 1_000_000
WORDS_AT_ONCE = 200_000
#: Rows of groups compared at once.
ROWS_AT_ONCE = 100_000
#: Bits of a shingle set's bitmap, and pairs of bitmaps compared at once.
SKETCH = 4096
PAIRS_AT_ONCE = 20_000


def segments(bits: int) -> list[tuple[int, int]]:
    """(offset, width) of the ``bits + 1`` segments, the first ones a bit wider where 64 does not divide."""
    m = bits + 1
    widths = [WIDTH // m + (i < WIDTH % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def fingerprint(text: str | bytes | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = raw(text).lower().split()
    n = max(len(words) - shingle + 1, 1 if words else 0)
    ones, digest = np.zeros(WIDTH, np.int64), xxhash.xxh64_intdigest
    for start in range(0, n, WORDS_AT_ONCE):
        stop = min(n, start + WORDS_AT_ONCE)
        h = np.fromiter((digest(b" ".join(words[i : i + shingle]), SEED) for i in range(start, stop)), "<u8", stop - start)
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, WIDTH).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def set_fingerprint(shingles: np.ndarray) -> int:
    """The fingerprint of a set of shingles, each counted once however often a text repeats it, as a signed 64-bit number."""
    ones = np.zeros(WIDTH, np.int64)
    for start in range(0, len(shingles), WORDS_AT_ONCE):
        part = shingles[start : start + WORDS_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, WIDTH).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Return ``keep`` and fp (long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in bytes_of(batch.column(len(keep)))]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], [*keep, "fp"])

    used = docs.select(*keep, F.col("text").alias("_text"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in used.drop("_text").dtypes)
    return used.mapInArrow(run, f"{fields}, fp long")


def _joined(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those links that join the components already, the closest ones first."""
    used = spanning(a, b, np.bitwise_count(a ^ b))
    return a[used], b[used]


def spanning(a: np.ndarray, b: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Places of the links of a forest: every component picks its link with the least ``gap``, components merge, and so on."""
    order = np.argsort(gap, kind="stable")
    a, b = a[order], b[order]
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    label, used = np.arange(len(nodes)), np.zeros(len(a), bool)
    left = np.arange(len(a))
    while True:
        left = left[label[u[left]] != label[v[left]]]
        if not len(left):
            return order[used]
        first = np.full(len(nodes), len(a))
        np.minimum.at(first, label[u[left]], left)
        np.minimum.at(first, label[v[left]], left)
        used[first[first < len(a)]] = True
        label = _joined(len(nodes), u[used], v[used])


class Linker:
    """Checks groups of fingerprints that share the start of a chain and keeps a forest of links."""

    def __init__(self, bits: int):
        self.bits, self.ring = bits, segments(bits)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held = 0

    def _masks(self, start: int) -> list[tuple[np.uint64, int]]:
        """Mask and budget of each longer chain from ``start``."""
        m, mask, found = len(self.ring), 0, []
        for step in range(m):
            offset, width = self.ring[(start + step) % m]
            mask |= ((1 << width) - 1) << offset
            found.append((np.uint64(mask), (step + 1) * self.bits // m))
        return found[1:]

    def groups(self, fps: np.ndarray, ends: np.ndarray, start: int) -> None:
        """``fps`` in runs; ``ends[i]`` is where the run of place i ends."""
        checks = self._masks(start)
        places, shift = np.arange(len(fps)), 1
        while True:
            places = places[places + shift < ends[places]]
            if not len(places):
                return
            left, right = fps[places], fps[places + shift]
            for mask, budget in checks:
                fit = np.bitwise_count((left ^ right) & mask) <= budget
                left, right = left[fit], right[fit]
            self.add(left, right)
            shift += 1

    def crowd(self, fps: np.ndarray, start: int) -> None:
        """A large group: grouped again by the next segment with each of its bits left out in turn."""
        offset, width = self.ring[(start + 1) % len(self.ring)]
        segment = np.uint64(((1 << width) - 1) << offset)
        for bit in range(offset, offset + width):
            key = fps & segment & ~np.uint64(1 << bit)
            order = np.lexsort((fps, key))
            key = key[order]
            self.groups(fps[order], np.searchsorted(key, key, "right"), start)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            a, b = np.minimum(a, b), np.maximum(a, b)
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > LINKS_HELD:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.uint64)
        a, b = forest(np.concatenate([none, *self.a]), np.concatenate([none, *self.b]))
        self.a, self.b, self.held = [a], [b], 0
        return a, b


def _link_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = Linker(bits)
        rest: list[np.ndarray] = [np.zeros(0, np.int64) for _ in range(4)]

        def finish(seg, val, cut, fp) -> None:
            """Whole groups, sorted by (seg, val, cut)."""
            new = np.ones(len(fp), bool)
            new[1:] = (seg[1:] != seg[:-1]) | (val[1:] != val[:-1]) | (cut[1:] != cut[:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(fp)))
            crowded = (sizes > CROWDED_IN_TASK) & (cut[starts] < 0)
            for at, size in zip(starts[crowded], sizes[crowded]):
                linker.crowd(fp[at : at + size], int(seg[at]))
            plain = np.repeat(~crowded & (sizes > 1), sizes)
            for s in range(bits + 1):
                own = plain & (seg == s)
                if own.any():
                    fps, runs = fp[own], np.cumsum(new)[own]
                    linker.groups(fps, np.searchsorted(runs, runs, "right"), s)

        for batch in batches:
            seg, val, cut = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            seg, val, cut, fp = (np.concatenate([r.view(x.dtype) if len(r) else r.astype(x.dtype), x]) for r, x in zip(rest, (seg, val, cut, fp)))
            last = (seg == seg[-1]) & (val == val[-1]) & (cut == cut[-1])
            split = len(fp) - int(last[::-1].argmin()) if not last.all() else 0
            finish(seg[:split], val[:split], cut[:split], fp[:split])
            rest = [x[split:] for x in (seg, val, cut, fp)]
        if len(rest[0]):
            finish(*rest[:3], rest[3].view(np.uint64))
        a, b = linker.reduce()
        for at in range(0, len(a), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(a[part].view(np.int64)), pa.array(b[part].view(np.int64))], ["a", "b"])

    return run


def _value(fp, offset: int, width: int):
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def links(distinct: DataFrame, bits: int = 2, chain: int = 1) -> DataFrame:
    """Links (a, b) whose components are those of all pairs at most ``bits`` apart.

    ``distinct`` has each fingerprint once. ``chain`` is how many segments a group shares; 2 suits
    distances whose single segments are too short to tell groups apart.
    """
    fp = F.col("fp")
    if bits < 1:
        return distinct.select(fp.alias("a"), fp.alias("b")).limit(0)
    n = partitions(distinct.sparkSession)
    sorted_ = keyed(distinct, bits, chain).repartition(n, "seg", "val", "cut").sortWithinPartitions("seg", "val", "cut", "fp")
    return sorted_.select(F.col("seg").cast("long"), "val", F.col("cut").cast("long"), "fp").mapInArrow(_link_task(bits), "a long, b long")


def keyed(distinct: DataFrame, bits: int, chain: int) -> DataFrame:
    """The groups (seg, val, cut) of each row, with the row's columns."""
    ring = segments(bits)
    fp, own = F.col("fp"), distinct.columns

    def start(i: int):
        return F.struct(F.lit(i).alias("seg"), _value(fp, *ring[i]).alias("val"), F.lit(-1).alias("cut"))

    def longer(i: int):
        """The chain's first segment and the next one without bit j, for each j."""
        (offset, width), (next_offset, next_width) = ring[i], ring[(i + 1) % len(ring)]
        first = F.shiftleft(_value(fp, offset, width), 32)
        second = _value(fp, next_offset, next_width)
        return F.transform(
            F.sequence(F.lit(0), F.lit(next_width - 1)),
            lambda j: F.struct(
                F.lit(i).alias("seg"),
                first.bitwiseOR(second).bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), j))).alias("val"),
                j.alias("cut"),
            ),
        )

    def all_longer(i):
        return F.element_at(F.array(*[longer(k) for k in range(len(ring))]), i + 1)

    if chain > 1:
        every = F.flatten(F.array(*[longer(i) for i in range(len(ring))]))
        return distinct.select(F.explode(every).alias("k"), *own).select("k.*", *own)
    single = distinct.select(F.explode(F.array(*[start(i) for i in range(len(ring))])).alias("k"), *own).select("k.*", *own)
    counts = single.groupBy("seg", "val").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    marked = single.join(counts, ["seg", "val"])
    few = marked.filter(F.col("_n") <= CROWDED).select("seg", "val", "cut", *own)
    many = marked.filter(F.col("_n") > CROWDED).select(F.explode(all_longer(F.col("seg"))).alias("k"), *own).select("k.*", *own)
    return few.unionByName(many)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """A bitmap of a shingle set: bit h mod ``SKETCH`` for each hash h.

    A bit that one set has and another has not stands for at least one shingle that the other set lacks, so two bitmaps bound
    the shingles that two sets share from above.
    """
    bits = np.zeros(SKETCH, np.uint8)
    bits[(shingles % np.uint64(SKETCH)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


class Candidates:
    """Pairs of nodes with fingerprints at most ``bits`` apart, sizes that allow the similarity and, where there are any, sketches that do."""

    def __init__(self, bits: int, similarity: float, whole: bool):
        """``whole``: all pairs that no root joins yet; otherwise a forest, and each node of the other pairs with itself."""
        self.bits, self.similarity, self.whole = bits, similarity, whole
        self.ring = [np.uint64(((1 << w) - 1) << offset) for offset, w in segments(bits)]
        self.held, self.n, self.flagged = [], 0, [np.zeros(0, np.int64)]

    def alike(self, left: np.ndarray, right: np.ndarray, size: np.ndarray, sketches: np.ndarray) -> np.ndarray:
        """Whether the bitmaps leave room for the similarity; never false for a pair that has it."""
        fit = np.ones(len(left), bool)
        for at in range(0, len(left), PAIRS_AT_ONCE):
            part = slice(at, at + PAIRS_AT_ONCE)
            a, b = sketches[left[part]], sketches[right[part]]
            mine, others = np.bitwise_count(a & ~b).sum(1, dtype=np.int64), np.bitwise_count(b & ~a).sum(1, dtype=np.int64)
            n, m = size[left[part]], size[right[part]]
            shared = np.minimum(n - mine, m - others)
            fit[part] = shared >= self.similarity * (n + m - shared) - 1e-6
        return fit

    def groups(self, seg, val, cut, size, fp, node, root, sketches=None) -> Iterator[pa.RecordBatch]:
        """Whole groups, sorted by (seg, val, cut, size)."""
        new = np.ones(len(fp), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (val[1:] != val[:-1]) | (cut[1:] != cut[:-1])
        run = np.cumsum(new) << 32
        most = np.minimum(np.floor(size / self.similarity + 1e-6), (1 << 32) - 1).astype(np.int64)
        ends = np.searchsorted(run + size, run + most, "right")
        fp, places, shift = fp.view(np.uint64), np.arange(len(fp)), 1
        while True:
            places = places[places + shift < ends[places]]
            if not len(places):
                return
            left = places[np.bitwise_count(fp[places] ^ fp[places + shift]) <= self.bits]
            right = left + shift
            if self.whole:
                open_ = root[left] != root[right]
                left, right = left[open_], right[open_]
            if sketches is not None and len(left):
                fit = self.alike(left, right, size, sketches)
                left, right = left[fit], right[fit]
            if len(left):
                apart = fp[left] ^ fp[right]
                here = self.first(apart, seg[left], cut[left])
                yield from self.add(node[left[here]], node[right[here]], np.bitwise_count(apart[here]))
            shift += 1

    def first(self, apart: np.ndarray, seg: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Whether a pair shares no earlier group."""
        m, here = len(self.ring), np.ones(len(apart), bool)
        for s in range(m):
            after = np.bitwise_count(apart & self.ring[(s + 1) % m])
            meets = ((apart & self.ring[s]) == 0) & (after <= 1)
            here &= ~(meets & (seg > s))
            here &= ~((seg == s) & (after == 0) & (cut > 0))
        return here

    def add(self, a: np.ndarray, b: np.ndarray, gap: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((np.minimum(a, b), np.maximum(a, b), gap))
        self.n += len(a)
        if self.n > LINKS_HELD:
            if self.whole:
                yield from self.out()
            else:
                self.reduce()

    def reduce(self) -> None:
        a, b, gap = (np.concatenate(x) for x in zip(*self.held))
        used = spanning(a, b, gap)
        left = np.ones(len(a), bool)
        left[used] = False
        self.flagged = [np.unique(np.concatenate([*self.flagged, a[left], b[left]]))]
        self.held, self.n = [(a[used], b[used], gap[used])], 0

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.held and not self.whole:
            self.reduce()
        pairs = [(a, b) for a, b, _ in self.held] + [(x, x) for x in self.flagged]
        self.held, self.n, self.flagged = [], 0, []
        for a, b in pairs:
            for at in range(0, len(a), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(a[part]), pa.array(b[part])], ["a", "b"])


def candidates(nodes: DataFrame, bits: int, chain: int, similarity: float, whole: bool) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, fp, size, root and maybe sketch), as ``Candidates`` gives them."""
    if chain < 2:
        raise ValueError("candidates are grouped by two segments of the chain")
    n = partitions(nodes.sparkSession)
    rows = keyed(nodes, bits, chain).repartition(n, "seg", "val", "cut").sortWithinPartitions("seg", "val", "cut", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rest, waiting = Candidates(bits, similarity, whole), [], 0
        for batch in batches:
            numbers = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:7]]
            bitmaps = [np.frombuffer(b"".join(c.to_pylist()), "<u8").reshape(-1, SKETCH // 64) for c in batch.columns[7:]]
            rest.append(numbers + bitmaps)
            waiting += batch.num_rows
            if waiting < ROWS_AT_ONCE:
                continue
            columns = [np.concatenate(c) for c in zip(*rest)]
            last = np.logical_and.reduce([c == c[-1] for c in columns[:3]])
            split = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            if split:
                yield from found.groups(*(c[:split] for c in columns))
            rest = [[c[split:] for c in columns]]
            # A long group is not put together again with every batch.
            waiting = 0
        if rest:
            yield from found.groups(*(np.concatenate(c) for c in zip(*rest)))
        yield from found.out()

    more = ["sketch"] if "sketch" in nodes.columns else []
    used = rows.select(F.col("seg").cast("long"), "val", F.col("cut").cast("long"), "size", "fp", "node", "root", *more)
    return used.mapInArrow(run, "a long, b long")


def bits_for(similarity: float) -> int:
    """Expected distance of two texts whose shingle sets have this Jaccard similarity."""
    return int(WIDTH * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def shingle_set(text: str | bytes | None, shingle: int) -> np.ndarray:
    """Hashes of a text's distinct shingles, sorted."""
    words = raw(text).lower().split()
    n = max(len(words) - shingle + 1, 1 if words else 0)
    found = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)), "<u8", n)
    return np.unique(found)


def set_nodes(docs: DataFrame, shingle: int, keep: tuple[str, ...]) -> DataFrame:
    """Return ``keep``, fp (of the set of shingles), node (hash of the set) and size (of the set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in bytes_of(batch.column(len(keep))):
                own = shingle_set(text, shingle)
                found.append((set_fingerprint(own), xxhash.xxh64_intdigest(own.tobytes(), SEED), len(own)))
            numbers = np.array([(f, n - (1 << 64) if n >> 63 else n, size) for f, n, size in found], np.int64).reshape(-1, 3)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.ascontiguousarray(c)) for c in numbers.T)], [*keep, "fp", "node", "size"])

    used = docs.select(*keep, F.col("text").alias("_text"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in used.drop("_text").dtypes)
    return used.mapInArrow(run, f"{fields}, fp long, node long, size long")


def with_sketches(nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """``nodes`` (with _row, a row that has the node's set) and the bitmaps of their sets. Only these nodes' texts are read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [sketch(shingle_set(t, shingle)).tobytes() for t in bytes_of(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["node", "sketch"])

    texts = docs.join(nodes.select("node", "_row"), "_row").select("node", "text")
    return nodes.join(texts.mapInArrow(run, "node long, sketch binary"), "node")


def similar(edges: DataFrame, first: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The links whose sets have at least this Jaccard similarity.

    ``first`` has node and _row, a row with the node's set; ``docs`` _row and text. Only texts with a link are read again.
    """
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    texts = first.join(ends, "node", "left_semi").select("node", "_row")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingle_set(t, shingle).tobytes() for t in bytes_of(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["node", "shingles"])

    known = stored(docs.join(texts, "_row").select("node", "text").mapInArrow(sets, "node long, shingles binary"), "shingles")
    left = known.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = known.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    pairs = edges.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(shared >= similarity * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(near, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, chain: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """Return doc_id, fp, root, component_id and ``keep``: the class of every document.

    ``root`` is the smallest fingerprint of the class, ``component_id`` its smallest id.
    """
    marked = stored(fingerprints(docs, shingle, ("doc_id", *keep)), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), bits, chain))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = linked.select("fp", "root").join(names, "root")
    return marked.join(classes, "fp").select("doc_id", "fp", "root", "component_id", *keep)


def similar_classes(docs: DataFrame, shingle: int, bits: int, chain: int, similarity: float) -> DataFrame:
    """Return doc_id, _row, node and root for ``docs`` (doc_id, text, _row): classes of pairs that are candidates and this similar."""
    marked = stored(set_nodes(docs, shingle, ("doc_id", "_row")), "simhash")
    nodes = stored(marked.groupBy("node").agg(F.first("fp").alias("fp"), F.first("size").alias("size"), F.min("_row").alias("_row")), "simhash-nodes")
    texts = docs.select("_row", "text")
    found = stored(candidates(nodes.select("node", "fp", "size", F.col("node").alias("root")), bits, chain, similarity, False).distinct(), "links")
    tried = found.filter("a <> b")
    edges = stored(similar(tried, nodes, texts, shingle, similarity), "similar")
    roots = components(edges)
    again = found.filter("a = b").select(F.col("a").alias("node"))
    again = nodes.join(again, "node", "left_semi").join(roots, "node", "left")
    again = stored(again.select("node", "fp", "size", F.coalesce("root", "node").alias("root"), "_row"), "open-nodes")
    again = stored(with_sketches(again, texts, shingle).drop("_row"), "open-sketches")
    rest = stored(candidates(again, bits, chain, similarity, True).join(tried, ["a", "b"], "left_anti"), "open-links")
    roots = components(edges.unionByName(similar(rest, nodes, texts, shingle, similarity)))
    return marked.join(roots, "node", "left").select("doc_id", "_row", "node", F.coalesce("root", "node").alias("root"))


def one_of_each(docs: DataFrame, shingle: int, bits: int, chain: int, similarity: float) -> DataFrame:
    """The document with the smallest id of each class (no id: last; then the first in the table), with all columns."""
    sealed = Sealed(docs, ("doc_id", "text"))
    rows = numbered(sealed.rows, "_row")
    classes = similar_classes(rows.select("doc_id", "text", "_row"), shingle, bits, chain, similarity)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"]
    chosen = classes.groupBy("root").agg(first.alias("_row")).select("_row")
    return sealed.open(rows.join(chosen, "_row", "left_semi"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
