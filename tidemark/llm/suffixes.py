"""Substring dedup with a logarithmic family of suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier is removed. Earlier means:
in a document with a smaller id (ties: further up in the table; no id: last), or further left.

Which windows have to meet is found by the sieve in ``anchors``; per shard, the open texts are then
indexed in order. They come in batches. A batch gets a suffix array of its open windows, which is
merge-scanned against every level of the index for matches of ``LENGTH`` bytes; what is new becomes the
youngest level, and levels merge while the younger one is as large as the older, so there are
logarithmically many. Batches come in order of documents, so a match in a level is an earlier one.

Defined results: a null text is empty; documents shorter than ``LENGTH`` bytes lose nothing and give
nothing; of repeated rows (same id and text) the first in the table stays; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.anchors import PIECE, Chunk, Method, Sequence, Sums, repeated
from tidemark.llm.common import table

#: Fixed value: bytes of a string that counts as repeated.
LENGTH = 100
GRAM = 32
BATCH = 1 << 16


class SuffixArrays:
    """Sorted arrays of the windows seen so far, youngest last; sizes fall by half or more."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, windows: np.ndarray) -> np.ndarray:
        """Index a batch of windows, in order; return which of them are already known or stand earlier in the batch."""
        order = np.argsort(windows, kind="stable")
        ordered = windows[order]
        seen = np.zeros(len(windows), bool)
        seen[1:] = ordered[1:] == ordered[:-1]
        known = np.zeros(len(windows), bool)
        for level in self.levels:
            at = np.searchsorted(level, ordered)
            inside = at < len(level)
            known[inside] |= level[at[inside]] == ordered[inside]
        self._keep(ordered[~(seen | known)])
        repeats = np.empty(len(windows), bool)
        repeats[order] = seen | known
        return repeats

    def _keep(self, level: np.ndarray) -> None:
        while self.levels and len(self.levels[-1]) <= len(level):
            level = np.sort(np.concatenate([self.levels.pop(), level]), kind="stable")
        if len(level):
            self.levels.append(level)


class Bytes(Method):
    length, gram, first_is_new = LENGTH, GRAM, True

    def __init__(self, with_text: bool = False):
        self.with_text = with_text

    def sequence(self, chunk: Chunk) -> Sequence:
        return Sequence(np.frombuffer(chunk.data, np.uint8), chunk.starts, chunk.ends)

    def segment(self, chunk: Chunk, seq: Sequence, start: int, n: int) -> bytes:
        return chunk.data[start : start + n + self.length - 1]

    def resolve(self, texts: list[bytes], n: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
        data = np.frombuffer(b"".join([texts[i] for i in order]), np.uint8)
        n = n[order]
        base = np.cumsum(n + self.length - 1) - (n + self.length - 1)
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first - base, n)
        # A window whose hash stands alone is no repeat and need not be indexed.
        hashes = np.empty(len(at), np.uint64)
        for low in range(0, len(data), PIECE):
            a, b = np.searchsorted(at, [low, low + PIECE])
            if b > a:
                sums = Sums(data[low : low + PIECE + self.length])
                hashes[a:b] = sums.hashes(at[a:b] - low, at[a:b] - low + self.length)
        by_hash = np.argsort(hashes, kind="stable")
        equal = hashes[by_hash][1:] == hashes[by_hash][:-1]
        open_ = np.zeros(len(at), bool)
        open_[by_hash[1:][equal]] = True
        open_[by_hash[:-1][equal]] = True
        index, repeats = SuffixArrays(), np.zeros(len(at), bool)
        places = np.flatnonzero(open_)
        views = np.lib.stride_tricks.sliding_window_view(data, self.length) if len(data) >= self.length else None
        for low in range(0, len(places), BATCH):
            part = places[low : low + BATCH]
            windows = np.ascontiguousarray(views[at[part]]).view(f"S{self.length}").ravel()
            repeats[part] = index.add(windows)
        found: list[np.ndarray] = [repeats[:0]] * len(texts)
        for i, f, k in zip(order, first, n):
            found[i] = repeats[f : f + k]
        return found

    def finish(self, chunk: Chunk, seq: Sequence, repeats: np.ndarray) -> pd.DataFrame:
        steps = np.zeros(len(chunk.data) + 1, np.int32)
        steps[repeats] += 1
        steps[repeats + self.length] -= 1
        gone = np.cumsum(steps[:-1]) > 0
        data, rows = seq.symbols, []
        for r, i, known, start, end in zip(chunk.rows, chunk.ids, chunk.known, seq.starts, seq.ends):
            cover = gone[start:end]
            kept = data[start:end][~cover].tobytes()
            spans = int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum()) if end > start else 0
            row = [r, i if known else None, end - start, int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()]
            rows.append([*row, kept.decode("utf-8", errors="ignore")] if self.with_text else row)
        names = ["_row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * self.with_text
        made = pd.DataFrame(rows, columns=names)
        # Through floating point, which a column with nulls would take, large ids would lose digits.
        made["doc_id"] = pd.array([row[1] for row in rows], "Int64")
        return made


SCHEMA = "_row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def substring_dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Return _row, doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept.

    ``kept`` is text: bytes of characters that a removed stretch cuts through are left out of it; the
    digest is of the remaining bytes as they are.
    """
    return repeated(docs, Bytes(with_text), SCHEMA + ", kept string" * with_text)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("_row")
