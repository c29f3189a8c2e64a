"""Substring dedup by relative Lempel-Ziv factors.

Every word covered by a window of ``LENGTH`` words that also starts anywhere else is removed, in all
places. Which windows have to meet is found by the sieve in ``anchors``. Each shard is then a reference
block: its open texts, indexed by the rank of the ``LENGTH``-word phrase at every position. The texts are
factored against the block: a factor is copied from one source, another place of the block that
starts with the same phrase, and goes on while the next phrase is found at the source's next place.
Where a factor ends, the phrase across the boundary is looked up anew and may start a factor from another
source. Every factor has at least ``LENGTH`` words, and what factors cover are the duplicate spans.

Defined results: a null text has no words; texts of fewer than ``LENGTH`` words lose nothing; repeated rows are
repeats of each other and lose the same words; bytes that are no UTF-8 are word bytes like any other; texts of any length
are whole; ids may be any long; an empty table gives an empty result; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.anchors import PIECE, Chunk, Method, Sequence, Sums, mix, repeated
from tidemark.llm.common import table

#: Fixed value: words of a window that counts as repeated.
LENGTH = 35
GRAM = 8
#: Bytes from which a word is hashed by itself: sums modulo 2^64 are weak on long words with a pattern, not on short ones.
LONG_WORD = 64

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Words(Sequence):
    """Word hashes, and the bytes of each word: ``begin[i]:stop[i]``."""

    begin: np.ndarray
    stop: np.ndarray


def words_of(chunk: Chunk) -> Words:
    data = np.frombuffer(chunk.data, np.uint8)
    solid = ~_BLANK[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[chunk.starts] = True
    opens = opens[:-1]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    begin = np.flatnonzero(solid & (~before | opens))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:] & ~opens[1:]
    stop = np.flatnonzero(solid & ~after) + 1
    hashes = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(stop, begin[i] + PIECE, "right")))
        low = begin[i]
        hashes[i:j] = Sums(data[low : stop[j - 1]]).hashes(begin[i:j] - low, stop[i:j] - low)
        i = j
    for i in np.flatnonzero(stop - begin >= LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(chunk.data[begin[i] : stop[i]])
    hashes = mix(hashes ^ (stop - begin).astype(np.uint64))
    starts = np.searchsorted(begin, chunk.starts)
    return Words(hashes, starts, np.append(starts[1:], len(begin)), begin, stop)


def phrase_ranks(words: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length``-word phrase at each place: equal ranks, equal phrases."""
    _, ranks = np.unique(words, return_inverse=True)
    width = 1
    while width < length:
        step = min(width, length - width)
        pairs = ranks[:-step].astype(np.int64) * (int(ranks.max()) + 1) + ranks[step:]
        _, ranks = np.unique(pairs, return_inverse=True)
        width += step
    return ranks


def factor(ranks: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors of a block against itself: (place, phrases, source) of each.

    ``ranks`` are phrases in order of place and ``group`` the text each belongs to. A place's source is the
    place the factor it lies in has come to, if that has its phrase, else the nearest other place with it.
    """
    order = np.argsort(ranks, kind="stable")
    equal = ranks[order][1:] == ranks[order][:-1]
    source = np.full(len(ranks), -1)
    source[order[:-1][equal]] = order[1:][equal]
    source[order[1:][equal]] = order[:-1][equal]
    places = np.flatnonzero(source >= 0)
    if not len(places):
        return places, places, places
    source = source[places]
    goes_on = np.zeros(len(places), bool)
    goes_on[1:] = (places[1:] == places[:-1] + 1) & (group[places[1:]] == group[places[:-1]]) & (source[1:] == source[:-1] + 1)
    first = np.flatnonzero(~goes_on)
    return places[first], np.diff(np.append(first, len(places))), source[first]


class Phrases(Method):
    length, gram, first_is_new = LENGTH, GRAM, False

    def __init__(self, with_text: bool = False):
        self.with_text = with_text

    def sequence(self, chunk: Chunk) -> Words:
        return words_of(chunk)

    def segment(self, chunk: Chunk, seq: Words, start: int, n: int) -> bytes:
        return b" ".join(chunk.data[seq.begin[start] : seq.stop[start + n + self.length - 2]].split())

    def resolve(self, texts: list[bytes], n: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t.split()), np.int64)
        base = np.cumsum(n + self.length - 1) - (n + self.length - 1)
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first - base, n)
        hits = np.zeros(len(at), bool)
        if len(at):
            place, size, _ = factor(phrase_ranks(ids, self.length)[at], np.repeat(np.arange(len(n)), n))
            for p, k in zip(place, size):
                hits[p : p + k] = True
        return np.split(hits, first[1:])

    def finish(self, chunk: Chunk, seq: Words, repeats: np.ndarray) -> pd.DataFrame:
        steps = np.zeros(len(seq.symbols) + 1, np.int32)
        steps[repeats] += 1
        steps[repeats + self.length] -= 1
        gone = np.cumsum(steps[:-1]) > 0
        rows = []
        for r, i, known, start, end, low, high in zip(chunk.rows, chunk.ids, chunk.known, seq.starts, seq.ends, chunk.starts, chunk.ends):
            words = chunk.data[low:high].split()
            removed = int(gone[start:end].sum())
            if removed:
                words = [w for w, g in zip(words, gone[start:end]) if not g]
            kept = b" ".join(words)
            row = [r, i if known else None, end - start, removed, hashlib.sha256(kept).hexdigest()]
            rows.append([*row, kept.decode("utf-8", errors="ignore")] if self.with_text else row)
        names = ["_row", "doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * self.with_text
        made = pd.DataFrame(rows, columns=names)
        # Through floating point, which a column with nulls would take, large ids would lose digits.
        made["doc_id"] = pd.array([row[1] for row in rows], "Int64")
        return made


SCHEMA = "_row long, doc_id long, n_words long, n_removed long, kept_sha256 string"


def phrase_dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Return _row, doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept."""
    return repeated(docs, Phrases(with_text), SCHEMA + ", kept string" * with_text)


def op3_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup(table(spark, sf_dir, "documents")).drop("_row")


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM docs),
windows AS (
  SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
  FROM (SELECT r, ws, unnest(range(1, greatest(1, len(ws) - 33))) AS i FROM docs)),
repeats AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
marked AS (
  SELECT words.r, words.i, word,
    max(CASE WHEN repeats.i IS NULL THEN 0 ELSE 1 END)
      OVER (PARTITION BY words.r ORDER BY words.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM words LEFT JOIN repeats ON words.r = repeats.r AND words.i = repeats.i),
kept AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS said
  FROM marked GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON docs.r = kept.r"""
