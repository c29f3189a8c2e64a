from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import anchors, factors, suffixes

SMALL = "/root/testdata/sf0.001/documents.parquet"


def brute_bytes(rows, length=suffixes.LENGTH):
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, rows[n][2]))
    seen, found = set(), []
    for n in order:
        i, text, _ = rows[n]
        data = (text or "").encode()
        cover = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                cover[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, gone in zip(data, cover) if not gone)
        spans = sum(1 for k in range(len(cover)) if cover[k] and (k == 0 or not cover[k - 1]))
        found.append((i, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return found


def brute_words(rows, length=factors.LENGTH):
    words = [(i, (t or "").encode().split()) for i, t, _ in rows]
    count = Counter(tuple(w[s : s + length]) for _, w in words for s in range(len(w) - length + 1))
    found = []
    for i, w in words:
        cover = [False] * len(w)
        for s in range(len(w) - length + 1):
            if count[tuple(w[s : s + length])] > 1:
                cover[s : s + length] = [True] * length
        kept = b" ".join(x for x, gone in zip(w, cover) if not gone)
        found.append((i, len(w), sum(cover), hashlib.sha256(kept).hexdigest()))
    return found


def check(docs):
    """Compare with brute force as bags, since repeated rows may have either order."""
    rows = [tuple(r) for r in anchors.scanned(docs).collect()]
    for run, brute in ((suffixes.substring_dedup, brute_bytes), (factors.phrase_dedup, brute_words)):
        got = [tuple(r) for r in run(docs).drop("_row").collect()]
        assert Counter(got) == Counter(brute(rows)), run.__name__


@pytest.mark.parametrize(("crowded", "chunk"), [(16, 100_000), (2, 100_000), (16, 2_000_000)])
def test_given_documents(spark, monkeypatch, crowded, chunk):
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    monkeypatch.setattr(anchors, "CHUNK_BYTES", chunk)
    check(spark.read.parquet(SMALL))


@pytest.mark.parametrize(("crowded", "batch"), [(2, 64), (16, 1 << 16)])
def test_shared_passages_in_many_documents(docs_of, monkeypatch, crowded, batch):
    """A passage in most documents, other words around it, ids null and repeated, windows that end at a border."""
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    monkeypatch.setattr(anchors, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(suffixes, "BATCH", batch)
    draw = random.Random(1)
    common = " ".join(draw.choice(["ab", "cde", "f", "ghij", "klm"]) for _ in range(60))

    def own(n):
        return " ".join(str(draw.random()) for _ in range(n))

    odd = [None, "", "a" * 150, "a" * 99, "a " * 80, common, f"{common} {common}"]
    rows = [(None if n % 7 == 0 else n % 50, f"{own(12)} {common} {own(5)}" if n % 3 else draw.choice(odd)) for n in range(300)]
    check(docs_of(rows, 1))


def test_odd_and_empty_tables(odd_docs, no_docs):
    check(odd_docs)
    check(no_docs)


def test_windows_across_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", 256)
    monkeypatch.setattr(suffixes, "PIECE", 256)
    monkeypatch.setattr(factors, "PIECE", 256)
    text = " ".join(str(n % 97) for n in range(900))
    check(docs_of([(1, text), (2, "head " + text[:700]), (3, text + text)]))


def test_levels_of_suffix_arrays_fall_by_half():
    index, draw = suffixes.SuffixArrays(), np.random.default_rng(0)
    seen: set = set()
    for _ in range(20):
        batch = draw.integers(97, 100, (50, 6)).astype(np.uint8).view("S6").ravel()
        repeats = index.add(batch)
        for window, repeat in zip(batch.tolist(), repeats):
            assert repeat == (window in seen)
            seen.add(window)
    sizes = [len(level) for level in index.levels]
    assert sum(sizes) == len(seen)
    assert all(old > young for old, young in zip(sizes, sizes[1:]))


def test_factors_follow_one_source():
    ranks = np.array([5, 6, 7, 1, 5, 6, 7, 2])
    place, size, source = factors.factor(ranks, np.zeros(8, int))
    assert place.tolist() == [0, 4] and size.tolist() == [3, 3] and source.tolist() == [4, 0]
