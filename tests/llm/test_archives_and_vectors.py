"""WARC archives, whitening and hard negatives against brute force."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import negatives, warc, whiten
from tidemark.session import scratch_path

MIDDLE = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


# -- WARC ---------------------------------------------------------------------


def local(path):
    return path.removeprefix("file:")



LONG = "a page of some length " * 60
PAGES = [
    (1, "http://a/1", LONG),
    (7, "http://a/7", LONG),
    (3, "http://a b/\r\nX: y", LONG),
    (7, "http://a/7", LONG),
    (4, None, None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "short"),
    (8, "http://a/8", "short"),
    (9, "http://ü/", "ü" * 600),
    (10, "http://ü/", "ü" * 600),
    (None, "http://n/", LONG),
    (None, "http://n/", "z" * 2000),
    (None, "http://n/", "z" * 2000),
    (11, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 3_000_000),
]
FIELDS = "page_id long, url string, html string, digest string, record_id int, refers_to string"


def pages_of(spark, rows, tmp_path):
    path = f"{tmp_path}/pages-{uuid.uuid4().hex}"
    spark.createDataFrame([(*r, "d", 1, "r") for r in rows], FIELDS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def wanted_records(rows):
    made = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        again = len(payload) >= 1000 and same and page != max(same)
        made.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return Counter(made)


def test_warc_records_come_back(spark, tmp_path):
    got = warc.archived(pages_of(spark, PAGES, tmp_path), scratch_path(spark, "warc-test"))
    rows = got.select("page_id", "payload_bytes", "payload_digest", "type", "refers_page", "intact").collect()
    assert all(r["intact"] for r in rows)
    assert Counter(tuple(r)[:5] for r in rows) == wanted_records(PAGES)


def test_warc_payloads_and_index(spark, tmp_path):
    """Every index entry is a gzip member of its own; payloads come back byte by byte, other than UTF-8 too."""
    pages = pages_of(spark, PAGES, tmp_path).selectExpr("page_id", "url", "html")
    odd = spark.sql("SELECT 12L AS page_id, CAST(X'68FF2F' AS STRING) AS url, CAST(X'00FFFE0A' AS STRING) AS html")
    root = f"{tmp_path}/warc"
    archives = warc.write_archives(pages.unionByName(odd), f"{root}/crawl")
    for row in archives.collect():
        whole = zlib.decompressobj(31)
        text = whole.decompress(open(local(row["path"]), "rb").read())
        # One stream over the whole file.
        assert whole.eof and not whole.unused_data
        assert text.count(b"WARC-Record-ID") == row["records"] + 1
    index = warc.normalise(archives, f"{root}/members")
    entries = index.collect()
    for archive in {e["archive"] for e in entries}:
        own = sorted((e["offset"], e["length"]) for e in entries if e["archive"] == archive)
        assert own[0][0] == 0 and [a + n for a, n in own] == [a for a, _ in own[1:]] + [os.path.getsize(local(archive))]
        assert [json.loads(line)["offset"] for line in open(f"{local(archive)}.idx.json")] == [a for a, _ in own]
    found = warc.read_records(index, with_payload=True).collect()
    got = Counter((r["page_id"], bytes(r["payload"])) for r in found if r["type"] == "response")
    assert got[(12, b"\x00\xff\xfe\n")] == 1 and got[(11, PAGES[-1][2].encode())] == 1 and got[(4, b"")] == 1
    assert {r["uri"] for r in found if r["page_id"] == 3} == {"http://a%20b/%0D%0AX:%20y"}
    assert {r["uri"] for r in found if r["page_id"] == 4} == {None}


def test_warc_members_of_members(spark, tmp_path):
    """Normalising what is normal already changes nothing; several archives per task are rolled."""
    root = f"{tmp_path}/warc"
    index = warc.normalise(warc.write_archives(pages_of(spark, PAGES, tmp_path), f"{root}/crawl"), f"{root}/one")
    once = Counter((r["offset"], r["length"], r["record_id"]) for r in index.collect())
    again = warc.normalise(index.selectExpr("archive AS path").distinct(), f"{root}/two")
    assert Counter((r["offset"], r["length"], r["record_id"]) for r in again.collect()) == once


def test_warc_leftovers_of_lost_tasks_are_not_read(spark, tmp_path):
    root = f"{tmp_path}/warc"
    archives = warc.write_archives(pages_of(spark, PAGES[:3], tmp_path), f"{root}/crawl")
    os.makedirs(f"{root}/members", exist_ok=True)
    with open(f"{root}/members/lost.warc.gz.idx.json", "w") as file:
        file.write(json.dumps({"archive": "lost", "offset": 0, "length": 9, "type": "response"}) + "\n")
    assert warc.read_records(warc.normalise(archives, f"{root}/members")).count() == 3


@pytest.mark.parametrize("damage", ["cut", "other"])
def test_warc_damaged_archive_is_named(spark, tmp_path, damage):
    path = f"{tmp_path}/bad.warc.gz"
    whole = gzip.compress(warc.info_record("x") if damage == "cut" else b"no archive at all\r\n")
    with open(path, "wb") as file:
        file.write(whole[:-12] if damage == "cut" else whole)
    with pytest.raises(Exception, match="bad.warc.gz"):
        warc.normalise(spark.createDataFrame([(path,)], "path string"), f"{tmp_path}/out").count()


def test_warc_of_no_pages(spark, tmp_path):
    assert warc.archived(pages_of(spark, [], tmp_path), scratch_path(spark, "warc-test")).count() == 0


# -- whitening ----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, x string, m int, deviation int, n string, away int"


def vectors_of(spark, rows, tmp_path):
    path = f"{tmp_path}/vectors-{uuid.uuid4().hex}"
    spark.createDataFrame([(*r, "x", 1, 2, "n", 3) for r in rows], VECTORS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def spread(n, d, seed=1):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, d)) * np.linspace(2, 0.3, d) + draw.normal(size=d)).astype(np.float32).tolist()


def odd_rows(d):
    """Rows that take no part: null, empty, null or non-finite numbers, another length."""
    bad = [None, [], [None] + [1.0] * (d - 1), [NAN] * d, [INF] + [0.0] * (d - 1), [1.0] * (d + 1)]
    return [(1000 + i, v, 1) for i, v in enumerate(bad)]


@pytest.mark.parametrize("by_rows", [False, True])
def test_whitening_against_numpy(spark, tmp_path, by_rows):
    plain = spread(60, 6)
    rows = [(i, v, 0) for i, v in enumerate(plain)] + [(100 + i, plain[3], 0) for i in range(50)] + [(None, plain[4], 0), (7, plain[4], 0)]
    rows.append((200, [0.0] * 6, 0))
    got = whiten.whiten(vectors_of(spark, rows + odd_rows(6), tmp_path), weigh_by_rows=by_rows).collect()
    x = np.floor(256 * np.array([v for _, v, _ in rows], np.float64)).astype(np.int64)
    fit, counts = np.unique(x, axis=0, return_counts=True)
    weight = counts if by_rows else np.ones(len(fit), np.int64)
    n, sums = int(weight.sum()), weight @ fit
    centred = fit - sums / n
    value, vector = np.linalg.eigh((centred * weight[:, None]).T @ centred / n)
    assert len(got) == 4 * len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["component"]), []).append(r)
    for (vec_id, _, _), own in zip(rows, x):
        for c in range(1, 5):
            for r in by_id[vec_id, c]:
                if (vec_id, c) in ((7, c),):
                    continue
                assert (r["n"], r["deviation"]) == (n, int(np.square(n * own - sums).sum()))
                want = (own - sums / n) @ vector[:, -c] / np.sqrt(value[-c])
                assert abs(abs(r["whitened"]) - abs(want)) < 1e-9
                assert abs(r["explained"] / (value[-c] / value.sum()) - 1) < 1e-9
    assert len(by_id[7, 1]) == 2 and len(by_id[None, 1]) == 1
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_whitening_without_variance(spark, tmp_path):
    one = whiten.whiten(vectors_of(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)], tmp_path)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    two = whiten.whiten(vectors_of(spark, [(1, [0.5, 0.25], 0), (2, [1.0, 0.25], 0)], tmp_path)).collect()
    assert sorted((r["component"], r["whitened"] is None) for r in two) == [(1, False), (1, False), (2, True), (2, True)]
    assert two[0]["identity_error"] < 1e-12
    assert whiten.whiten(vectors_of(spark, odd_rows(2)[:4], tmp_path)).count() == 0
    assert whiten.whiten(vectors_of(spark, [], tmp_path)).count() == 0


def test_whitening_of_large_numbers():
    x = np.array([[2**61, -5], [2**61 - 3, 7]])
    assert whiten.exact_sums(x, np.array([9, 1])) == [10 * 2**61 - 3, -38]
    assert whiten.deviations(np.array([[3, 1], [2, 0]]), 2, [5, 1]) == [2, 2]
    assert whiten.deviations(x, 2, [2**62 - 3, 2]) == [9 + 144, 9 + 144]
    assert whiten.deviations(np.array([[2**40], [0]]), 2, [2**40]) == [None, None]


# -- hard negatives -----------------------------------------------------------


def brute_negatives(rows, positives=5, negatives_=3):
    good = [(i, lab, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v, lab in rows]
    made = []
    for a, (aid, alab, ax) in enumerate(good):
        if aid % 50:
            continue
        scored = sorted((-int(ax @ x), i, b) for b, (i, lab, x) in enumerate(good) if b != a and lab == alab)[:positives]
        others = sorted((-int(ax @ x), i, b) for b, (i, lab, x) in enumerate(good) if lab != alab)
        for p, pid, _ in scored:
            near = [(-s, i) for s, i, _ in others if 50 * -p <= 100 * -s <= 95 * -p][:negatives_]
            made += [(aid, pid, n + 1, i, -p, s) for n, (s, i) in enumerate(near)]
    return Counter(made)


def clustered(n, d, seed=5):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, d))
    return (centres[draw.integers(0, 12, n)] + 0.2 * draw.normal(size=(n, d))) * draw.uniform(0.2, 2, (n, 1))


@pytest.mark.parametrize(("block", "shards", "asks"), [(8192, 4096, 8192), (40, 8, 3), (25, 2, 1000)])
def test_hard_negatives_against_brute_force(spark, tmp_path, monkeypatch, block, shards, asks):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "SHARDS", shards)
    monkeypatch.setattr(negatives, "ASKS", asks)
    vectors = clustered(400, 5).astype(np.float32).tolist()
    rows = [(i * 5, v, i % 3) for i, v in enumerate(vectors)]
    # Copies with and without the label, ids that repeat, zero vectors, anchors without positives.
    rows += [(3000 + i, vectors[10], 1) for i in range(60)] + [(4000 + i, vectors[10], 2) for i in range(30)]
    rows += [(50, vectors[20], 2), (5000, [0.0] * 5, 0), (5001, [0.0] * 5, 1), (5050, vectors[30], 9), (-50, vectors[31], 1)]
    odd = odd_rows(5) + [(6000, vectors[0], None), (None, vectors[0], 1), (6050, [1e30] * 5, 1)]
    got = negatives.hard_negatives(vectors_of(spark, rows + odd, tmp_path), "vec_id % 50 = 0")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark, tmp_path):
    assert negatives.hard_negatives(vectors_of(spark, [], tmp_path), "vec_id % 50 = 0").count() == 0
    assert negatives.hard_negatives(vectors_of(spark, [(50, [1.0], 1)], tmp_path), "vec_id % 50 = 0").count() == 0


def test_cover_tree_covers_and_skips():
    """Every point lies in the cap of each node above it, and a search opens a part of clustered points only."""
    vectors = np.floor(256 * clustered(4000, 8, 9)).astype(np.int64)
    longest = float(np.sqrt(np.square(vectors.astype(float)).sum(1).max()))
    points = negatives.spheric(vectors.astype(float), longest)
    tree = negatives.cover_tree(points)
    assert sorted(tree.order.tolist()) == list(range(4000))

    def below(node):
        if not tree.children[node]:
            return tree.order[tree.first[node] : tree.first[node] + tree.rows[node]]
        return np.concatenate([below(tree.first[node] + i) for i in range(tree.children[node])])

    for node in range(len(tree.angle)):
        own = below(node)
        if len(own):
            assert negatives.angle_of(points[own] @ tree.centre[node]).max() <= tree.angle[node] + 1e-9
    x, looked = vectors[tree.order], []
    for q in range(0, 4000, 80):
        best = negatives.Best([(negatives.LOWEST, negatives.HIGHEST)], 5)
        every = np.ones(4000, bool)
        looked.append(negatives.descend(tree, x, tree.order, tree.order, longest, vectors[q], every, best))
        want = sorted((-int(s), i) for i, s in enumerate(vectors @ vectors[q]))[:5]
        assert [(s, i) for s, i, _ in best.found[0]] == want
    assert np.mean(looked) < 4000 / 3


def test_hard_negatives_of_large_numbers(spark, tmp_path):
    rows = [(50, [2.0**20, 1.0], 1), (51, [2.0**20, 3.0], 1), (52, [2.0**19, 9.0], 2), (53, [2.0**19 + 0.25, 5.0], 2)]
    got = negatives.hard_negatives(vectors_of(spark, rows, tmp_path), "vec_id % 50 = 0")
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(rows)
