"""SimHash, the quality classifier, nearest neighbours and the pipeline against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, neighbours, resample, simhash
from tidemark.llm.common import numbered

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def brute_classes(texts, ids, shingle, bits):
    prints = []
    for text in texts:
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    own = np.array(prints, np.uint64)
    near = np.bitwise_count(own[:, None] ^ own[None, :]) <= bits
    label = np.array([math.inf if i is None else i for i in ids])
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return prints, [None if x == math.inf else int(x) for x in label]
        label = new


@pytest.mark.parametrize(("shingle", "bits", "chain"), [(3, 2, 1), (5, 6, 2), (3, 9, 2), (3, 0, 1)])
def test_simhash_classes(spark, odd_docs, shingle, bits, chain):
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), odd_docs):
        rows = docs.collect()
        prints, names = brute_classes([r["text"] for r in rows], [r["doc_id"] for r in rows], shingle, bits)
        got = simhash.near_duplicates(docs, shingle, bits, chain).select("doc_id", "fp", "component_id").collect()
        want = Counter((r["doc_id"], p, c) for r, p, c in zip(rows, prints, names))
        assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want


@pytest.mark.parametrize(("crowded", "in_task"), [(2, 1024), (200_000, 3), (2, 3)])
def test_simhash_crowded_groups(spark, monkeypatch, crowded, in_task):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "CROWDED_IN_TASK", in_task)
    monkeypatch.setattr(simhash, "LINKS_HELD", 10)
    draw = np.random.default_rng(3)
    centres = draw.integers(0, 2**63, 6, dtype=np.uint64)
    prints = np.unique([int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in draw.integers(0, 63, (60, 2))])
    near = np.bitwise_count(prints.astype(np.uint64)[:, None] ^ prints.astype(np.uint64)[None, :]) <= 2
    label = prints.copy()
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(int(p),) for p in prints], "fp long")
    found = {r["node"]: r["root"] for r in components.components(simhash.links(df, 2)).collect()}
    assert [found.get(int(p), int(p)) for p in prints] == label.tolist()


def test_simhash_of_no_documents(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 6), (200, 200), (300, 301), (301, 300)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert found == want


def test_similar_links_only(docs_of):
    base = " ".join(f"w{i}" for i in range(300))
    near, far = base.replace("w150 ", "other "), " ".join(f"v{i}" for i in range(300))
    docs = docs_of([(1, base), (2, near), (3, far), (4, base), (None, base), (5, None), (6, "")])
    kept = simhash.one_of_each(docs, 5, 10, 2, 0.8)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5]
    assert {tuple(r)[5:] for r in kept.collect()} == {("r", 1, "c", "w", 7)}


def jaccard(x, y):
    shared = len(np.intersect1d(x, y))
    return shared / max(1, len(x) + len(y) - shared)


def test_similar_pair_behind_closer_unlike_texts(spark, docs_of):
    """a and b are similar; c, not similar to either, is closer to both, so a forest of candidates holds a-c and c-b only."""
    draw = np.random.default_rng(5)

    def text(changed):
        return " ".join(changed.get(i, f"w{i}") for i in range(200))

    for _ in range(1000):
        n = int(draw.integers(1 << 30))
        places = [20 * i + 10 for i in range(7)]
        one, two = {p: f"x{n}{p}" for p in places[:4]}, {p: f"x{n}{p}" for p in (*places[:2], *places[4:])}
        texts = [text({}), text(one), text(two)]
        prints = [simhash.fingerprint(t, 5) for t in texts]
        ab, ac, bc = (bin((prints[i] ^ prints[j]) % 2**64).count("1") for i, j in ((0, 1), (0, 2), (1, 2)))
        if max(ac, bc) < ab <= 12:
            break
    a, b, c = (simhash.shingle_set(t, 5) for t in texts)
    assert max(ac, bc) < ab <= 12 and jaccard(a, b) >= 0.8 > max(jaccard(a, c), jaccard(b, c))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        kept = simhash.one_of_each(docs_of(list(enumerate(texts))), 5, 15, 2, 0.8)
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("held", [3, 1_000_000])
def test_similar_classes_are_those_of_all_candidates(spark, odd_docs, monkeypatch, held):
    monkeypatch.setattr(simhash, "LINKS_HELD", held)
    monkeypatch.setattr(simhash, "ROWS_AT_ONCE", 1000 * held)
    draw = np.random.default_rng(1)
    words = [f"w{i}" for i in range(120)]
    near = [" ".join(f"y{n}" if n % 7 and i in own else w for i, w in enumerate(words)) for n, own in enumerate(draw.integers(0, 120, (60, 3)).tolist())]
    texts = near + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + [r["text"] for r in odd_docs.collect()]
    docs = spark.createDataFrame([(n, t, n) for n, t in enumerate(texts)], "doc_id long, text string, _row long")
    found = {r["doc_id"]: r for r in simhash.similar_classes(docs, 5, 15, 2, 0.8).collect()}
    sets = [simhash.shingle_set(t, 5) for t in texts]
    prints = {r["_row"]: r["fp"] for r in simhash.set_nodes(docs, 5, ("_row",)).collect()}
    label = list(range(len(texts)))
    own = np.array([prints[n] for n in range(len(texts))]).view(np.uint64)
    links = [(i, j) for i in range(len(texts)) for j in np.flatnonzero(np.bitwise_count(own ^ own[i]) <= 15) if j > i]
    links = [(i, j) for i, j in links if (not len(sets[i]) and not len(sets[j])) or jaccard(sets[i], sets[j]) >= 0.8]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    roots = [found[n]["root"] for n in range(len(texts))]
    assert len(set(zip(roots, label))) == len(set(roots)) == len(set(label)) < len(texts)


def test_texts_around_one_repeated_line_stay(docs_of):
    """A line of five words 300 times, and 200 words of a text's own: one majority of shingles, similarity near 0.01."""
    line = "all rights reserved by us\n" * 300
    texts = [line + " ".join(f"w{n}x{i}" for i in range(200)) for n in range(6)]
    assert len({simhash.fingerprint(t, 5) for t in texts}) == 1
    kept = simhash.one_of_each(docs_of(list(enumerate([*texts, texts[0], texts[1].replace("w1x100 ", "other ")]))), 5, 15, 2, 0.8)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5]


# Quality classifier


def test_classifier_on_held_out_labels(spark):
    found = resample.op9_quality_classifier(spark, MIDDLE).toPandas()
    both = found.merge(spark.read.parquet(f"{MIDDLE}/labels.parquet").toPandas(), on="doc_id")
    assert both[both.quality == 1].kept.mean() > 0.98
    assert both[both.quality == 0].kept.mean() < 0.15
    again = resample.op9_quality_classifier(spark, MIDDLE).toPandas()
    assert (found.set_index("doc_id").kept.sort_index() == again.set_index("doc_id").kept.sort_index()).all()


def test_classifier_weights_by_hand(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = resample.fit(docs, labels)
    sample = {r["_label_id"]: r for r in resample.labelled_sample(labels).collect()}
    raw, target = Counter(), Counter()
    for r in docs.collect():
        own = Counter(resample.features(r["text"]).tolist())
        raw += own
        known = sample.get(r["doc_id"])
        if known and known["good"] and known["fit"]:
            target += own
    share = sum(target.values()) / sum(raw.values())
    for bucket in list(raw)[:500]:
        p = (target[bucket] + share) / (sum(target.values()) + share * resample.BUCKETS)
        q = (raw[bucket] + 1) / (sum(raw.values()) + resample.BUCKETS)
        assert abs(model.ratio[bucket] - math.log(p / q)) < 1e-4


@pytest.mark.parametrize("k", [0, 1, 5, 37, 99, 100, 200])
def test_top_k_cut(spark, monkeypatch, k):
    monkeypatch.setattr(resample, "BINS", 4)
    keys = [math.sin(i) * (1000 if i % 9 == 0 else 1) for i in range(100)]
    cut = resample.top_k_cut(spark.createDataFrame([(x,) for x in keys], "key double"), k)
    assert sum(x >= cut for x in keys) == min(k, 100)


def test_classifier_on_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    none = labels.limit(0)
    for docs in (odd_docs, no_docs):
        for given in (labels, none):
            kept = resample.keep_good(docs, given)
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()
    assert resample.keep_good(odd_docs, none).count() == odd_docs.count()


# Nearest neighbours


def brute_nearest(ids, vectors, query, k=10):
    gap = np.sqrt(np.square(vectors - vectors[query]).sum(1))
    gap[query] = np.inf
    return [(ids[i], gap[i]) for i in np.lexsort((ids, gap))[:k] if np.isfinite(gap[i])]


@pytest.mark.parametrize("block", [64, 4096])
def test_neighbours_recall(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = rows.toPandas().sort_values("vec_id")
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(float)
    found = neighbours.op10_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        own = found[found.query_id == ids[q]].sort_values("rank")
        want = brute_nearest(ids, vectors, q)
        assert own["rank"].tolist() == list(range(1, 11))
        hit += len(set(own.vec_id) & {i for i, _ in want})
        total += len(want)
        exact = dict(brute_nearest(ids, vectors, q, len(ids)))
        assert np.allclose(own.score, [exact[i] for i in own.vec_id], rtol=1e-12)
        assert list(zip(own.score, own.vec_id)) == sorted(zip(own.score, own.vec_id))
    assert hit / total >= 0.9


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.0, 1.0]), (0, [0.0, 2.0]), (None, [1.0, 0.0])]
    rows += [(200, None), (300, [0.0, 0.0]), (400, [1.0, nan]), (500, [inf, 1.0]), (600, [None, 1.0]), (700, []), (800, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("_row", F.lit("x")).withColumn("leaf", F.lit(1))
    found = [tuple(r) for r in neighbours.nearest(df, "vec_id % 100 = 0").orderBy("query_id", "rank", "vec_id").collect()]
    assert {r[0] for r in found} == {0, 100} and len(found) == 3 * 4
    assert [r[2] for r in found if r[0] == 100] == [0, 3, 5, 0]
    assert neighbours.nearest(df.limit(0), "vec_id % 100 = 0").count() == 0


def test_neighbours_are_k_beside_a_large_group_of_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 4)
    draw = np.random.default_rng(2)
    vectors = [[1.0, 0.0, 0.0]] * 3000 + (10 * draw.normal(size=(100, 3))).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = Counter(r["query_id"] for r in neighbours.nearest(df, "vec_id >= 3000 OR vec_id = 7").collect())
    assert found == {i: 10 for i in [7, *range(3000, 3100)]}


# Pipeline


def test_pipeline_stages_keep_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    before = docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, MIDDLE)
        made.write.parquet(str(tmp_path / str(n)))
        made = spark.read.parquet(str(tmp_path / str(n)))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns, name
        assert {r["doc_id"] for r in made.select("doc_id").collect()} <= ids
        if n == 2:
            assert made.count() == before
        docs, before = made, made.count()
    assert before > 0 and docs.filter("n_tokens <> size(ids)").count() == 0


def test_pipeline_on_odd_tables(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for n, docs in enumerate((odd_docs, no_docs)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert made.columns == docs.columns
            made.write.parquet(str(tmp_path / f"out{n}-{k}"))
            docs = spark.read.schema(made.schema).parquet(str(tmp_path / f"out{n}-{k}"))


def test_numbers_of_rows_are_those_of_the_table(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    whole, narrow = numbered(docs), numbered(docs.select("doc_id"))
    assert whole.join(narrow, ["doc_id", "row"]).count() == docs.count()
