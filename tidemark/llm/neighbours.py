"""Approximate nearest neighbours in a hierarchical k-means tree, searched best bin first.

The tree is fitted on ``SAMPLE`` vectors (those with the smallest hash of their id): each node is split into ``BRANCH`` clusters until a
leaf holds ``LEAF`` of them. Every vector of the table then goes down to its leaf. A query walks the tree through a priority
queue of nodes by distance to their centre; leaves come out best first.

How many leaves a query visits at least is calibrated: on distinct vectors of the sample as queries, searched among them, visits
are widened until a share ``RECALL`` of the queries has a recall of ``RECALL``. A query whose leaves hold fewer than ``k`` other
rows goes on through the tree until they do, or there is no other leaf. With more vectors than
the sample neighbours are nearer, so they share leaves more often; tests and the README have measured recall.

The search joins queries with rows by leaf, in two rounds: the first leaves of each query give a bound, its k-th distance so
far, and the other leaves return only what is within it. Crowded leaves are split into blocks of ``BLOCK`` rows, and their queries into blocks
as well, so no task gets an unbounded group and each block returns the best ``k`` of each query only.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers take no part, nor do rows without an id or
with another length than most vectors; rows that repeat an id are rows of their own, and only the query's own row is
left out; ties go to the smaller id; with fewer candidates than ``k`` all are returned; an empty table gives an empty
result; columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, stored, table

SAMPLE = 20_000
BRANCH = 8
LEAF = 256
ROUNDS = 12
RECALL = 0.95
#: Leaves visited first; the k-th distance found there bounds what the other leaves return.
FIRST = 2
CALIBRATION_QUERIES = 200
BLOCK = 4096


@dataclass
class Tree:
    """Nodes in order of creation: centres, children (none: a leaf)."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf each vector belongs to, by the nearest child at every node."""
        at = np.zeros(len(vectors), np.int64)
        stack = [(0, np.arange(len(vectors)))]
        while stack:
            node, own = stack.pop()
            if not self.children[node]:
                at[own] = node
                continue
            centres = np.stack([self.centres[c] for c in self.children[node]])
            nearest = _nearest(vectors[own], centres)
            for i, child in enumerate(self.children[node]):
                part = own[nearest == i]
                if len(part):
                    stack.append((child, part))
        return at

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best first: the nearest open node is opened until it is a leaf."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield node
                continue
            gaps = np.square(np.stack([self.centres[c] for c in below]) - query).sum(1)
            for gap, child in zip(gaps, below):
                heapq.heappush(queue, (float(gap), child))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.square(centres).sum(1)[None, :] - 2 * vectors @ centres.T).argmin(1)


def grow(vectors: np.ndarray) -> Tree:
    """Hierarchical k-means; starts are spread evenly over the vectors, so it repeats."""
    tree = Tree([vectors.mean(0)], [[]])
    stack = [(0, vectors)]
    while stack:
        node, own = stack.pop()
        if len(own) <= LEAF:
            continue
        centres = own[np.linspace(0, len(own) - 1, BRANCH).astype(int)]
        for _ in range(ROUNDS):
            label = _nearest(own, centres)
            centres = np.stack([own[label == i].mean(0) if (label == i).any() else centres[i] for i in range(BRANCH)])
        label = _nearest(own, centres)
        parts = [(i, own[label == i]) for i in range(BRANCH) if (label == i).any()]
        if len(parts) < 2:  # equal vectors
            continue
        for i, part in parts:
            tree.centres.append(centres[i])
            tree.children.append([])
            tree.children[node].append(len(tree.centres) - 1)
            stack.append((len(tree.centres) - 1, part))
    return tree


def calibrate(tree: Tree, vectors: np.ndarray, k: int) -> int:
    """Leaves to visit so that a share ``RECALL`` of the queries finds as much of its neighbours; equal vectors count once."""
    vectors = vectors[np.sort(np.unique(vectors, axis=0, return_index=True)[1])]
    leaf = tree.leaves_of(vectors)
    k = min(k, len(vectors) - 1)
    if k < 1:
        return 1
    some = np.linspace(0, len(vectors) - 1, min(CALIBRATION_QUERIES, len(vectors))).astype(int)
    needed = []
    for q in np.unique(some):
        gap = np.square(vectors - vectors[q]).sum(1)
        gap[q] = np.inf
        best = np.argsort(gap, kind="stable")[:k]
        place = {node: i for i, node in enumerate(tree.best_bins(vectors[q]))}
        needed.append(sorted(place[leaf[b]] for b in best)[int(np.ceil(RECALL * k)) - 1])
    return int(np.sort(needed)[int(np.ceil(RECALL * len(needed))) - 1]) + 1


def usable(rows: DataFrame) -> DataFrame:
    """Rows that take part: _row, vec_id, embedding (array of double)."""
    vector = F.col("embedding").cast("array<double>")
    cleaned = numbered(rows.select("vec_id", vector.alias("embedding")), "_row").filter("vec_id IS NOT NULL AND size(embedding) > 0")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    cleaned = cleaned.filter(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    lengths = cleaned.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return cleaned.filter(F.size("embedding") == (lengths["n"] if lengths else 0)).select("_row", "vec_id", "embedding")


def nearest(rows: DataFrame, queries: str, k: int = 10) -> DataFrame:
    """For rows of (vec_id, embedding) that the SQL condition ``queries`` picks: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    good = stored(usable(rows), "vectors")
    few = good.orderBy(F.xxhash64("vec_id"), "_row").limit(SAMPLE).select("embedding").toPandas()
    fields = "query_id long, rank int, vec_id long, score double"
    if few.empty:
        return spark.createDataFrame([], fields)
    sample = np.stack(few["embedding"].to_numpy())
    tree = grow(sample)
    visits = calibrate(tree, sample, k)
    shared = spark.sparkContext.broadcast((tree.centres, tree.children, visits))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree(*shared.value[:2])
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("embedding"))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.leaves_of(vectors))], [*batch.schema.names, "leaf"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = Tree(*shared.value[:2]), shared.value[2]
        for batch in batches:
            if batch.num_rows:
                found = []
                for query in _matrix(batch.column("embedding")):
                    bins, rows_in = [], 0
                    for leaf in own.best_bins(query):
                        bins.append(leaf)
                        rows_in += held.value.get(leaf, 0)
                        if len(bins) >= least and rows_in > k:
                            break
                    found.append(bins)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names, "bins"])

    kind = "_row long, vec_id long, embedding array<double>"
    placed = stored(good.mapInArrow(assign, f"{kind}, leaf long"), "leaves")
    # One row per leaf: a bounded table, as the tree is.
    counts = stored(placed.groupBy("leaf").count(), "leaf-counts")
    held = spark.sparkContext.broadcast({r["leaf"]: r["count"] for r in counts.collect()})
    asked = good.filter(queries).mapInArrow(visit, f"{kind}, bins array<long>")
    asked = stored(asked.select("_row", "vec_id", "embedding", F.posexplode("bins").alias("place", "leaf")), "visits")
    sizes = counts.select("leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    asking = asked.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("askers"))
    plan = F.broadcast(stored(sizes.join(asking, "leaf"), "leaf-plan"))

    def every(name: str):
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    def block(name: str):
        return F.pmod(F.xxhash64("_row"), F.col(name)).cast("int")

    right = placed.join(plan, "leaf").withColumn("block", block("blocks")).withColumn("asker", every("askers"))
    keys, kept = ["leaf", "block", "asker"], ["leaf", "block", "asker", "_row", "vec_id", "embedding"]
    right = right.select(*kept).groupBy(*keys)

    def compare(asks: pd.DataFrame, has: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(has):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        vectors = np.stack(has["embedding"].to_numpy())
        ids, places = has["vec_id"].to_numpy(), has["_row"].to_numpy()
        made = []
        for row, query_id, query, bound in zip(asks["_row"], asks["vec_id"], asks["embedding"], asks["bound"]):
            score = np.sqrt(np.square(vectors - query).sum(1))
            score[(places == row) | (score > bound)] = np.inf
            if len(score) > 4 * k:
                near = np.flatnonzero(score <= np.partition(score, k)[k])
            else:
                near = np.arange(len(score))
            near = near[np.isfinite(score[near])]
            best = near[np.lexsort((ids[near], score[near]))[:k]]
            made += [(row, query_id, i, s) for i, s in zip(ids[best], score[best])]
        return pd.DataFrame(made, columns=["query_row", "query_id", "vec_id", "score"])

    def search(asks: DataFrame) -> DataFrame:
        left = asks.join(plan, "leaf").withColumn("asker", block("askers")).withColumn("block", every("blocks"))
        left = left.select(*kept, "bound").groupBy(*keys)
        return left.cogroup(right).applyInPandas(compare, "query_row long, query_id long, vec_id long, score double")

    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id"))
    infinite = F.lit(float("inf"))
    first = stored(search(asked.filter(F.col("place") < FIRST).withColumn("bound", infinite)), "nearest")
    bounds = first.withColumn("_n", rank).filter(F.col("_n") == k).select(F.col("query_row").alias("_row"), "score")
    rest = asked.filter(F.col("place") >= FIRST).join(bounds, "_row", "left").withColumn("bound", F.coalesce("score", infinite))
    near = first.unionByName(search(rest.drop("score")))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")
