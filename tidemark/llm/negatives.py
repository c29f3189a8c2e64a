"""Hard negatives by inner product, found exactly in cover trees over norm-augmented vectors.

Every candidate c becomes a point (c, sqrt(M^2 - |c|^2)) / M of the unit sphere, M the greatest norm, so that the inner product with a
query q is |q| M cos of the angle between the point and (q, 0). A node of a tree holds a centre and the angle that covers
all its points; with a query's angle to the centre that bounds the inner products below it from both sides. A search
opens nodes best bound first, skips those whose bounds miss the query's windows of scores, or lie below what it has found
already, and computes the scores of a leaf's rows exactly.

*Trees.* The root level has one shard per ``BLOCK`` candidates (``SHARDS`` at most): the vectors with the smallest hashes are centres, and each
candidate goes to the nearest, which fixes the shard's covering angle. A shard is dealt out to blocks of about ``BLOCK`` rows,
and each block is built into a tree in a task, level by level: centres are picked farthest first until they cover the points
within ``SHRINK`` of the level's angle, or there are ``FAN`` of them; every child's angle is that of its own farthest point. The trees are
stored once and searched twice.

*Search.* A query first asks the ``FIRST`` best shards. What they return raises the lower ends of its windows,
and only shards whose bounds still meet a window are asked next. The scores are exact whatever the tree looks like: it decides
how much is skipped. Queries of a shard come in groups of ``ASKS``, so no task gets an unbounded group.

*Copies.* Of candidates with one vector and label only the ``k`` smallest ids can be among the first k, so no others are indexed;
partial limits drop the rest before the shuffle. Anchors with one vector and label are one query.

Defined results: rows with a null id, label or vector, an empty vector, null or non-finite numbers or another length than most vectors take no
part, nor do vectors whose scaled squared norm is 2^62 or more (their scores would not fit a long); zero vectors take part. Rows that repeat
an id are rows of their own; an anchor is left out of its own positives only. Ties go to the smaller id. An anchor without
positives, and a positive without negatives in its window, give no row; a negative positive score has an empty window. An empty table gives an
empty result; columns other than vec_id, embedding and label are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, scaled, stored, table, usable_vectors

BLOCK = 8192
SHARDS = 4096
FAN, LEAF = 8, 128
#: How much larger each lot of leaves is than the one before.
LOT = 4
SHRINK = 0.75
FIRST = 2
ASKS = 8192
POSITIVES, NEGATIVES = 5, 3
#: Bounds on scores are computed in floating point; this share of |q| M is added to be safe.
SLACK = 1e-6
LOWEST, HIGHEST = -(2**63), 2**63 - 1


@dataclass
class CoverTree:
    """Nodes in order of creation. Children of a node stand together; a leaf's rows do as well."""

    centre: np.ndarray
    angle: np.ndarray
    #: First child and number of children; for a leaf (no children) first row and number of rows.
    first: np.ndarray
    children: np.ndarray
    rows: np.ndarray
    order: np.ndarray


def angle_of(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def spheric(x: np.ndarray, longest: float) -> np.ndarray:
    """Points of the unit sphere for whole vectors whose norms are at most ``longest``."""
    unit = x / longest
    rest = np.sqrt(np.clip(1.0 - np.square(unit).sum(1), 0.0, None))
    made = np.concatenate([unit, rest[:, None]], 1)
    return made / np.sqrt(np.square(made).sum(1))[:, None]


def cover_tree(points: np.ndarray) -> CoverTree:
    """Tree over points of the unit sphere, the first point its root's centre."""
    centre, angle, first, children, rows, order = [points[0]], [0.0], [0], [0], [0], []
    stack = [(0, np.arange(len(points)))]
    while stack:
        node, own = stack.pop()
        away = angle_of(points[own] @ centre[node])
        angle[node] = float(away.max())
        # Equal points have angles of rounding errors only.
        if len(own) <= LEAF or angle[node] < 1e-7:
            first[node], rows[node] = len(order), len(own)
            order.extend(own.tolist())
            continue
        level, nearest, picked = angle[node] * SHRINK, np.zeros(len(own), np.int64), [centre[node]]
        while len(picked) < FAN and away.max() > level:
            chosen = points[own[int(away.argmax())]]
            gap = angle_of(points[own] @ chosen)
            closer = gap < away
            nearest[closer], away[closer] = len(picked), gap[closer]
            picked.append(chosen)
        first[node], children[node] = len(centre), len(picked)
        for i, chosen in enumerate(picked):
            centre.append(chosen)
            angle.append(0.0)
            first.append(0)
            children.append(0)
            rows.append(0)
            part = own[nearest == i]
            if len(part):
                stack.append((len(centre) - 1, part))
    return CoverTree(np.stack(centre), np.array(angle), np.array(first), np.array(children), np.array(rows), np.array(order, np.int64))


def bounds(point: np.ndarray, centres: np.ndarray, angles: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of the query ``point`` with anything a node covers; ``scale`` is |q| M."""
    apart = angle_of(centres[:, : len(point)] @ point)
    slack = SLACK * scale + SLACK
    return scale * np.cos(np.minimum(np.pi, apart + angles)) - slack, scale * np.cos(np.maximum(0.0, apart - angles)) + slack


class Best:
    """The first ``k`` rows of each window by (falling score, id)."""

    def __init__(self, windows: list[tuple[int, int]], k: int):
        self.low, self.high = [w[0] for w in windows], [w[1] for w in windows]
        self.k = k
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in windows]

    def open(self, least: float, most: float) -> bool:
        return any(low <= most and high >= least for low, high in zip(self.low, self.high))

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Rows that meet any window are put in order once; each window then takes its own from the place of its upper end."""
        here = np.flatnonzero((score >= min(self.low)) & (score <= max(self.high)))
        if not len(here):
            return
        here = here[np.lexsort((rows[here], ids[here], -score[here]))]
        falling = -score[here]
        for w, (low, high) in enumerate(zip(self.low, self.high)):
            at = int(np.searchsorted(falling, -high, "left")) if high < HIGHEST else 0
            mine = [(-int(score[i]), int(ids[i]), int(rows[i])) for i in here[at : at + self.k] if score[i] >= low]
            if mine:
                self.found[w] = sorted(self.found[w] + mine)[: self.k]
                if len(self.found[w]) == self.k:
                    # A row that ties with the last one may have the smaller id.
                    self.low[w] = max(low, -self.found[w][-1][0])


def descend(tree: CoverTree, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, longest: float, query: np.ndarray, match: np.ndarray, best: Best) -> int:
    """Search one tree, best bound first; ``match`` tells which rows (in the tree's order) may be found. Returns the rows looked at.

    Leaves are looked at in growing lots: the best one, then the next ``LOT`` still open, then ``LOT`` times as many, each
    lot against the windows as the ones before have left them. ``x`` is of a type in which the products are exact.
    """
    length = float(np.sqrt(np.square(query.astype(np.float64)).sum()))
    point = query / length if length else np.zeros(len(query))
    least, most = (b.tolist() for b in bounds(point, tree.centre, tree.angle, length * longest))
    first, children, sizes = tree.first, tree.children, tree.rows
    queue, lot, looked, query = [(-most[0], 0)], 1, 0, query.astype(x.dtype)
    while queue:
        leaves: list[int] = []
        while queue and len(leaves) < lot:
            _, node = heapq.heappop(queue)
            if not best.open(least[node], most[node]):
                continue
            if not children[node]:
                leaves.append(node)
                continue
            for child in range(first[node], first[node] + children[node]):
                if best.open(least[child], most[child]):
                    heapq.heappush(queue, (-most[child], child))
        if leaves:
            here = np.concatenate([np.arange(first[v], first[v] + sizes[v]) for v in leaves])
            looked += len(here)
            here = here[match[here]]
            if len(here):
                # Rows are copied to be multiplied by themselves, which pays for a part of the tree only.
                score = x[here] @ query if 4 * len(here) < len(x) else (x @ query)[here]
                best.add(score.astype(np.int64), ids[here], rows[here])
        lot *= LOT
    return looked


def _vectors(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


class Index:
    """Stored trees over candidates (_row, vec_id, label, x) with their shards."""

    def __init__(self, candidates: DataFrame):
        self.spark = candidates.sparkSession
        norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
        size = candidates.agg(F.count("*").alias("n"), F.max(norm).alias("most")).first()
        self.longest = longest = max(float(np.sqrt(size["most"] or 0.0)), 1.0)
        n_shards = int(min(SHARDS, max(1, -(-size["n"] // BLOCK))))
        few = candidates.orderBy(F.xxhash64("x"), "_row").limit(n_shards).select("x").toPandas()
        centres = spheric(_vectors(few["x"]).astype(np.float64), longest) if len(few) else np.zeros((0, 1))
        shared = self.spark.sparkContext.broadcast(centres)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy()
                    cosine = spheric(flat.reshape(batch.num_rows, -1).astype(np.float64), longest) @ shared.value.T
                    shard = cosine.argmax(1)
                    away = angle_of(cosine[np.arange(len(shard)), shard])
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard), pa.array(away)], [*batch.schema.names, "shard", "away"])

        fields = "_row long, vec_id long, label long, x array<long>"
        placed = stored(candidates.select("_row", "vec_id", "label", "x").mapInArrow(place, f"{fields}, shard long, away double"), "placed")
        # One row per shard, of which there are SHARDS at most.
        shards = placed.groupBy("shard").agg(F.count("*").alias("n"), F.max("away").alias("angle"))
        self.shards = stored(shards.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "shards")
        known = self.shards.orderBy("shard").collect()
        self.numbers = np.array([r["shard"] for r in known], np.int64)
        self.centres = centres[self.numbers] if known else centres
        self.angles = np.array([r["angle"] for r in known]) + 1e-7
        dealt = placed.join(F.broadcast(self.shards.select("shard", "blocks")), "shard")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("_row"), F.col("blocks")).cast("int"))

        def build(part: pd.DataFrame) -> pd.DataFrame:
            x = _vectors(part["x"])
            tree = cover_tree(spheric(x.astype(np.float64), longest))
            ordered = [part[c].to_numpy().astype(np.int64)[tree.order] for c in ("_row", "vec_id", "label")] + [x[tree.order]]
            blobs = [_pack(a) for a in (*astuple(tree)[:5], *ordered)]
            return pd.DataFrame({"shard": part["shard"].iloc[:1].to_numpy(), "block": part["block"].iloc[:1].to_numpy(), "blobs": [blobs]})

        built = dealt.groupBy("shard", "block").applyInPandas(build, "shard long, block int, blobs array<binary>")
        self.trees = stored(built, "cover-trees")

    def _ask(self, queries: DataFrame, first: bool) -> DataFrame:
        """Queries by shard: the ``FIRST`` best ones, or all others whose bounds meet a window."""
        shared = self.spark.sparkContext.broadcast((self.numbers, self.centres, self.angles))
        longest, names = self.longest, queries.columns

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, centres, angles = shared.value
            for batch in batches:
                chosen = []
                columns = [batch.column(names.index(c)).to_pylist() for c in ("x", "windows")]
                for x, windows in zip(*columns):
                    query = np.array(x, np.float64)
                    length = float(np.sqrt(np.square(query).sum()))
                    least, most = bounds(query / length if length else query, centres, angles, length * longest)
                    order = np.argsort(-most, kind="stable")
                    if first:
                        order = order[:FIRST]
                    else:
                        order = [i for i in order[FIRST:] if any(w["low"] <= most[i] and w["high"] >= least[i] for w in windows)]
                    chosen.append(numbers[order].tolist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, pa.list_(pa.int64()))], [*names, "shards"])

        fields = ", ".join(f"{n} {t}" for n, t in queries.dtypes)
        return queries.mapInArrow(choose, f"{fields}, shards array<long>").withColumn("shard", F.explode("shards")).drop("shards")

    def _search(self, asks: DataFrame, k: int, same: bool) -> DataFrame:
        """Asked queries meet the trees of their shard: (query, window, score, id, row), ``k`` per window and block at most."""
        longest = self.longest
        asks = stored(asks, "asks")
        askers = asks.groupBy("shard").agg(F.ceil(F.count("*") / ASKS).cast("int").alias("askers"))
        plan = F.broadcast(stored(self.shards.join(askers, "shard").select("shard", "blocks", "askers"), "ask-plan"))
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        left = asks.join(plan, "shard").withColumn("asker", F.pmod(F.xxhash64("query"), F.col("askers")).cast("int")).withColumn("block", every)
        right = self.trees.join(plan.drop("blocks"), "shard").withColumn("asker", F.explode(F.sequence(F.lit(0), F.col("askers") - 1)))
        keys = ["shard", "block", "asker"]
        left = left.select(*keys, "query", "label", "x", "windows")
        right = right.select(*keys, "blobs")
        columns = ["query", "window", "score", "id", "row"]

        def compare(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            made = []
            if len(asked) and len(held):
                blobs = held["blobs"].iloc[0]
                kinds = (np.float64, np.float64, np.int64, np.int64, np.int64, np.int64, np.int64, np.int64, np.int64)
                centre, angle, first, children, rows, places, ids, labels, x = (np.frombuffer(b, t) for b, t in zip(blobs, kinds))
                tree = CoverTree(centre.reshape(len(angle), -1), angle, first, children, rows, places)
                x = x.reshape(len(ids), -1)
                # Products in floating point are exact below 2^53; beyond, whole numbers are, as no score leaves a long.
                smooth, greatest = x.astype(np.float64), float(np.sqrt(np.square(x.astype(np.float64)).sum(1).max()))
                for query, label, own, windows in zip(asked["query"], asked["label"], asked["x"], asked["windows"]):
                    own = np.asarray(own, np.int64)
                    best = Best([(int(w["low"]), int(w["high"])) for w in windows], k)
                    safe = float(np.sqrt(np.square(own.astype(np.float64)).sum())) * greatest < 2**52
                    descend(tree, smooth if safe else x, ids, places, longest, own, (labels == label) == same, best)
                    made += [(query, w, -s, i, r) for w, found in enumerate(best.found) for s, i, r in found]
            return pd.DataFrame(made, columns=columns)

        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "query long, window int, score long, id long, row long")
        return found

    def search(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """First ``k`` candidates of each window with the query's label (or, not ``same``, another): query, window, rank, score, id, row.

        ``queries`` is a stored table (query, label, x, windows), windows an array of (low, high), both inclusive.
        """
        order = [F.desc("score"), F.asc("id"), F.asc("row")]
        place = F.row_number().over(Window.partitionBy("query", "window").orderBy(*order))
        near = stored(self._search(self._ask(queries, True), k, same), "first-found")
        if len(self.numbers) > FIRST:
            full = near.withColumn("n", place).filter(F.col("n") == k).select("query", "window", "score")
            full = full.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("least"))
            raised = F.transform("windows", lambda w, i: w.withField("low", F.greatest(w["low"], F.coalesce(F.col("least")[i], w["low"]))))
            narrow = queries.join(full, "query", "left").withColumn("windows", raised).select(*queries.columns)
            near = near.unionByName(self._search(self._ask(narrow, False), k, same))
        return near.withColumn("rank", place).filter(F.col("rank") <= k)


def first_of_equals(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest ids of each vector and label. Equal vectors tie in every score, so no other row can be among the first k."""
    order = Window.partitionBy("h", "label", "x").orderBy("vec_id", "_row")
    return rows.withColumn("h", F.xxhash64("x")).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("h", "n")


def hard_negatives(rows: DataFrame, anchors: str, low: int = 50, high: int = 95, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """For ``rows`` (vec_id, embedding, label) that the SQL condition ``anchors`` picks: their first positives, and for each the first
    rows of other labels that score between ``low`` and ``high`` per cent of it."""
    good = usable_vectors(rows, "label")
    whole, fits = scaled()
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    good = good.filter(fits).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("x"))
    good = good.filter("vec_id IS NOT NULL AND label IS NOT NULL").filter(norm < 2.0**62)
    good = numbered(stored(good, "labelled-vectors"), "_row")
    index = Index(first_of_equals(good, max(positives + 1, negatives)))
    window = F.struct(F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high"))
    asking = good.filter(anchors)
    queries = stored(asking.select("label", "x").distinct(), "queries")
    queries = stored(numbered(queries, "query").withColumn("windows", F.array(window)), "numbered-queries")
    # One more than asked for: the anchor may be among them.
    ahead = stored(index.search(queries, positives + 1, True).select("query", "score", "id", "row"), "positives")

    def per_cent(share: int, up: int) -> Column:
        """Per cent of the score, rounded up or down; a decimal, as a hundredfold long may not fit one."""
        return F.floor((F.col("score").cast("decimal(38,0)") * share + up) / F.lit(100).cast("decimal(3,0)")).cast("long")

    spans = ahead.filter("score >= 0").select("query", "score").distinct()
    spans = spans.withColumn("low", per_cent(low, 99)).withColumn("high", per_cent(high, 0)).filter("low <= high")
    spans = spans.groupBy("query").agg(F.sort_array(F.collect_set(F.struct("score", "low", "high"))).alias("spans"))
    spans = queries.drop("windows").join(spans, "query")
    spans = stored(spans.withColumn("windows", F.transform("spans", lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high")))), "spans")
    found = index.search(spans.select("query", "label", "x", "windows"), negatives, False)
    spots = spans.select("query", F.posexplode("spans").alias("window", "span")).select("query", "window", F.col("span.score").alias("positive_score"))
    found = found.join(spots, ["query", "window"]).select("query", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    asked = asking.select(F.col("vec_id").alias("anchor_id"), F.col("_row").alias("anchor"), "label", "x").join(queries.drop("windows"), ["label", "x"])
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    pairs = asked.select("anchor_id", "anchor", "query").join(ahead, "query").filter("row <> anchor").withColumn("n", F.row_number().over(order))
    pairs = pairs.filter(F.col("n") <= positives).select("anchor_id", "query", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(found, ["query", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows, "vec_id % 50 = 0")


ORACLE = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = len(embedding)),
usual AS (SELECT len(x) AS n FROM good GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
rows_ AS (SELECT row_number() OVER () AS r, * FROM good WHERE len(x) = (SELECT n FROM usual)),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, b.r, a.label = b.label AS same,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
pos AS (
  SELECT anchor, anchor_id, id AS positive_id, r AS p, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) <= 5),
neg AS (
  SELECT pos.anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY pos.anchor, p ORDER BY score DESC, id, r) AS rank
  FROM pos JOIN scores USING (anchor)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""
