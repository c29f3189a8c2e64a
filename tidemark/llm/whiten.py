"""Embedding whitening from a weighted covariance over distinct vectors.

Vectors become whole numbers x = floor(``SCALE`` * c). Equal x vectors are grouped; the distinct ones are the fit list, each
with a weight of one or of its number of rows. Sums are exact. Tasks centre their distinct vectors and multiply them
(a weighted GEMM each); their matrices meet row by row, added in the order of the tasks, so reruns agree. The driver holds one
matrix of the vectors' dimension, whatever the number of rows, and takes its eigenvectors. Each distinct vector is whitened once, and
the result is joined back to its rows; a vector that many rows share is broadcast for that (``common.join_back``).

Defined results: rows whose vector is null, empty or holds null or non-finite numbers go, as do those of another length than most
vectors or with a number that does not fit a long when scaled; zero vectors stay; a null id is kept; repeated rows give repeated
results. A component without variance (fewer distinct vectors than dimensions, or all vectors equal) has a null
``whitened``, and ``identity_error`` is taken over the other components (null without any); ``explained`` is null where there
is no variance at all. A ``deviation`` beyond a long is null. An empty table gives an empty result; columns other than vec_id
and embedding are not read. Equal eigenvalues leave their components open up to a rotation. The sign of a component is that
which makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_back, scaled, stored, table, usable_vectors

#: Fixed value: numbers are compared and counted at this resolution.
SCALE = 256.0
COMPONENTS = 4
LONG = 2**63
RESULT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _largest(numbers: np.ndarray) -> float:
    return max(abs(float(numbers.max())), abs(float(numbers.min()))) if numbers.size else 0.0


def exact_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Weighted sum of each column of whole numbers."""
    if _largest(x) * float(weight.max()) * len(x) < LONG / 2:
        return [int(s) for s in weight @ x]
    return [int(s) for s in (x.astype(object) * weight.astype(object)[:, None]).sum(0)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the columns of (n*x - sum)^2, exactly; None beyond a long."""
    bound = n * _largest(x) + max(abs(s) for s in sums)
    if bound * bound * x.shape[1] < LONG / 2:
        return np.square(n * x - np.array(sums, np.int64)).sum(1).tolist()
    found = np.square(n * x.astype(object) - np.array(sums, object)).sum(1)
    return [int(v) if v < LONG else None for v in found]


def column_sums(rows: DataFrame, vectors: str = "x", weight: str = "weight") -> tuple[int, list[int]]:
    """Total weight and weighted sum of each column, without rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                weights = batch.column(1).to_numpy().astype(np.int64)
                total += sum(weights.tolist())
                own = exact_sums(_matrix(batch.column(0), np.int64), weights)
                sums = own if sums is None else [a + b for a, b in zip(sums, own)]
        if sums is not None:
            found = pa.array([str(v) for v in [total, *sums]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), found], ["place", "amount"])

    parts = rows.select(vectors, weight).mapInArrow(run, "place int, amount string")
    found = parts.groupBy("place").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).orderBy("place").collect()
    return (int(found[0]["amount"]), [int(r["amount"]) for r in found[1:]]) if found else (0, [])


def scatter(rows: DataFrame, mean: np.ndarray, vectors: str = "x", weight: str = "weight") -> np.ndarray:
    """Weighted sum of (v - mean)(v - mean)^T: one GEMM per batch, one matrix per task, one row of all of them per group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch.column(0), np.float64) - mean
                own = (centred * batch.column(1).to_numpy().astype(np.float64)[:, None]).T @ centred
                made = own if made is None else made + own
        if made is not None:
            task = TaskContext.get().partitionId()
            columns = [pa.array([task] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()), pa.array(made.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["task", "place", "part"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("task")
        return pd.DataFrame({"place": parts["place"].to_numpy()[:1], "part": [np.add.reduce(np.stack(parts["part"].to_numpy()))]})

    parts = rows.select(vectors, weight).mapInArrow(run, "task int, place int, part array<double>")
    found = parts.groupBy("place").applyInPandas(add, "place int, part array<double>").orderBy("place").collect()
    return np.array([r["part"] for r in found], np.float64).reshape(len(mean), len(mean))


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most].copy(), vectors[:, ::-1][:, :most].copy()
    top = np.abs(vectors).argmax(0)
    return values, vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def whiten(rows: DataFrame, components: int = COMPONENTS, weigh_by_rows: bool = False) -> DataFrame:
    """For ``rows`` (vec_id, embedding): one row per row that takes part and component, as ``RESULT`` has it.

    ``weigh_by_rows`` gives each distinct vector the number of its rows as weight, otherwise one.
    """
    spark = rows.sparkSession
    good = usable_vectors(rows)
    whole, fits = scaled(scale=SCALE)
    good = good.filter(fits).select("vec_id", whole.alias("x"))
    weight = F.col("m") if weigh_by_rows else F.lit(1).cast("long")
    distinct = stored(good.groupBy("x").agg(F.count("*").alias("m")).withColumn("weight", weight), "distinct-vectors")
    n, sums = column_sums(distinct)
    if not n:
        return spark.createDataFrame([], RESULT.format(dict(rows.dtypes)["vec_id"]))
    mean = np.array([s / n for s in sums])
    covariance = scatter(distinct, mean) / n
    values, vectors = principal(covariance, min(components, len(sums)))
    total = float(np.trace(covariance))
    varies = values > max(float(values[0]), 0.0) * len(sums) * np.finfo(float).eps * 8
    project = vectors[:, varies] / np.sqrt(values[varies])
    places = np.flatnonzero(varies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), np.int64)
            made = (x - mean) @ project
            far = pa.array(deviations(x, n, sums) if len(x) else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, far, pa.array(made.tolist(), pa.list_(pa.float64()))], [*batch.schema.names, "deviation", "w"])

    white = stored(distinct.mapInArrow(run, "x array<long>, m long, weight long, deviation long, w array<double>"), "white-vectors")
    error = F.lit(None).cast("double")
    if len(places):
        means = white.agg(*[(F.sum(F.col("w")[i] * F.col("weight")) / n).alias(f"w{i}") for i in range(len(places))]).first()
        apart = scatter(white, np.array(list(means)), "w") / n - np.eye(len(places))
        error = F.lit(float(np.abs(apart).max()))
    share = [float(v) / total if total > 0 else None for v in values]
    where = {int(p): i for i, p in enumerate(places)}
    each = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("component"),
                (F.col("w")[where[i]] if i in where else F.lit(None).cast("double")).alias("whitened"),
                F.lit(share[i]).cast("double").alias("explained"),
            )
            for i in range(len(values))
        ]
    )
    joined = join_back(good, white.select("x", "m", "deviation", "w"), ["x"], "m")
    return joined.select("vec_id", "deviation", F.explode(each).alias("c")).select(
        "vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", error.alias("identity_error")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
