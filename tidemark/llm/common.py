"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import storage

#: Fixed value: what a word is in every contract of this subpackage (ASCII blanks part words).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null. Counts the places where a word starts, without an array of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends, a lost executor costs a read.

    The table is deleted when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    storage.delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str = "row") -> DataFrame:
    """Number rows by place in the table. ``docs`` has to be a scan, so a repeated task gives the same numbers."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def join_back(rows: DataFrame, groups: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``rows`` with the columns of their group; rows without one go.

    ``groups`` is a stored table with one row per key, ``count`` its column with the number of rows that have the key.
    Groups of at least a thousandth of all rows, of which there are at most a thousand, are broadcast, so a hot key
    does not meet in one task; the rest is an ordinary join. ``rows`` is read twice.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    few = F.broadcast(groups.filter(F.col(count) * 1000 >= total))
    return rows.join(few, keys).unionByName(
        rows.join(few.select(*keys), keys, "left_anti").join(groups.join(few.select(*keys), keys, "left_anti"), keys)
    )


def usable_vectors(rows: DataFrame, *more: str) -> DataFrame:
    """vec_id, ``more`` and embedding (array of double) of rows with a vector of finite numbers, as long as most vectors."""
    found = rows.select("vec_id", *more, F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = found.filter(F.coalesce((F.size("embedding") > 0) & finite, F.lit(False)))
    lengths = found.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.filter(F.size("embedding") == (lengths["n"] if lengths else 0))


def scaled(embedding: str = "embedding", scale: float = 256.0) -> tuple[Column, Column]:
    """Each number times ``scale``, rounded down to a long; and whether all of them fit one."""
    whole = F.transform(embedding, lambda c: F.floor(c * scale))
    fits = F.forall(embedding, lambda c: F.abs(c * scale) < float(2**63))
    return whole, fits


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bytes_of(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as they are stored; a Spark string may hold any bytes, UTF-8 or not."""
    return column.cast(pa.binary()).to_pylist()


def raw(text: str | bytes | None) -> bytes:
    """Bytes of a text, none for null."""
    return text.encode() if isinstance(text, str) else text or b""


class Sealed:
    """A table whose other columns are out of the way: those not in ``used`` get neutral names until ``open``."""

    def __init__(self, docs: DataFrame, used: tuple[str, ...]):
        self.names = {c: c if c in used else f"c{i}" for i, c in enumerate(docs.columns)}
        self.rows = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in self.names.items()))

    def open(self, rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col(name).alias(c) for c, name in self.names.items()))
