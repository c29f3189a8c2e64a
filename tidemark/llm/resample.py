"""Quality classifier by importance resampling.

Two bag-of-n-grams models over hashed buckets are fitted: one of target text (documents labelled good), one of
raw text (all documents). A document's log importance weight is the mean log ratio of the two over its
unigrams and bigrams, times ``TOKENS``: it weighs every text as one of that length, so long texts do not drift away. The
documents kept are the Gumbel top-k: the k largest of log weight plus Gumbel noise, which is a sample
without replacement in proportion to the weights.

k is the number of documents whose weight reaches a threshold set on labelled documents that the target
model has not seen. Raw counts, weights and the top-k cover all documents. Only the labelled documents are a sample: the
``LABELLED`` rows of ``labels`` with the smallest hash of their id. Noise is a hash of the id,
so reruns agree.

Tokens are runs of letters and digits, and runs of marks, in lower-case ASCII. Defined results: a null or empty text has
weight 0; without labels of either kind every document is kept; rows with one id get the same noise; ties at the cut are
all kept; an empty table gives an empty result; other columns are passed through by ``keep_good`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.anchors import Sums, mix
from tidemark.llm.common import Sealed, bytes_of, raw, stored, table

BUCKETS = 1 << 18
TOKENS = 200.0
#: Bound of the labelled sample.
LABELLED = 20_000
#: How much more a good document lost weighs than a bad one kept, where the threshold is set.
GOOD_WEIGHS = 3.0
SEED = 9
BINS = 4096

_KIND = np.array(
    [0 if c in (9, 10, 11, 12, 13, 32) else 1 if c >= 128 or chr(c).isalnum() else 2 for c in range(256)], np.uint8
)


def features(text: str | bytes | None) -> np.ndarray:
    """Buckets of a text's unigrams and bigrams, with repeats."""
    data = np.frombuffer(raw(text).lower(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(data))
    solid = kind[start] > 0
    token = Sums(data).hashes(start[solid], stop[solid])
    pairs = mix(token[:-1] * np.uint64(3) + token[1:])
    return (np.concatenate([token, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    """Log ratio of target and raw per bucket, and the threshold on weights."""

    ratio: np.ndarray
    threshold: float

    def weight(self, text: str | None) -> float:
        found = features(text)
        return float(self.ratio[found].mean(dtype=np.float64) * TOKENS) if len(found) else 0.0


def labelled_sample(labels: DataFrame) -> DataFrame:
    """At most ``LABELLED`` rows: _label_id, good, fit (whether the target model may use it)."""
    known = labels.select(F.col("doc_id").alias("_label_id"), "quality").dropna()
    few = known.orderBy(F.xxhash64("_label_id"), "_label_id").limit(LABELLED)
    one = few.groupBy("_label_id").agg((F.min("quality") == 1).alias("good"))
    return one.withColumn("fit", F.pmod(F.xxhash64("_label_id", F.lit(SEED)), F.lit(2)) == 0)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for text, use in zip(bytes_of(part.column(0)), part.column(1).to_pylist()):
                found = features(text)
                np.add.at(raw, found, 1)
                if use:
                    np.add.at(target, found, 1)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def weigh(docs: DataFrame, model: Model, name: str = "weight") -> DataFrame:
    """Add the log weight of every row; the other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ratio, model.threshold))
    fields = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        at = fields.index("text")
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                weights = pa.array([own.weight(t) for t in bytes_of(part.column(at))], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, weights], [*fields, name])

    schema = docs.select("*", F.lit(0.0).alias(name)).schema
    return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit both models and the threshold. What reaches the driver is bounded: the buckets and the labelled sample."""
    sample = stored(labelled_sample(labels), "labelled")
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_label_id"), "left")
    use = F.coalesce(F.col("good") & F.col("fit"), F.lit(False))
    counts = (
        marked.select("text", use.alias("use"))
        .mapInArrow(_counts, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"]], target[counts["bucket"]] = counts["raw"], counts["target"]
    if not target.sum():
        return Model(np.zeros(BUCKETS, np.float32), -np.inf)
    share = target.sum() / raw.sum()
    # An n-gram the target lacks gets one occurrence at the target's share of the raw text.
    p, q = (target + share) / (target.sum() + share * BUCKETS), (raw + 1) / (raw.sum() + BUCKETS)
    model = Model(np.log(p / q).astype(np.float32), -np.inf)
    unseen = marked.filter("NOT fit").select("text", "good")
    rows = weigh(unseen, model).select("weight", "good").toPandas().sort_values("weight")
    good, bad = (rows["good"] == True).to_numpy(), (rows["good"] == False).to_numpy()  # noqa: E712
    if good.any() and bad.any():
        lost = np.cumsum(good) / good.sum()
        caught = np.cumsum(bad) / bad.sum()
        gain = caught - GOOD_WEIGHS * lost
        best = int(gain.argmax())
        if gain[best] > 0:
            above = rows["weight"].iloc[min(best + 1, len(rows) - 1)]
            model.threshold = float((rows["weight"].iloc[best] + above) / 2)
    return model


def noise(doc_id: Column) -> Column:
    """Gumbel noise from a hash of the id."""
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(SEED)), 11) + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(u))


def top_k_cut(keys: DataFrame, k: int) -> float:
    """The k-th largest ``key``. Counts per bin are refined until few keys are left to look at."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k >= (n or 0):
        return float("-inf")
    if k <= 0:
        return float("inf")
    while True:
        inside = keys.filter(F.col("key").between(low, high))
        if high <= low:
            return float(high)
        width = (high - low) / BINS
        bins = F.least(F.lit(BINS - 1), F.floor((F.col("key") - low) / width).cast("int"))
        rows = inside.groupBy(bins.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for row in sorted(rows, key=lambda r: -r["bin"]):
            if k <= row["n"]:
                break
            k -= row["n"]
        if row["n"] <= BINS:
            few = sorted((r["key"] for r in inside.filter(F.col("key").between(row["low"], row["high"])).collect()), reverse=True)
            return float(few[k - 1])
        if (low, high) == (row["low"], row["high"]):
            return float(high)
        low, high = row["low"], row["high"]


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Add weight, key and kept to ``docs``, whose other columns stay.

    Texts are weighed once for the top-k and again here, so they are never shuffled.
    """
    used = docs.select("doc_id", "text")
    model = fit(used, labels)
    key = (F.col("weight") + noise(F.col("doc_id"))).alias("key")
    keys = stored(weigh(used, model).select("weight", key), "gumbel")
    k = keys.filter(F.col("weight") >= model.threshold).count()
    cut = top_k_cut(keys, k)
    return weigh(docs, model).withColumn("key", key).withColumn("kept", F.col("key") >= cut)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents kept, with the columns of ``docs``."""
    sealed = Sealed(docs, ("doc_id", "text"))
    return sealed.open(classify(sealed.rows, labels).filter("kept"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).drop("text")
