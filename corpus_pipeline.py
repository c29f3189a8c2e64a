"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, resample, simhash, suffixes, tokens
from tidemark.llm.common import Sealed, numbered, stored, table

#: Near duplicates: shingles of five words, similarity of 0.8 or more. At that similarity 9 of 64 bits are expected
#: to differ, give or take 3, so candidates are fingerprints up to 15 bits apart; links are decided on the texts.
SHINGLE, SIMILARITY, BITS, CHAIN = 5, 0.8, 15, 2


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    return resample.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return simhash.one_of_each(docs, SHINGLE, BITS, CHAIN, SIMILARITY)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that stand earlier are cut out; n_chars follows the text. No row goes."""
    sealed = Sealed(docs, ("doc_id", "text", "n_chars"))
    found = suffixes.substring_dedup(sealed.rows, with_text=True).select("_row", F.col("kept").alias("text"))
    rest = numbered(sealed.rows, "_row").drop("text").join(found, "_row")
    if "n_chars" in rest.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast(dict(rest.dtypes)["n_chars"]))
    return sealed.open(rest)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents taken no time go."""
    sealed = Sealed(docs, ("doc_id", "text", "source"))
    plan = mixing.mix(sealed.rows).filter("copies > 0").select("_row", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("_each"))
    return sealed.open(numbered(sealed.rows, "_row").join(plan, "_row").withColumn("_copy", F.explode("_each")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    coded = tokens.encode(docs, keep=("doc_id", "lang", "source"))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", substring_dedup),
    ("mixing", mix),
    ("BPE encoding", encode),
]

#: SimHash chains, fitted classifiers and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
