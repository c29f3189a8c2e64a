"""Quality rules under weak supervision.

Each rule looks at a few measures of a document and votes good, votes bad or abstains. How far a rule is to
be trusted is not set by hand: expectation-maximisation over the votes of all documents estimates, for
each rule, how often it votes either way on good and on bad documents, and the share of good documents.
A document is kept if its posterior probability of being good is at least ``KEEP_FROM``, so one rule alone
need not decide.

Measures and votes are one pass in Python over Arrow batches. Votes have at most ``3 ** rules`` patterns, so EM works on
counts per pattern: Spark counts, the driver iterates over a few thousand rows at most, and the posteriors
go back by a broadcast of that same bounded table.

Defined results: a null or empty text has no words and fails the base rules; very long texts are read whole; repeated rows are
measured each on their own; a text's measures do not depend on other rows; an empty table gives an empty
result; columns not named here are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, raw, stored, table

#: Fixed values of the base rules: least words, most words in repeated windows (percent), words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
KEEP_FROM = 0.5
ROUNDS = 200

PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_bytes",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct",
)
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def rules() -> dict[str, tuple[Column, Column]]:
    """For each rule, when it votes good and when it votes bad; it abstains elsewhere."""
    words, chars = F.col("n_words"), F.greatest(F.col("n_bytes"), F.lit(1))
    symbols = F.col("n_symbols") / F.greatest(words, F.lit(1))
    upper, digits, marks = (F.col(name) / chars for name in ("n_upper", "n_digits", "n_marks"))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    repeats = F.col("n_repeat_words") / F.greatest(words, F.lit(1))
    length = F.col("word_chars") / F.greatest(words, F.lit(1))
    distinct = F.col("n_distinct") / F.greatest(words, F.lit(1))
    return {
        "symbols": (symbols <= 0.1, symbols >= 0.4),
        "upper": (upper <= 0.2, upper >= 0.5),
        "digits": (digits <= 0.1, digits >= 0.3),
        "marks": (marks <= 0.12, marks >= 0.2),
        "lines": (lines <= 0.1, lines >= 0.3),
        "repeats": (repeats <= 0.1, repeats >= 0.2),
        "length": (length.between(3, 12), (length < 2) | (length > 20)),
        "distinct": ((words >= 50) & (distinct >= 0.2), (words >= 50) & (distinct < 0.1)),
        "words": (words >= 50, words < LEAST_WORDS),
    }


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # Ranks of windows of 2, 4, 8 words: a pair of ranks is one number, so equal ranks are equal windows.
    width = 1
    while width < WINDOW:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        _, ids = np.unique(pairs, return_inverse=True)
        width *= 2
    again = np.bincount(ids)[ids] > 1
    if not again.any():
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + WINDOW, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def measures(text: str | bytes | None) -> tuple[int, ...]:
    """The values of ``MEASURES``. In bytes that are no UTF-8 each part that cannot be read counts as one character."""
    whole = raw(text)
    words = whole.split()
    joined = b"".join(words)
    lines = [line for line in whole.split(b"\n") if line.strip()]

    def of(some: bytes) -> int:
        return len(joined) - len(joined.translate(None, some))

    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        of(SYMBOLS.encode()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(joined),
        of(_UPPER),
        of(_DIGITS),
        of(_MARKS),
        len(set(words)),
    )


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Return ``keep`` and the measures of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(t) for t in bytes_of(batch.column(len(keep)))]
            columns = [batch.column(i) for i in range(len(keep))]
            values = [pa.array([m[i] for m in found], pa.int64()) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*columns, *values], [*keep, *MEASURES])

    used = docs.select(*keep, F.col("text").alias("_text"))
    fields = [f"`{name}` {kind}" for name, kind in used.drop("_text").dtypes] + [f"{m} long" for m in MEASURES]
    return used.mapInArrow(run, ", ".join(fields))


def votes() -> Column:
    """One letter per rule: g, b or - for abstaining."""
    return F.concat(*[F.when(bad, "b").when(good, "g").otherwise("-") for good, bad in rules().values()])


def posteriors(patterns: list[str], counts: np.ndarray) -> np.ndarray:
    """Probability of good for each vote pattern, by expectation-maximisation.

    Two classes; a rule's vote depends on the class alone; abstaining says nothing. A weak prior
    (``PRIOR_RIGHT`` right votes to ``PRIOR_WRONG`` wrong ones, per rule and class) keeps "good" and
    "bad" from trading places and covers rules that never vote.
    """
    good = np.array([[c == "g" for c in p] for p in patterns], float)
    bad = np.array([[c == "b" for c in p] for p in patterns], float)
    n = counts.astype(float)[:, None]
    p = (good.sum(1) + 1) / (good.sum(1) + 3 * bad.sum(1) + 2)
    before = np.inf
    for _ in range(ROUNDS):
        w, v = p[:, None] * n, (1 - p)[:, None] * n
        share = (w.sum() + PRIOR_RIGHT) / (n.sum() + PRIOR_RIGHT + PRIOR_WRONG)
        good_says_good = ((w * good).sum(0) + PRIOR_RIGHT) / ((w * (good + bad)).sum(0) + PRIOR_RIGHT + PRIOR_WRONG)
        bad_says_good = ((v * good).sum(0) + PRIOR_WRONG) / ((v * (good + bad)).sum(0) + PRIOR_RIGHT + PRIOR_WRONG)
        up = np.log(share) + good @ np.log(good_says_good) + bad @ np.log(1 - good_says_good)
        down = np.log(1 - share) + good @ np.log(bad_says_good) + bad @ np.log(1 - bad_says_good)
        p = 1 / (1 + np.exp(np.clip(down - up, -700, 700)))
        if abs(up.sum() - before) < 1e-9 * max(1.0, abs(before)):
            break
        before = up.sum()
    return p


def judge(measured: DataFrame) -> DataFrame:
    """Add base_failed, votes, posterior, kept. ``measured`` should be a stored table; it is read twice."""
    spark = measured.sparkSession
    voted = measured.withColumn("votes", votes())
    rows = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    found = posteriors([r["votes"] for r in rows], np.array([r["n"] for r in rows])) if rows else []
    known = spark.createDataFrame([(r["votes"], float(p)) for r, p in zip(rows, found)], "votes string, posterior double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        voted.join(F.broadcast(known), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("posterior") >= KEEP_FROM))
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(measure(table(spark, sf_dir, "documents")), "quality-measures")
    wanted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
    return judge(measured).select("doc_id", *wanted)
