"""Texts that are no UTF-8, texts above a megabyte, words with a pattern, and the greatest id."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, factors, mixing, ngrams, quality, resample, simhash, suffixes, tokens
from tidemark.llm.common import numbered

LAST = 2**63 - 1
BAD = b"caf\xff \xc3\x28 three four five six seven \xed\xa0\x80 nine"
LONG = " ".join(f"word{i % 977}" for i in range(200_000)).encode()
ROWS = [(1, BAD), (2, BAD), (LAST, b"plain text of a few words"), (None, b"plain text of a few words"), (5, LONG), (6, None)]


@pytest.fixture(scope="module")
def odd_bytes(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    made = spark.createDataFrame([(i, t and bytearray(t), "en", "s", 1) for i, t in ROWS], "doc_id long, text binary, lang string, source string, n_chars long")
    made.withColumn("text", F.col("text").cast("string")).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_substring_operators(odd_bytes):
    bytes_ = suffixes.substring_dedup(odd_bytes).collect()
    assert Counter((r["doc_id"], r["n_bytes"]) for r in bytes_) == Counter((i, len(t or b"")) for i, t in ROWS)
    assert by_id(bytes_)[1]["kept_sha256"] == hashlib.sha256(BAD).hexdigest()
    words = factors.phrase_dedup(odd_bytes).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in words) == Counter((i, len((t or b"").split())) for i, t in ROWS)
    # All of the long text but its ends repeats itself.
    assert by_id(words)[5]["n_removed"] == 200_000 and by_id(words)[1]["n_removed"] == 0


def test_fingerprints(odd_bytes):
    found = by_id(simhash.near_duplicates(odd_bytes).collect())
    parts = BAD.lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + 3]), 42) for i in range(len(parts) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert found[1]["fp"] % 2**64 == want and found[2]["component_id"] == 1 and found[None]["component_id"] == LAST


def test_measures_and_weights(odd_bytes, spark):
    found = by_id(quality.measure(odd_bytes).collect())
    assert found[1]["n_words"] == 9 and found[1]["word_chars"] == len(b"".join(BAD.split()).decode("utf-8", "replace"))
    assert found[5]["n_words"] == 200_000
    labels = spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, quality int")
    assert resample.weigh(odd_bytes, resample.fit(odd_bytes, labels)).count() == len(ROWS)


def test_tokens(odd_bytes):
    for encode in (tokens.encode, tokens.encode_distinct):
        coded = by_id(tokens.decode(encode(odd_bytes)).collect())
        assert coded[1]["decoded"] == BAD.decode("utf-8", "replace") and coded[5]["decoded"] == LONG.decode()


def test_scores_and_mix(odd_bytes):
    found = ngrams.lm_scores(odd_bytes).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in ROWS)
    assert by_id(found)[5]["n_tokens"] == 200_001
    assert mixing.mix(odd_bytes).count() == len(ROWS)


def test_pipeline_stages(odd_bytes):
    spark = odd_bytes.sparkSession
    deduped = corpus_pipeline.near_dedup(spark, odd_bytes, "")
    assert sorted(r["doc_id"] for r in deduped.select("doc_id").collect()) == [1, 5, 6, LAST]
    assert corpus_pipeline.encode(spark, odd_bytes, "").count() == len(ROWS)


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 else b for i in range(n))


@pytest.mark.parametrize("size", [64, 256, 1024, 4096])
def test_words_with_a_pattern_are_told_apart(docs_of, size):
    """Sums modulo 2^64 are equal for these two words from 1,024 letters on, whatever the base."""
    rest = " ".join(f"w{i}" for i in range(34))
    docs = docs_of([(1, f"{thue_morse(size, 'a', 'b')} {rest}"), (2, f"{thue_morse(size, 'b', 'a')} {rest}")])
    assert [r["n_removed"] for r in factors.phrase_dedup(docs).collect()] == [0, 0]


def test_words_not_trained_on_are_unknown(docs_of):
    trained = [(i, thue_morse(1024, "a", "b")) for i in range(1, 9) if not ngrams.held_out(i)]
    held = next(i for i in range(1, 100) if ngrams.held_out(i))
    found = by_id(ngrams.lm_scores(docs_of([*trained, (held, thue_morse(1024, "b", "a"))])).collect())
    # The end of the text is a token that is known.
    assert found[held]["n_known"] == 1


def test_bitmaps_rule_out_no_similar_pair():
    draw = np.random.default_rng(4)
    sets = []
    for size in (0, 1, 5, 300, 5000):
        base = draw.integers(0, 2**63, size, dtype=np.uint64)
        for share in (0.0, 0.05, 0.1, 0.15, 0.3):
            fresh = draw.integers(0, 2**63, int(size * share), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([base[len(fresh) :], fresh])))
    sketches = np.stack([simhash.sketch(s) for s in sets])
    size = np.array([len(s) for s in sets])
    left, right = np.triu_indices(len(sets), 1)
    fit = simhash.Candidates(15, 0.8, True).alike(left, right, size, sketches)
    for a, b, kept in zip(left, right, fit):
        shared = len(np.intersect1d(sets[a], sets[b]))
        assert kept or shared < 0.8 * (size[a] + size[b] - shared)
    assert not fit.all()


def test_chat_rows_of_other_layouts_and_ties(spark):
    def formatted(rows, schema):
        done = chat.format_rows(spark.createDataFrame(rows, schema))
        return [[tuple(t) for t in r["t"]] for r in done.select(chat.read_back(F.col("formatted")).alias("t")).collect()]

    want = [[("user", "hello"), ("assistant", "yes")]]
    plain = [(1, 0, "user", "hello"), (1, 1, "assistant", "yes")]
    assert formatted(plain, "conv_id long, turn int, role string, text string") == want
    assert formatted(plain, "conv_id long, turn int, role string, content string") == want
    told = [(1, 0, "human", "hello"), (1, 1, "gpt", "yes")]
    assert formatted(told, "conv_id long, turn int, `from` string, value string") == want
    nested = [(1, 0, ("user", "hello")), (1, 1, ("assistant", "yes"))]
    assert formatted(nested, "conv_id long, turn int, message struct<role:string,content:string>") == want
    both = [(*r, "other") for r in plain]
    assert formatted(both, "conv_id long, turn int, role string, text string, content string") == want
    # Null counts as empty before rows are ordered.
    assert formatted([(1, 0, None, "b"), (1, 0, "", "a")], "conv_id long, turn int, role string, text string") == [[("", "a"), ("", "b")]]
    with pytest.raises(ValueError, match="no mapping"):
        chat.format_rows(spark.createDataFrame([(1, "x")], "conv_id long, body string"))


def test_fingerprint_is_the_same_in_a_column(spark):
    paths = ["messages[].role", "messages[].content"]
    row = spark.range(1).select(chat._hash(F.array(*map(F.lit, paths))).alias("h")).first()
    assert row["h"] == chat.fingerprint(paths)
    assert numbered(spark.range(2), "n").count() == 2
