"""Chat formatting, BPE, quality rules, mixing and the language model against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, ngrams, quality, tokens
from tidemark.llm.anchors import Chunk
from tidemark.llm.factors import words_of

SMALL = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Chat


def test_chat_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    want = con.execute(chat.ORACLE).fetchall()
    got = [tuple(r) for r in chat.op8_chat_format(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)


def test_chat_reads_back_any_text(spark):
    texts = [None, "", "</turn>\n", "&lt;turn&gt;", "<turn>user\nx</turn>\n", "a\nb", "\\n &amp;#10; <", "\x00"]
    rows = [(c, t, role, text) for c in (1, None) for t, (role, text) in enumerate((r, x) for r in ("user", "assistant", None, "a<b\n") for x in texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    done = chat.format_rows(df)
    back = done.select("conv_id", chat.read_back(F.col("formatted")).alias("t"), chat.learnt_text(F.col("formatted"), F.col("loss")).alias("l")).collect()
    assert len(back) == 2
    for row in back:
        own = [(r or "", x or "") for c, _, r, x in rows if c == row["conv_id"]]
        assert [(t["role"], t["text"]) for t in row["t"]] == own
        assert row["l"] == "".join(x for r, x in own if r == "assistant")


def test_chat_ties_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "user", "z"), (1, 0, "user", "a")]
    (row,) = chat.format_rows(spark.createDataFrame(rows, schema)).select(chat.read_back(F.col("formatted")).alias("t")).collect()
    assert [t["text"] for t in row["t"]] == ["a", "a", "b", "z"]
    assert chat.format_rows(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize(
    ("record", "layout", "turns"),
    [
        ('{"messages":[{"role":"user","content":"a<b"},{"role":"assistant","content":null}],"id":5}', "messages", [("user", "a<b"), ("assistant", None)]),
        ('{"prompt":"p","completion":"c"}', "prompt", [("user", "p"), ("assistant", "c")]),
        ('{"instruction":"i","output":"o"}', "instruction", [("user", "i"), ("assistant", "o")]),
        ('{"instruction":"i","input":"x","output":"o"}', "instruction_input", [("user", "i\nx"), ("assistant", "o")]),
        ('{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', "conversations", [("user", "h"), ("assistant", "g")]),
        ('{"prompt":"p","completion":"c","instruction":"i","output":"o"}', None, []),
        ("no json", None, []),
        (None, None, []),
    ],
)
def test_chat_layouts(spark, record, layout, turns):
    df = spark.createDataFrame([(1, record)], "id int, j string")
    (row,) = chat.turns_of_records(df, "j", ["id"]).collect()
    assert row["layout"] == layout and [tuple(t) for t in row["turns"]] == turns
    assert len(chat.format_turns(chat.turns_of_records(df, "j", ["id"]), ["id"]).collect()) == 1


# BPE


def test_bpe_agrees_with_the_library(spark, odd_docs, no_docs, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_tokenizer())
    extra = ["<|endoftext|>a<|endoftext|>", " don't I'LL   x 　 12½٠ \x1c\x85 ​", "éẞ̀", "�﻿"]
    docs = odd_docs.unionByName(odd_docs.limit(1).withColumn("text", F.explode(F.array(*map(F.lit, extra)))))
    docs = docs.unionByName(spark.read.parquet(f"{SMALL}/documents.parquet").limit(40), allowMissingColumns=True)
    want = Counter()
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        want[(row["doc_id"], tuple(ids), library.decode(ids, skip_special_tokens=False))] += 1
    for run, size in ((tokens.encode, 500), (tokens.encode_distinct, 500), (tokens.encode_distinct, tokens.CHUNK_BYTES)):
        monkeypatch.setattr(tokens, "CHUNK_BYTES", size)
        coded = run(docs)
        back = tokens.decode(coded.withColumn("key", F.to_json("ids")), keep=("doc_id", "key"))
        got = Counter((r["doc_id"], tuple(map(int, re.findall(r"\d+", r["key"]))), r["decoded"]) for r in back.collect())
        assert got == want
        assert run(no_docs).count() == 0
    tables = tokens.Tables(tokens.read_description(tokens.default_tokenizer()))
    monkeypatch.setattr(tokens, "TABLE_ROWS", 3)
    for text in ("one two three four five", "one two", "x y z one"):
        assert np.frombuffer(tables.encode(text), "<i4").tolist() == library.encode(text).ids


def test_bpe_encodes_each_distinct_word_once():
    tables = tokens.Tables(tokens.read_description(tokens.default_tokenizer()))
    met = Counter()

    class Counted:
        def coded(self, piece):
            met[piece] += 1
            return tables.coded(piece)

    blocks = [["one", " two", " two."], [" two", "é", "<|endoftext|>"], ["one", "é"]]
    answers = [tokens.unpack(b) for b in tokens.answers_to(map(tokens._pieces_packed, blocks), Counted())]
    assert set(met.values()) == {1} and set(met) == {p for b in blocks for p in b}
    for block, (sizes, ids) in zip(blocks, answers):
        assert [tables.coded(p) for p in block] == [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_bpe_keeps_columns_of_any_name(docs_of):
    texts = ["one two three", "three two", "", None, "one two three one two three"] * 20
    coded = tokens.encode_distinct(docs_of(list(enumerate(texts)), parts=4), keep=("doc_id", "_copy", "c0", "source"))
    rows = coded.collect()
    # Texts are cut once.
    assert "ReusedExchange" in coded._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 100 and all((r["_copy"], r["c0"]) == (7, "c") for r in rows)
    assert all((r["source"] is None) == (r["doc_id"] % 5 == 0) for r in rows)
    of = {r["doc_id"] % 5: r["ids"] for r in rows}
    assert all(r["ids"] == of[r["doc_id"] % 5] for r in rows) and of[2] == of[3] == [] and of[4][:len(of[0]) - 1] == of[0][:-1]


# Quality rules


def brute_measures(text):
    text = text or ""
    words = re.findall(WORD, text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            again += line in seen
            seen.add(line)
    places = defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k : k + 8])].append(k)
    covered = {j for v in places.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_quality_measures(spark, odd_docs):
    for docs in (odd_docs, spark.read.parquet(f"{SMALL}/documents.parquet")):
        want = Counter((r["doc_id"], *brute_measures(r["text"])) for r in docs.collect())
        assert Counter(tuple(r) for r in quality.measure(docs).select("doc_id", *quality.MEASURES[:5]).collect()) == want


def brute_em(patterns, counts):
    """The same model, one document and rule at a time."""
    p = [(sum(c == "g" for c in x) + 1) / (sum(c == "g" for c in x) + 3 * sum(c == "b" for c in x) + 2) for x in patterns]
    right, wrong = quality.PRIOR_RIGHT, quality.PRIOR_WRONG
    for _ in range(quality.ROUNDS):
        share = (sum(a * n for a, n in zip(p, counts)) + right) / (sum(counts) + right + wrong)
        rates = []
        for r in range(len(patterns[0])):
            g, b = [right, right + wrong], [wrong, right + wrong]
            for x, a, n in zip(patterns, p, counts):
                if x[r] != "-":
                    for rate, w in ((g, a * n), (b, (1 - a) * n)):
                        rate[0] += w * (x[r] == "g")
                        rate[1] += w
            rates.append((g[0] / g[1], b[0] / b[1]))
        p = []
        for x in patterns:
            up, down = share, 1 - share
            for c, (g, b) in zip(x, rates):
                up *= {"g": g, "b": 1 - g, "-": 1}[c]
                down *= {"g": b, "b": 1 - b, "-": 1}[c]
            p.append(up / (up + down))
    return p


def test_quality_expectation_maximisation():
    patterns, counts = ["ggg", "gg-", "bbg", "bb-", "gbb", "---"], np.array([50, 20, 10, 5, 2, 1])
    assert np.allclose(quality.posteriors(patterns, counts), brute_em(patterns, counts), atol=1e-4)


def test_quality_verdicts(spark, no_docs, tmp_path):
    found = quality.op5_quality_rules(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = found.merge(labels, on="doc_id")
    assert both[both.quality == 1].kept.mean() > 0.93
    assert both[both.quality == 0].kept.mean() < 0.5
    assert not found[found.base_failed].kept.any()
    assert ((found.n_words < 20) | (100 * found.n_repeat_words > 30 * found.n_words)).equals(found.base_failed)
    assert quality.judge(quality.measure(no_docs)).count() == 0


# Mixing


def brute_targets(sizes, limit=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        level = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if level[s] > limit * sizes[s]}
        if not over:
            return level | {s: limit * sizes[s] for s in full}
        full |= over


def test_mixing(spark, odd_docs, no_docs):
    for docs in (spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), odd_docs):
        rows = docs.select("doc_id", "source", "text").collect()
        sizes, longest = Counter(), Counter()
        for r in rows:
            n = len(re.findall(WORD, r["text"] or ""))
            sizes[r["source"]] += n
            longest[r["source"]] = max(longest[r["source"]], n)
        found = mixing.mix(docs).toPandas().astype({"source": object})
        assert len(found) == len(rows)
        assert (found.taken <= 3 * found["size"]).all() and (found.taken == found.copies * found["size"]).all()
        want = brute_targets(sizes)
        for source, own in found.groupby("source", dropna=False):
            source = source if isinstance(source, str) else None
            assert own.source_size.iloc[0] == sizes[source]
            assert math.isclose(own.target.iloc[0], want[source], rel_tol=1e-9, abs_tol=1e-6)
            assert abs(own.taken.sum() - want[source]) <= longest[source]
        # Rates are tilted exponentially in size: the logit is a line through the origin of "once".
        one = found[(found.rate < 2.999) & (found["size"] > 0)]
        for _, own in one.groupby("source", dropna=False):
            slope = np.log(2 * own.rate / (3 - own.rate)) / own["size"]
            assert np.allclose(slope, slope.iloc[0], atol=1e-6)
        again = mixing.mix(docs).toPandas()
        assert Counter(zip(found.doc_id.fillna(-1), found.taken)) == Counter(zip(again.doc_id.fillna(-1), again.taken))
    assert mixing.mix(no_docs).count() == 0


# Language model


@pytest.mark.parametrize(("n", "top"), [(1, 5), (10, 100), (1000, 10**6), (5000, 2**44), (300, 300)])
def test_elias_fano_successors(n, top):
    draw = np.random.default_rng(0)
    values = np.unique(draw.integers(0, top, n).astype(np.uint64))
    sequence = ngrams.EliasFano(ngrams.EliasFano.make(values))
    asked = np.unique(np.concatenate([values, draw.integers(0, top + 1000, 2000).astype(np.uint64)]))
    index, found = sequence.successor(asked)
    assert (index == np.searchsorted(values, asked)).all() and (found == np.isin(asked, values)).all()


def brute_model(docs):
    """Base figures and the model's score with plain dictionaries and no quantising."""
    words = {n: (i, (t or "").encode().lower().split() + [None]) for n, (i, t) in enumerate(docs)}
    train = {n for n, (i, _) in words.items() if i is None or zlib.crc32(str(i).encode()) % 7 != 2}
    count = Counter(w for n in train for w in words[n][1])
    return words, train, count


def test_language_model(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(ngrams, "CHUNK", 200_000)
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        words, train, count = brute_model(rows)
        total, distinct = sum(count.values()), len(count)
        want = Counter()
        for n, (i, own) in words.items():
            base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own)
            want[(i, n not in train, len(own), sum(count[w] > 0 for w in own), total, round(base, 6))] += 1
        got = ngrams.lm_scores(docs).collect()
        assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
        assert all(r["score"] < 0 for r in got)
    assert ngrams.lm_scores(no_docs).count() == 0


def brute_scores(docs):
    """Interpolated Witten-Bell trigrams in plain dictionaries, without quantising: log10 of each text's probability."""
    words, train, count = brute_model(docs)
    total, distinct = sum(count.values()), len(count)
    grams = [Counter(), Counter()]
    for n in train:
        own = ["begin", *words[n][1]]
        for at in range(1, len(own)):
            grams[0][(own[at - 1],), own[at]] += 1
            if at > 1:
                grams[1][(own[at - 2], own[at - 1]), own[at]] += 1
    of = [{}, {}]
    for order in (0, 1):
        for (context, _), c in grams[order].items():
            tokens, kinds = of[order].get(context, (0, 0))
            of[order][context] = (tokens + c, kinds + 1)
    made = {}
    for n, (i, text) in words.items():
        own, score = ["begin", *text], 0.0
        for at in range(1, len(own)):
            p = (count[own[at]] + 1) / (total + distinct + 1)
            contexts = [(own[at - 1],)] + ([(own[at - 2], own[at - 1])] if at > 1 else [])
            for order, context in enumerate(contexts):
                if context in of[order]:
                    tokens, kinds = of[order][context]
                    p = (grams[order][context, own[at]] + kinds * p) / (tokens + kinds)
            score += math.log10(p)
        made[n] = (i, len(text), score)
    return made


def scores_agree(spark_rows, docs):
    want = sorted((str(i), n, score) for i, n, score in brute_scores(docs).values())
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in spark_rows)
    assert [w[:2] for w in want] == [g[:2] for g in got]
    # A value and up to two weights per token, each rounded down by a step at most.
    assert all(w[2] - 3 * ngrams.STEP * w[1] <= g[2] <= w[2] + 1e-6 for w, g in zip(want, got))


def test_language_model_value(docs_of):
    """Held-out texts with unknown words, after known and unknown contexts."""
    held = [i for i in range(100) if ngrams.held_out(i)]
    others = [i for i in range(20) if not ngrams.held_out(i)]
    rows = [(i, "a b c a b d") for i in others] + list(zip(held, ["a b zz", "zz a b c", "yy zz b", "", "a b c a b d"]))
    scores_agree(ngrams.lm_scores(docs_of(rows)).collect(), rows)


def test_language_model_agrees_with_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "CHUNK", 200_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scores_agree(ngrams.lm_scores(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_language_model_without_training_documents(docs_of):
    held = [i for i in range(100) if ngrams.held_out(i)][:3]
    found = ngrams.lm_scores(docs_of([(i, "a b a") for i in held])).collect()
    assert [(r["n_known"], r["train_tokens"], r["score"]) for r in found] == [(0, 0, 0.0)] * 3


def test_trie_finds_successors_between_pointers():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 300, 4000).astype(np.uint64) * np.uint64(1000) + draw.integers(0, 900, 4000).astype(np.uint64))
    context, word = keys // np.uint64(1000) * np.uint64(1 << 40), keys % np.uint64(1000)
    count = draw.integers(1, 50, len(keys))
    trie = ngrams.Trie(context, word, count, 1000)
    asked = np.arange(310, dtype=np.uint64) * np.uint64(1 << 40)
    gram, w = np.repeat(np.arange(310), 20), draw.integers(0, 1000, 6200).astype(np.uint64)
    value, weight = trie.lookup(asked, gram, w)
    table = {(int(c), int(x)): int(n) for c, x, n in zip(context, word, count)}
    total, kinds = Counter(), Counter()
    for (c, _), n in table.items():
        total[c] += n
        kinds[c] += 1
    for g, x, v, back in zip(gram, w, value, weight):
        c = int(asked[g])
        p = table.get((c, int(x)), 0) / (total[c] + kinds[c]) if c in total else 0
        assert v == ngrams.codes(np.array([p]))[0]
        assert back == (ngrams.codes(np.array([kinds[c] / (total[c] + kinds[c])]))[0] if c in total else 0)


@pytest.mark.parametrize("n, top", [(1, 5), (50, 60), (5000, 1 << 60)])
def test_elias_fano_values(n, top):
    values = np.sort(np.random.default_rng(2).integers(0, top, n).astype(np.uint64))
    assert (ngrams.EliasFano(ngrams.EliasFano.make(values)).at(np.arange(n)) == values).all()


def test_language_model_beats_base_on_held_out_text(spark):
    found = ngrams.op7_lm_scores(spark, "/root/testdata/sf0.01").toPandas()
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum() + 0.6 * held.n_tokens.sum()


@pytest.mark.parametrize("top", [400, 1 << 20, 1 << 62])
def test_elias_fano_look_ups_in_lots(monkeypatch, top):
    """Ascending look-ups in ascending ranges: as a search of the plain values, without halving the sequence for each of them."""
    monkeypatch.setattr(ngrams, "LOT", 64)
    draw = np.random.default_rng(3)
    values = np.sort(draw.integers(0, top, 3000).astype(np.uint64))
    sequence = ngrams.EliasFano(ngrams.EliasFano.make(values))
    for a, b in ((0, 0), (0, 3000), (0, 1), (63, 65), (1000, 1000), (2999, 3000), (700, 2100)):
        assert (sequence.values(a, b) == values[a:b]).all()
    # Ranges of successors, some empty, with look-ups below, inside and above what they hold.
    cuts = np.sort(draw.integers(0, 3001, 41))
    x = np.sort(np.concatenate([values[::3], draw.integers(0, top, 2000).astype(np.uint64)]))
    of = np.minimum(np.searchsorted(values[np.minimum(cuts, 2999)], x), 39)
    start, stop = cuts[of], cuts[of + 1]
    asked = []
    at = ngrams.EliasFano.at
    monkeypatch.setattr(ngrams.EliasFano, "at", lambda self, i: asked.append(len(i)) or at(self, i))
    index, found = sequence.between(x, start, stop)
    want = np.clip(np.searchsorted(values, x), start, stop)
    assert (index == want).all()
    assert (found == ((want < stop) & (values[np.minimum(want, 2999)] == x))).all()
    assert sum(asked) < len(x)
    empty = ngrams.EliasFano(ngrams.EliasFano.make(values[:0]))
    assert [y.tolist() for y in empty.successor(x[:2])] == [[0, 0], [False, False]]


@pytest.mark.parametrize("top", [50, 1 << 40, 1 << 64])
def test_distinct_keys_with_and_without_room_for_places(top):
    keys = np.random.default_rng(4).integers(0, top - 1, 5000, np.uint64, endpoint=True)
    keys[::7] = top - 1
    found, place = ngrams._distinct(keys, top)
    want, inverse = np.unique(keys, return_inverse=True)
    assert (found == want).all() and (place == inverse).all()
    found, total, place = ngrams._added(keys, np.arange(5000), top)
    assert (total == np.bincount(inverse, np.arange(5000))).all() and (found[place] == keys).all()
    assert [len(x) for x in ngrams._distinct(keys[:0], top)] == [0, 0]


def test_a_chunk_of_tokens_is_rebuilt_without_its_order():
    """The order of a chunk's words is not sent, as it follows from how often each occurs."""
    texts = [b"b a a zz", b"", b"A b q a"]
    ids = np.array([1, 2, 3])
    own = ngrams.Tokens(Chunk(ids, np.cumsum([len(t) for t in texts]), b"".join(texts), ids, ids > 0), 5)
    again = ngrams.Tokens.unpack(own.pack())
    assert (again.at == own.at).all() and (np.diff(own.often[again.at]) <= 0).all()
    words = words_of(Chunk(ids, np.cumsum([len(t) for t in texts]), b"".join(texts).lower(), ids, ids > 0)).symbols
    of_words = own.words[again.at][again.place]
    ends = np.cumsum(own.counts) - 1
    assert (np.delete(of_words, ends) == words).all() and len(set(of_words[ends].tolist())) == 1


def test_trie_look_ups_share_decoded_stretches(monkeypatch):
    """Looking up many grams reads single values of the coded levels for a few of them only."""
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 20, 200_000).astype(np.uint64))
    context, word = keys >> np.uint64(8), keys & np.uint64(255)
    trie = ngrams.Trie(context, word, np.ones(len(keys), np.int64), 256)
    contexts, gram = np.unique(context, return_inverse=True)
    asked = []
    at = ngrams.EliasFano.at
    monkeypatch.setattr(ngrams.EliasFano, "at", lambda self, i: asked.append(len(i)) or at(self, i))
    value, weight = trie.lookup(contexts, gram, word)
    assert (value < 255).all() and (weight > 0).all()
    assert sum(asked) < len(keys) / 10


def test_language_model_sends_a_chunk_once(spark):
    """The step that asks for grams and the one that scores read one exchange of the chunks."""
    found = ngrams.op7_lm_scores(spark, SMALL)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
