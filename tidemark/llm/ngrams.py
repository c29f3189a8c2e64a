"""Scoring texts with a trigram model of words in Elias-Fano tries.

Each order is interpolated with the one below it (Witten-Bell), so all orders are proper:

* ``P(w)``: the count of the word plus one, over the tokens plus the distinct words plus one; all words that were not seen in training
  are one word.
* ``P(w | v)`` and ``P(w | u, v)``: with ``c`` the context's count and ``d`` its distinct successors, the gram's count over ``c + d``, plus
  the lower order times ``d / (c + d)``. A context that was not seen leaves the lower order as it is. The first word of a
  text has the beginning as its context, the second the beginning and the first.

A word is its 64-bit hash. Words seen in training are numbered by shard and falling count, so that frequent ones have small numbers; the
numbers are joined back per chunk of documents, as are all answers. Counts cover all training documents:

1. Each chunk is cut into tokens once; its distinct words go to shards, with counts, and its tokens are stored as places in its own list of words.
2. A shard of words adds up the counts and answers with count and number of each word.
3. Chunks turn places into numbers and send their distinct bigrams and trigrams to shards, by context.
4. A shard of grams builds the trie of its contexts and looks each distinct gram up, once for all chunks.
5. Chunks turn answers into scores.

What a shard gets of one gram is one entry per chunk, however often it occurs. A chunk's tokens are sent once: steps 3 and 5 read the
same exchange, as they are parts of one job. The number of shards grows with the bytes of the texts.

A trie level is an Elias-Fano sequence: monotone contexts, monotone pointers to where the context's successors begin, and the successors,
each relative to its context's number so that they are monotone as well. A look-up finds the context, reads its two pointers and searches
the successors between them. A shard's look-ups come in order, in lots: the first and the last of a lot halve the coded sequence, and
the stretch between the two is decoded once for all of the lot. Values are smoothed probabilities and back-off weights, quantised to a byte. Levels lie
in one file that the task maps into memory and unlinks at once.

Defined results: a null or empty text is the end token alone; a null id trains; repeated rows count as often as they
occur; without training documents every probability is that of an empty model; an empty table gives an empty result;
columns other than doc_id and text are not read; more than 2^32 distinct training words are an error.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.anchors import Chunk, chunked, mix, pack, scanned, unpack
from tidemark.llm.common import partitions, stored, table
from tidemark.llm.factors import words_of
from tidemark.session import many_open_writers, scratch_path
from tidemark.sources import storage

CHUNK = 8_000_000
#: Bytes of text to a shard.
SHARD_BYTES = 64_000_000
#: Numbers that are not words: not seen in training, and the beginning of a text.
UNKNOWN, BEFORE, WORDS_FROM = 0, 1, 2
#: Look-ups that share a decoded stretch of a level.
LOT = 1 << 16
#: Step of the quantised logarithms, in powers of ten; code 255 stands for zero.
STEP = 0.025
#: Every seventh remainder is held out.
HELD_MODULUS, HELD_REMAINDER = 7, 2

_U = np.uint64
_END = mix(np.array([0xE4D], np.uint64))[0]


class EliasFano:
    """A monotone sequence as low bits side by side and a bit per unary step of the high parts."""

    def __init__(self, words: np.ndarray):
        """``words`` as ``make`` returns them; nothing is copied, so they may be mapped from a file."""
        self.n, self.low_bits, size = (int(x) for x in words[:3])
        self.low = words[3 : 3 + size].view(np.uint8)
        self.high = words[3 + size :]
        self.ones_before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])

    @staticmethod
    def make(values: np.ndarray) -> np.ndarray:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, min(50, ((top + 1) // max(n, 1)).bit_length() - 1))
        low = np.zeros(-(-n // 64) * low_bits + 2, np.uint64)
        if n and low_bits:
            # 64 values fill as many words as they have low bits; column i holds the i-th value of each such group.
            columns = np.ascontiguousarray(np.pad(values, (0, -n % 64)).reshape(-1, 64).T) & _U((1 << low_bits) - 1)
            side = np.zeros((low_bits, columns.shape[1]), np.uint64)
            for i, column in enumerate(columns):
                word, shift = divmod(i * low_bits, 64)
                side[word] |= column << _U(shift)
                if shift + low_bits > 64:
                    side[word + 1] |= column >> _U(64 - shift)
            low[:-2] = side.T.ravel()
        places = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        size = int(places[-1]) + 2 if n else 1
        flags = np.zeros(-(-size // 64) * 64 + 64, np.uint8)
        flags[places] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        return np.concatenate([np.array([n, low_bits, len(low)], np.uint64), low, high])

    def _select(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th one of the high bits, from 0."""
        word = np.searchsorted(self.ones_before, k, "right") - 1
        rest = k - self.ones_before[word]
        bits, at = self.high[word], np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            half = np.bitwise_count(bits & _U((1 << width) - 1)).astype(np.int64)
            up = rest >= half
            rest -= np.where(up, half, 0)
            at += np.where(up, width, 0)
            bits = np.where(up, bits >> _U(width), bits)
        return word * 64 + at

    def at(self, i: np.ndarray) -> np.ndarray:
        """The i-th value."""
        high = self._select(i) - i
        return (high.astype(np.uint64) << _U(self.low_bits)) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.low_bits
        word = np.lib.stride_tricks.as_strided(self.low[: 8].view(np.uint64), (len(self.low) - 7,), (1,))[bit >> 3]
        return (word >> (bit & 7).astype(np.uint64)) & _U((1 << self.low_bits) - 1)

    def values(self, start: int, stop: int) -> np.ndarray:
        """The values from ``start`` to ``stop``, decoded in one go."""
        if start >= stop:
            return np.zeros(0, np.uint64)
        a, b = (np.searchsorted(self.ones_before, [start, stop - 1], "right") - 1).tolist()
        ones = np.flatnonzero(np.unpackbits(self.high[a : b + 1].view(np.uint8), bitorder="little").view(bool))
        skip, i = start - int(self.ones_before[a]), np.arange(start, stop)
        return ((ones[skip : skip + len(i)] + 64 * a - i).astype(np.uint64) << _U(self.low_bits)) | self._low(i)

    def halve(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """For each x, the first index from ``start`` whose value is not below it, or ``stop``, by halving the range."""
        start, stop = start.copy(), stop.copy()
        on = np.flatnonzero(start < stop)
        while len(on):
            middle = (start[on] + stop[on]) >> 1
            below = self.at(middle) < x[on]
            start[on[below]] = middle[below] + 1
            stop[on[~below]] = middle[~below]
            on = on[start[on] < stop[on]]
        return start

    def between(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``halve`` finds for ascending x with ascending ranges, and whether the value there is x.

        Only the first and the last of each lot halve the sequence itself; the stretch between the two is decoded once for the lot.
        """
        index, found = start.copy(), np.zeros(len(x), bool)
        lots = np.arange(0, len(x), LOT)
        last = np.minimum(lots + LOT, len(x)) - 1
        begin, end = self.halve(x[lots], start[lots], stop[lots]), self.halve(x[last], start[last], stop[last])
        for low, high, a, b in zip(lots.tolist(), (last + 1).tolist(), begin.tolist(), end.tolist()):
            stretch = self.values(a, min(b + 1, self.n))
            if not len(stretch):
                index[low:high] = a
                continue
            at = np.clip(np.searchsorted(stretch, x[low:high]) + a, start[low:high], stop[low:high])
            index[low:high] = at
            found[low:high] = (at < stop[low:high]) & (stretch[np.minimum(at - a, len(stretch) - 1)] == x[low:high])
        return index, found

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x, which ascend, the index of the first value not below it, and whether the value is x."""
        return self.between(x, np.zeros(len(x), np.int64), np.full(len(x), self.n))


def codes(p: np.ndarray) -> np.ndarray:
    """Byte for a probability, rounded down so that sums stay below one."""
    with np.errstate(divide="ignore"):
        code = np.ceil(-np.log10(p) / STEP - 1e-9)
    return np.where(p > 0, np.minimum(np.maximum(code, 0), 254), 255).astype(np.uint8)


_VALUES = np.append(10.0 ** (-STEP * np.arange(255)), 0.0)


class Trie:
    """Contexts and their successors with quantised values; built from distinct (context, word) counts in order."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, words: int):
        """``words`` is above every word."""
        self.words = _U(words)
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        total = np.bincount(number, count, len(first)) if len(first) else np.zeros(0)
        pointers = np.append(first, len(context)).astype(np.uint64)
        distinct = np.diff(pointers.astype(np.int64))
        successors = number.astype(np.uint64) * self.words + word
        value = codes(count / (total + distinct)[number]) if len(first) else np.zeros(0, np.uint8)
        weight = codes(distinct / (total + distinct))
        levels = [EliasFano.make(context[first]), EliasFano.make(pointers), EliasFano.make(successors)]
        levels += [np.pad(x, (0, -len(x) % 8)).view(np.uint64) for x in (value, weight)]
        ends = np.cumsum([len(x) for x in levels])
        with tempfile.TemporaryFile() as file:
            file.write(np.concatenate(levels).data)
            file.flush()
            mapped = np.memmap(file, np.uint64, "r")
        a, b, c, d = ends[:4]
        self.contexts, self.pointers, self.successors = EliasFano(mapped[:a]), EliasFano(mapped[a:b]), EliasFano(mapped[b:c])
        self.value, self.weight = mapped[c:d].view(np.uint8), mapped[d:].view(np.uint8)

    def lookup(self, context: np.ndarray, gram: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the probability and of the weight of the lower order; gram i is ``word[i]`` after ``context[gram[i]]``.

        Contexts ascend. Grams are looked up in order of context and word, whatever order they come in.
        """
        value, weight = np.full(len(word), 255, np.uint8), np.zeros(len(word), np.uint8)
        number, seen = self.contexts.successor(context)
        known = np.flatnonzero(seen[gram])
        if not len(known):
            return value, weight
        target = number[gram[known]].astype(np.uint64) * self.words + word[known]
        if (target[1:] < target[:-1]).any():
            order = np.argsort(target)
            known, target = known[order], target[order]
        # Where the successors of each context that was seen begin and end.
        start, stop = np.zeros(len(context), np.int64), np.zeros(len(context), np.int64)
        least, most = int(number[seen][0]), int(number[seen][-1])
        pointers = self.pointers.values(least, most + 2).astype(np.int64)
        start[seen], stop[seen] = pointers[number[seen] - least], pointers[number[seen] - least + 1]
        of = gram[known]
        weight[known] = self.weight[number[of]]
        index, found = self.successors.between(target, start[of], stop[of])
        value[known[found]] = self.value[index[found]]
        return value, weight


class Tokens:
    """A chunk's documents: their tokens as ranks of the chunk's distinct words by falling count, which pack well.

    ``words``, ``shard``, ``count`` (in training) and ``often`` (in all) are in order of shard and hash, as answers are; ``at`` has each
    rank's place there, which follows from ``often``.
    """

    def __init__(self, chunk: Chunk, shards: int):
        words = words_of(Chunk(chunk.ids, chunk.ends, chunk.data.lower(), chunk.rows, chunk.known))
        self.ids, self.known = chunk.ids, chunk.known
        self.counts = words.ends - words.starts + 1
        hashes = np.empty(int(self.counts.sum()), np.uint64)
        is_end = np.zeros(len(hashes), bool)
        is_end[np.cumsum(self.counts) - 1] = True
        hashes[is_end], hashes[~is_end] = _END, words.symbols
        self.held = np.array([known and held_out(i) for i, known in zip(chunk.ids, chunk.known)], bool)
        own, place, often = np.unique(hashes, return_inverse=True, return_counts=True)
        shard = (mix(own) % _U(shards)).astype(np.int64)
        order = _by_shard(shard, shards)
        self.words, self.shard, self.often = own[order], shard[order], often[order].astype(np.int32)
        numbers = np.arange(len(own), dtype=np.int32)
        where, rank = np.empty_like(numbers), np.empty_like(numbers)
        where[order], rank[self.at] = numbers, numbers
        self.place = rank[where][place]
        self.count = np.bincount(place, self.training(), len(own))[order].astype(np.int64)

    @cached_property
    def at(self) -> np.ndarray:
        return np.argsort(-self.often, kind="stable")

    def pack(self) -> bytes:
        return pack(self.ids, self.known, self.counts, self.held, self.often, self.place)

    @staticmethod
    def unpack(block: bytes) -> Tokens:
        made = object.__new__(Tokens)
        made.ids, made.known, made.counts, made.held, made.often, made.place = unpack(block)
        return made

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.counts)


class Grams:
    """Distinct bigrams (order 0) and trigrams (order 1) of a chunk, with training counts, by context and word.

    ``numbers`` has each rank's number, ``train`` the tokens that count, if counts are wanted. Grams whose context holds a word that was not
    seen in training are left out of ``asked``.
    """

    def __init__(self, own: Tokens, numbers: np.ndarray, train: np.ndarray | None, words: int, shards: int):
        first = np.cumsum(own.counts) - own.counts
        # Small numbers in the same order, so that a key and its place fit 64 bits.
        known, small = np.unique(np.append(numbers, BEFORE).astype(np.uint64), return_inverse=True)
        many = len(known)
        tokens = small[:-1][own.place]
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first] = small[-1]
        pairs, place = _distinct((before * many + tokens).astype(np.uint64), many * many)
        #: Trigrams begin at the second word of a text; their context is the pair before the word.
        self.third = np.ones(len(tokens), bool)
        self.third[first] = False
        third = np.flatnonzero(self.third)
        triples, place3 = _distinct((place[third - 1].astype(np.int64) * many + tokens[third]).astype(np.uint64), len(pairs) * many)
        u, older = pairs // _U(many), triples // _U(many)
        v, w = pairs - u * _U(many), triples - older * _U(many)
        u, v, w, older = known[u], known[v], known[w], older.astype(np.int64)
        pair = u * _U(words) + v
        self.place = [place, place3]
        if train is not None:
            self.count = [np.bincount(place, train, len(pairs)).astype(np.int32), np.bincount(place3, train[third], len(triples)).astype(np.int32)]
        self.context = [u, pair[older]]
        self.word = [v.astype(np.uint32), w.astype(np.uint32)]
        self.asked = [u != UNKNOWN, ((u != UNKNOWN) & (v != UNKNOWN))[older]]
        self.shard = [(mix(u) % _U(shards)).astype(np.int64), (mix(pair) % _U(shards)).astype(np.int64)[older]]
        self.shards = shards

    def by_shard(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams asked for, in order of shard and key, and the shards in that order."""
        asked = np.flatnonzero(self.asked[order])
        at = asked[_by_shard(self.shard[order][asked], self.shards)]
        return at, self.shard[order][at]


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HELD_MODULUS == HELD_REMAINDER


def _stretches(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each stretch of equal values: the value, begin, end."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
        if b > a:
            yield int(values[a]), a, b


def _by_shard(shard: np.ndarray, shards: int) -> np.ndarray:
    """Places in order of shard, stable."""
    return np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")


def _ordered(keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, which are below ``top``, in order, and where each came from."""
    bits = len(keys).bit_length()
    if top.bit_length() + bits > 64:
        order = np.argsort(keys)
        return keys[order], order
    # Key and place in one number: sorting values is faster than sorting places.
    both = np.sort((keys << _U(bits)) | np.arange(len(keys), dtype=np.uint64))
    return both >> _U(bits), (both & _U((1 << bits) - 1)).astype(np.int64)


def _grouped(ordered: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key begins, and for each key, as they came, its place among the distinct ones."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(ordered), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return np.flatnonzero(new), place


def _distinct(keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, which are below ``top``, in order, and for each key its place among them."""
    ordered, order = _ordered(keys, top)
    first, place = _grouped(ordered, order)
    return ordered[first], place


def _added(keys: np.ndarray, counts: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, which are below ``top``, in order, their summed counts, and for each key its place among them."""
    ordered, order = _ordered(keys, top)
    first, place = _grouped(ordered, order)
    return ordered[first], np.add.reduceat(counts[order].astype(np.int64), first), place


def _answer_words(keys: list[np.ndarray], counts: list[np.ndarray], shard: int, shards: int) -> tuple[list[bytes], list[bytes], int, int]:
    """Per chunk, number and training count of each word; training tokens and distinct training words of the shard."""
    _, count, place = _added(np.concatenate(keys), np.concatenate(counts), 1 << 64)
    seen = int((count > 0).sum())
    number = np.zeros(len(count), np.int64)
    number[np.argsort(-count, kind="stable")[:seen]] = WORDS_FROM + shard + shards * np.arange(seen)
    parts = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
    return [pack(number[p]) for p in parts], [pack(count[p]) for p in parts], int(count.sum()), seen


def _question(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
    """Grams by context and word: steps between distinct contexts, a bit where one begins, words and counts."""
    new = np.ones(len(context), bool)
    new[1:] = context[1:] != context[:-1]
    return pack(np.diff(context[new], prepend=_U(0)), np.packbits(new), word, count)


def _answer_grams(blocks: list[bytes], words: int) -> list[bytes]:
    parts = [unpack(b) for b in blocks]
    own = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
    contexts, ranks = _distinct(np.concatenate(own), words * words)
    ranks = np.split(ranks.astype(np.uint64) * _U(words), np.cumsum([len(c) for c in own])[:-1])
    begins = [np.unpackbits(p[1], count=len(p[2])) for p in parts]
    keys = np.concatenate([r[np.cumsum(b, dtype=np.int32) - 1] + p[2] for r, b, p in zip(ranks, begins, parts)])
    del ranks, begins, own
    parts = [p[2:] for p in parts]
    grams, count, place = _added(keys, np.concatenate([p[1] for p in parts]), len(contexts) * words)
    context = (grams // _U(words)).astype(np.int64)
    word = grams - context.astype(np.uint64) * _U(words)
    seen = count > 0
    trie = Trie(contexts[context[seen]], word[seen], count[seen], words)
    value, weight = trie.lookup(contexts, context, word)
    return [pack(value[p], weight[p]) for p in np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])]


def lm_scores(docs: DataFrame) -> DataFrame:
    """Return doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    used = scanned(docs)
    size = used.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(2 * partitions(spark), -(-size // SHARD_BYTES))
    fields = "shard long, chunk long, block binary"

    def rows_of(number: int, shard: list[int], blocks: list[bytes]) -> pa.RecordBatch:
        kinds = ["tokens" if s < 0 else "words" for s in shard]
        columns = [pa.array(shard, pa.int64()), pa.array([number] * len(shard), pa.int64()), pa.array(blocks, pa.binary()), pa.array(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "block", "kind"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in chunked(batches, CHUNK):
            own = Tokens(chunk, shards)
            names, blocks = [-1], [own.pack()]
            for shard, a, b in _stretches(own.shard):
                names.append(shard)
                blocks.append(pack(np.diff(own.words[a:b], prepend=_U(0)), own.count[a:b]))
            yield rows_of(number, names, blocks)

    def answer_words(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        parts = [unpack(b) for b in rows["block"]]
        numbers, counts, tokens, seen = _answer_words([np.cumsum(p[0], dtype=np.uint64) for p in parts], [p[1] for p in parts], shard, shards)
        made = pd.DataFrame({"shard": rows["shard"], "chunk": rows["chunk"], "block": numbers, "counts": counts, "tokens": 0, "words": 0})
        sums = {"shard": [shard], "chunk": [-1], "block": [b""], "counts": [b""], "tokens": [tokens], "words": [seen]}
        return pd.concat([made, pd.DataFrame(sums)])

    path = scratch_path(spark, "chunks")
    with many_open_writers(spark):
        used.mapInArrow(cut, fields + ", kind string").write.partitionBy("kind").parquet(path)
    storage.delete_at_exit(spark, path)
    cuts = spark.read.schema(fields + ", kind string").parquet(path)
    of_words = cuts.filter("kind = 'words'").drop("kind").groupBy("shard")
    answers = stored(of_words.applyInPandas(answer_words, fields + ", counts binary, tokens long, words long"), "words")
    # All that is asked of the words is stored now; a chunk's own lists of words are not read again.
    storage.delete(spark, [f"{path}/kind=words"])
    held = spark.read.schema(fields + ", kind string").parquet(path).filter("kind = 'tokens'").drop("kind")
    sums = answers.filter("chunk = -1").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v"), F.max("words").alias("most")).first()
    train, distinct = sums["n"] or 0, sums["v"] or 0
    #: Above every number of a word.
    words = WORDS_FROM + (sums["most"] or 0) * shards + 1
    if words > 1 << 32:
        raise ValueError(f"{distinct} distinct training words are more than numbers of 32 bits tell apart")
    answers = answers.filter("chunk >= 0").select("shard", "chunk", "block", "counts")
    # Both steps below group these rows in one way, so they are sent once.
    chunks = held.withColumn("counts", F.lit(None).cast("binary")).unionByName(answers).groupBy("chunk")

    def opened(rows: pd.DataFrame) -> tuple[Tokens, pd.DataFrame]:
        """A chunk's tokens, which have the lowest number of a shard, and the answers on its words in order of shard."""
        rows = rows.sort_values("shard")
        return Tokens.unpack(rows["block"].iloc[0]), rows.iloc[1:]

    def joined(own: Tokens, blocks: pd.Series) -> np.ndarray:
        """Answers on words, which are in order of shard, by rank."""
        return np.concatenate([unpack(b)[0] for b in blocks])[own.at]

    def request(rows: pd.DataFrame) -> pd.DataFrame:
        own, got = opened(rows)
        grams = Grams(own, joined(own, got["block"]), own.training(), words, shards)
        names, blocks = [], []
        for order in (0, 1):
            at, shard = grams.by_shard(order)
            for name, a, b in _stretches(shard):
                names.append(order * shards + name)
                blocks.append(_question(*(x[order][at[a:b]] for x in (grams.context, grams.word, grams.count))))
        return pd.DataFrame({"shard": names, "chunk": rows["chunk"].iloc[0], "block": blocks})

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(block=_answer_grams(list(rows["block"]), words))

    found = chunks.applyInPandas(request, fields).groupBy("shard").applyInPandas(answer, fields)

    def finish(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own, got = opened(rows)
        grams = Grams(own, joined(own, got["block"]), None, words, shards)
        known = joined(own, got["counts"])
        base = np.log10(known + 1.0) - np.log10(train + distinct + 1.0)
        known, base, p = known[own.place], base[own.place], (10.0**base)[own.place]
        filled = [(np.full(len(w), 255, np.uint8), np.zeros(len(w), np.uint8)) for w in grams.word]
        sent = [grams.by_shard(order) for order in (0, 1)]
        for name, block in zip(found["shard"], found["block"]):
            order, shard = divmod(int(name), shards)
            at, shards_of = sent[order]
            a, b = np.searchsorted(shards_of, [shard, shard + 1])
            for target, codes_ in zip(filled[order], unpack(block)):
                target[at[a:b]] = codes_
        for order, place in enumerate((slice(None), grams.third)):
            value, weight = (_VALUES[x][grams.place[order]] for x in filled[order])
            p[place] = value + weight * p[place]
        starts = np.cumsum(own.counts) - own.counts
        return pd.DataFrame(
            {
                "doc_id": pd.array([i if k else None for i, k in zip(own.ids.tolist(), own.known)], "Int64"),
                "held_out": own.held,
                "n_tokens": own.counts,
                "n_known": np.add.reduceat((known > 0).astype(np.int64), starts),
                "train_tokens": train,
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(np.log10(p), starts),
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.cogroup(found.groupBy("chunk")).applyInPandas(finish, schema)


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
