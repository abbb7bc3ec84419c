"""Spelling variant grouping by Bloom-guided neighbourhoods.

The vocabulary (distinct words of enough length and count) fills a split-block Bloom filter of
bounded size, sharded by word length and broadcast. Every word generates its deletions and its
replacements by a larger letter; each pair of near words is generated exactly once, from the
longer word or from the one with the smaller letter. Hashes of edits come from the word's own
in constant time and are probed against the shard of their length. Only positives become
strings and shuffle to an exact join with the vocabulary, which removes the false positives.

A word's form is its near word of largest count, so counts at least double along forms; the
root is found by pointer jumping over written tables in as many rounds as the logarithm of the
longest chain.

Defined results: null text has no words; a null id counts as the empty text in the rule that
deletes a letter. Rows that repeat an id count each. A run longer than a slice of probes is
worked off in slices. An empty table gives none; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm import bloom
from threadmill.llm.common import Scratch, mix64, text_bytes

LEAST_LENGTH, LEAST_COUNT, RATIO, MODULUS = 5, 3, 2, 97
#: Words longer than this share one shard of the filter.
LONG = 48
#: Probes made at once, distinct words that a task counts before it passes them on, words of one task of edits.
PROBES, HELD_WORDS, PART_WORDS = 1 << 20, 100_000, 50_000

# A-Z and U+00C0 to U+00FF, as UTF-8 after A-Z became a-z (the lead byte 0xC3 is never a second byte).
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
#: A 64-bit value for each code point that a word can hold.
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _word_counts(least: int, modulus: int, held: int):
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def out(counts):
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def run(batches):
        counts = Counter()
        for b in batches:
            for a in range(0, b.num_rows, 256):
                s = b.slice(a, 256)
                for head, body in zip(s.column(0).to_pylist(), s.column(1).to_pylist()):
                    seed = zlib.crc32(head)
                    for w, n in Counter(_RUN.findall(body.lower())).items():
                        h = zlib.crc32(w, seed)
                        if h % modulus == 0:
                            t = w.decode("utf-8")
                            at = h % len(t)
                            w = (t[:at] + t[at + 1:]).encode("utf-8")
                        if len(w) - w.count(b"\xc3") >= least:
                            counts[w] += n
                    if len(counts) >= held:
                        yield from out(counts)
                        counts = Counter()
        if counts:
            yield from out(counts)
    return run


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, modulus: int = MODULUS) -> DataFrame:
    """(word, n) of the distinct words after the rule that deletes a letter."""
    head = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).cast("binary")
    part = docs.select(head.alias("head"), text_bytes().alias("body")).mapInArrow(_word_counts(least_length, modulus, HELD_WORDS), "word binary, n long")
    return part.groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class _Words:
    """A batch of words as flat code points, with hashes of all prefixes."""

    def __init__(self, words: list[str]):
        self.words = words
        self.len = np.array([len(w) for w in words], np.int64)
        self.cp = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16).astype(np.int64)
        self.first = np.cumsum(self.len) - self.len
        self.own = np.repeat(np.arange(len(words)), self.len)
        self.at = np.arange(len(self.cp)) - self.first[self.own]
        longest = int(self.len.max(initial=0))
        power = np.cumprod(np.r_[np.uint64(1), np.full(max(longest, 1), np.uint64(_BASE))], dtype=np.uint64)
        self.power = power[self.at]
        run = np.r_[np.uint64(0), np.cumsum(_VALUE[self.cp] * self.power, dtype=np.uint64)]
        self.before = run[:-1] - run[self.first][self.own]           # hash of the letters before each position
        self.hash = run[self.first + self.len] - run[self.first]
        self.last = self.at == self.len[self.own] - 1


class _Shards:
    """Where the filter of each word length lies."""

    def __init__(self, counts: dict[int, int], max_bits: int):
        total = sum(counts.values())
        share = min(1.0, max_bits / max(1, total * bloom.BITS_PER_KEY))
        self.blocks, self.first, at = np.ones(LONG + 1, np.int64), np.zeros(LONG + 1, np.int64), 0
        for n in range(LONG + 1):
            self.blocks[n] = max(1, int(counts.get(n, 0) * bloom.BITS_PER_KEY * share) // 256)
            self.first[n], at = at, at + self.blocks[n]
        self.total = at

    def place(self, h: np.ndarray, length: np.ndarray):
        n = np.minimum(length, LONG)
        return mix64(h), bloom.place(mix64(h), self.blocks[n], self.first[n])


def _edits(filt, shards: _Shards, letters: np.ndarray, least: int, probes: int):
    """(word, n, near) for the deletions and replacements that the filter holds."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])
    value = _VALUE[letters]

    def found(batch_words, n, table):
        w = _Words(batch_words)
        # one deletion for each run of equal letters
        spot = np.flatnonzero((w.len[w.own] > least) & (w.last | (w.cp != np.r_[w.cp[1:], -1])))
        own = w.own[spot]
        h = w.before[spot] + (w.hash[own] - w.before[spot] - _VALUE[w.cp[spot]] * w.power[spot]) * _INVERSE
        key, block = shards.place(h, w.len[own] - 1)
        for i in bloom.contains(table, key, block):
            t, at = batch_words[own[i]], w.at[spot[i]]
            yield t, n[own[i]], t[:at] + t[at + 1:]
        step = max(1, probes // max(1, len(letters)))
        for a in range(0, len(w.cp), step):
            z = slice(a, a + step)
            pos, new = np.nonzero(letters[None, :] > w.cp[z, None])
            pos += a
            h = w.hash[w.own[pos]] + (value[new] - _VALUE[w.cp[pos]]) * w.power[pos]
            key, block = shards.place(h, w.len[w.own[pos]])
            for i in bloom.contains(table, key, block):
                t, at = batch_words[w.own[pos[i]]], w.at[pos[i]]
                yield t, n[w.own[pos[i]]], t[:at] + chr(letters[new[i]]) + t[at + 1:]

    def run(batches):
        table = filt.value
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_pylist()
            for a in range(0, len(words), 2048):
                rows = list(found(words[a:a + 2048], n[a:a + 2048], table))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def near_pairs(vocab: DataFrame, scratch: Scratch, least: int = LEAST_LENGTH, max_bits: int = bloom.MAX_BITS, probes: int = PROBES) -> DataFrame:
    """(a, n_a, b, n_b): every pair of vocabulary words one edit apart, once."""
    sc = vocab.sparkSession.sparkContext
    lengths = vocab.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("k")).count().collect()
    shards = _Shards({r["k"]: r["count"] for r in lengths}, max_bits)
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    letters = np.array(sorted(ord(r["c"]) for r in letters), np.int64)

    def placed(b):
        w = _Words(b.column(0).to_pylist())
        return shards.place(w.hash, w.len)

    filt = sc.broadcast(bloom.build(vocab.select("word"), placed, shards.total))
    dealt = vocab.repartition(max(1, -(-sum(r["count"] for r in lengths) // PART_WORDS)))    # edits cost far more than the words' bytes
    maybe = scratch.write(dealt.mapInArrow(_edits(filt, shards, letters, least, probes), "word string, n long, near string"), "positives")
    exact = vocab.select(F.col("word").alias("near"), F.col("n").alias("n_b"))
    return maybe.join(exact, "near").select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("near").alias("b"), "n_b")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of every row of (word, form): the end of the chain, by pointer jumping."""
    now = scratch.write(forms.select("word", F.col("form").alias("root")), "roots_0")
    step = 0
    while True:
        step += 1
        up = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        jumped = scratch.write(now.join(up, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), f"roots_{step}")
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        now = jumped.select("word", "root")


def group_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, modulus: int = MODULUS,
                   **options) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession, "spelling")
    vocab = scratch.write(vocabulary(docs, least_length, least_count, modulus), "vocabulary")
    pairs = near_pairs(vocab, scratch, least_length, **options)
    side = lambda a, na, b, nb: F.struct(F.col(a).alias("word"), F.col(na).alias("n"), F.col(b).alias("near"), F.col(nb).alias("near_n"))
    both = pairs.select(F.explode(F.array(side("a", "n_a", "b", "n_b"), side("b", "n_b", "a", "n_a"))).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best"))
    rows = vocab.join(near, "word", "left").withColumn("form_n", F.when(-F.col("best.m") >= ratio * F.col("n"), -F.col("best.m")))
    rows = scratch.write(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
                                     F.when(F.col("form_n").isNotNull(), F.col("best.near")).alias("form")), "forms")
    ends = roots(rows.where("form is not null"), scratch)
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
