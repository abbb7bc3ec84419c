"""Language-model scoring by subword lattice likelihood.

The probability of a word is the sum over all its segmentations into the pieces of an existing
vocabulary (plus an end symbol), computed by a forward recursion in log space over the lattice
of pieces. Pieces only hold a space in front, so the lattice of a text is the chain of its
words' lattices and the end. The vocabulary's own ranks give the first piece scores; two rounds
of expected counts over the distinct words of the training documents (forward and backward over
the same lattices) fit them to the corpus. The lattice of a word has one more edge, the whole
word, whose probability is its absolutely discounted share of the training tokens; the mass
that the discount frees goes to the segmentations. The probabilities of all word sequences
together add up to one.

Counting: each task adds up its words, one aggregation gives the corpus counts, and the
lattice runs once per distinct word. Documents get their words' numbers in two exact ways:
the ``head`` most frequent short words (a bound on number and bytes) travel as a broadcast,
all others of a document are joined by word. Texts are never shuffled.

Defined results: null text is empty and has the end token only. Rows that repeat an id are
scored one by one. Without training documents every count is 0 and the vocabulary's ranks
alone weight the pieces. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch, doc_bucket, text_bytes

HEAD_WORDS = 150_000
HEAD_BYTES = 64
ROUNDS = 2
_BASE = 0x9E3779B97F4A7C15 | 1
_LN10 = math.log(10)


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> tuple[list[bytes], np.ndarray]:
    """Byte strings that can occur in a lower-cased word with its leading space, and log probabilities by rank."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, int] = {bytes([i]): sp.get_piece_size() for i in range(256)}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        if sp.is_byte(i):
            found[bytes([int(sp.id_to_piece(i)[3:5], 16)])] = i
            continue
        s = sp.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in s[1:] and s == s.lower():
            found[s] = min(i, found.get(s, i))
    names = sorted(found)
    p = 1.0 / (np.array([found[s] for s in names]) + 10.0)
    return names, np.log(p / p.sum())


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((rows.shape[1] + 1, rows.shape[0]), np.uint64)
    base = np.uint64(_BASE)
    for i in range(rows.shape[1]):
        out[i + 1] = out[i] * base + rows[:, i].astype(np.uint64) + np.uint64(1)
    return out


class Lattice:
    """All segmentations of words into pieces, for many words of one length at a time."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        code = np.zeros(len(pieces), np.uint64)
        for n in {len(p) for p in pieces}:
            at = [i for i, p in enumerate(pieces) if len(p) == n]
            code[at] = _prefix_hashes(np.frombuffer(b"".join(pieces[i] for i in at), np.uint8).reshape(-1, n))[n]
        self.order = np.argsort(code)
        self.codes, self.logp, self.longest = code[self.order], logp, max(map(len, pieces))
        self.powers = [np.uint64(pow(_BASE, n, 1 << 64)) for n in range(self.longest + 1)]

    def _edge(self, hashes, i: int, n: int) -> np.ndarray:
        """Piece number of the bytes [i, i + n) of each word, or -1."""
        h = hashes[i + n] - hashes[i] * self.powers[n]
        at = np.minimum(np.searchsorted(self.codes, h), len(self.codes) - 1)
        return np.where(self.codes[at] == h, self.order[at], -1)

    def _sums(self, rows: np.ndarray, counts: np.ndarray | None):
        """Log probability of each word; with counts also the expected counts of the pieces."""
        n, length = rows.shape
        hashes = _prefix_hashes(rows)
        padded = np.append(self.logp, -np.inf)
        held: dict = {}

        def edge(i, k):
            got = held.get((i, k))
            if got is None:
                got = self._edge(hashes, i, k)
                if counts is not None and length <= 256:
                    held[i, k] = got
            return got

        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        for j in range(1, length + 1):
            into = np.stack([alpha[j - k] + padded[edge(j - k, k)] for k in range(1, min(j, self.longest) + 1)])
            top = into.max(0)
            alpha[j] = top + np.log(np.exp(into - top).sum(0))
        if counts is None:
            return alpha[length], None
        expected = np.zeros(len(self.logp) + 1)
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0
        for i in range(length - 1, -1, -1):
            ids = [edge(i, k) for k in range(1, min(length - i, self.longest) + 1)]
            out = np.stack([padded[e] + beta[i + k + 1] for k, e in enumerate(ids)])
            top = out.max(0)
            beta[i] = top + np.log(np.exp(out - top).sum(0))
            share = np.exp(out + alpha[i] - alpha[length]) * counts
            expected += np.bincount(np.concatenate(ids) % len(expected), share.ravel(), len(expected))
        return alpha[length], expected[:-1]

    def _chunks(self, words: list[bytes]):
        by = {}
        for i, w in enumerate(words):
            by.setdefault(len(w) + 1, []).append(i)
        for length, at in by.items():
            step = max(1, (1 << 18) // length)
            for a in range(0, len(at), step):
                part = at[a:a + step]
                yield part, np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8).reshape(len(part), length)

    def log10(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words))
        for part, rows in self._chunks(words):
            out[part] = self._sums(rows, None)[0] / _LN10
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.logp))
        for part, rows in self._chunks(words):
            out += self._sums(rows, counts[part])[1]
        return out


def _count_words(batches):
    schema = pa.schema([("word", pa.binary()), ("k", pa.int64()), ("c", pa.int64())])

    def flush(every, train):
        words = list(every)
        for a in range(0, len(words), 1 << 16):
            w = words[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array([every[x] for x in w], pa.int64()),
                                              pa.array([train.get(x, 0) for x in w], pa.int64())], schema=schema)

    every, train = Counter(), Counter()
    for b in batches:
        for held_out, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = Counter(body.lower().split())
            every.update(words)
            if not held_out:
                train.update(words)
            if len(every) > 400_000:
                yield from flush(every, train)
                every, train = Counter(), Counter()
    yield from flush(every, train)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """word, k (all occurrences), c (in training documents)."""
    src = docs.select((doc_bucket(7) == 2).alias("held_out"), text_bytes().alias("body"))
    return src.mapInArrow(_count_words, "word binary, k long, c long").groupBy("word").agg(F.sum("k").alias("k"), F.sum("c").alias("c"))


def fit_pieces(counts: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray]:
    """Pieces and their log probabilities after ``rounds`` of expected counts; a word ends before the next leading space."""
    names, logp = pieces_of(path)
    train = counts.where("c > 0").select("word")
    for _ in range(rounds):
        lattice = Lattice(names, logp)

        def run(batches, lattice=lattice):
            total = np.zeros(len(lattice.logp))
            for b in batches:
                total += lattice.expected(b.column(0).to_pylist(), np.ones(b.num_rows))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.float64())], names=["piece", "n"])

        got = train.mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        n = np.full(len(names), 0.1)          # every piece stays possible
        n[got["piece"].to_numpy(np.int64)] += got["n"].to_numpy()
        logp = np.log(n / n.sum())
    return names, logp


def _score(model):
    """Per document a row of head sums, and a row for each of its other words."""
    def run(batches):
        head, base, lp, known = model.value
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("n_known", pa.int64()),
                            ("base", pa.float64()), ("score", pa.float64())])
        for b in batches:
            for a in range(0, b.num_rows, 512):
                rows = []
                s = b.slice(a, 512)
                for row, doc_id, body in zip(*(s.column(i).to_pylist() for i in range(3))):
                    words = body.lower().split()
                    at = np.fromiter(map(head.get, words, itertools.repeat(-1)), np.int64, len(words))
                    hit = at[at >= 0]
                    rows.append((row, doc_id, None, len(words), int(known[hit].sum()), float(base[hit].sum()), float(lp[hit].sum())))
                    if len(hit) < len(words):
                        rest = Counter(words[i] for i in np.flatnonzero(at < 0).tolist())
                        rows.extend((row, None, w, n, 0, 0.0, 0.0) for w, n in rest.items())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def _head(words: DataFrame, limit: int) -> DataFrame:
    """The most frequent words of at most ``HEAD_BYTES`` bytes, ``limit`` at most, for the broadcast.

    Words are cut off at a step of their count (16 steps to a doubling), found from the number of
    words of each step: the driver receives no more than these numbers and the words themselves.
    A word left out takes the join, with the same result.
    """
    short = words.where(F.length("word") <= HEAD_BYTES).withColumn("_step", F.floor(F.log2("k") * 16))
    left, cut = limit, None
    for step, n in sorted(short.groupBy("_step").count().collect(), reverse=True):
        if n > left:
            cut = step
            break
        left -= n
    return short if cut is None else short.where(F.col("_step") > cut)


def lm_score(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm_score")
    path = path or vocabulary()
    counts = scratch.write(corpus_counts(docs), "counts")
    n_docs = docs.where(doc_bucket(7) != 2).count()
    times = lambda n: F.count(F.when(F.col("c") == n, 1))
    total = counts.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"), times(1).alias("once"), times(2).alias("twice")).first()
    tokens, kinds = (total["n"] or 0) + n_docs, total["v"] + (n_docs > 0)
    names, logp = fit_pieces(counts, path, rounds)
    lattice = Lattice(names, logp)
    norm = math.log10(tokens + kinds + 1)
    cut = (total["once"] + 1) / (total["once"] + 2 * total["twice"] + 2)
    # what the discount frees, and one more count for the end, so that it is possible without training documents
    freed = math.log10((cut * total["v"] + 1) / (tokens + 2))
    end = math.log10((n_docs + 1) / (tokens + 2))

    def weigh(batches):
        for b in batches:
            c = b.column(2).to_numpy().astype(np.float64)
            whole = np.maximum(c - cut, 0) / (tokens + 2)
            lp = np.logaddexp(np.log(np.maximum(whole, 1e-300)), (lattice.log10(b.column(0).to_pylist()) + freed) * _LN10) / _LN10
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lp, pa.float64())], names=["word", "k", "c", "lp"])

    words = scratch.write(counts.mapInArrow(weigh, "word binary, k long, c long, lp double"), "words")
    head = _head(words, head_words).select("word", "c", "lp").toPandas()
    c = head["c"].to_numpy(np.float64) if len(head) else np.zeros(0)
    model = spark.sparkContext.broadcast((
        {bytes(w): i for i, w in enumerate(head["word"])}, np.log10(c + 1) - norm, head["lp"].to_numpy(np.float64), c > 0))
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    parts = scratch.write(src.mapInArrow(_score(model), "row long, doc_id long, word binary, n long, n_known long, base double, score double"), "parts")
    tail = parts.where("word is not null").select("row", "word", "n").join(words.select("word", "c", "lp"), "word").select(
        "row", (F.col("n") * (F.col("c") > 0).cast("long")).alias("n_known"),
        (F.col("n") * (F.log10(F.col("c") + 1.0) - norm)).alias("base"), (F.col("n") * F.col("lp")).alias("score"))
    sums = tail.groupBy("row").agg(*[F.sum(x).alias(f"t_{x}") for x in ("n_known", "base", "score")]).withColumnRenamed("row", "_row")
    j = parts.where("word is null").join(sums, F.col("row") == F.col("_row"), "left")
    add = lambda x, more: F.col(x) + F.coalesce(F.col(f"t_{x}"), F.lit(0)) + F.lit(more)
    return j.select(
        "doc_id", (doc_bucket(7) == 2).alias("held_out"), (F.col("n") + 1).alias("n_tokens"), add("n_known", int(n_docs > 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), add("base", math.log10(n_docs + 1) - norm).alias("base_score"),
        add("score", end).alias("score"))
