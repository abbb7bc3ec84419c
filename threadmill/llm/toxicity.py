"""Toxicity: a factorization machine over hashed terms.

A text is the set of its lower-cased words, stripped of punctuation, and of the words' first
three to six letters (insults come inflected), all as 64-bit hashes; the whole text counts.
Terms that enough training rows contain and that tell the classes apart by chi-square (at least
``least_chi``, at most the best ``max_terms``) get a weight and a factor vector; all other hashes are absent, so that
no unknown word shares the weight of a known one. The score of a set is a bias, the sum of
weights, and the sum over pairs of terms of the products of their factors (in linear time by
the square-of-sums identity). Adagrad fits the logistic loss on a bounded sample of labelled
rows (``sample_rows``, smallest id hashes); weights are soft-thresholded, so that common words
drop out.

Defined results: null text is empty; its score is that of the bias. Rows that repeat an id
are scored one by one; an id with several labels counts with the largest. Without labelled
rows of both classes the score is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from threadmill.llm.common import Scratch, doc_bucket, signed, text_bytes
from threadmill.llm.quality import labelled_sample

SAMPLE_ROWS = 12_000
MAX_TERMS = 8_000
LEAST_ROWS = 4
LEAST_CHI = 15.0
FACTORS = 8
_EDGE = b".,;:!?\"'()[]{}<>*#$%&|-_/\\~`^+=@"


class Terms(dict):
    """word -> its hashed terms (with ``known``: only these), remembered within a task."""

    LIMIT = 200_000

    def __init__(self, known: np.ndarray | None = None):
        super().__init__()
        self.known = None if known is None else set(known.tolist())

    def __missing__(self, word: bytes) -> tuple:
        w, out = word.strip(_EDGE), ()
        if w:
            letters = w.decode("utf-8", "replace")
            keys = (w, *(b"^" + letters[:n].encode() for n in range(3, min(len(letters), 6) + 1)))
            out = tuple(h for h in map(xxh3_64_intdigest, keys) if self.known is None or h in self.known)
        if len(self) < self.LIMIT:
            self[word] = out
        return out

    def of(self, body: bytes) -> np.ndarray:
        """The distinct hashed terms of a text, sorted."""
        found = set().union(*map(self.__getitem__, set(body.lower().split())))
        out = np.fromiter(found, np.uint64, len(found))
        out.sort()
        return out


@dataclass
class Machine:
    known: np.ndarray            # sorted hashes
    bias: float
    weight: np.ndarray
    factor: np.ndarray           # one row per known term

    def rows(self, sets: list[np.ndarray]):
        """Known terms of the sets as (row number, index of term)."""
        if not len(self.known) or not sum(map(len, sets)):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(self.known, flat), len(self.known) - 1)
        hit = self.known[at] == flat
        return row[hit], at[hit]

    def raw(self, row: np.ndarray, at: np.ndarray, n: int):
        scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
        sums = np.stack([np.bincount(row, self.factor[at, k], n) for k in range(self.factor.shape[1])], 1)
        squares = np.bincount(row, (self.factor[at] ** 2).sum(1), n)
        pairs = 0.5 * ((sums**2).sum(1) - squares) * scale**2
        return self.bias + np.bincount(row, self.weight[at], n) + pairs, sums, scale

    def score(self, sets: list[np.ndarray]) -> np.ndarray:
        raw, _, _ = self.raw(*self.rows(sets), len(sets))
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(sets: list[np.ndarray], y: np.ndarray, epochs: int = 30, rate: float = 0.25, l1: float = 2e-4, l2: float = 1e-3, batch: int = 256,
        least_rows: int = LEAST_ROWS, least_chi: float = LEAST_CHI, max_terms: int = MAX_TERMS, factors: int = FACTORS, seed: int = 5) -> Machine:
    rng = np.random.default_rng(seed)
    n, pos = len(sets), float(y.sum()) if len(y) else 0.0
    start = float(np.log((pos + 1) / (n - pos + 1)))
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    hashes, slot = np.unique(flat, return_inverse=True)
    counts = np.bincount(slot, minlength=len(hashes)).astype(np.float64)
    toxic = np.bincount(slot, np.repeat(y, [len(t) for t in sets]), len(hashes))
    share = pos / max(n, 1)
    chi = (toxic - counts * share) ** 2 / np.maximum(counts * share * (1 - share) * (1 - counts / (n + 1)), 1e-9)
    often = np.flatnonzero((counts >= least_rows) & (chi >= least_chi))
    often = np.sort(often[np.argsort(-chi[often], kind="stable")[:max_terms]])
    m = Machine(hashes[often], start, np.zeros(len(often)), rng.normal(0, 0.01, (len(often), factors)))
    if not 0 < pos < n or not len(often):
        return m
    row, at = m.rows(sets)
    ptr = np.searchsorted(row, np.arange(n + 1))
    gw, gv, gb = np.full(len(often), 1e-8), np.full(m.factor.shape, 1e-8), 1e-8
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(n), max(1, n // batch)):
            size = ptr[part + 1] - ptr[part]
            r = np.repeat(np.arange(len(part)), size)
            t = at[np.concatenate([np.arange(ptr[i], ptr[i + 1]) for i in part])] if len(r) else np.zeros(0, np.int64)
            raw, sums, scale = m.raw(r, t, len(part))
            err = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y[part]) / len(part)
            gb += err.sum() ** 2
            m.bias -= rate * err.sum() / np.sqrt(gb)
            touched, slot = np.unique(t, return_inverse=True)
            if not len(touched):
                continue
            dw = np.bincount(slot, err[r], len(touched))
            gw[touched] += dw**2
            step = rate / np.sqrt(gw[touched])
            w = m.weight[touched] - step * dw
            m.weight[touched] = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
            own = m.factor[t]
            each = (err * scale**2)[r, None] * (sums[r] - own)
            dv = np.stack([np.bincount(slot, each[:, k], len(touched)) for k in range(factors)], 1) + l2 / len(part) * m.factor[touched]
            gv[touched] += dv**2
            m.factor[touched] -= 0.2 * rate * dv / np.sqrt(gv[touched])
    return m


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_terms: int = MAX_TERMS) -> Machine:
    """The screening of terms is an aggregation; the driver gets the sample's rows with the chosen terms only."""
    @F.pandas_udf("array<long>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Terms()
        for body in batches:
            yield pd.Series([signed(words.of(x)) for x in body])

    sample = Scratch(docs.sparkSession, "toxicity").write(labelled_sample(docs, labels, "toxic", sample_rows).select(hashed("body").alias("t"), "y"), "sample")
    size = sample.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    n, share = size["n"], (size["pos"] or 0) / max(size["n"], 1)
    stats = sample.select(F.explode("t").alias("term"), "y").groupBy("term").agg(F.count("*").alias("k"), F.sum("y").alias("pos")).where(F.col("k") >= LEAST_ROWS)
    chi = F.pow(F.col("pos") - F.col("k") * share, 2) / F.greatest(F.col("k") * (share * (1 - share)) * (1 - F.col("k") / F.lit(n + 1.0)), F.lit(1e-9))
    best = stats.withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI * 0.999).orderBy(F.desc("chi"), "term").limit(max_terms).toPandas()
    known = np.sort(best["term"].to_numpy(np.int64))

    @F.pandas_udf("array<long>")
    def chosen(t: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(x)[np.isin(x, known)] for x in t])

    rows = sample.select(chosen("t").alias("t"), "y").toPandas()
    sets = [np.sort(np.asarray(t, np.int64).view(np.uint64)) for t in rows["t"]]
    y = rows["y"].to_numpy(np.float64)
    # rows arrive in any order: sort them, so that reruns agree
    order = sorted(range(len(sets)), key=lambda i: (y[i], sets[i].tobytes()))
    return fit([sets[i] for i in order], y[order], max_terms=max_terms)


def scorer(model: Machine):
    """Pandas UDF: the UTF-8 bytes of a text -> score."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Terms(model.known)
        for body in batches:
            out = [model.score([words.of(x) for x in body[a:a + 512]]) for a in range(0, len(body), 512)]
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.7) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(docs, labels, sample_rows)
    s = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model)(text_bytes()).alias("score"))
    return s.select("doc_id", (doc_bucket(3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
