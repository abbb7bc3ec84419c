"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics describe a whole text (sizes, shares of byte classes, repetition of words,
lines and neighbours). Trees are grown level by level on binned statistics of a bounded
sample of labelled training rows (``sample_rows``, the rows with the smallest id hashes); the
finished ensemble is flattened into arrays, and scoring walks all trees of a batch at once
by numpy gathers. The sample's ids are broadcast (their number is the bound); texts are
never shuffled.

Defined results: null text is empty, and an empty text has a score like any other. Rows that
repeat an id are scored one by one; an id with several labels counts with the largest.
Without labelled rows of both classes the score is the smoothed share of label 1.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import doc_bucket, releasing, text_bytes

SAMPLE_ROWS = 20_000
BINS = 64

_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".", b",;:", b"!", b"?",
            b"|", b"#", b"$", b"%", b"&", b"*", b"<>{}[]\\=_^~`", b"\"'()-/", b"@+", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))]
_BELONGS = np.zeros((256, len(_CLASSES)), np.float64)
for _i, _c in enumerate(_CLASSES):
    _BELONGS[list(_c), _i] = 1.0
_UPPER, _DIGIT = frozenset(_CLASSES[1]), frozenset(_CLASSES[2])


def statistics(body: bytes) -> np.ndarray:
    """The statistics of one text, as a fixed-length vector."""
    n = len(body)
    share = np.bincount(np.frombuffer(body, np.uint8), minlength=256) @ _BELONGS / max(n, 1)
    words = body.split()
    m = len(words)
    lines = [x for x in body.split(b"\n") if x.strip()]
    if m:
        lens = np.fromiter(map(len, words), np.int64, m)
        same = sum(map(operator.eq, words, words[1:])) / m
        kinds = len(set(words))
        pairs = len(set(zip(words, words[1:]))) / max(m - 1, 1)
        word = [lens.mean(), lens.std(), lens.max(), (lens == 1).mean(), (lens > 20).mean(), same, kinds / m, np.log1p(kinds) / np.log1p(m), pairs]
        head = sum(w[0] in _UPPER for w in words) / m
        stop = sum(w[-1] in b".!?" for w in words) / m
    else:
        word, head, stop = [0.0] * 9, 0.0, 0.0
    if lines:
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        kinds = {}
        for x in lines:
            kinds[x] = kinds.get(x, 0) + 1
        again = 1 - len(kinds) / len(lines)
        most = max(c * len(x) for x, c in kinds.items() if c > 1) / n if again else 0.0
        line = [np.log1p(len(lines)), sizes.mean(), sizes.std(), again, most, sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines)]
    else:
        line = [0.0] * 6
    return np.array([np.log1p(n), np.log1p(m), *share, *word, head, stop, *line], np.float32)


N_STATISTICS = len(statistics(b""))


@dataclass
class Forest:
    """All trees in one set of arrays. ``feature`` is -1 at a leaf, whose ``value`` counts."""

    edges: list                  # per feature: the upper edges of its bins
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray              # rows go left when their bin is <= cut
    left: np.ndarray             # the right child is left + 1
    value: np.ndarray
    depth: int
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1).astype(np.uint8) if len(x) else np.zeros((0, len(self.edges)), np.uint8)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of statistics."""
        b, rows = self.bins(x), np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            f = self.feature[at]
            step = self.left[at] + (b[rows, np.maximum(f, 0)] > self.cut[at])
            at = np.where(f >= 0, step, at)
        raw = self.base + self.value[at].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = BINS, l2: float = 1.0,
        least: float = 3.0) -> Forest:
    """Second-order boosting of the logistic loss on feature histograms."""
    n, d = x.shape if len(x) else (0, N_STATISTICS)
    pos = float(y.sum()) if n else 0.0
    base = float(np.log((pos + 1) / (n - pos + 1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(d)]
    out = Forest(edges, np.zeros(0, np.int64), np.full(1, -1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), depth, base)
    if not 0 < pos < n:
        return out
    b = out.bins(x).astype(np.int64)
    flat = b + np.arange(d) * bins
    feature, cut, left, value, roots = [], [], [], [], []
    raw = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        first = len(feature)
        roots.append(first)
        feature.append(-1), cut.append(0), left.append(0), value.append(0.0)
        at, level = np.full(n, first), [first]
        for step in range(depth + 1):
            slot = {node: i for i, node in enumerate(level)}
            local = np.array([slot.get(i, -1) for i in range(first, len(feature))])[at - first]
            live = local >= 0
            key = (local[live, None] * (d * bins) + flat[live]).ravel()
            size = len(level) * d * bins
            hist = lambda v: np.bincount(key, np.repeat(v[live], d), size).reshape(len(level), d, bins)
            hg, hh = hist(g), hist(h)
            tg, th = hg[:, 0].sum(1), hh[:, 0].sum(1)
            for i, node in enumerate(level):
                value[node] = -rate * tg[i] / (th[i] + l2)
            if step == depth:
                break
            lg, lh = hg.cumsum(2), hh.cumsum(2)
            rg, rh = tg[:, None, None] - lg, th[:, None, None] - lh
            gain = lg**2 / (lh + l2) + rg**2 / (rh + l2) - (tg**2 / (th + l2))[:, None, None]
            gain[(lh < least) | (rh < least)] = 0
            best = gain.reshape(len(level), -1).argmax(1)
            grown = []
            for i, node in enumerate(level):
                if gain.reshape(len(level), -1)[i, best[i]] <= 1e-6:
                    continue
                feature[node], cut[node], left[node] = int(best[i] // bins), int(best[i] % bins), len(feature)
                for _ in range(2):
                    grown.append(len(feature))
                    feature.append(-1), cut.append(0), left.append(0), value.append(0.0)
            if not grown:
                break
            f, c, lf = (np.array(v) for v in (feature, cut, left))
            split = f[at] >= 0
            at = np.where(split, lf[at] + (b[np.arange(n), np.maximum(f[at], 0)] > c[at]), at)
            level = grown
        raw = raw + np.array(value)[at]
    out.roots, out.feature, out.cut, out.left, out.value = (np.array(v) for v in (roots, feature, cut, left, value))
    return out


def _matrix(bodies: pa.Array) -> np.ndarray:
    """The statistics of each text, one text at a time in Python."""
    return np.stack([statistics(x.as_py()) for x in bodies]) if len(bodies) else np.zeros((0, N_STATISTICS), np.float32)


def _stats_udf():
    @F.arrow_udf("array<float>")
    def stats(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from releasing(lambda arrays: (pa.array(list(_matrix(a)), pa.list_(pa.float32())) for a in arrays))(bodies)
    return stats


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """(body, y) of at most ``sample_rows`` labelled training rows; held-out ids never enter."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (doc_bucket(3) != 1)))
    # only rows under a bound of the hash are sorted: twice as many as are taken, whatever the number of labels
    share = 2.0 * sample_rows / max(lab.count(), 1)
    if share < 1:
        lab = lab.where(F.xxhash64("doc_id") < int(share * 2.0 ** 64) - 2 ** 63)
    lab = lab.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    return src.join(F.broadcast(lab), "doc_id").select("body", "y")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest:
    rows = labelled_sample(docs, labels, label, sample_rows).select(_stats_udf()("body").alias("x"), "y").toPandas()
    x = np.stack(rows["x"].to_numpy()).astype(np.float32) if len(rows) else np.zeros((0, N_STATISTICS), np.float32)
    y = rows["y"].to_numpy(np.float64)
    order = np.lexsort([*x.T, y])                 # the trees don't depend on the order in which rows arrive
    return fit(x[order], y[order])


def scorer(model: Forest):
    """Arrow UDF: the UTF-8 bytes of a text -> score."""
    @F.arrow_udf("double")
    def score(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from releasing(lambda arrays: (pa.array(model.score(_matrix(a)), pa.float64()) for a in arrays))(bodies)
    return score


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(docs, labels, "quality", sample_rows)
    s = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model)(text_bytes()).alias("score"))
    return s.select("doc_id", (doc_bucket(3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier does not reject."""
    model = train(docs, labels, "quality", sample_rows)
    return docs.where(scorer(model)(text_bytes()) >= threshold)
