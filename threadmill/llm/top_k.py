"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates and queries are dealt into blocks of bounded size; a task gets one block of each.
It turns the candidate block into postings (per term: row numbers and integer weights), and
each term of the query rows adds its weighted postings to dense score arrays, one row of
accumulators per query. ``argpartition`` then selects the k best of the block, and the block
winners are merged by rank. Every candidate of every block is scored: no pruning, no index.

Defined results: vectors that are null, or hold null or non-finite components, take no part;
shorter vectors count missing terms as 0. Rows that repeat an id are separate candidates, but
a query never meets its own id. Fewer than k candidates: all of them. Products are 64-bit
integers; where one may not fit, the job fails with an overflow error instead of giving another
order. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch

BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024


def postings(rows: np.ndarray):
    """Per term with any weight: (term, row numbers or None for all rows, weights)."""
    out = []
    for t in range(rows.shape[1]):
        ids = np.flatnonzero(rows[:, t])
        if len(ids) * 4 > len(rows) * 3:      # a posting list of most rows: a dense column adds faster
            out.append((t, None, np.ascontiguousarray(rows[:, t])))
        elif len(ids):
            out.append((t, ids, rows[ids, t]))
    return out


def accumulate(queries: np.ndarray, lists) -> np.ndarray:
    """Scores of all queries against one block, term after term."""
    n = max((len(w) if ids is None else int(ids.max()) + 1 for _, ids, w in lists), default=0)
    raise_to = np.zeros((len(queries), n), queries.dtype)
    for t, ids, w in lists:
        q = queries[:, t]
        active = np.flatnonzero(q)
        if not len(active):
            continue
        if ids is None:
            for i in active:
                raise_to[i, :len(w)] += q[i] * w
        else:
            for i in active:
                raise_to[i, ids] += q[i] * w
    return raise_to


def block_top(query_ids, queries, cand_ids, cands, k: int, chunk: int = 64):
    """(query_id, vec_id, score) of the k best candidates of the block for each query."""
    order = np.argsort(cand_ids, kind="stable")
    cand_ids, cands = cand_ids[order], cands[order]
    width = max(queries.shape[1], cands.shape[1])
    pad = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
    queries, cands = pad(queries), pad(cands)
    peak = float(np.abs(queries).max(initial=0)) * float(np.abs(cands).max(initial=0)) * width
    if peak >= 2.0**63:
        raise OverflowError("exact_top_k: an inner product may not fit 64 bits")
    kind = np.int32 if peak < 2**31 else np.int64
    queries, cands = queries.astype(kind), cands.astype(kind)
    lists, n = postings(cands), len(cands)
    low = np.iinfo(np.int64).min
    for a in range(0, len(queries), chunk):
        ids = query_ids[a:a + chunk]
        scores = np.zeros((len(ids), n), np.int64)
        got = accumulate(queries[a:a + chunk], lists)
        scores[:, :got.shape[1]] = got
        for q, s in zip(ids, scores):
            free = cand_ids != q
            take = np.flatnonzero(free)
            if len(take) > k:                 # ties at the border: all that reach the k-th score stay
                s2 = np.where(free, s, low)
                kth = np.partition(s2, n - k)[n - k]
                take = np.flatnonzero(free & (s2 >= kth))
                take = take[np.lexsort((cand_ids[take], -s[take]))][:k]
            yield from zip([int(q)] * len(take), cand_ids[take].tolist(), s[take].tolist())


def exact_top_k(rows: DataFrame, k: int = 20, query_filter="vec_id % 20 = 0", scale: int = 64,
                block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The ``k`` best rows for each row that ``query_filter`` selects: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "top_k")
    wide = F.raise_error(F.lit("exact_top_k: a scaled component does not fit 64 bits")).cast("long")
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.when(F.abs(v * scale) < 2.0**62, F.floor(v * scale)).otherwise(wide))
    valid = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    vecs = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & valid).select("vec_id", x.alias("x"))
    vecs = scratch.write(vecs, "vectors")
    queries = vecs.where(query_filter)
    n, nq = vecs.count(), queries.count()
    nb, nqb = max(1, -(-n // block_rows)), max(1, -(-nq // block_queries))
    slot = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = queries.select(slot(nqb).alias("qb"), every(nb).alias("cb"), "vec_id", "x")
    right = vecs.select(every(nqb).alias("qb"), slot(nb).alias("cb"), "vec_id", "x")

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = max(map(len, [*q.x, *c.x]))
        mat = lambda s: np.array([np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in s]).reshape(len(s), width)
        got = list(block_top(q.vec_id.to_numpy(), mat(q.x), c.vec_id.to_numpy(), mat(c.x), k))
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype("int64")

    best = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
