"""Similarity self-join with full recall: length, prefix and positional filtering.

Every pair of texts whose shingle sets reach a Jaccard threshold is found, over all rows and
without bands (after Bayardo et al. 2007 and Xiao et al. 2008):

* Texts with equal sets are one class; one member stands for it.
* Shingles are put in one order for all sets, about from rare to frequent: by the count of the
  2^20 slots that they hash to, then by value. The counts are as large for any input; any order
  is right, a good one only spares work.
* Two sets of sizes m <= n reach t only if they share at least ``need = ceil(t / (1 + t) * (m + n))``
  shingles, hence one among the first ``n - ceil(t * n) + 1`` of each. Only these prefixes leave
  the row of their set.
* Prefix shingles meet in an equi-join on the shingle. A meeting at positions i and j counts
  only where ``m >= t * n`` (length) and ``min(m - i, n - j) >= need`` (position), which the first
  shingle that a pair shares always meets.
* Candidates that the parity bitmaps do not exclude are verified on whole sets; only the sets of
  candidates are shuffled.

A shingle that many near copies share leads to pairs that are mostly true ones. AQE splits the
join where a shingle is skewed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.operators.near_dedup import (SHINGLE_WORDS, THRESHOLD, class_key, may_reach, pair_sets, parity, shingle_hashes,
                                             shingle_words, unpacked)
from threadmill.session import materialize

#: Shingles are counted by so many leading bits of their hash (4 MB of counts).
SLOT_BITS = 20


def slot_counts(sets: DataFrame) -> np.ndarray:
    """Shingles of all rows by slot: at most 2^SLOT_BITS counts, however large the input."""
    slot = F.shiftrightunsigned("h", 64 - SLOT_BITS).cast("int").alias("slot")
    got = sets.select(F.explode("sh").alias("h")).groupBy(slot).agg(F.count(F.lit(1)).alias("c")).toPandas()
    counts = np.zeros(1 << SLOT_BITS, np.uint32)
    counts[got["slot"].to_numpy(np.int64)] = np.minimum(got["c"].to_numpy(np.int64), 2**32 - 1)
    return counts


def shingle_classes(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, k: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, rep) of every row with an id and words; (fp, rep, n, pre, bits, no) of every class: its key, its
    smallest id, the number of its shingles, its prefix, its parity bitmap and a number of its own, which takes
    less room than the key; (fp, _sh), the sets of all rows."""
    w = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), shingle_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    sets = w.select("id", F.array_sort(shingle_hashes(F.col("w"), k)).alias("sh"))
    sets = materialize(sets.select("id", "sh", class_key(F.col("sh")).alias("fp")), "shingle_sets")
    num, den = _ratio(threshold)
    counts = df.sparkSession.sparkContext.broadcast(slot_counts(sets))

    @F.pandas_udf("pre array<long>, bits array<long>")
    def prefix(sh: pd.Series) -> pd.DataFrame:
        c, out = counts.value, []
        for h in sh:
            length = len(h) + num * len(h) // -den + 1        # n - ceil(t * n) + 1
            order = np.lexsort((h, c[h.view(np.uint64) >> np.uint64(64 - SLOT_BITS)]))
            out.append((h[order[:length]], parity(h)))
        return pd.DataFrame(out, columns=["pre", "bits"])
    # rows of one class have the same set, prefix and bitmap
    classes = sets.select("id", "fp", F.size("sh").alias("n"), prefix("sh").alias("p")).select("id", "fp", "n", "p.*")
    first = [F.first(c).alias(c) for c in ("n", "pre", "bits")]
    classes = classes.groupBy("fp").agg(F.min("id").alias("rep"), *first)
    classes = materialize(classes.withColumn("no", F.monotonically_increasing_id()), "classes")
    members = sets.select("id", "fp").join(classes.select("fp", "rep"), "fp").select("id", "rep")
    return members, classes, sets.select("fp", F.col("sh").alias("_sh"))


def similar_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, k: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(a, b, shared, total) of every pair of classes with Jaccard >= ``threshold`` (a before b by
    their smallest ids; no pair twice), and (id, rep) of all rows with words.

    Null ids and texts without words take no part. An id with several texts is a member of
    several classes.
    """
    members, classes, sets = shingle_classes(df, id_col, text_col, threshold, k)
    num, den = _ratio(threshold)
    # a class goes by its number, until its candidates are known
    dealt = classes.select("no", "n", F.posexplode("pre").alias("i", "h"))
    x, y = dealt.alias("x"), dealt.alias("y")
    m, n = F.col("x.n"), F.col("y.n")
    need = F.ceil(F.lit(num) * (m + n) / F.lit(num + den))
    left = F.least(m - F.col("x.i"), n - F.col("y.i"))       # shingles from the meeting on
    smaller = (m < n) | ((m == n) & (F.col("x.no") < F.col("y.no")))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & smaller & (m * F.lit(den) >= n * F.lit(num)) & (left >= need))
    pairs = pairs.select(F.col("x.no").alias("p_no"), F.col("y.no").alias("q_no")).distinct()
    side = lambda c: classes.select(F.col("no").alias(f"{c}_no"), F.col("fp").alias(c), F.col("rep").alias(f"{c}_rep"), F.col("n").alias(f"{c}_n"), *unpacked("bits", f"{c}_w"))
    pairs = pairs.join(side("p"), "p_no").join(side("q"), "q_no").where(may_reach((F.col("p_n"), F.col("q_n")), ("p_w", "q_w"), threshold))
    pairs = materialize(pairs.select("p", "q", "p_rep", "q_rep", "p_n", "q_n"), "candidates")
    met = pair_sets(sets, pairs, "fp", "p", "q").withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    total = F.col("p_n") + F.col("q_n") - F.col("shared")
    met = met.withColumn("total", total).where(F.col("shared") * F.lit(den) >= F.col("total") * F.lit(num))
    return met.select(F.least("p_rep", "q_rep").alias("a"), F.greatest("p_rep", "q_rep").alias("b"), "shared", "total"), members


def _ratio(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction, so that borders are exact."""
    from fractions import Fraction
    f = Fraction(str(threshold))
    return f.numerator, f.denominator
