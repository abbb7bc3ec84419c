"""Near-duplicate removal with MinHash + LSH (D2, J7) and the exact-Jaccard aid (D2x).

Pipeline (all DataFrame operations):

1. rows with fewer than ``min_words`` words are exempt;
2. 3-word shingles of the lower-cased text, each hashed once to a long; rows with equal
   shingle sets are one class;
3. a ``num_perm`` MinHash signature: for permutation i the minimum of ``xxhash64(shingle, i)``
   over the shingle set, computed with numpy for a slice of rows at once;
4. ``bands`` x ``rows`` LSH: every class is exploded into its band hashes and classes
   sharing a ``(band, hash)`` bucket become candidates (equi self-join, J7);
5. candidates are verified by exact Jaccard of the shingle sets (removes false merges);
   only the sets of candidates are shuffled;
6. drops are resolved exactly from the pair graph, as the reference's sequential
   loop would (keep the richer row, on a tie the later one survives):

   * ``self(j)``: some earlier neighbour m has ``th(m) > th(j)``, ``self(m)`` is
     false and no neighbour k of m with ``m < k < j`` has ``th(k) >= th(m)``;
   * x is dropped iff ``self(x)`` or some later neighbour k has ``th(k) >= th(x)``.

   Only ``self`` recurses (along strictly richer earlier rows); it is resolved by
   iterated joins until no row is undecided, with the state checkpointed per round.
   Members of one class, or of two linked ones, are neighbours each with each. A class
   without links keeps the last of its richest rows, which two running maxima find; rows
   of linked classes meet in joins that only count and filter.

Bucket sizes: a bucket of m classes has m(m-1)/2 pairs. Two exact bounds are part of the join,
so that a pair that cannot pass the verification never leaves it: the sizes of the sets, and
the bits in which their parity bitmaps differ (at most the size of the symmetric difference).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions.text import words
from threadmill.session import materialize

# Fixed values of the reference's near-dedup.
THRESHOLD = 0.85
NUM_PERM = 128
SHINGLE_WORDS = 3
MIN_WORDS = 20
# LSH shape: 18 bands of 7 of the 128 permutations share a bucket with probability
# 1 - (1 - s^7)^18 at Jaccard s: 0.999 at the threshold 0.85, 0.13 at 0.5.
BANDS, ROWS = 18, 7
#: Hashes whose permutations are computed together.
HASHES = 65_536
#: Longs of a parity bitmap.
PARITY_LONGS = 8
#: Bits of one bitmap of Spark's, and bitmaps that are broadcast at most (4 KB each, so 16 MB).
MAP_BITS, MAPS = 32_768, 4_096


def shingle_words(text: Column) -> Column:
    return words(F.lower(F.coalesce(text, F.lit(""))))


def shingle_hashes(w: Column, k: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of the k-word shingles of a word array (``shingle_words``).

    For n words there are ``max(1, n - k + 1)`` shingles (one shorter shingle when n < k).
    ``w`` must be a column reference, not an expression: lambda bodies re-evaluate
    outer expressions per element.
    """
    n = F.greatest(F.size(w) - (k - 1), F.lit(1))
    sh = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(w, i, k), " "))
    return F.array_distinct(F.transform(sh, lambda s: F.xxhash64(s)))


def _xxhash(x: np.ndarray, then: int | None = None) -> np.ndarray:
    """``xxhash64`` of longs (seed 42), or of the int ``then`` seeded with the hashes ``x``."""
    p1, p2, p3, p4, p5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turned = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    if then is None:
        v = turned(x * p2, 31) * p1 ^ (np.uint64(42 + 8) + p5)
        v = turned(v, 27) * p1 + p4
    else:
        v = (x + (p5 + np.uint64(4))) ^ np.uint64(then * int(p1) & (1 << 64) - 1)
        v = turned(v, 23) * p2 + p3
    v = (v ^ (v >> np.uint64(33))) * p2
    v = (v ^ (v >> np.uint64(29))) * p3
    return v ^ (v >> np.uint64(32))


def signatures(sets: list[np.ndarray], num_perm: int) -> np.ndarray:
    """One row per set (none empty): for each permutation i, min of ``xxhash64(x, i)``."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    base = _xxhash(np.concatenate(sets).view(np.uint64))
    out = np.empty((len(sets), num_perm), np.int64)
    for i in range(num_perm):
        out[:, i] = np.minimum.reduceat(_xxhash(base, i).view(np.int64), starts)
    return out


def minhash(h: Column, num_perm: int = NUM_PERM) -> Column:
    """Signature: for each permutation i, min over the set of ``xxhash64(x, i)``."""
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def of(sets: pd.Series) -> pd.Series:
        out, part, size = [[None] * num_perm] * len(sets), [], 0
        at = [i for i, s in enumerate(sets) if s is not None and len(s)]
        for i in at:
            part.append(i)
            size += len(sets.iloc[i])
            if size >= HASHES or i == at[-1]:                # a slice at a time, so that it stays in the cache
                for j, row in zip(part, signatures([np.asarray(sets.iloc[j], np.int64) for j in part], num_perm)):
                    out[j] = row
                part, size = [], 0
        return pd.Series(out, dtype=object)
    return of(h)


def band_hashes(sig: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """One hash per band. No lambda, in which the whole signature would be computed anew for every band."""
    return F.array(*[F.xxhash64(F.slice(sig, j * rows + 1, rows)) for j in range(bands)])


def class_key(h: Column) -> Column:
    """128 bits of the SHA-256 of a shingle set."""
    return F.unhex(F.substring(F.sha2(F.to_json(F.array_sort(h)), 256), 1, 32))


def parity(h: np.ndarray) -> np.ndarray:
    """Bit b is set iff an odd number of hashes end in b: two sets differ in at least as many
    elements as their bitmaps differ in bits."""
    odd = np.bincount(h & (64 * PARITY_LONGS - 1), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def parity_bits(h: pd.Series) -> pd.Series:
    return pd.Series([parity(x) for x in h], dtype=object)


def may_reach(n: tuple[Column, Column], bits: tuple[str, str], threshold: float) -> Column:
    """False only for pairs of sets that cannot have Jaccard ``threshold``: by their sizes, or as
    they differ in more than (1 - t) / (1 + t) of all elements."""
    differ = sum((F.bit_count(F.col(f"{bits[0]}{i}").bitwiseXOR(F.col(f"{bits[1]}{i}"))) for i in range(1, PARITY_LONGS)),
                 F.bit_count(F.col(f"{bits[0]}0").bitwiseXOR(F.col(f"{bits[1]}0"))))
    slack = F.lit(1e-6)
    return ((F.least(*n) + slack >= F.lit(threshold) * F.greatest(*n))
            & (differ <= F.lit((1 - threshold) / (1 + threshold)) * (n[0] + n[1]) + slack))


def unpacked(bits: str, prefix: str) -> list[Column]:
    return [F.col(bits)[i].alias(f"{prefix}{i}") for i in range(PARITY_LONGS)]


def candidate_pairs(sig: DataFrame, id_col: str, bands: int = BANDS, rows: int = ROWS,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Pairs ``(a < b)`` sharing at least one LSH bucket that can pass verification.

    ``sig`` has the sets (``_sh``) and their signatures (``sig``) or band hashes (``_bh``). Rows that
    repeat an id and its set count once.
    """
    bh = F.col("_bh") if "_bh" in sig.columns else band_hashes(F.col("sig"), bands, rows)
    t = sig.where(F.col(id_col).isNotNull())
    t = t.select(F.col(id_col).alias("k"), F.size("_sh").alias("n"), parity_bits("_sh").alias("bits"), bh.alias("bh")).distinct()
    b = t.select("k", "n", *unpacked("bits", "w"), F.posexplode("bh").alias("band", "h"))
    side = lambda c: b.select(*[F.col(x).alias(f"{c}_{x}") for x in b.columns])
    met = side("l").join(side("r"), (F.col("l_band") == F.col("r_band")) & (F.col("l_h") == F.col("r_h")) & (F.col("l_k") < F.col("r_k"))
                         & may_reach((F.col("l_n"), F.col("r_n")), ("l_w", "r_w"), threshold))
    return met.select(F.col("l_k").alias("a"), F.col("r_k").alias("b")).distinct()


def among(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be in ``wanted``, by one bit of a broadcast bitmap.

    It spares the exact join that follows from shuffling most other rows. There are 16 bits to a
    key while they fit ``MAPS``; beyond, more rows pass, which only costs work.
    """
    maps = min(MAPS, max(1, -(-16 * wanted.count() // MAP_BITS)))
    slot = F.pmod(F.xxhash64(key), F.lit(maps * MAP_BITS))
    bits = wanted.select(F.floor(slot / MAP_BITS).alias("_map"), (slot % MAP_BITS).alias("_bit"))
    bits = bits.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    at = slot % MAP_BITS
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = (F.floor(slot / MAP_BITS) == F.col("_map")) & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return rows.join(F.broadcast(bits), held, "left_semi")


def pair_sets(rows: DataFrame, pairs: DataFrame, id_col: str, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` with the sets ``sa`` and ``sb`` of both ends; of ``rows``, only theirs are shuffled.
    Rows that repeat an id have the same set."""
    ends = pairs.select(F.col(a).alias("_k")).union(pairs.select(b)).distinct()
    s = among(rows.select(F.col(id_col).alias("_k"), "_sh"), ends, "_k").dropDuplicates(["_k"])
    return (pairs.join(s.select(F.col("_k").alias(a), F.col("_sh").alias("sa")), a)
            .join(s.select(F.col("_k").alias(b), F.col("_sh").alias("sb")), b))


def verified_pairs(rows: DataFrame, pairs: DataFrame, id_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """Keep candidate pairs whose exact shingle-set Jaccard is at least ``threshold``."""
    j = pair_sets(rows, materialize(pairs, "near_candidates"), id_col)
    inter = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - inter
    return j.where(inter >= F.lit(threshold) * union).select("a", "b")


def resolve_drops(rows: DataFrame, pairs: DataFrame, id_col: str, th_col: str) -> DataFrame:
    """Exact drop set of the sequential loop, from the neighbour pairs. Returns ``(id, dropped)``."""
    th = rows.select(F.col(id_col).alias("_id"), F.col(th_col).alias("_th"))
    p = (pairs.join(th.select(F.col("_id").alias("a"), F.col("_th").alias("tha")), "a")
         .join(th.select(F.col("_id").alias("b"), F.col("_th").alias("thb")), "b"))
    return _flagged(rows, _dropped(p), id_col)


def _flagged(rows: DataFrame, dropped: DataFrame, id_col: str) -> DataFrame:
    out = rows.select(F.col(id_col).alias("_id")).join(dropped.withColumn("_d", F.lit(True)), "_id", "left")
    return out.select(F.col("_id").alias(id_col), F.coalesce("_d", F.lit(False)).alias("dropped"))


def _dropped(p: DataFrame) -> DataFrame:
    """The ids (``_id``, once each) that drop out of the neighbours (a, tha, b, thb), a < b.

    Every round settles at least the first undecided row, whose droppers all come earlier;
    the loop ends when nothing is undecided. Only rows with a possible dropper take part.
    """
    # first later neighbour k of m with th(k) >= th(m)
    fs = materialize(p.where(F.col("thb") >= F.col("tha")).groupBy("a").agg(F.min("b").alias("first_strong")), "first_strong")
    # candidate droppers m of j: m < j, th(m) > th(j), j before m's first strong later neighbour
    cand = (p.where(F.col("tha") > F.col("thb")).join(fs, "a", "left")
            .where(F.col("first_strong").isNull() | (F.col("b") < F.col("first_strong")))
            .select(F.col("a").alias("m"), F.col("b").alias("j")))
    cand = materialize(cand, "droppers")
    state = (cand.select(F.col("m").alias("_id"), F.lit(False).alias("_has")).union(cand.select("j", F.lit(True)))
             .groupBy("_id").agg(F.when(~F.max("_has"), F.lit(False)).alias("self")))
    state = state.checkpoint()
    undecided = state.where(F.col("self").isNull()).count()
    while undecided:
        votes = (cand.join(state.select(F.col("_id").alias("m"), F.col("self").alias("sm")), "m")
                 .groupBy(F.col("j").alias("_id"))
                 .agg(F.count_if(F.col("sm") == F.lit(False)).alias("_f"),
                      F.count_if(F.col("sm").isNull()).alias("_u")))
        state = (state.join(votes, "_id", "left")
                 .select("_id", F.when(F.col("self").isNotNull(), F.col("self"))
                         .when(F.col("_f") > 0, F.lit(True))
                         .when(F.col("_u") == 0, F.lit(False)).alias("self")))
        state = state.checkpoint()
        before, undecided = undecided, state.where(F.col("self").isNull()).count()
        if undecided >= before:
            raise RuntimeError(f"near-dedup resolution made no progress with {undecided} rows undecided")
    return state.where("self").select("_id").union(fs.select("a")).distinct()


def class_drops(members: DataFrame, links: DataFrame) -> DataFrame:
    """The ids that drop out of classes: ``members`` are (_id, _th, fp), ``links`` (a, b) are pairs
    of classes, each once. Members of a class, or of two linked ones, are neighbours."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    repeated = members.groupBy("_id").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_id")
    busy = materialize(both.select(F.col("u").alias("fp")).union(members.join(repeated, "_id", "left_semi").select("fp")).distinct(), "linked_classes")
    quiet = members.join(busy, "fp", "left_anti")
    richest = lambda order: F.max("_th").over(Window.partitionBy("fp").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    quiet = quiet.withColumn("_before", richest(F.col("_id"))).withColumn("_after", richest(F.col("_id").desc()))
    quiet = quiet.where((F.col("_before") > F.col("_th")) | (F.col("_after") >= F.col("_th"))).select("_id")
    met = members.join(busy, "fp", "left_semi")
    edges = both.union(busy.select("fp", F.col("fp").alias("v")))
    p = (edges.join(met.select(F.col("fp").alias("u"), F.col("_id").alias("a"), F.col("_th").alias("tha")), "u")
         .join(met.select(F.col("fp").alias("v"), F.col("_id").alias("b"), F.col("_th").alias("thb")), "v").where(F.col("a") < F.col("b")))
    return _dropped(p.select("a", "tha", "b", "thb")).union(quiet).distinct()


def near_dedup(df: DataFrame, id_col: str, text_col: str, thinking_col: str,
               threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with a boolean ``near_dup`` column (rows to drop). ``id_col`` is the
    processing order of the reference (first seen first)."""
    th = F.length(F.coalesce(F.col(thinking_col), F.lit("")))
    base = df.select(id_col, F.size(words(F.coalesce(F.col(text_col), F.lit("")))).alias("_nw"),
                     F.col(text_col).alias("_t"), th.alias("_th"))
    eligible = (base.where((F.col("_nw") >= min_words) & F.col(id_col).isNotNull()).withColumn("_w", shingle_words(F.col("_t")))
                .select(F.col(id_col).alias("_id"), "_th", shingle_hashes(F.col("_w")).alias("_sh")))
    # a class is known by the hash of its set
    eligible = eligible.withColumn("sig", minhash(F.col("_sh")))
    eligible = eligible.select("_id", "_th", class_key(F.col("_sh")).alias("fp"), band_hashes(F.col("sig")).alias("_bh"), "_sh")
    eligible = materialize(eligible, "near_sets")
    links = materialize(verified_pairs(eligible, candidate_pairs(eligible, "fp", threshold=threshold), "fp", threshold), "near_links")
    members = materialize(eligible.select("_id", "fp").distinct().join(eligible.select("_id", "_th").distinct(), "_id"), "near_members")
    drops = _flagged(eligible, class_drops(members, links), "_id").withColumnRenamed("_id", id_col)
    return (df.join(drops, id_col, "left")
            .withColumn("near_dup", F.coalesce(F.col("dropped"), F.lit(False))).drop("dropped"))


def exact_jaccard_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD,
                        min_words: int = MIN_WORDS) -> DataFrame:
    """D2x (test aid): all pairs with shingle-set Jaccard >= threshold, by an inverted
    index join on shingle hashes. Quadratic in the rows sharing a shingle: for small
    fixtures and recall checks of D2 only."""
    base = (df.where(F.size(words(F.coalesce(F.col(text_col), F.lit("")))) >= min_words)
            .select(id_col, shingle_words(F.col(text_col)).alias("_w"))
            .select(id_col, shingle_hashes(F.col("_w")).alias("_sh")))
    ex = base.select(id_col, F.size("_sh").alias("_n"), F.explode("_sh").alias("_h"))
    l, r = ex.alias("l"), ex.alias("r")
    inter = (l.join(r, (F.col("l._h") == F.col("r._h")) & (F.col(f"l.{id_col}") < F.col(f"r.{id_col}")))
             .groupBy(F.col(f"l.{id_col}").alias("a"), F.col(f"r.{id_col}").alias("b"),
                      F.col("l._n").alias("na"), F.col("r._n").alias("nb"))
             .agg(F.count(F.lit(1)).alias("i")))
    return inter.where(F.col("i") >= F.lit(threshold) * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")
