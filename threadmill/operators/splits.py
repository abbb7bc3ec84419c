"""Held-out and train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.functions.text import ColumnOrName, col, nz
from threadmill.operators.ranking import cut_keys, few, flag_first_k, md5_order_key

SPLIT_SEED = 42  # fixed value: the reference's split seed


def holdout_key(session_id: ColumnOrName, completion: ColumnOrName) -> Column:
    """W1 key: session id if non-empty, else 'C:' + first 200 chars of the completion."""
    return F.coalesce(nz(F.col(session_id) if isinstance(session_id, str) else session_id),
                      F.concat(F.lit("C:"), F.substring(F.coalesce(col(completion), F.lit("")), 1, 200)))


def md5_mod20_is_zero(key: ColumnOrName) -> Column:
    """``int(md5(key), 16) % 20 == 0`` without 128-bit arithmetic.

    16 = 0 (mod 4) and 16 = 1 (mod 5), so the number is 0 mod 4 iff its last hex
    digit is, and 0 mod 5 iff the sum of its hex digits is.
    """
    h = F.md5(col(key))
    digits = F.transform(F.split(h, ""), lambda d: F.conv(d, 16, 10).cast("int"))
    digit_sum = F.aggregate(digits, F.lit(0), lambda a, x: a + x)
    last = F.conv(F.substring(h, 32, 1), 16, 10).cast("int")
    return (last % 4 == 0) & (digit_sum % 5 == 0)


def is_holdout(session_id: ColumnOrName, completion: ColumnOrName) -> Column:
    """Deterministic ~5 % held-out bucket."""
    return md5_mod20_is_zero(holdout_key(session_id, completion))


def stratified_split(df: DataFrame, strata_col: str, id_col: str, test_size: float = 0.05,
                     seed: int = SPLIT_SEED, out_col: str = "split") -> DataFrame:
    """Per stratum, the first max(1, floor(n * t)) rows in seeded hash order are 'test'.

    If any stratum has fewer than 2 rows the whole set is split at random instead
    (same seeded order, one stratum). Rows with a null stratum form a stratum of their own.
    """
    keyed = df.withColumn("_ok", md5_order_key(seed, id_col))
    sizes = keyed.groupBy(strata_col).agg(F.count(F.lit(1)).alias("_sn"))
    sizes = sizes.withColumn("_strat", F.min("_sn").over(Window.partitionBy()) >= 2).checkpoint()
    eff = F.when(F.col("_strat"), F.col(strata_col).cast("string")).otherwise(F.lit("*"))
    st = few(sizes.select(F.col(strata_col).alias("_st"), "_strat"))
    keyed = (keyed.join(st, keyed[strata_col].eqNullSafe(F.col("_st"))).drop("_st")
             .withColumn("_stratum", eff).drop("_strat"))
    k = lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(test_size)))
    flagged = flag_first_k(keyed, "_ok", ["_stratum"], k, "_is_test")
    return (flagged.withColumn(out_col, F.when(F.col("_is_test"), "test").otherwise("train"))
            .drop("_ok", "_stratum", "_is_test"))


def seeded_global_split(df: DataFrame, id_col: str, test_size: float = 0.05, seed: int = SPLIT_SEED,
                        out_col: str = "split") -> DataFrame:
    """The first ceil(n * t) rows in seeded hash order are 'test', no strata."""
    keyed = df.withColumn("_ok", md5_order_key(seed, id_col))
    k = lambda n: F.ceil(n * F.lit(test_size))
    flagged = flag_first_k(keyed, "_ok", [], k, "_is_test")
    return (flagged.withColumn(out_col, F.when(F.col("_is_test"), "test").otherwise("train"))
            .drop("_ok", "_is_test"))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = SPLIT_SEED) -> DataFrame:
    """Seeded shuffled sample of a fixed n (a sampling operator: the limit is the feature).

    ``orderBy(key).limit(n)`` plans as TakeOrderedAndProject: each task keeps its n
    smallest keys, so only n rows per task reach the final merge.
    """
    return df.withColumn("_ok", md5_order_key(seed, id_col)).orderBy("_ok").limit(n).drop("_ok")


def first_n_per_group(df: DataFrame, group_col: str, order_col: str, n: int,
                      out_col: str = "rn", salt_buckets: int = 256) -> DataFrame:
    """First n rows per group in ``order_col`` order (one scan, not one per group).

    A window over a whole group would put a hot group in one task. Instead the
    narrow ``(group, order)`` projection is counted per distinct order value and ranked within
    ``salt_buckets`` slices of each group; the union of every slice's first n values holds the
    group's n-th row, so the cutoff is found among at most ``salt_buckets * n`` values per group.
    Rows up to that cutoff are then numbered, rows that share the last value included, and cut at n.
    Nulls come first in the order; a null group is a group.
    """
    g, o = F.col(group_col).alias("_g"), F.col(order_col).alias("_o")
    values = df.select(g, o).groupBy("_g", "_o").agg(F.count(F.lit(1)).alias("_c"))
    values = values.withColumn("_salt", F.pmod(F.xxhash64("_o"), F.lit(salt_buckets)))
    cands = values.withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_salt").orderBy("_o"))).where(F.col("_r") <= n)
    before = F.coalesce(F.sum("_c").over(Window.partitionBy("_g").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.struct(F.col("_o").isNotNull().alias("a"), F.col("_o").alias("b"))
    cuts = cands.withColumn("_before", before).where(F.col("_before") < n).groupBy("_g").agg(F.max(rank).alias("_cut"))
    own = F.struct(F.col(order_col).isNotNull().alias("a"), F.col(order_col).alias("b"))
    kept = df.join(cuts, df[group_col].eqNullSafe(F.col("_g"))).where(own <= F.col("_cut")).drop("_g", "_cut")
    first = Window.partitionBy(group_col).orderBy(order_col)
    return kept.withColumn(out_col, F.row_number().over(first)).where(F.col(out_col) <= n)


def staged_split(df: DataFrame, id_col: str, sizes: list[int], seed: int = SPLIT_SEED, out_col: str = "stage") -> DataFrame:
    """Disjoint stages of the given sizes in seeded hash order, 1 first; 0 for the rows after the last stage.

    All borders come from one refined histogram of the hash (``ranking.cut_keys``), and a row finds
    its stage by comparing its own hash with them: no window over rows, no join. Rows that repeat
    an id share its stage (a null id counts as the empty text).
    """
    keyed = df.withColumn("_ok", md5_order_key(seed, id_col))
    ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
    stage = F.lit(None).cast("int")
    open_end = False
    cuts = iter(cut_keys(keyed, "_ok", [e for e in ends if e > 0]))
    for i, cut in enumerate([next(cuts) if e > 0 else "" for e in ends], 1):
        if cut is None:                       # the table ends in this stage
            stage, open_end = F.coalesce(stage, F.lit(i)), True
            break
        stage = F.coalesce(stage, F.when(F.col("_ok") <= cut, F.lit(i)))
    return keyed.withColumn(out_col, stage if open_end else F.coalesce(stage, F.lit(0))).drop("_ok")
