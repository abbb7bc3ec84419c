"""Exact deduplication: keep the first-seen row per content key.

"First seen" is the smallest order tuple (source rank, row id). The winner per key
is found with ``min(struct(order))`` in a ``groupBy``: partial aggregation collapses a
hot key (say, a third of all rows sharing an empty prompt) to one row per map task
before the shuffle, so no task ever holds a whole group. The rows that are not first, usually
few, are then matched back on the order tuple, which spreads evenly. A ``row_number`` window
partitioned by the key would instead send every copy of a hot key to one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions.text import ColumnOrName, col, strip
from threadmill.session import materialize


def sha256_key(c: ColumnOrName) -> Column:
    """D1 key: SHA-256 of the stripped text (case kept)."""
    return F.sha2(strip(F.coalesce(col(c), F.lit(""))), 256)


def signature_key(a: ColumnOrName, b: ColumnOrName, prefix: tuple[int, int] | None = None) -> Column:
    """D1b/D1c key of two whole texts: md5(md5(a) || md5(b)). With ``prefix`` the reference's
    form over their first characters: md5(a[:prefix[0]] || '||' || b[:prefix[1]])."""
    a, b = F.coalesce(col(a), F.lit("")), F.coalesce(col(b), F.lit(""))
    if prefix is None:
        return F.md5(F.concat(F.md5(a), F.md5(b)))
    return F.md5(F.concat(F.substring(a, 1, prefix[0]), F.lit("||"), F.substring(b, 1, prefix[1])))


def _order(order_cols: list[str]) -> Column:
    """The order tuple, nulls last in every column."""
    return F.struct(*[f(c) for c in order_cols for f in (lambda c: F.col(c).isNull().alias(f"{c}_null"), F.col)])


def _later(df: DataFrame, key: Column, order_cols: list[str]) -> DataFrame:
    """Keys and order tuples of the rows of ``df`` that are not the first of their key.

    Keys are computed once and written beside the order columns. Only keys that occur twice are
    joined, on these narrow rows; a key without copies, the common case, leaves after the
    aggregation.
    """
    keyed = materialize(df.select(key.alias("_dk"), *order_cols), "dedup_keys")
    # one column aggregates with ``min``, which skips nulls, in a hash aggregate; a tuple needs a sort aggregate
    order = F.col(order_cols[0]) if len(order_cols) == 1 else _order(order_cols)
    first = keyed.groupBy("_dk").agg(F.min(order).alias("_w"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = keyed.join(first.select(F.col("_dk").alias("_ld"), "_w"), F.col("_dk") == F.col("_ld"))
    return rows.where(~order.eqNullSafe(F.col("_w"))).select("_ld", *[F.col(c).alias(f"_l{i}") for i, c in enumerate(order_cols)]).distinct()


def _is_row(df: DataFrame, key: Column, order_cols: list[str]) -> Column:
    """Join condition with ``_later``: the order tuple, and the key itself only where the tuple holds a null."""
    same = reduce(and_, [df[c].eqNullSafe(F.col(f"_l{i}")) for i, c in enumerate(order_cols)])
    whole = reduce(and_, [F.col(f"_l{i}").isNotNull() for i in range(len(order_cols))])
    return same & (whole | (key == F.col("_ld")))


def flag_first_seen(df: DataFrame, key: Column, order_cols: list[str],
                    out_col: str = "is_first", eligible: Column | None = None) -> DataFrame:
    """Add boolean ``out_col``: row is the first (smallest ``order_cols``, nulls last) of its key.

    Rows where ``eligible`` is false take no part (they keep ``out_col`` = null), e.g. rows
    already dropped by a filter. ``order_cols`` identify a row where they hold no null: rows that
    repeat the whole tuple are flagged alike. Only the rows that are not first are joined back.
    """
    later = _later(df if eligible is None else df.where(eligible), key, order_cols).withColumn("_lost", F.lit(True))
    out = df.join(later, _is_row(df, key, order_cols), "left")
    flag = F.col("_lost").isNull()
    if eligible is not None:
        flag = F.when(eligible, flag)
    return out.withColumn(out_col, flag).drop("_ld", "_lost", *[f"_l{i}" for i in range(len(order_cols))])


def keep_first_seen(df: DataFrame, key: Column, order_cols: list[str]) -> DataFrame:
    """Drop later copies; ``exact_dedup`` of the reference."""
    return df.join(_later(df, key, order_cols), _is_row(df, key, order_cols), "left_anti")
