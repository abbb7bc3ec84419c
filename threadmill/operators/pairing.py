"""Pairing of two independently written result tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_results(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer pairing by ``keys``: the keys, structs ``l`` and ``r`` of the other columns, and
    ``side``: ``both``, ``left`` or ``right``.

    Keys are matched null-safe. The tables are joined on the whole key (example and position, say),
    so an example with very many rows is spread over tasks. A key that one table repeats is paired
    with each row of the other; ``duplicate_keys`` counts such keys beforehand.
    """
    pack = lambda df, name: df.select(*[F.col(k).alias(f"_{name}{i}") for i, k in enumerate(keys)],
                                      F.struct(*[c for c in df.columns if c not in keys]).alias(name))
    a, b = pack(left, "l"), pack(right, "r")
    same = reduce(and_, [F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}")) for i in range(len(keys))])
    j = a.join(b, same, "full_outer")
    side = F.when(F.col("l").isNull(), "right").when(F.col("r").isNull(), "left").otherwise("both")
    key = [F.when(side == "right", F.col(f"_r{i}")).otherwise(F.col(f"_l{i}")).alias(k) for i, k in enumerate(keys)]
    return j.select(*key, "l", "r", side.alias("side"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def paired_accuracy(pairs: DataFrame, example: str, left_hit: Column, right_hit: Column) -> DataFrame:
    """Per example: rows on both sides and on one only, mean hits of the paired rows and their delta."""
    both = F.col("side") == "both"
    p = pairs.groupBy(example).agg(
        F.count_if(both).alias("n_both"), F.count_if(F.col("side") == "left").alias("n_left_only"), F.count_if(F.col("side") == "right").alias("n_right_only"),
        F.avg(F.when(both, left_hit.cast("double"))).alias("_l"), F.avg(F.when(both, right_hit.cast("double"))).alias("_r"))
    return p.select(example, "n_both", "n_left_only", "n_right_only", F.round("_l", 6).alias("acc_left"), F.round("_r", 6).alias("acc_right"),
                    F.round(F.col("_l") - F.col("_r"), 6).alias("delta"))
