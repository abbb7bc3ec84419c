"""Parquet scans of the input tables.

Scans are lazy; callers select the columns they need so Catalyst prunes the
``ReadSchema`` and pushes filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table: the plain Parquet scan, whatever its size, so that filters and
    projections push into the reader on every input alike."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temp view (for SQL users and tests)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
