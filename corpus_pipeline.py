"""A corpus pipeline of five operators: quality, exact dedup, near-dedup, mixing, packing.

Each stage takes all rows that the one before kept and returns rows with the columns of
``documents``; the last returns the packed pieces. Stages are written as Parquet in the shared
checkpoint folder and read again, so that a lost executor never reaches back over a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch, scan, text_version
from threadmill.llm.exact_dedup import exact_dedup
from threadmill.llm.minhash_dedup import minhash_dedup
from threadmill.llm.mixing import mixed_documents
from threadmill.llm.packing import pack
from threadmill.llm.quality import keep_quality

# The quality model and the byte-level vocabulary have no SQL form; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def _only(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay by their own verdicts (doc_id, version, team, rank, kept).

    A row is known by its id and the version of its text, so that rows that repeat an id with
    different texts stand each by its own verdict. Of the kept rows of one ``team`` the one with
    the smallest (rank, version) stays; rows without a team stand alone. Rows of equal id and text
    are one document: the smallest of them by all columns stays.

    The join is against the rows that go, which are fewer than those that stay: Spark broadcasts
    them while their table is under its threshold, and else shuffles both sides.
    """
    scratch = Scratch(docs.sparkSession, "kept")
    v = scratch.write(verdicts.select(F.col("doc_id").cast("long").alias("_id"), F.col("version").alias("_v"), "team", "rank", "kept"), "verdicts")
    lead = v.where("kept and team is not null").groupBy(F.col("team").alias("_team")).agg(
        F.min(F.struct("rank", "_v")).alias("_lead"), F.max(F.struct("rank", "_v")).alias("_last")).where("_lead <> _last")
    spare = v.where("kept").join(lead, F.col("team") == F.col("_team")).where(F.struct("rank", "_v") != F.col("_lead"))
    gone = scratch.write(v.where("not kept").select("_id", "_v").union(spare.select("_id", "_v")).distinct(), "gone")
    twice = scratch.write(v.groupBy("_id", "_v").count().where("count > 1").select("_id", "_v"), "twice")
    version = text_version()
    match = lambda other: docs["doc_id"].cast("long").eqNullSafe(other["_id"]) & (version == other["_v"])
    out = docs.join(gone, match(gone), "left_anti")
    if twice.isEmpty():
        return out
    again = out.join(twice, match(twice), "left_semi")
    again = again.groupBy(F.col("doc_id").alias("_id"), version.alias("_v")).agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return out.join(twice, match(twice), "left_anti").unionByName(again)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality model does not reject; it scores null and empty texts too, and every row by its own text."""
    return keep_quality(docs, scan(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: most code points, smallest id (null last), smallest version."""
    verdicts = exact_dedup(docs).withColumn("team", F.col("text_sha256")).withColumn("rank", -F.col("code_points"))
    return _only(docs, verdicts)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the smallest id; rows with a null id stay."""
    verdicts = minhash_dedup(docs).withColumnRenamed("group", "team").withColumn("rank", F.lit(0).cast("long"))
    return _only(docs, verdicts)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix of sources takes it; null ids and repeated rows are rows of their own."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed; a null text is empty, and extra columns are not read."""
    return pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("minhash_dedup", near), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = scan(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
