"""Scans and sinks.

Readers take explicit schemas where the format allows (no inference passes over the
data); writers are plain DataFrame writers, partitioned where the layout asks for it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """JSONL file or glob; malformed lines kept with ``_corrupt_record`` (PERMISSIVE)."""
    r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        if CORRUPT not in schema:
            schema = f"{schema}, {CORRUPT} string"
        r = r.schema(schema)
    return r.json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with nested messages; non-ASCII text is written as UTF-8, not escaped."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def load_sources(spark: SparkSession, sources: Iterable[tuple[DataFrame, str, str]]) -> DataFrame:
    """S1 + U1: each source DataFrame tagged with literal ``source``/``model`` and a
    ``source_rank`` (list order), then concatenated by column name."""
    out = None
    for rank, (df, source, model) in enumerate(sources):
        t = df.withColumn("source", F.lit(source)).withColumn("model", F.lit(model)) \
              .withColumn("source_rank", F.lit(rank))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def write_layout(sft: dict[str, DataFrame], grpo: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """``{sft,grpo}/{train,test}`` parquet layout via ``partitionBy(config, split)``."""
    parts = []
    for config, splits in (("sft", sft), ("grpo", grpo)):
        for split, df in splits.items():
            parts.append(df.withColumn("config", F.lit(config)).withColumn("split", F.lit(split)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out.write.mode(mode).partitionBy("config", "split").parquet(path)


def to_json_messages(df: DataFrame, col: str = "messages") -> DataFrame:
    """S8 (publish): nested messages -> JSON text column."""
    return df.withColumn(col, F.to_json(F.col(col)))


def from_json_messages(df: DataFrame, col: str = "messages",
                       schema: str = "array<struct<role:string,content:string,thinking:string>>") -> DataFrame:
    """S8 (use): JSON text -> nested messages."""
    return df.withColumn(col, F.from_json(F.col(col), schema))


def fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: rows ``n`` and an order-free fingerprint of the multiset of rows.

    A row's hash is 128 bits (two halves of the MD5 of its JSON text with nulls and names); the
    sums of the halves, in decimals that do not overflow, do not depend on order or partitions.
    """
    h = F.md5(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    half = lambda at: F.conv(F.substring(h, at, 16), 16, 10).cast("decimal(20,0)")
    return df.select(*keys, half(1).alias("_h1"), half(17).alias("_h2")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_h1").alias("h1"), F.sum("_h2").alias("h2"))


def reconcile(src: DataFrame, dst: DataFrame, keys: list[str]) -> DataFrame:
    """Per key of either side: ``n_src``, ``n_dst``, ``same_content`` and ``match`` (counts and contents agree)."""
    side = lambda df, name: fingerprints(df, keys).select(*[F.col(k).alias(f"_{name}{i}") for i, k in enumerate(keys)],
                                                          F.col("n").alias(f"n_{name}"), F.struct("h1", "h2").alias(f"_h_{name}"))
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"_src{i}").eqNullSafe(F.col(f"_dst{i}"))
    j = side(src, "src").join(side(dst, "dst"), same, "full_outer")
    content = F.coalesce(F.col("_h_src") == F.col("_h_dst"), F.lit(False))
    key = [F.when(F.col("n_src").isNotNull(), F.col(f"_src{i}")).otherwise(F.col(f"_dst{i}")).alias(k) for i, k in enumerate(keys)]
    return j.select(*key, "n_src", "n_dst", content.alias("same_content"), (content & F.col("n_src").eqNullSafe(F.col("n_dst"))).alias("match"))


def mirror(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Copy every config/split of a partitioned layout; row counts and contents of both sides
    per (config, split), full-outer reconciled (``match`` false on any difference)."""
    data = spark.read.parquet(src)
    data.write.mode("overwrite").partitionBy("config", "split").parquet(dst)
    return reconcile(data, spark.read.parquet(dst), ["config", "split"])


def commit_snapshot(df: DataFrame, path: str, batch: str, commit: bool = True) -> None:
    """Write one batch of a snapshot log, then its commit.

    The rows go to the batch's own folder, overwriting what an earlier attempt left there; the
    commit, one row with the batch's row count, follows. Readers (``read_snapshots``) take
    committed batches only, so a run that is repeated, or broken off between the two writes
    (``commit=False`` shows that state), leaves one copy or none.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    df.write.mode("overwrite").parquet(f"{root}/data/batch=b{batch}")
    if commit:
        n = spark.read.parquet(f"{root}/data/batch=b{batch}").agg(F.count(F.lit(1)).alias("n"))
        n.write.mode("overwrite").parquet(f"{root}/commits/batch=b{batch}")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the committed batches of a snapshot log; ``batch`` names each row's."""
    root = path.rstrip("/")
    done = spark.read.parquet(f"{root}/commits").select("batch")
    rows = spark.read.parquet(f"{root}/data").join(done, "batch", "left_semi")
    return rows.withColumn("batch", F.expr("substring(batch, 2)"))


def read_jsonl_quarantined(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """The good rows of JSON lines, and the malformed lines with where and why.

    Good: the columns of ``schema``. Bad: ``file``, ``block_start`` (byte at which the scan's block
    begins), ``line`` and ``reason``: ``not_json``, ``not_object`` (JSON, but no object) or
    ``wrong_type`` (a field does not fit the schema). Lines of white space only are neither; all
    others are in exactly one of the two.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"))
    lines = lines.where(F.trim(F.regexp_replace("line", r"\s+", " ")) != "")
    parsed = F.from_json("line", f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    v = F.try_parse_json("line")
    reason = (F.when(v.isNull(), "not_json").when(~F.schema_of_variant(v).startswith("OBJECT"), "not_object")
              .when(parsed[CORRUPT].isNotNull(), "wrong_type"))
    rows = lines.select("*", parsed.alias("_row"), reason.alias("reason"))
    good = rows.where("reason is null").select("_row.*").drop(CORRUPT)
    return good, rows.where("reason is not null").select("file", "block_start", "line", "reason")


def append_snapshot(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """Append-only snapshot log partitioned by date (replaces the 'header once' check)."""
    df.withColumn("date", F.date_format(F.col(ts_col), "yyyy-MM-dd")).write.mode("append") \
      .partitionBy("date").parquet(path)


def read_results(spark: SparkSession, path: str, required: str = "top1_trained",
                 skip_prefix: str = "SMOKE_") -> DataFrame:
    """One JSON document per file; files named ``SMOKE_*`` are skipped, documents
    without the required key or unreadable (PERMISSIVE gives nulls) are dropped."""
    df = (spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
          .withColumn("_file", F.col("_metadata.file_name")))
    if required not in df.columns:
        return df.limit(0)
    return df.where(~F.col("_file").startswith(skip_prefix) & F.col(required).isNotNull())


def read_profiler_csv(spark: SparkSession, path: str) -> DataFrame:
    """GPU profiler CSV with ' MiB' unit suffixes stripped and cast to numbers
    (header units dropped, dots in names become underscores: ``memory_used``)."""
    df = spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "true").csv(path)
    out = df
    for c in df.columns:
        clean = c.strip().replace(" [MiB]", "").replace(" [%]", "").replace(".", "_")
        out = out.withColumnRenamed(c, clean)
    for c in out.columns:
        if c != "timestamp":
            out = out.withColumn(c, F.regexp_replace(F.col(c), r"\s*(MiB|%)\s*$", "").try_cast("double"))
    return out


def write_text_only(df: DataFrame, path: str, text_col: str = "text", mode: str = "overwrite") -> None:
    """Keep only the rendered text column and save."""
    df.select(text_col).write.mode(mode).parquet(path)
