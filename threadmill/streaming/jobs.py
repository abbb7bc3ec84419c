"""Structured Streaming jobs.

The reference only iterates lazily; these are the incremental forms of its batch
jobs. Every job uses a checkpoint location in the shared folder so a restarted or
re-scheduled query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.functions.scrub import scrub_columns

STEP_LOG_SCHEMA = "ts timestamp, run string, step long, reward double, loss double"


def step_log_means(spark: SparkSession, log_dir: str, window: str = "1 hour",
                   watermark: str = "2 hours") -> DataFrame:
    """Append-only JSONL step logs -> per run, per event-time window mean reward/loss.
    Late rows older than the watermark are dropped; a window is emitted once closed."""
    return step_windows(spark.readStream.schema(STEP_LOG_SCHEMA).json(log_dir), window, watermark)


def step_windows(logs: DataFrame, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """X1 over any stream of step logs: means per run and event-time window."""
    return (logs.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"), "run")
            .agg(F.avg("reward").alias("mean_reward"), F.avg("loss").alias("mean_loss"),
                 F.count(F.lit(1)).alias("n")))


def incremental_clean(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """Stateless clean columns on each micro-batch: scrub and the row-level drop reason."""
    c = scrub_columns(stream, {"clean": text_col})
    return c.withColumn("drop_reason", F.when(F.col("clean") == "", F.lit("empty")))


def incremental_dedup(stream: DataFrame, key_cols: list[str], ts_col: str, watermark: str) -> DataFrame:
    """The reference's ``seen`` set as bounded streaming state: a key is dropped when
    seen again within the watermark delay (state older than that is evicted)."""
    return stream.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(key_cols)


def snapshot_writer(path: str):
    """``foreachBatch`` sink appending daily totals; a replayed batch id overwrites its
    own partition instead of appending twice (idempotent on ``batchId``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))

    return write


def daily_totals(stream: DataFrame, ts_col: str = "ts", value_col: str = "value", watermark: str = "2 days") -> DataFrame:
    """X4 input: running totals per day; a day's state goes once the watermark has passed it."""
    days = stream.withWatermark(ts_col, watermark).groupBy(F.window(ts_col, "1 day").alias("w"))
    return days.agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("total")).select(F.to_date("w.start").alias("day"), "n", "total")


def first_seen_writer(key_col: str, order_cols: list[str], out_path: str):
    """X3 without a watermark: a row passes when its key was in no earlier batch, whatever the delay.

    The output itself is the seen set: the first row of each key (smallest ``order_cols`` of its
    batch, nulls last) is written to the batch's own partition. A batch compares its keys with the
    partitions of earlier batches only and overwrites its own, so a replayed batch gives the same
    rows. Only the keys of the output that also occur in the batch are joined.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        order = F.struct(*[x for c in order_cols for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])
        first = batch.groupBy(F.col(key_col).alias("_k")).agg(F.min(F.struct(order.alias("o"), F.struct(*batch.columns).alias("row"))).alias("_w"))
        first = first.select("_k", "_w.row.*")
        if batch_id > 0 and _exists(spark, out_path):
            seen = spark.read.parquet(out_path).where(F.col("batch_id") < batch_id).select(F.col(key_col).alias("_s"))
            again = seen.join(first.select("_k"), F.col("_s").eqNullSafe(F.col("_k")), "left_semi").distinct()
            first = first.join(again, F.col("_k").eqNullSafe(F.col("_s")), "left_anti")
        first.drop("_k").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return write


def incremental_first_seen(stream: DataFrame, key_col: str, order_cols: list[str], out_path: str, checkpoint: str):
    """Run ``first_seen_writer`` over what has arrived since the last run."""
    return (stream.writeStream.foreachBatch(first_seen_writer(key_col, order_cols, out_path))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
