"""Registered queries that run the streaming jobs (X1-X4) to completion over the driver
tables (``availableNow``) and return their sink contents as batch DataFrames.

Sinks are parquet folders and stream checkpoints live under the shared checkpoint
folder; nothing is collected into driver memory. X1 appends closed windows, X4 updates
its running totals through ``foreachBatch``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.session import checkpoint_dir
from threadmill.streaming import jobs as J


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/checkpoint"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream source: a folder of part files itself, or the folder of a single
    file, filtered to that file."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@register("stream_step_log_means", "SELECT user_id AS run, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, "
          "round(avg(value), 6) AS mean_reward, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 2 DAY "
          "<= (SELECT max(ts) FROM events) GROUP BY ALL")
def stream_step_log_means(spark, sf_dir):
    """Event-time daily mean reward per run; a day is emitted once the watermark (one day
    behind the newest row) has passed its end, and its state goes."""
    out, ck = _paths(spark, "x1")
    src = _stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"),
                                                   F.col("user_id").cast("string").alias("run"),
                                                   F.col("event_id").alias("step"), F.col("value").alias("reward"),
                                                   F.lit(None).cast("double").alias("loss"))
    q = (J.step_windows(src, "1 day", "1 day").writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    r = spark.read.parquet(out)
    return r.select(F.col("run").cast("long").alias("run"), F.date_format("w.start", "yyyy-MM-dd").alias("day"),
                    F.round("mean_reward", 6).alias("mean_reward"), "n")


@register("stream_incremental_clean", "SELECT doc_id, " + S.scrub("text") + " AS clean, CASE WHEN " + S.scrub("text")
          + " = '' THEN 'empty' END AS drop_reason FROM documents")
def stream_incremental_clean(spark, sf_dir):
    """New files scrubbed and reason-tagged row by row, appended to a parquet sink."""
    out, ck = _paths(spark, "x2")
    c = J.incremental_clean(_stream(spark, sf_dir, "documents")).select("doc_id", "clean", "drop_reason")
    q = (c.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_incremental_dedup", "SELECT DISTINCT event_type, user_id FROM events")
def stream_incremental_dedup(spark, sf_dir):
    """Repeated (event_type, user_id) keys dropped within the watermark delay."""
    out, ck = _paths(spark, "x3")
    src = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    d = J.incremental_dedup(src, ["event_type", "user_id"], "ts", "31 days").select("event_type", "user_id")
    q = (d.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_daily_snapshots", "SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 6) AS total "
          "FROM events GROUP BY 1")
def stream_daily_snapshots(spark, sf_dir):
    """Per-batch daily totals appended idempotently (one partition per batch id)."""
    out, ck = _paths(spark, "x4")
    totals = J.daily_totals(_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    q = (totals.writeStream.outputMode("update").foreachBatch(J.snapshot_writer(out))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    # update mode: a day's row in a later batch carries its running total, so the
    # latest batch per day is the day's value
    snap = spark.read.parquet(out)
    return snap.groupBy("day").agg(F.max_by("n", "batch_id").alias("n"),
                                   F.round(F.max_by("total", "batch_id"), 6).alias("total"))


@register("stream_first_seen", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def stream_first_seen(spark, sf_dir):
    """X3 without a watermark: first event of each user and type, against all earlier batches."""
    out, ck = _paths(spark, "first_seen")
    e = _stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    e = e.withColumn("key", F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    J.incremental_first_seen(e, "key", ["event_id"], out, ck).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_type", "event_id")
