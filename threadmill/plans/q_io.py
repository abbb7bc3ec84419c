"""Registered queries over written data: quarantine of malformed lines (S2, S11), mirror (S9), snapshot log (S10),
JSON lines (S6), config layout (S7), profiler CSV (S12), text-only sink (S14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadmill.functions.messages import render_chat
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import normalized_conversations
from threadmill.plans.q_messages import NORM
from threadmill.session import checkpoint_dir
from threadmill.sources import io as IO
from threadmill.sources.tables import table


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex}"


@register("jsonl_quarantine", "SELECT CASE doc_id % 10 WHEN 3 THEN 'not_json' WHEN 5 THEN 'not_object' WHEN 7 THEN 'wrong_type' ELSE 'ok' END AS reason, "
          "count(*) AS n, sum(CASE WHEN doc_id % 10 IN (3, 5, 7) THEN 0 ELSE length(text) END)::BIGINT AS n_chars, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY 1")
def jsonl_quarantine(spark, sf_dir):
    """S2 + S11: documents written as JSON lines, some of them cut, wrapped in a list or with a text
    where a number belongs, read back as good rows and a quarantine."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id") % 10
    odd = F.to_json(F.struct(F.concat(F.lit("id "), F.col("doc_id").cast("string")).alias("doc_id"), "text"))
    value = (F.when(k == 3, F.expr("substring(line, 1, length(line) - 1)")).when(k == 5, F.concat(F.lit("["), F.col("line"), F.lit("]")))
             .when(k == 7, F.col("odd")).otherwise(F.col("line")))
    path = _folder(spark, "lines")
    d.withColumn("line", F.to_json(F.struct("doc_id", "text"))).withColumn("odd", odd).select(value.alias("value")).write.text(path)
    good, bad = IO.read_jsonl_quarantined(spark, path, "doc_id long, text string")
    ids = F.regexp_extract("line", r'"doc_id":"?(?:id )?(\d+)', 1).cast("long")
    rows = good.select(F.lit("ok").alias("reason"), F.length("text").alias("c"), F.col("doc_id").alias("i")).unionByName(
        bad.select("reason", F.lit(0).alias("c"), ids.alias("i")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("c").cast("long").alias("n_chars"), F.sum("i").alias("ids"))


_CONFIG = "CASE WHEN event_id % 3 = 0 THEN 'grpo' ELSE 'sft' END"


@register("mirror_reconcile", "WITH e AS (SELECT " + _CONFIG + " AS config, event_type AS split, event_id FROM events) SELECT config, split, count(*) AS n_src, "
          "count(*) AS n_dst, count(*) FILTER (WHERE event_id % 997 = 5) = 0 AS same_content, count(*) FILTER (WHERE event_id % 997 = 5) = 0 AS match "
          "FROM e GROUP BY ALL")
def mirror_reconcile(spark, sf_dir):
    """A layout against a copy in which some values changed while all counts stayed."""
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 3 == 0, "grpo").otherwise("sft").alias("config"), F.col("event_type").alias("split"),
                                              "event_id", "user_id", "value", "props")
    src, dst = _folder(spark, "layout"), _folder(spark, "copy")
    e.write.partitionBy("config", "split").parquet(src)
    changed = F.when(F.col("event_id") % 997 == 5, F.col("user_id") + 1).otherwise(F.col("user_id"))
    spark.read.parquet(src).withColumn("user_id", changed).write.partitionBy("config", "split").parquet(dst)
    return IO.reconcile(spark.read.parquet(src), spark.read.parquet(dst), ["config", "split"])


@register("snapshot_log", "SELECT CASE WHEN event_id % 2 = 0 THEN '0' ELSE '1' END AS batch, event_type, count(*) AS n, sum(user_id)::BIGINT AS users "
          "FROM events WHERE event_id % 4 <> 3 GROUP BY ALL")
def snapshot_log(spark, sf_dir):
    """Batches of a log of which one ran twice and one broke off before its commit."""
    path = _folder(spark, "snapshots")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    IO.commit_snapshot(e.where("event_id % 4 = 1"), path, "1")
    for _ in range(2):
        IO.commit_snapshot(e.where("event_id % 2 = 0"), path, "0")
    IO.commit_snapshot(e.where("event_id % 4 = 3"), path, "2", commit=False)
    r = IO.read_snapshots(spark, path)
    return r.groupBy("batch", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


@register("jsonl_roundtrip", "SELECT conv_id, count(*) AS n_msgs, md5(string_agg(role || ':' || coalesce(text, ''), chr(10) ORDER BY turn)) AS body_md5, "
          "count(*) FILTER (WHERE turn % 2 = 0) AS n_thinking FROM conversations GROUP BY conv_id")
def jsonl_roundtrip(spark, sf_dir):
    """Conversations written as JSON lines with nested messages (nulls and non-ASCII text kept) and read back."""
    c = table(spark, sf_dir, "conversations")
    thinking = F.when(F.col("turn") % 2 == 0, F.lit("é")).alias("thinking")
    m = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"), thinking))).alias("messages"))
    path = _folder(spark, "jsonl")
    IO.write_jsonl(m, path)
    r = IO.read_jsonl(spark, path, "conv_id long, messages array<struct<turn:long,role:string,content:string,thinking:string>>")
    body = F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit(":"), F.coalesce(x["content"], F.lit("")))), "\n")
    kept = F.size(F.filter("messages", lambda x: x["thinking"] == "é"))
    return r.where(F.col(IO.CORRUPT).isNull()).select("conv_id", F.size("messages").cast("long").alias("n_msgs"), F.md5(body).alias("body_md5"),
                                                      kept.cast("long").alias("n_thinking"))


@register("config_layout", "WITH d AS (SELECT *, CASE WHEN doc_id % 20 = 0 THEN 'test' ELSE 'train' END AS split FROM documents), "
          "l AS (SELECT 'sft' AS config, split, doc_id, text FROM d UNION ALL SELECT 'grpo', split, doc_id, text FROM d WHERE lang = 'en') "
          "SELECT config, split, count(*) AS n, sum(doc_id)::BIGINT AS ids, sum(length(text))::BIGINT AS n_chars FROM l GROUP BY ALL")
def config_layout(spark, sf_dir):
    """The {sft,grpo}/{train,test} layout written from documents and read back by partition."""
    d = table(spark, sf_dir, "documents")
    test = F.col("doc_id") % 20 == 0
    sft, grpo = d.select("doc_id", F.col("text").alias("response")), d.where("lang = 'en'").select("doc_id", F.col("text").alias("prompt"))
    path = _folder(spark, "configs")
    IO.write_layout({"train": sft.where(~test), "test": sft.where(test)}, {"train": grpo.where(~test), "test": grpo.where(test)}, path)
    return spark.read.parquet(path).groupBy("config", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"), F.sum(F.length(F.coalesce("response", "prompt"))).cast("long").alias("n_chars"))


@register("profiler_csv", "WITH e AS (SELECT user_id % 8 AS device, event_id % 81920 AS mem, CASE WHEN event_id % 50 <> 7 THEN event_id % 101 END AS util FROM events) "
          "SELECT device::DOUBLE AS device, count(*) AS n, max(mem)::DOUBLE AS peak_mib, count(util) AS n_util, round(avg(util), 6) AS mean_util FROM e GROUP BY 1")
def profiler_csv(spark, sf_dir):
    """A profiler's CSV (values with units, some not available) written from events and read back as numbers."""
    e, path = table(spark, sf_dir, "events"), _folder(spark, "csv")
    util = F.when(F.col("event_id") % 50 == 7, "[N/A]").otherwise(F.concat((F.col("event_id") % 101).cast("string"), F.lit(" %")))
    e.select(F.col("ts").cast("string").alias("timestamp"), (F.col("user_id") % 8).alias("index"),
             F.concat((F.col("event_id") % 81920).cast("string"), F.lit(" MiB")).alias("memory.used [MiB]"),
             util.alias("utilization.gpu [%]")).write.option("header", "true").csv(path)
    r = IO.read_profiler_csv(spark, path)
    return r.groupBy(F.col("index").alias("device")).agg(
        F.count(F.lit(1)).alias("n"), F.max("memory_used").alias("peak_mib"), F.count("utilization_gpu").alias("n_util"),
        F.round(F.avg("utilization_gpu"), 6).alias("mean_util"))


@register("text_only_sink", NORM + " SELECT md5(r) AS text_md5, length(r)::BIGINT AS text_len FROM (SELECT " + S.render_chat("m") + " AS r FROM norm WHERE ok)")
def text_only_sink(spark, sf_dir):
    """Rendered conversations saved with their text column alone, and read back."""
    n, path = normalized_conversations(spark, sf_dir).where("ok"), _folder(spark, "text")
    IO.write_text_only(n.select("conv_id", "messages", render_chat("messages").alias("text")), path)
    r = spark.read.parquet(path)
    return r.select(*[F.md5(c).alias(f"{c}_md5") for c in r.columns], *[F.length(c).cast("long").alias(f"{c}_len") for c in r.columns])
