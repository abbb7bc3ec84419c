"""Sources/sinks round trips (S1, S2, S6-S12, S14) and streaming jobs equal to batch."""

import json
import os
import time

from pyspark.sql import functions as F

from threadmill.sources import io as IO
from threadmill.streaming import jobs as J


def test_jsonl_roundtrip_and_corrupt(spark, tmp_path):
    p = tmp_path / "in.jsonl"
    p.write_text('{"a": "é", "m": [{"role": "user"}]}\n{broken\n', encoding="utf-8")
    df = IO.read_jsonl(spark, str(p), "a string, m array<struct<role:string>>")
    rows = df.collect()
    assert rows[0].a == "é" and rows[1]["_corrupt_record"] == "{broken"
    out = tmp_path / "out"
    IO.write_jsonl(df.where(F.col("a").isNotNull()).drop("_corrupt_record"), str(out))
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in os.listdir(out) if f.endswith(".json"))
    assert "é" in text and '"role":"user"' in text


def test_layout_mirror_and_text_only(spark, tmp_path):
    a = spark.range(5).withColumn("text", F.concat(F.lit("t"), F.col("id").cast("string")))
    IO.write_layout({"train": a, "test": a.limit(1)}, {"train": a.limit(2)}, str(tmp_path / "lay"))
    rec = IO.mirror(spark, str(tmp_path / "lay"), str(tmp_path / "copy")).collect()
    assert {(r.config, r.split, r.n_src) for r in rec} == {("sft", "train", 5), ("sft", "test", 1), ("grpo", "train", 2)}
    assert all(r.match for r in rec)
    IO.write_text_only(a, str(tmp_path / "txt"))
    assert spark.read.parquet(str(tmp_path / "txt")).columns == ["text"]


def test_reconcile_reports_changed_rows_with_equal_counts(spark):
    schema = "k string, a string, b string, m array<struct<x:int>>"
    rows = [("p", "1", None, [(1,)]), ("p", None, "1", [(1,)]), ("q", "a", "b", None), ("q", "a", "b", None), (None, "z", "z", [])]
    src = spark.createDataFrame(rows, schema)
    ok = {r.k: r for r in IO.reconcile(src, src.repartition(5).select("m", "b", "a", "k"), ["k"]).collect()}
    assert set(ok) == {"p", "q", None} and all(r.match and r.same_content for r in ok.values())
    other = spark.createDataFrame([("p", "1", None, [(1,)]), ("p", "1", None, [(1,)]), ("q", "a", "b", None), ("new", "a", "b", None), (None, "z", "z", [])], schema)
    got = {r.k: (r.n_src, r.n_dst, r.same_content, r.match) for r in IO.reconcile(src, other, ["k"]).collect()}
    assert got == {"p": (2, 2, False, False), "q": (2, 1, False, False), "new": (None, 1, False, False), None: (1, 1, True, True)}


def test_snapshot_log_survives_repeats_and_breaks(spark, tmp_path):
    path = str(tmp_path / "log")
    day = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    IO.commit_snapshot(day(1, 2), path, "2024-01-01")
    IO.commit_snapshot(day(3), path, "2024-01-02", commit=False)       # broken off before the commit
    read = lambda: sorted((r.batch, r.v) for r in IO.read_snapshots(spark, path).collect())
    assert read() == [("2024-01-01", 1), ("2024-01-01", 2)]
    for _ in range(2):                                                  # run again, twice
        IO.commit_snapshot(day(3, 4), path, "2024-01-02")
    assert read() == [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-02", 4)]
    assert {(r.batch, r.n) for r in spark.read.parquet(f"{path}/commits").collect()} == {("b2024-01-01", 2), ("b2024-01-02", 2)}


def test_quarantine_accounts_for_every_line(spark, tmp_path):
    good = ['{"a": 1, "b": "x"}', '{"a": null}', '{"b": "é", "c": [1]}', "{}"]
    bad = {'{"a": 1': "not_json", "nope": "not_json", "[1]": "not_object", "3": "not_object", '"s"': "not_object", "null": "not_object", '{"a": "x"}': "wrong_type"}
    (tmp_path / "one.jsonl").write_text("\n".join([*good, "", "  \t "]) + "\n", encoding="utf-8")
    (tmp_path / "two.jsonl").write_text("\n".join([*bad, good[0]]), encoding="utf-8")
    rows, odd = IO.read_jsonl_quarantined(spark, str(tmp_path), "a int, b string")
    assert sorted(((r.a, r.b) for r in rows.collect()), key=str) == sorted([(1, "x"), (1, "x"), (None, None), (None, "é"), (None, None)], key=str)
    got = odd.collect()
    assert {r.line: r.reason for r in got} == bad and len(got) == len(bad)
    assert all(r.file.endswith("two.jsonl") and r.block_start == 0 for r in got)


def test_sources_union_and_json_column(spark):
    a = spark.createDataFrame([("q",)], "prompt string")
    b = spark.createDataFrame([([("user", "hi", None)],)], "messages array<struct<role:string,content:string,thinking:string>>")
    u = IO.load_sources(spark, [(a, "s1", "m1"), (b, "s2", "m2")]).collect()
    assert [(r.source, r.source_rank) for r in u] == [("s1", 0), ("s2", 1)]
    j = IO.from_json_messages(IO.to_json_messages(b)).collect()[0]
    assert j.messages[0].content == "hi"


def test_results_snapshot_csv(spark, tmp_path):
    d = tmp_path / "res"
    d.mkdir()
    (d / "m1.json").write_text(json.dumps({"model": "a", "top1_trained": 0.5}))
    (d / "SMOKE_x.json").write_text(json.dumps({"model": "s", "top1_trained": 0.1}))
    (d / "m2.json").write_text(json.dumps({"model": "b"}))
    r = IO.read_results(spark, str(d)).collect()
    assert [x.model for x in r] == ["a"]
    snap = spark.createDataFrame([("2024-01-02 10:00:00", "model", 3)], "timestamp string, type string, downloads long")
    IO.append_snapshot(snap.withColumn("timestamp", F.to_timestamp("timestamp")), str(tmp_path / "snap"))
    IO.append_snapshot(snap.withColumn("timestamp", F.to_timestamp("timestamp")), str(tmp_path / "snap"))
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 2
    (tmp_path / "gpu.csv").write_text("timestamp, memory.used [MiB], memory.total [MiB]\n1, 100 MiB, 200 MiB\n2, 150 MiB, 200 MiB\n")
    g = IO.read_profiler_csv(spark, str(tmp_path / "gpu.csv"))
    assert g.agg(F.max("memory_used")).collect()[0][0] == 150.0


def _write_logs(dirpath, rows):
    with open(os.path.join(dirpath, f"part-{time.time_ns()}.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_step_log_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "logs"
    src.mkdir()
    rows = [{"ts": f"2024-01-01T0{h}:{m:02d}:00", "run": "r1", "step": h * 60 + m, "reward": float(m % 3), "loss": 1.0}
            for h in range(4) for m in range(0, 60, 15)]
    _write_logs(str(src), rows)
    q = (J.step_log_means(spark, str(src), "1 hour", "0 seconds").writeStream.outputMode("complete")
         .format("memory").queryName("steplog").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.w.start.hour, round(r.mean_reward, 6)) for r in spark.sql("select * from steplog").collect()}
    batch = spark.read.schema(J.STEP_LOG_SCHEMA).json(str(src))
    want = {(r.h, round(r.m, 6)) for r in batch.groupBy(F.hour("ts").alias("h")).agg(F.avg("reward").alias("m")).collect()}
    assert got == want


def test_incremental_clean_dedup_snapshot(spark, tmp_path):
    src = tmp_path / "ev"
    src.mkdir()
    df = spark.createDataFrame([(i, f"2024-01-0{1 + i % 3} 00:00:0{i % 5}", f"text /home/u{i % 4}/x", float(i))
                                for i in range(30)], "id long, ts string, text string, value double") \
        .withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(src / "p"))
    stream = spark.readStream.schema(df.schema).parquet(str(src / "p"))
    clean = J.incremental_clean(stream)
    q = (clean.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "c1"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from cleaned where clean like '%/home/user/%'").collect()[0][0] == 30
    dd = J.incremental_dedup(stream.withColumn("sig", F.md5("text")), ["sig"], "ts", "10 days")
    q = (dd.writeStream.format("memory").queryName("dedupd").option("checkpointLocation", str(tmp_path / "c2"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from dedupd").collect()[0][0] == 4
    out = str(tmp_path / "snap")
    q = (J.daily_totals(stream).writeStream.outputMode("complete").foreachBatch(J.snapshot_writer(out))
         .option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start())
    q.awaitTermination()
    snap = spark.read.parquet(out)
    assert snap.agg(F.sum("n")).collect()[0][0] == 30


def test_stream_reads_folder_tables(spark, tmp_path):
    """A table that is a folder of part files gives the same stream result as one file."""
    from threadmill.plans.q_streams import stream_daily_snapshots
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    a, b = (sorted(map(tuple, stream_daily_snapshots(spark, d).collect())) for d in (str(tmp_path), "/root/testdata/sf0.001"))
    assert a == b and a
