"""Registered queries: evaluation, rollouts, games and run logs
(J4, J6, A10-A14, A17, A18, A21, W4-W7, W9, P30, R4, T8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadmill.functions.answers import answer_integer
from threadmill.operators import history as H
from threadmill.plans.catalog import register
from threadmill.sources.tables import table

# token predictions from lineitem: gold = partkey % 10; trained top-5 starts at suppkey % 10,
# base top-5 at (suppkey + linenumber) % 10, five consecutive digits each.
_TOP = "[{s} % 10, ({s} + 1) % 10, ({s} + 2) % 10, ({s} + 3) % 10, ({s} + 4) % 10]"
_PRED_SQL = ("pred AS (SELECT l_orderkey AS example_id, l_linenumber AS pos, l_partkey % 10 AS gold, "
             + _TOP.format(s="l_suppkey") + " AS top_t, " + _TOP.format(s="(l_suppkey + l_linenumber)")
             + " AS top_b FROM lineitem)")


def _pred(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")

    def top(s):
        return F.array(*[(s + i) % 10 for i in range(5)])

    return li.select(F.col("l_orderkey").alias("example_id"), F.col("l_linenumber").alias("pos"),
                     (F.col("l_partkey") % 10).alias("gold"), top(F.col("l_suppkey")).alias("top_t"),
                     top(F.col("l_suppkey") + F.col("l_linenumber")).alias("top_b"))


@register("token_accuracy", "WITH " + _PRED_SQL + " SELECT round(count(*) FILTER (WHERE gold = top_t[1]) / count(*), 6) "
          "AS top1_trained, round(count(*) FILTER (WHERE list_contains(top_t, gold)) / count(*), 6) AS top5_trained, "
          "round(count(*) FILTER (WHERE gold = top_b[1]) / count(*), 6) AS top1_base, round(count(*) FILTER (WHERE "
          "list_contains(top_b, gold)) / count(*), 6) AS top5_base FROM pred")
def token_accuracy(spark, sf_dir):
    """Micro-averaged top-1/top-5 token accuracy for trained and base predictions."""
    p = _pred(spark, sf_dir)
    t1, t5 = H.token_accuracy(p, "gold", "top_t")
    b1, b5 = H.token_accuracy(p, "gold", "top_b")
    return p.agg(t1.alias("top1_trained"), t5.alias("top5_trained"), b1.alias("top1_base"), b5.alias("top5_base"))


@register("trained_vs_base", "WITH " + _PRED_SQL + ", t AS (SELECT example_id, avg(CASE WHEN gold = top_t[1] THEN 1.0 "
          "ELSE 0.0 END) AS acc FROM pred GROUP BY example_id), b AS (SELECT example_id, avg(CASE WHEN gold = top_b[1] "
          "THEN 1.0 ELSE 0.0 END) AS acc FROM pred GROUP BY example_id) SELECT t.example_id, round(t.acc, 6)::DOUBLE AS "
          "acc_trained, round(b.acc, 6)::DOUBLE AS acc_base, round(t.acc - b.acc, 6)::DOUBLE AS delta FROM t JOIN b "
          "ON t.example_id = b.example_id")
def trained_vs_base(spark, sf_dir):
    """Per-example accuracy of both models with deltas. Both predictions are columns of one
    table here, so one aggregation pairs them."""
    p = _pred(spark, sf_dir)
    hit = lambda top: F.avg(F.when(F.col("gold") == F.col(top)[0], 1.0).otherwise(0.0))
    j = p.groupBy("example_id").agg(hit("top_t").alias("a"), hit("top_b").alias("b"))
    return j.select("example_id", F.round("a", 6).alias("acc_trained"), F.round("b", 6).alias("acc_base"),
                    F.round(F.col("a") - F.col("b"), 6).alias("delta"))


# eval results from supplier: SMOKE_ names every 13th, missing trained score every 17th
_RES_SQL = ("res AS (SELECT CASE WHEN s_suppkey % 13 = 0 THEN 'SMOKE_' || s_name ELSE s_name END AS model, "
            "(s_acctbal + 1000.0) / 11000.0 AS top1_base, CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE "
            "(s_acctbal + 1000.0) / 11000.0 + ((s_suppkey % 7) - 3) / 100.0 END AS top1_trained FROM supplier), "
            "ok AS (SELECT model, top1_base, top1_trained, top1_trained - top1_base AS delta FROM res WHERE "
            "NOT starts_with(model, 'SMOKE_') AND top1_trained IS NOT NULL)")


def _results(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    base = (F.col("s_acctbal") + 1000.0) / 11000.0
    r = s.select(F.when(F.col("s_suppkey") % 13 == 0, F.concat(F.lit("SMOKE_"), "s_name")).otherwise(F.col("s_name"))
                 .alias("model"), base.alias("top1_base"),
                 F.when(F.col("s_suppkey") % 17 != 0, base + ((F.col("s_suppkey") % 7) - 3) / 100.0)
                 .alias("top1_trained"))
    r = r.where(~F.col("model").startswith("SMOKE_") & F.col("top1_trained").isNotNull())
    return r.withColumn("delta", F.col("top1_trained") - F.col("top1_base"))


@register("eval_ranked", "WITH " + _RES_SQL + " SELECT model, round(delta, 6) AS delta, rank() OVER (ORDER BY "
          "round(delta, 12) DESC) AS rank FROM ok")
def eval_ranked(spark, sf_dir):
    """S11 filters + W4: result rows (SMOKE_ runs and rows without a trained score skipped), ranked by delta."""
    r = H.ranked(_results(spark, sf_dir).withColumn("delta", F.round("delta", 12)), "delta")
    return r.select("model", F.round("delta", 6).alias("delta"), F.col("rank").cast("long").alias("rank"))


@register("eval_summary", "WITH " + _RES_SQL + " SELECT count(*) FILTER (WHERE delta > 0) AS improved, "
          "round(avg(delta), 6) AS mean_delta, round(max(delta), 6) AS best_delta, arg_max(model, top1_trained) AS "
          "top_model FROM ok")
def eval_summary(spark, sf_dir):
    """Improved count, mean and best delta, model with the highest trained score."""
    return H.eval_summary(_results(spark, sf_dir), "model", "delta", "top1_trained")


@register("downloads_rollup", "SELECT CASE WHEN grouping(t) = 1 THEN 'TOTAL' ELSE t END AS type, sum(c_custkey)::BIGINT "
          "AS downloads, sum(c_custkey % 100)::BIGINT AS likes FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'model' "
          "ELSE 'dataset' END AS t, c_custkey FROM customer) GROUP BY ROLLUP (t)")
def downloads_rollup(spark, sf_dir):
    """Downloads and likes per repo type and the grand total (rollup + grouping)."""
    c = table(spark, sf_dir, "customer")
    d = c.select(F.when(F.col("c_custkey") % 2 == 0, "model").otherwise("dataset").alias("type"),
                 F.col("c_custkey").alias("downloads"), (F.col("c_custkey") % 100).alias("likes"))
    return H.totals_with_rollup(d, "type", "downloads", "likes")


@register("outcome_backfill", "WITH reg AS (SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN l.quality END AS outcome "
          "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), f AS (SELECT r.doc_id, r.outcome IS NULL AND "
          "l.quality IS NOT NULL AS filled, coalesce(r.outcome, l.quality) AS outcome FROM reg r LEFT JOIN labels l ON "
          "r.doc_id = l.doc_id) SELECT count(*) FILTER (WHERE filled) AS n_filled, count(*) FILTER (WHERE outcome IS "
          "NULL) AS n_unknown, count(*) AS n FROM f")
def outcome_backfill(spark, sf_dir):
    """Fill null outcomes from keyed facts; count rows whose key has no fact."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels")
    reg = d.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("quality")).alias("outcome"))
    f = H.backfill(reg, labels, "doc_id", "outcome", "quality")
    return f.agg(F.count_if("filled").alias("n_filled"), F.count_if(F.col("outcome").isNull()).alias("n_unknown"),
                 F.count(F.lit(1)).alias("n"))


# rollouts from orders: reward 1.0 when status 'F'; a tool turn and an assistant tool call
_ROLL_SQL = ("roll AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS reward, "
             "'{\"answer\": ' || CAST(o_orderkey AS VARCHAR) || '}' AS args FROM orders)")


def _rollouts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("reward"),
                    F.concat(F.lit('{"answer": '), F.col("o_orderkey").cast("string"), F.lit("}")).alias("args"))


@register("rollout_stats", "WITH " + _ROLL_SQL + " SELECT count(*) FILTER (WHERE reward = 1.0) AS collected, "
          "count(*) FILTER (WHERE reward <> 1.0) AS dropped, round(avg(reward), 6)::DOUBLE AS avg_reward, "
          "round(count(*) FILTER (WHERE reward > 0) / count(*), 6) AS success_rate FROM roll")
def rollout_stats(spark, sf_dir):
    """A10: collected / dropped episodes, mean reward, success rate."""
    r = _rollouts(spark, sf_dir)
    return r.agg(F.count_if(F.col("reward") == 1.0).alias("collected"),
                 F.count_if(F.col("reward") != 1.0).alias("dropped"),
                 F.round(F.avg("reward"), 6).alias("avg_reward"),
                 F.round(F.count_if(F.col("reward") > 0) / F.count(F.lit(1)), 6).alias("success_rate"))


@register("rollout_sft_rows", "WITH " + _ROLL_SQL + " SELECT o_orderkey, 4::BIGINT AS n_msgs, '<tool_call>' || chr(10) "
          "|| '{\"name\": \"answer\", \"arguments\": {\"answer\": ' || CAST(json_extract(args, '$.answer') AS VARCHAR) || "
          "'}}' || chr(10) || '</tool_call>' AS assistant, 'done' AS final FROM roll WHERE reward = 1.0")
def rollout_sft_rows(spark, sf_dir):
    """Keep reward = 1.0 episodes; tool turns dropped, the first tool call of an
    assistant turn becomes ``<tool_call>`` JSON text."""
    from threadmill.functions.messages import rollout_to_sft
    r = _rollouts(spark, sf_dir).where(F.col("reward") == 1.0)
    tc = F.array(F.struct(F.struct(F.lit("answer").alias("name"), F.col("args").alias("arguments")).alias("function")))
    none = F.lit(None).cast("array<struct<function:struct<name:string,arguments:string>>>")

    def turn(role, content, calls=none):
        return F.struct(F.lit(role).alias("role"), content.alias("content"), calls.alias("tool_calls"))

    msgs = F.array(turn("system", F.lit("You are a solver.")),
                   turn("user", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))),
                   turn("assistant", F.lit(""), tc), turn("tool", F.lit("ok")), turn("assistant", F.lit("done")))
    sft = r.select("o_orderkey", rollout_to_sft(msgs).alias("m"))
    return sft.select("o_orderkey", F.size("m").cast("long").alias("n_msgs"),
                      F.col("m")[2]["content"].alias("assistant"), F.col("m")[3]["content"].alias("final"))


# games from conversations: cumulative feedback per turn, invalid moves every 4th turn
_GAME_SQL = ("g AS (SELECT conv_id AS game, turn, CASE WHEN turn % 4 = 3 THEN text || ' You attempted an invalid move.' "
             "ELSE text END AS t, CASE WHEN conv_id % 3 = 0 THEN 1.0 ELSE 0.0 END AS reward, turn = max(turn) OVER "
             "(PARTITION BY conv_id) AS done FROM conversations), "
             "f AS (SELECT *, string_agg(t, '' ORDER BY turn) OVER (PARTITION BY game ORDER BY turn ROWS BETWEEN "
             "UNBOUNDED PRECEDING AND CURRENT ROW) AS full_feedback FROM g), "
             "fb AS (SELECT *, substring(full_feedback, coalesce(length(lag(full_feedback) OVER (PARTITION BY game "
             "ORDER BY turn)), 0) + 1) AS feedback FROM f)")


def _games(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    t = F.when(F.col("turn") % 4 == 3, F.concat("text", F.lit(" You attempted an invalid move."))).otherwise(F.col("text"))
    g = c.select(F.col("conv_id").alias("game"), "turn", t.alias("t"),
                 F.when(F.col("conv_id") % 3 == 0, 1.0).otherwise(0.0).alias("reward"),
                 (F.col("turn") == F.max("turn").over(Window.partitionBy("conv_id"))).alias("done"))
    w = Window.partitionBy("game").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("full_feedback", F.array_join(F.collect_list("t").over(w), ""))
    return H.appended_feedback(g, "game", "turn", "full_feedback", "reward")


@register("game_feedback", "WITH " + _GAME_SQL + " SELECT game, turn, md5(feedback) AS feedback_md5, length(feedback)::BIGINT "
          "AS feedback_len, CASE WHEN contains(feedback, 'You attempted an invalid move') THEN 0.0 ELSE reward END::DOUBLE "
          "AS turn_reward FROM fb")
def game_feedback(spark, sf_dir):
    """W6 + R4: newly appended feedback per turn; invalid moves score 0."""
    g = _games(spark, sf_dir)
    return g.select("game", "turn", F.md5("feedback").alias("feedback_md5"),
                    F.length("feedback").cast("long").alias("feedback_len"), "turn_reward")


@register("game_stats", "WITH " + _GAME_SQL + ", last AS (SELECT game, done, CASE WHEN contains(feedback, 'You attempted "
          "an invalid move') THEN 0.0 ELSE reward END AS r FROM fb WHERE done) SELECT count(*) AS games, count(*) "
          "FILTER (WHERE done AND r > 0) AS wins, round(count(*) FILTER (WHERE done AND r > 0) / count(*), 6) AS "
          "win_rate, round(avg(r), 6)::DOUBLE AS mean_reward FROM last")
def game_stats(spark, sf_dir):
    """win = done with a positive reward; win rate and mean final reward."""
    g = _games(spark, sf_dir).where("done")
    won = H.win("done", "turn_reward")
    return g.agg(F.count(F.lit(1)).alias("games"), F.count_if(won).alias("wins"),
                 F.round(F.count_if(won) / F.count(F.lit(1)), 6).alias("win_rate"),
                 F.round(F.avg("turn_reward"), 6).alias("mean_reward"))


# step logs from events: run = user_id, step = order by (ts, event_id), reward = value
_LOG_SQL = "logs AS (SELECT user_id AS run, event_id AS step, value AS reward FROM events)"


def _logs(spark, sf_dir):
    """step logs from events: run = user_id, step = event_id (increasing in time), reward = value."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("reward"))


@register("reward_delta", "WITH " + _LOG_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step) AS a, "
          "row_number() OVER (PARTITION BY run ORDER BY step DESC) AS d FROM logs WHERE reward IS NOT NULL), "
          "g AS (SELECT run, count(*) AS n_logs, avg(reward) FILTER (WHERE a <= 5) AS i, avg(reward) FILTER "
          "(WHERE d <= 5) AS f FROM r GROUP BY run) SELECT run, n_logs, CASE WHEN n_logs >= 5 THEN round(i, 6) END AS "
          "initial, CASE WHEN n_logs >= 5 THEN round(f, 6) END AS final, CASE WHEN n_logs >= 5 THEN round(f - i, 6) END "
          "AS delta FROM g")
def reward_delta(spark, sf_dir):
    """Mean of the last five minus the first five logged rewards per run."""
    r = H.reward_delta(_logs(spark, sf_dir), "run", "step", "reward")
    return r.select("run", "n_logs", *[F.round(c, 6).alias(c) for c in ("initial", "final", "delta")])


@register("log_history_explode", "WITH " + _LOG_SQL + " SELECT run, step, round(reward, 6) AS reward, CASE WHEN step % 4 <> 0 THEN round(reward / 8, 6) END AS loss, "
          "CASE WHEN step % 3 = 0 THEN (step % 64) / 64.0::DOUBLE END AS clipped_ratio FROM logs")
def log_history_explode(spark, sf_dir):
    """``log_history`` JSON arrays exploded back to (step, loss, reward, clipped ratio) rows; some entries lack
    a loss or a ratio. The arrays are built per run and block of 1000 steps, so no document holds a whole hot run."""
    step = F.col("step")
    entry = F.struct("step", F.when(step % 4 != 0, F.col("reward") / 8).alias("loss"), "reward",
                     F.when(step % 3 == 0, (step % 64) / 64).alias("completions/clipped_ratio"), F.lit(0.5).alias("grad_norm"))
    hist = _logs(spark, sf_dir).groupBy("run", F.floor(step / 1000).alias("_blk")).agg(F.to_json(F.collect_list(entry)).alias("log_history"))
    ex = H.explode_log_history(hist, "log_history", "run")
    return ex.select("run", "step", F.round("reward", 6).alias("reward"), F.round("loss", 6).alias("loss"), "clipped_ratio")


@register("daily_trend", "SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events "
          "GROUP BY 1 ORDER BY day DESC LIMIT 30")
def daily_trend(spark, sf_dir):
    """Last 30 daily snapshots (a top-k report)."""
    e = table(spark, sf_dir, "events")
    d = e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return d.orderBy(F.desc("day")).limit(30)


@register("node_outcomes", "SELECT 'node' || CAST(user_id % 4 AS VARCHAR) AS node, event_type AS state, count(*) AS n, "
          "round(max(value), 6) AS peak FROM events GROUP BY 1, 2")
def node_outcomes(spark, sf_dir):
    """A21 + A18: outcomes per node and state with the peak value (memory stand-in)."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.concat(F.lit("node"), (F.col("user_id") % 4).cast("string")).alias("node"),
                      F.col("event_type").alias("state"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 6).alias("peak")))


@register("answer_integer", "SELECT event_id, regexp_extract(t, '\"answer\"[\\t-\\r ]*:[\\t-\\r ]*\"?(-?[0-9]+)\"?', 1) <> '' "
          "AS format_hit, CASE WHEN regexp_extract(t, '\"answer\"[\\t-\\r ]*:[\\t-\\r ]*\"?(-?[0-9]+)\"?', 1) <> '' THEN "
          "regexp_extract(t, '\"answer\"[\\t-\\r ]*:[\\t-\\r ]*\"?(-?[0-9]+)\"?', 1) ELSE coalesce(regexp_extract_all(t, "
          "'(-?[0-9]+)', 1)[-1], '0') END AS answer FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN "
          "'{\"answer\": ' || CAST(user_id AS VARCHAR) || '}' WHEN 1 THEN 'result ' || props ELSE event_type END AS t "
          "FROM events)")
def answer_integer_q(spark, sf_dir):
    """T8 + A11 input: answer integer and format hit from generated text."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 3
    t = (F.when(k == 0, F.concat(F.lit('{"answer": '), F.col("user_id").cast("string"), F.lit("}")))
         .when(k == 1, F.concat(F.lit("result "), "props")).otherwise(F.col("event_type")))
    a = answer_integer(t)
    return e.select("event_id", a["format_hit"].alias("format_hit"), a["answer"].alias("answer"))
