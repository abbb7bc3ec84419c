"""Run histories and evaluation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.functions.rewards import invalid_move_reward
from threadmill.functions.text import ColumnOrName, col


#: Fixed value: the fields of a log history's entries and the columns they become.
LOG_FIELDS = {"step": ("step", "long"), "loss": ("loss", "double"), "reward": ("reward", "double"), "completions/clipped_ratio": ("clipped_ratio", "double")}


def explode_log_history(df: DataFrame, history_col: str, *keep: str) -> DataFrame:
    """One row per entry of a ``log_history`` JSON array: the columns ``keep``, then step, loss,
    reward and clipped ratio. A field that an entry lacks is null; so is one of another type. A null
    text, one that is no array and an empty array give no row; other fields are not read."""
    fields = ", ".join(f"`{name}`: {kind}" for name, (_, kind) in LOG_FIELDS.items())
    entry = F.explode(F.from_json(F.col(history_col), f"array<struct<{fields}>>")).alias("_e")
    return df.select(*keep, entry).where("_e is not null").select(*keep, *[F.col("_e").getField(name).alias(out) for name, (out, _) in LOG_FIELDS.items()])


def reward_delta(logs: DataFrame, run_col: str, step_col: str, reward_col: str, k: int = 5, slices: int = 256) -> DataFrame:
    """Per run, mean of the last k minus mean of the first k logged rewards (null
    if fewer than k logs). One scan: a run is dealt into hash slices, the first and last
    k of each slice are kept, and a run's list holds at most ``2 * k * slices`` of them."""
    r = logs.where(F.col(reward_col).isNotNull()).select(run_col, step_col, F.col(reward_col).cast("double").alias(reward_col))
    r = r.withColumn("_s", F.pmod(F.xxhash64(step_col), F.lit(slices)))
    part = Window.partitionBy(run_col, "_s")
    ends = r.select("*", F.row_number().over(part.orderBy(step_col, reward_col)).alias("_a"),
                    F.row_number().over(part.orderBy(F.desc(step_col), F.desc(reward_col))).alias("_d"),
                    F.count(F.lit(1)).over(part).alias("_n")).where((F.col("_a") <= k) | (F.col("_d") <= k))
    per = ends.groupBy(run_col, "_s").agg(F.max("_n").alias("_n"), F.collect_list(F.struct(step_col, reward_col)).alias("_l"))
    g = per.groupBy(run_col).agg(F.sum("_n").alias("n_logs"), F.sort_array(F.flatten(F.collect_list("_l"))).alias("_l"))

    def mean(start: int) -> Column:
        rewards = F.transform(F.slice("_l", start, k), lambda e: e[reward_col])
        return F.when(F.col("n_logs") >= k, F.aggregate(rewards, F.lit(0.0), lambda x, y: x + y) / k)

    g = g.select(run_col, "n_logs", mean(1).alias("initial"), mean(-k).alias("final"))
    return g.withColumn("delta", F.col("final") - F.col("initial"))


def appended_feedback(turns: DataFrame, game_col: str, turn_col: str, full_col: str,
                      reward_col: str) -> DataFrame:
    """W6 + R4: newly appended feedback = current cumulative text minus the previous one;
    an invalid-move message zeroes the turn's reward."""
    w = Window.partitionBy(game_col).orderBy(turn_col)
    prev = F.lag(full_col).over(w)
    t = turns.withColumn("_prev_len", F.coalesce(F.length(prev), F.lit(0)))
    t = t.withColumn("feedback", F.expr(f"substring({full_col}, _prev_len + 1)")).drop("_prev_len")
    return t.withColumn("turn_reward", invalid_move_reward("feedback", reward_col))


def token_accuracy(pred: DataFrame, gold_col: str, top_col: str) -> list[Column]:
    """Micro-averaged top-1 and top-5 accuracy over positions."""
    n = F.count(F.lit(1))
    return [F.round(F.count_if(F.col(gold_col) == F.try_element_at(top_col, F.lit(1))) / n, 6),
            F.round(F.count_if(F.array_contains(top_col, F.col(gold_col))) / n, 6)]


def eval_summary(results: DataFrame, name_col: str, delta_col: str, score_col: str) -> DataFrame:
    """Improved count, mean delta, best delta and the model with the highest score
    (of equal scores, the last name)."""
    return results.agg(F.count_if(F.col(delta_col) > 0).alias("improved"),
                       F.round(F.avg(delta_col), 6).alias("mean_delta"),
                       F.round(F.max(delta_col), 6).alias("best_delta"),
                       F.max_by(name_col, F.struct(score_col, name_col)).alias("top_model"))


def ranked(results: DataFrame, value_col: str, out_col: str = "rank") -> DataFrame:
    """``rank()`` by ``value_col`` descending, null values last. The table has one row per
    evaluated model, so the one window over all of it is bounded by their number."""
    return results.withColumn(out_col, F.rank().over(Window.orderBy(F.desc_nulls_last(value_col))).cast("long"))


def totals_with_rollup(df: DataFrame, type_col: str, *measures: str) -> DataFrame:
    """Per-type sums plus the grand total (``rollup`` + ``grouping``)."""
    aggs = [F.sum(m).cast("long").alias(m) for m in measures]
    r = df.rollup(type_col).agg(*aggs, F.grouping(type_col).alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col(type_col)).alias(type_col),
                    *measures)


def backfill(registry: DataFrame, facts: DataFrame, key: str, value_col: str, fact_col: str, strict: bool = False) -> DataFrame:
    """Fill null outcomes from keyed facts (left join + coalesce). Rows still null after
    the fill have an unknown key: with ``strict`` the job fails on them, else they stay null."""
    j = registry.join(facts.select(key, F.col(fact_col).alias("_fact")), key, "left")
    value = F.coalesce(F.col(value_col), F.col("_fact"))
    if strict:
        unknown = F.concat(F.lit(f"no {fact_col} for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
        value = F.when(value.isNull(), F.raise_error(unknown)).otherwise(value)
    return j.withColumn("filled", F.col(value_col).isNull() & F.col("_fact").isNotNull()) \
            .withColumn(value_col, value).drop("_fact")


def win(done: ColumnOrName, reward: ColumnOrName) -> Column:
    """A game is won when it is done with a positive reward."""
    return col(done) & (col(reward) > 0)
