"""Registered queries: math answers, ground truth and rewards."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import answers as A
from threadmill.functions import rewards as R
from threadmill.functions.text import prompt_key
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import math_completions, math_problems

_BOXED = ("WITH " + S.MATH + ", b AS (SELECT p_partkey, solution, " + S.extract_boxed("solution") + " AS boxed, "
          "contains(solution, '\\boxed{') OR contains(solution, '\\boxed {') AS has_boxed FROM math)")


@register("boxed_extract", _BOXED + " SELECT p_partkey, boxed, " + S.extract_answer("solution", "boxed")
          + " AS answer FROM b")
def boxed_extract(spark, sf_dir):
    """T2 + T3 on every derived solution."""
    m = math_problems(spark, sf_dir).withColumn("boxed", A.extract_boxed("solution"))
    return m.select("p_partkey", "boxed", A.extract_answer("solution").alias("answer"))


_NORM = ("WITH " + S.MATH + ", a AS (SELECT p_partkey, " + S.extract_answer("solution") + " AS answer FROM math)"
         ", n AS (SELECT p_partkey, answer, " + S.normalize_answer("answer") + " AS norm FROM a)")


@register("answer_normalize", _NORM + " SELECT p_partkey, norm, " + S.try_parse_number("norm") + " AS num FROM n")
def answer_normalize(spark, sf_dir):
    """T4 + T5: normalised answers and their numeric value."""
    a = math_problems(spark, sf_dir).select("p_partkey", A.extract_answer("solution").alias("answer"))
    n = a.withColumn("norm", A.normalize_answer("answer"))
    return n.select("p_partkey", "norm", A.try_parse_number("norm").alias("num"))


_GT = (", keyed AS (SELECT p_partkey, " + S.strip("regexp_replace(problem, '<\\|[^|]*\\|>', '', 'g')") + " AS key, "
       + S.extract_answer("solution") + " AS ans FROM math WHERE coalesce(problem, '') <> '' AND "
       "coalesce(solution, '') <> ''), gt AS (SELECT key, arg_max(ans, p_partkey) AS gt FROM keyed "
       "WHERE coalesce(ans, '') <> '' GROUP BY key)")


@register("ground_truth", "WITH " + S.MATH + _GT + " SELECT key, gt FROM gt")
def ground_truth_q(spark, sf_dir):
    """J1 build side: prompt key -> extracted answer, last write (largest id) wins."""
    return ground_truth(spark, sf_dir)


def ground_truth(spark, sf_dir):
    m = math_problems(spark, sf_dir).where((F.col("problem") != "") & (F.col("solution") != ""))
    k = m.select("p_partkey", prompt_key("problem").alias("key"), A.extract_answer("solution").alias("ans"))
    return (k.where(F.coalesce(F.col("ans"), F.lit("")) != "")
            .groupBy("key").agg(F.max_by("ans", "p_partkey").alias("gt")))


_SCORES = (
    "WITH " + S.MATH + ", " + S.COMPLETIONS + _GT + ", c AS (SELECT c.p_partkey, c.completion, g.gt, "
    + S.extract_answer("c.completion") + " AS pred FROM completions c LEFT JOIN gt g ON g.key = "
    + S.strip("regexp_replace(c.prompt, '<\\|[^|]*\\|>', '', 'g')") + "), n AS (SELECT *, "
    + S.normalize_answer("pred") + " AS pn, " + S.normalize_answer("gt") + " AS gn FROM c), "
    "v AS (SELECT *, " + S.try_parse_number("pn") + " AS pnum, " + S.try_parse_number("gn") + " AS gnum FROM n), "
    "s AS (SELECT p_partkey, " + S.accuracy("pred", "gt", "pn", "gn", "pnum", "gnum") + " AS acc, "
    + S.reward_parts("completion")["fmt"] + " AS fmt, " + S.reward_parts("completion")["len"] + " AS len, "
    + S.reward_parts("completion")["rsn"] + " AS rsn FROM v)"
)


@register("reward_scores", _SCORES + " SELECT p_partkey, acc::DOUBLE AS acc, fmt::DOUBLE AS fmt, len::DOUBLE AS len, "
          "rsn::DOUBLE AS rsn, round((acc * 0.5 + fmt * 0.25 + len * 0.15 + rsn * 0.1)::DOUBLE, 6) AS score FROM s")
def reward_scores(spark, sf_dir):
    """R1 (R1a-d): combined reward of every completion against the looked-up truth."""
    return scores(spark, sf_dir).select("p_partkey", "acc", "fmt", "len", "rsn", F.round("score", 6).alias("score"))


def scores(spark, sf_dir):
    gt = ground_truth(spark, sf_dir)
    c = math_completions(spark, sf_dir).withColumn("key", prompt_key("prompt"))
    c = c.join(gt, "key", "left").withColumn("pred", A.extract_answer("completion"))
    c = c.withColumn("pn", A.normalize_answer("pred")).withColumn("gn", A.normalize_answer("gt"))
    c = c.withColumn("pnum", A.try_parse_number("pn")).withColumn("gnum", A.try_parse_number("gn"))
    c = c.select("p_partkey", "completion", R.accuracy("pred", "gt", "pn", "gn", "pnum", "gnum").alias("acc"),
                 R.format_score("completion").alias("fmt"), R.length_score("completion").alias("len"),
                 R.reasoning_score("completion").alias("rsn"))
    return c.withColumn("score", R.combined("acc", "fmt", "len", "rsn"))


@register("reward_discrimination", _SCORES + ", t AS (SELECT p_partkey % 6 IN (0, 1, 5) AS correct, "
          "acc * 0.5 + fmt * 0.25 + len * 0.15 + rsn * 0.1 AS score FROM s) SELECT "
          "round(avg(score) FILTER (WHERE correct), 6) AS mean_correct, round(avg(score) FILTER (WHERE NOT correct), 6) "
          "AS mean_wrong, round(avg(score) FILTER (WHERE correct) - avg(score) FILTER (WHERE NOT correct), 6) AS gap, "
          "count(*) FILTER (WHERE score >= 0.5) AS n_ge_half FROM t")
def reward_discrimination(spark, sf_dir):
    """Mean reward of right vs wrong completions, their gap, rows scoring >= 0.5."""
    s = scores(spark, sf_dir).withColumn("correct", (F.col("p_partkey") % 6).isin(0, 1, 5))
    mc = F.avg(F.when(F.col("correct"), F.col("score")))
    mw = F.avg(F.when(~F.col("correct"), F.col("score")))
    return s.agg(F.round(mc, 6).alias("mean_correct"), F.round(mw, 6).alias("mean_wrong"),
                 F.round(mc - mw, 6).alias("gap"), F.count_if(F.col("score") >= 0.5).alias("n_ge_half"))


_DEPTH = ("list_max(list_transform(range(1, length(boxed) + 1), lambda i: length(replace(substring(boxed, 1, i), "
          "'}', '')) - length(replace(substring(boxed, 1, i), '{', ''))))")


@register("extraction_quality", _BOXED + ", e AS (SELECT *, " + S.extract_answer("solution", "boxed")
          + " AS answer, length(solution) - length(replace(solution, '\\boxed{', '')) AS nb FROM b) SELECT "
          "count(*) FILTER (WHERE has_boxed) AS n_boxed, count(*) FILTER (WHERE NOT has_boxed) AS n_plain, "
          "round(count(*) FILTER (WHERE coalesce(answer, '') <> '') / count(*), 6) AS extraction_rate, "
          "count(*) FILTER (WHERE has_boxed AND coalesce(boxed, '') <> '' AND coalesce(" + _DEPTH + ", 0) = 0) AS simple, "
          "count(*) FILTER (WHERE has_boxed AND coalesce(boxed, '') <> '' AND " + _DEPTH + " = 1) AS nested, "
          "count(*) FILTER (WHERE has_boxed AND coalesce(boxed, '') <> '' AND " + _DEPTH + " >= 2) AS deep_nested, "
          "count(*) FILTER (WHERE has_boxed AND coalesce(boxed, '') = '') AS failed, "
          "count(*) FILTER (WHERE nb > 7) AS multi_boxed FROM e")
def extraction_quality(spark, sf_dir):
    """Boxed / plain counts, extraction rate, brace-depth classes, parse failures, multi-boxed."""
    from threadmill.functions.text import max_brace_depth
    m = math_problems(spark, sf_dir).withColumn("boxed", A.extract_boxed("solution"))
    m = m.withColumn("has_boxed", F.contains("solution", F.lit("\\boxed{")) | F.contains("solution", F.lit("\\boxed {")))
    m = m.withColumn("answer", A.extract_answer("solution"))
    m = m.withColumn("depth", max_brace_depth(F.coalesce("boxed", F.lit(""))))
    ok = F.col("has_boxed") & (F.coalesce("boxed", F.lit("")) != "")
    n_box = (F.length("solution") - F.length(F.replace("solution", F.lit("\\boxed{"), F.lit("")))) / 7
    return m.agg(F.count_if("has_boxed").alias("n_boxed"), F.count_if(~F.col("has_boxed")).alias("n_plain"),
                 F.round(F.count_if(F.coalesce("answer", F.lit("")) != "") / F.count(F.lit(1)), 6)
                 .alias("extraction_rate"),
                 F.count_if(ok & (F.col("depth") == 0)).alias("simple"),
                 F.count_if(ok & (F.col("depth") == 1)).alias("nested"),
                 F.count_if(ok & (F.col("depth") >= 2)).alias("deep_nested"),
                 F.count_if(F.col("has_boxed") & (F.coalesce("boxed", F.lit("")) == "")).alias("failed"),
                 F.count_if(n_box > 1).alias("multi_boxed"))
