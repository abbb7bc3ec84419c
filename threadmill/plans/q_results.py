"""Registered queries: all boxed answers (A16), pairing of two result tables (J4), scrubbed tool calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import answers as A
from threadmill.functions import messages as M
from threadmill.operators.pairing import pair_results, paired_accuracy
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import ESC, math_problems
from threadmill.session import materialize
from threadmill.sources.tables import table

_BOXES = r"regexp_extract_all(solution, '\\boxed ?\{((?:[^{}]|\{[^{}]*\})*)\}', 1)"


@register("boxed_first_last", "WITH " + S.MATH + ", b AS (SELECT p_partkey, (length(solution) - length(replace(solution, '\\boxed{', ''))) // 7 "
          "AS n_boxed, list_transform(" + _BOXES + ", lambda x: " + S.strip("x") + ") AS x FROM math) SELECT p_partkey, n_boxed::BIGINT AS n_boxed, "
          "len(x)::BIGINT AS n_closed, x[1] AS first, x[-1] AS last, n_boxed > 1 AND x[1] IS DISTINCT FROM x[-1] AS mismatch FROM b")
def boxed_first_last(spark, sf_dir):
    """Every boxed answer of a solution in one pass; first against last where there are several."""
    m = math_problems(spark, sf_dir).select("p_partkey", A.boxed_contents("solution").alias("x"))
    first, last = F.try_element_at("x", F.lit(1)), F.try_element_at("x", F.lit(-1))
    return m.select("p_partkey", F.size("x").cast("long").alias("n_boxed"), F.size(F.filter("x", lambda v: v.isNotNull())).cast("long").alias("n_closed"),
                    first.alias("first"), last.alias("last"), ((F.size("x") > 1) & ~first.eqNullSafe(last)).alias("mismatch"))


@register("paired_results", "WITH t AS (SELECT l_orderkey AS example_id, l_linenumber AS pos, l_partkey % 10 AS gold, l_suppkey % 10 AS top FROM lineitem "
          "WHERE l_linenumber <> 7), b AS (SELECT l_orderkey AS example_id, l_linenumber AS pos, l_partkey % 10 AS gold, (l_suppkey + l_linenumber) % 10 "
          "AS top FROM lineitem WHERE l_orderkey % 11 <> 0), j AS (SELECT coalesce(t.example_id, b.example_id) AS example_id, t.example_id IS NOT NULL AS in_t, "
          "b.example_id IS NOT NULL AS in_b, CASE WHEN t.top = t.gold THEN 1.0::DOUBLE ELSE 0.0 END AS ht, CASE WHEN b.top = b.gold THEN 1.0::DOUBLE ELSE 0.0 END "
          "AS hb FROM t FULL JOIN b ON t.example_id = b.example_id AND t.pos = b.pos) SELECT example_id, count(*) FILTER (WHERE in_t AND in_b) AS n_both, "
          "count(*) FILTER (WHERE in_t AND NOT in_b) AS n_left_only, count(*) FILTER (WHERE in_b AND NOT in_t) AS n_right_only, "
          "round(avg(ht) FILTER (WHERE in_t AND in_b), 6) AS acc_left, round(avg(hb) FILTER (WHERE in_t AND in_b), 6) AS acc_right, "
          "round(avg(ht) FILTER (WHERE in_t AND in_b) - avg(hb) FILTER (WHERE in_t AND in_b), 6) AS delta FROM j GROUP BY 1")
def paired_results(spark, sf_dir):
    """Prediction tables of two models, written apart (each lacks rows of the other), paired by
    example and position; unmatched rows are counted per side."""
    li = table(spark, sf_dir, "lineitem")
    row = lambda top: (F.col("l_orderkey").alias("example_id"), F.col("l_linenumber").alias("pos"), (F.col("l_partkey") % 10).alias("gold"), (top % 10).alias("top"))
    trained = materialize(li.where("l_linenumber <> 7").select(*row(F.col("l_suppkey"))), "trained")
    base = materialize(li.where("l_orderkey % 11 <> 0").select(*row(F.col("l_suppkey") + F.col("l_linenumber"))), "base")
    pairs = pair_results(trained, base, ["example_id", "pos"])
    hit = lambda side: F.col(f"{side}.top") == F.col(f"{side}.gold")
    return paired_accuracy(pairs, "example_id", hit("l"), hit("r"))


_EID, _UID = "CAST(event_id AS VARCHAR)", "CAST(user_id AS VARCHAR)"


@register("trace_tool_calls", "SELECT event_id, " + S.scrub("chr(27) || '[31mevent ' || " + _EID + " || ' by u' || " + _UID + " || '@corp.example'") + " AS note, "
          + S.scrub("'type C:\\Users\\u' || " + _UID + " || '\\f ' || " + _EID) + " AS cmd, " + S.scrub("'u' || " + _UID + " || '@corp.example'") + " AS mail, "
          + S.scrub("'USER: Set model to ' || event_type") + " AS said, 'k' || " + _EID + " AS by_key, 'tool_use' AS output_type FROM events")
def trace_tool_calls(spark, sf_dir):
    """P12 + P14: tool calls of a reduced trace, scrubbed leaf by leaf: escape codes, Windows paths (also in
    the JSON text of ``arguments``) and addresses go, keys that look like addresses stay."""
    e = table(spark, sf_dir, "events")
    uid, eid = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    mail = F.concat(F.lit("u"), uid, F.lit("@corp.example"))
    args = F.to_json(F.struct(F.concat(F.lit("type C:\\Users\\u"), uid, F.lit("\\f "), eid).alias("cmd"), mail.alias("mail")))
    call = F.struct(F.concat(F.lit(ESC + "[31mevent "), eid, F.lit(" by "), mail).alias("note"), F.concat(F.lit("k"), eid).alias("a@b.example"),
                    F.concat(F.lit("USER: Set model to "), "event_type").alias("said"),
                    F.struct(F.lit("Bash").alias("name"), args.alias("arguments")).alias("function"))
    turn = F.to_json(F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"), F.array(call).alias("tool_calls")))
    d = M.reduce_trace(e.select("event_id", F.array(turn).alias("raw")), "raw")
    tc = F.col("_red_messages")[0]["tool_calls"]
    d = d.select("event_id", tc.alias("tc"), F.get_json_object(tc, "$[0].function.arguments").alias("args"), F.col("_red_output_type").alias("output_type"))
    get = F.get_json_object
    return d.select("event_id", get("tc", "$[0].note").alias("note"), get("args", "$.cmd").alias("cmd"), get("args", "$.mail").alias("mail"),
                    get("tc", "$[0].said").alias("said"), get("tc", "$[0]['a@b.example']").alias("by_key"), "output_type")
