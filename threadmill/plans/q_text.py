"""Registered queries: text formats, synthetic-corpus clean, flat and thinking-field messages,
consumer filters and corpus checks (P2, P4, P8, P19-P20, P23-P24, P26, P29, P31-P32, P36,
P38-P39, R2-R3, T6, T10, T15, L2, J3, D1c, A19, A20, A22, W8, S14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import messages as M
from threadmill.functions import rewards as R
from threadmill.functions.answers import py_float
from threadmill.functions.scrub import (CLOSING_PATTERN, PREAMBLE_PATTERN, PREAMBLE_TEXT, STUB_MARKERS, scrub_guarded,
                                        has_stub_marker, scrub, strip_boilerplate)
from threadmill.functions.text import slug, sum_of_integers
from threadmill.operators.dedup import flag_first_seen, signature_key
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.session import materialize
from threadmill.sources.tables import table

EOS = "<|im_end|>"  # ChatML end-of-turn token as the default EOS

# xlam rows from events: query = event_type, tools = a JSON list (broken every 9th), answers = one call
_XLAM_SQL = ("x AS (SELECT event_id, event_type AS query, CASE WHEN event_id % 9 = 0 THEN '[' || props ELSE '[' || props "
             "|| ',' || props || ']' END AS tools, '[\"call_' || CAST(event_id AS VARCHAR) || '\"]' AS answers FROM events)")


def _lines_sql(c: str) -> str:
    # Python str() of the fixture's elements: strings print bare, flat {"k": n} objects
    # print as {'k': n}
    pyrepr = "replace(replace(CAST(e AS VARCHAR), '\"', ''''), ':', ': ')"
    return (f"CASE WHEN json_valid({c}) AND json_type({c}) = 'ARRAY' THEN array_to_string(list_transform(CAST({c} AS "
            f"JSON[]), lambda e: CASE WHEN json_type(e) = 'VARCHAR' THEN e->>'$' ELSE {pyrepr} END), chr(10)) "
            f"ELSE {c} END")


@register("function_call_render", "WITH " + _XLAM_SQL + " SELECT event_id, '<query>' || query || '</query>' || chr(10) || "
          "chr(10) || '<tools>' || " + _lines_sql("tools") + " || '</tools>' || chr(10) || chr(10) || '<answers>' || "
          + _lines_sql("answers") + " || '</answers>' || '" + EOS + "' AS text FROM x")
def function_call_render(spark, sf_dir):
    """P29 + T6: ``<query>/<tools>/<answers>`` text; JSON lists one element per line as
    Python prints them, raw text when the value does not parse."""
    from threadmill.functions.udfs import json_list_lines_py
    e = table(spark, sf_dir, "events")
    tools = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("["), "props")) \
        .otherwise(F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")))
    answers = F.concat(F.lit('["call_'), F.col("event_id").cast("string"), F.lit('"]'))
    x = e.select("event_id", F.col("event_type").alias("query"), tools.alias("tools"), answers.alias("answers"))
    text = F.concat(F.lit("<query>"), "query", F.lit("</query>\n\n<tools>"), json_list_lines_py("tools"),
                    F.lit("</tools>\n\n<answers>"), json_list_lines_py("answers"), F.lit("</answers>" + EOS))
    return x.select("event_id", text.alias("text"))


@register("numeric_answers", "SELECT event_id FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE "
          "CAST(user_id AS VARCHAR) || '.5' END AS answer FROM events) WHERE " + S.py_float("answer") + " IS NOT NULL")
def numeric_answers(spark, sf_dir):
    """Keep rows whose answer parses as a float."""
    e = table(spark, sf_dir, "events")
    a = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.concat(F.col("user_id").cast("string"),
                                                                                    F.lit(".5")))
    return e.select("event_id", a.alias("answer")).where(py_float("answer").isNotNull()).select("event_id")


_INSTR = (". First provide reasoning between <REASONING> and </REASONING>, "
          "then your numeric answer between <SOLUTION> and </SOLUTION>.")
_TAGS_SQL = ("b AS (SELECT item_id, text || '" + _INSTR + "' AS prompt, CAST(item_id AS VARCHAR) AS answer, CASE "
             "item_id % 3 WHEN 0 THEN '<REASONING>' || text || '</REASONING><SOLUTION> ' || "
             "CAST(item_id AS VARCHAR) || ' </SOLUTION>' WHEN 1 THEN '<REASONING>' || text || '</REASONING><SOLUTION>1</SOLUTION>"
             "<SOLUTION>' || text || '</SOLUTION>' ELSE text END AS completion FROM benchmark)")


@register("tag_rewards", "WITH " + _TAGS_SQL + " SELECT item_id, md5(prompt) AS prompt_md5, ((CASE WHEN "
          "len(regexp_extract_all(completion, '(?s)<REASONING>(.*?)</REASONING>', 1)) = 1 THEN 1.0 ELSE 0.0 END) + "
          "(CASE WHEN len(regexp_extract_all(completion, '(?s)<SOLUTION>(.*?)</SOLUTION>', 1)) = 1 THEN 1.0 ELSE 0.0 "
          "END))::DOUBLE AS format_reward, (CASE WHEN len(regexp_extract_all(completion, '(?s)<SOLUTION>(.*?)</SOLUTION>', "
          "1)) = 1 AND " + S.strip("regexp_extract_all(completion, '(?s)<SOLUTION>(.*?)</SOLUTION>', 1)[1]")
          + " = answer THEN 2.0 ELSE 0.0 END)::DOUBLE AS accuracy_reward FROM b")
def tag_rewards(spark, sf_dir):
    """P32 + R2 + R3: instruction template, tag-format and tag-accuracy rewards."""
    b = table(spark, sf_dir, "benchmark")
    k = F.col("item_id") % 3
    comp = (F.when(k == 0, F.concat(F.lit("<REASONING>"), F.col("text"), F.lit("</REASONING><SOLUTION> "),
                                    F.col("item_id").cast("string"), F.lit(" </SOLUTION>")))
            .when(k == 1, F.concat(F.lit("<REASONING>"), F.col("text"), F.lit("</REASONING><SOLUTION>1</SOLUTION><SOLUTION>"), F.col("text"), F.lit("</SOLUTION>")))
            .otherwise(F.col("text")))
    b = b.select("item_id", F.concat("text", F.lit(_INSTR)).alias("prompt"), comp.alias("completion"),
                 F.col("item_id").cast("string").alias("answer"))
    return b.select("item_id", F.md5("prompt").alias("prompt_md5"),
                    R.tag_format_reward("completion").alias("format_reward"),
                    R.tag_accuracy_reward("completion", "answer").alias("accuracy_reward"))


@register("url_integer_sum", "SELECT page_id, coalesce(list_sum(list_transform(regexp_extract_all(url, '(-?[0-9]+)', 1), "
          "lambda x: CAST(x AS BIGINT))), 0)::BIGINT AS total FROM pages")
def url_integer_sum(spark, sf_dir):
    """Sum of the integers appearing in each page URL."""
    return table(spark, sf_dir, "pages").select("page_id", sum_of_integers("url").alias("total"))


@register("name_slugs", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), "
          "'^-+|-+$', '', 'g') AS slug FROM part")
def name_slugs(spark, sf_dir):
    """Lower-case hyphen slugs."""
    return table(spark, sf_dir, "part").select("p_partkey", slug("p_name").alias("slug"))


@register("extraction_failures", "WITH " + S.MATH + " SELECT p_partkey, substring(problem, 1, 80) AS problem_prefix, "
          "right(solution, 100) AS solution_tail FROM math WHERE " + S.extract_answer("solution") + " IS NULL "
          "ORDER BY p_partkey LIMIT 3")
def extraction_failures(spark, sf_dir):
    """L2: first three extraction failures with problem prefix and solution tail (a report)."""
    from threadmill.functions.answers import extract_answer
    from threadmill.plans.fixtures import math_problems
    m = math_problems(spark, sf_dir).where(extract_answer("solution").isNull())
    return (m.select("p_partkey", F.substring("problem", 1, 80).alias("problem_prefix"),
                     F.right("solution", F.lit(100)).alias("solution_tail")).orderBy("p_partkey").limit(3))


# synthetic corpus from documents: canned opener (full sentence or clause only), closing tag, stub markers
_PRE = PREAMBLE_TEXT
_SYN_SQL = (
    "syn AS (SELECT doc_id, substring(text, 1, 200) AS u, (CASE WHEN doc_id % 4 = 0 THEN '" + _PRE + " (distilled), I "
    "approach this with multi-layered analysis and ethical guardrails. ' || substring(text, 201) WHEN doc_id % 4 = 1 "
    "THEN '" + _PRE + " ' || substring(text, 201) ELSE substring(text, 201) END) || CASE WHEN doc_id % 6 = 0 THEN "
    "' *This response was generated to exemplify reasoning for training purposes.*' ELSE '' END || CASE WHEN "
    "doc_id % 25 = 0 THEN ' // Full implementation' ELSE '' END AS a FROM documents)"
)


def _bp_sql(a: str) -> str:
    first = S.strip(f"regexp_replace({a}, {S.q(S.detect_pattern('(?s)' + PREAMBLE_PATTERN))}, '', 'g')")
    fb = S.strip(f"replace({a}, '{_PRE}', '')")
    c = f"CASE WHEN {first} = {S.strip(a)} THEN {fb} ELSE {first} END"
    c = S.strip(f"regexp_replace({c}, {S.q('(?s)' + CLOSING_PATTERN)}, '', 'g')")
    return S.scrub(c)


_STUBS = " OR ".join(f"contains(a, {S.q(m)})" for m in STUB_MARKERS)
_SYN_CLEAN = (
    "WITH " + _SYN_SQL + ", s1 AS (SELECT doc_id, " + S.scrub("u") + " AS user, a FROM syn), s2 AS (SELECT *, CASE WHEN "
    "user = '' OR a = '' THEN 'empty' WHEN " + _STUBS + " THEN 'stub' END AS r0, " + _bp_sql("a") + " AS clean FROM s1), "
    "s3 AS (SELECT *, coalesce(r0, CASE WHEN length(clean) < 40 THEN 'empty' END) AS r1 FROM s2), "
    "s4 AS (SELECT *, CASE WHEN r1 IS NULL THEN row_number() OVER (PARTITION BY r1 IS NULL, md5(substring(user, 1, 300) "
    "|| '||' || substring(clean, 1, 400)) ORDER BY doc_id) END AS rn FROM s3)"
)


_SYN_PREFIX = (300, 400)   # the reference compares these prefixes of question and answer
_SYN_WHOLE = _SYN_CLEAN.replace("md5(substring(user, 1, 300) || '||' || substring(clean, 1, 400))",
                                "md5(user) || md5(clean)")


def _synthetic_clean(spark, sf_dir, prefix=None):
    d = table(spark, sf_dir, "documents")
    k4 = F.col("doc_id") % 4
    body = F.expr("substring(text, 201)")
    a = (F.when(k4 == 0, F.concat(F.lit(_PRE + " (distilled), I approach this with multi-layered analysis and ethical "
                                        "guardrails. "), body))
         .when(k4 == 1, F.concat(F.lit(_PRE + " "), body)).otherwise(body))
    a = F.concat(a, F.when(F.col("doc_id") % 6 == 0, F.lit(" *This response was generated to exemplify reasoning for "
                                                           "training purposes.*")).otherwise(F.lit("")),
                 F.when(F.col("doc_id") % 25 == 0, F.lit(" // Full implementation")).otherwise(F.lit("")))
    s = d.select("doc_id", scrub_guarded(F.substring("text", 1, 200)).alias("user"), a.alias("a"))
    s = s.withColumn("clean", strip_boilerplate("a"))
    r = (F.when((F.col("user") == "") | (F.col("a") == ""), "empty").when(has_stub_marker("a"), "stub")
         .when(F.length("clean") < 40, "empty"))
    # stage boundary: strip, scrub and signature once; the dedup reads narrow columns and the flag joins few rows
    s = materialize(s.select("doc_id", "clean", r.alias("drop_reason"), signature_key("user", "clean", prefix).alias("_sig")), "synthetic_rows")
    s = flag_first_seen(s, F.col("_sig"), ["doc_id"], "_first", eligible=F.col("drop_reason").isNull()).drop("_sig")
    return s.withColumn("drop_reason", F.coalesce("drop_reason", F.when(~F.col("_first"), F.lit("dup")))).drop("_first")


_SYN_ROWS = (" SELECT doc_id, coalesce(r1, CASE WHEN rn > 1 THEN 'dup' END) AS drop_reason, "
             "length(clean)::BIGINT AS clean_len, md5(clean) AS clean_md5 FROM s4")
_SYN_RATE = (" SELECT count(*) FILTER (WHERE coalesce(r1, CASE WHEN rn > 1 THEN 'dup' END) "
             "IS NULL) AS kept, count(*) AS total, round(count(*) FILTER (WHERE coalesce(r1, CASE WHEN rn > 1 THEN 'dup' "
             "END) IS NULL) / count(*), 6) AS survivor_rate FROM s4")


def _syn_rows(s):
    return s.select("doc_id", "drop_reason", F.length("clean").cast("long").alias("clean_len"),
                    F.md5("clean").alias("clean_md5"))


def _syn_rate(s):
    kept = F.count_if(F.col("drop_reason").isNull())
    return s.agg(kept.alias("kept"), F.count(F.lit(1)).alias("total"),
                 F.round(kept / F.count(F.lit(1)), 6).alias("survivor_rate"))


@register("synthetic_clean", _SYN_WHOLE + _SYN_ROWS)
def synthetic_clean(spark, sf_dir):
    """P19 + P20 + D1c + P21: boilerplate strip, stub drop, short drop, signature dedup of whole texts."""
    return _syn_rows(_synthetic_clean(spark, sf_dir))


@register("synthetic_clean_prefix", _SYN_CLEAN + _SYN_ROWS)
def synthetic_clean_prefix(spark, sf_dir):
    """The same with signatures of the first characters, the reference's parameter."""
    return _syn_rows(_synthetic_clean(spark, sf_dir, _SYN_PREFIX))


@register("survivor_rate", _SYN_WHOLE + _SYN_RATE)
def survivor_rate(spark, sf_dir):
    """Kept / total of the synthetic clean."""
    return _syn_rate(_synthetic_clean(spark, sf_dir))


@register("survivor_rate_prefix", _SYN_CLEAN + _SYN_RATE)
def survivor_rate_prefix(spark, sf_dir):
    """A20 with signatures of the first characters."""
    return _syn_rate(_synthetic_clean(spark, sf_dir, _SYN_PREFIX))


# flat rows with an optional system prompt and embedded think tags in some answers
_FLATQA_SQL = (
    S.FLAT + ", fq AS (SELECT doc_id, problem, CASE WHEN doc_id % 7 = 3 THEN '<think>' || substring(solution, 1, 30) || "
    "'</think>' || substring(solution, 31) WHEN doc_id % 7 = 5 THEN '<think>' || solution ELSE solution END AS solution, "
    "thinking, CASE WHEN doc_id % 10 = 0 THEN 'You are helpful.' END AS system FROM flat)"
)


def _flat_messages(spark, sf_dir):
    from threadmill.functions.text import first_nonempty
    from threadmill.plans.fixtures import flat_qa
    f = flat_qa(spark, sf_dir)
    sol = (F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("<think>"), F.substring("solution", 1, 30), F.lit("</think>"),
                                                      F.expr("substring(solution, 31)")))
           .when(F.col("doc_id") % 7 == 5, F.concat(F.lit("<think>"), "solution")).otherwise(F.col("solution")))
    f = f.withColumn("solution", sol).withColumn("system", F.when(F.col("doc_id") % 10 == 0, F.lit("You are helpful.")))
    n = f.select("doc_id", M.from_flat(first_nonempty("problem"), first_nonempty("solution"),
                                       first_nonempty("thinking"), first_nonempty("system")).alias("_m"))
    return n.select("doc_id", F.col("_m.ok").alias("ok"), F.col("_m.messages").alias("messages"))


_FLAT_MSG_SQL = (
    ", fm AS (SELECT doc_id, coalesce(problem, '') <> '' AND coalesce(solution, '') <> '' AND NOT (contains(solution, "
    "'<think>') AND " + S.think_trunc("solution") + ") AS ok, CASE WHEN coalesce(system, '') <> '' THEN 3 ELSE 2 END "
    "AS n_msgs, CASE WHEN contains(solution, '<think>') AND " + S.think_thinking("solution") + " IS NOT NULL THEN "
    + S.think_thinking("solution") + " ELSE nullif(thinking, '') END AS th, CASE WHEN contains(solution, '<think>') THEN "
    "coalesce(nullif(" + S.think_answer("solution") + ", ''), solution) ELSE solution END AS ans FROM fq)"
)


@register("flat_messages", "WITH " + _FLATQA_SQL + _FLAT_MSG_SQL + " SELECT doc_id, ok, n_msgs::BIGINT AS n_msgs, "
          "CASE WHEN th IS NOT NULL THEN " + S.strip("th") + " END AS thinking, " + S.strip("ans") + " AS content FROM fm")
def flat_messages(spark, sf_dir):
    """P2 + P7 + P8: column-variant coalesce, think tags in the answer, optional system turn."""
    n = _flat_messages(spark, sf_dir)
    last = M.last_message("messages")
    return n.select("doc_id", "ok", F.size("messages").cast("long").alias("n_msgs"), last["thinking"].alias("thinking"),
                    last["content"].alias("content"))


def _thinking_field(spark, sf_dir):
    from threadmill.plans.fixtures import tagged_turns
    t = tagged_turns(spark, sf_dir)
    null = F.lit(None).cast("string")
    th = F.when((F.col("role") == "assistant") & (F.col("conv_id") % 2 == 0), F.substring("text", 1, 20))
    g = (t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", th.alias("th"))))
                                  .alias("_t")))
    raw = F.transform("_t", lambda m: F.struct(m["role"].alias("role"), null.alias("from"), m["text"].alias("content"),
                                               null.alias("value"), m["th"].alias("thinking"),
                                               null.alias("reasoning_content")))
    n = g.select("conv_id", M.normalize_thinking_field(raw).alias("_n"))
    return n.select("conv_id", F.col("_n.ok").alias("ok"), F.col("_n.messages").alias("messages"))


_TF_SQL = (
    "WITH " + S.TAGGED + ", tt AS (SELECT conv_id, turn, " + S.canon_role("nullif(role, '')") + " AS role, coalesce(text, '') "
    "AS c, CASE WHEN role = 'assistant' AND conv_id % 2 = 0 THEN nullif(substring(text, 1, 20), '') END AS th FROM tagged), "
    "tm AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN " + S.strip("CASE WHEN contains(c, '<think>') THEN "
    "coalesce(nullif(" + S.think_answer("c") + ", ''), c) ELSE c END") + " ELSE c END AS content, CASE WHEN role = 'assistant' "
    "THEN CASE WHEN contains(c, '<think>') AND " + S.think_thinking("c") + " IS NOT NULL THEN " + S.think_thinking("c")
    + " WHEN th IS NOT NULL THEN " + S.strip("th") + " END END AS thinking, role = 'assistant' AND contains(c, '<think>') AND "
    "NOT contains(c, '</think>') AS tr FROM tt), "
    "agg AS (SELECT conv_id, count(*) AS n, bool_or(tr) AS anytr, bool_or(role = 'user') AS hu, bool_or(role = 'assistant') "
    "AS ha, arg_max_null(thinking, turn) AS last_thinking, arg_max_null(content, turn) AS last_content FROM tm GROUP BY conv_id)"
)


@register("thinking_field_messages", _TF_SQL + " SELECT conv_id, n > 0 AND NOT anytr AND hu AND ha AS ok, n::BIGINT AS "
          "n_msgs, last_thinking, last_content FROM agg")
def thinking_field_messages(spark, sf_dir):
    """Messages with a separate thinking field; an embedded tag block overrides it."""
    n = _thinking_field(spark, sf_dir)
    last = M.last_message("messages")
    return n.select("conv_id", "ok", F.size("messages").cast("long").alias("n_msgs"),
                    last["thinking"].alias("last_thinking"), last["content"].alias("last_content"))
