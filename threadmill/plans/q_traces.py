"""Registered queries: trace clean over event-derived JSON rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.traces import events_trace_clean

_TC = "(CASE WHEN coalesce(x->>'tool_calls', '') IN ('', '[]', '{}', 'null', 'false', '0') THEN NULL ELSE x->>'tool_calls' END)"
_SQL = (
    "WITH " + S.TRACE_META + ", t AS (SELECT event_id, first_source_dataset AS src, CASE WHEN json_valid(row_json) THEN row_json END AS rj, "
    "json_valid(row_json) AS valid FROM trace_meta WHERE first_source_dataset IN ('click', 'view', 'purchase', 'error')), "
    "o AS (SELECT *, coalesce(json_type(rj) = 'OBJECT', false) AS obj FROM t), "
    "f AS (SELECT *, CASE WHEN obj AND json_type(rj, '$.messages') = 'ARRAY' AND json_array_length(rj, '$.messages') > 0 "
    "THEN 'messages' WHEN obj AND (rj->>'thinking' IS NOT NULL OR rj->>'query' IS NOT NULL) THEN 'thinking' "
    "ELSE 'prompt' END AS fmt FROM o), "
    "pm AS (SELECT *, CASE WHEN fmt = 'messages' THEN list_transform(CAST(json_extract(rj, '$.messages') AS JSON[]), "
    "lambda x: struct_pack(role := x->>'role', content := " + S.scrub("x->>'content'") + ", tool_calls := " + _TC
    + ", rc := x->>'reasoning_content')) END AS pmsgs FROM f), "
    "r AS (SELECT *, CASE WHEN fmt = 'messages' THEN list_transform(pmsgs, lambda x: struct_pack(role := x.role, "
    "content := x.content, tool_calls := x.tool_calls)) WHEN fmt = 'thinking' THEN [struct_pack(role := 'user', content := "
    + S.scrub("rj->>'query'") + ", tool_calls := NULL::VARCHAR), struct_pack(role := 'assistant', content := coalesce(nullif("
    + S.scrub("coalesce(rj->>'response', rj->>'solution')") + ", ''), " + S.scrub("rj->>'thinking'") + "), "
    "tool_calls := NULL::VARCHAR)] ELSE [struct_pack(role := 'user', content := "
    + S.scrub("coalesce(rj->>'prompt', rj->>'instruction', rj->>'user_prompt')") + ", tool_calls := NULL::VARCHAR), "
    "struct_pack(role := 'assistant', content := " + S.scrub("coalesce(rj->>'response', rj->>'output', rj->>'solution', "
    "rj->>'completion')") + ", tool_calls := NULL::VARCHAR)] END AS msgs, "
    "CASE WHEN fmt = 'messages' THEN coalesce(" + S.scrub("list_filter(pmsgs, lambda x: x.role = 'assistant' AND "
    "coalesce(x.rc, '') <> '')[-1].rc") + ", '') WHEN fmt = 'thinking' THEN " + S.scrub("rj->>'thinking'") + " ELSE '' END "
    "AS thinking, CASE WHEN fmt = 'messages' THEN coalesce(list_filter(pmsgs, lambda x: x.role = 'assistant' AND "
    "x.content <> '')[-1].content, '') WHEN fmt = 'thinking' THEN " + S.scrub("coalesce(rj->>'response', rj->>'solution')")
    + " ELSE " + S.scrub("coalesce(rj->>'response', rj->>'output', rj->>'solution', rj->>'completion')") + " END AS response, "
    "CASE WHEN fmt = 'messages' AND list_bool_or(list_transform(pmsgs, lambda x: x.tool_calls IS NOT NULL)) "
    "THEN 'tool_use' ELSE 'text' END AS ot0 FROM pm), "
    "c AS (SELECT *, CASE WHEN NOT valid THEN 'noparse' WHEN NOT obj THEN 'empty' WHEN src = 'click' AND "
    "rj->>'category' = 'decoy' THEN 'decoy' WHEN fmt = 'prompt' AND msgs[1].content = '' AND msgs[2].content = '' "
    "THEN 'empty' WHEN NOT coalesce(list_bool_or(list_transform(msgs, lambda x: x.role = 'assistant' AND "
    "(coalesce(x.content, '') <> '' OR x.tool_calls IS NOT NULL))), false) THEN 'empty' END AS r0, "
    "CASE WHEN ot0 <> 'tool_use' AND list_bool_or(list_transform(msgs, lambda x: contains(coalesce(x.content, ''), "
    "'[Tool:'))) THEN 'tool_use' ELSE ot0 END AS output_type, array_to_string(list_transform(list_filter(msgs, "
    "lambda x: coalesce(x.content, '') <> ''), lambda x: upper(x.role) || ': ' || x.content), chr(10)) AS context "
    "FROM r), "
    "d AS (SELECT *, CASE WHEN r0 IS NULL THEN row_number() OVER (PARTITION BY r0 IS NULL, md5(substring(context, 1, 1000) "
    "|| '||' || substring(response, 1, 500)) ORDER BY event_id) END AS rn FROM c) "
    "SELECT event_id, coalesce(r0, CASE WHEN rn > 1 THEN 'dup' END) AS drop_reason, CASE WHEN length(thinking) > 450 "
    "AND output_type <> 'tool_use' THEN 'reasoning' ELSE 'agentic' END AS task_type, output_type, "
    "length(thinking)::BIGINT AS cot_length, length(context)::BIGINT AS context_length, length(response)::BIGINT AS "
    "response_length, md5(CASE WHEN thinking <> '' THEN '<think>' || chr(10) || thinking || chr(10) || '</think>' || "
    "chr(10) || response ELSE response END) AS completion_md5 FROM d"
)


@register("trace_clean", _SQL)
def trace_clean(spark, sf_dir):
    """Entry 2: every kept-source row with its drop reason and clean-trace columns."""
    d = events_trace_clean(spark, sf_dir)
    return d.select("event_id", "drop_reason", "task_type", "output_type",
                    F.col("cot_length").cast("long").alias("cot_length"),
                    F.col("context_length").cast("long").alias("context_length"),
                    F.col("response_length").cast("long").alias("response_length"),
                    F.md5("completion").alias("completion_md5"))
