"""Registered queries: corpus statistics, audit and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions.text import ascii_share, word_count
from threadmill.operators import stats as ST
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.sources.tables import table


@register("source_counts", "SELECT source, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE "
          "AS pct FROM documents GROUP BY source")
def source_counts(spark, sf_dir):
    """A1 + L1: rows and share per source, descending."""
    return ST.count_share(table(spark, sf_dir, "documents"), "source").orderBy(F.desc("n"), "source")


_WC = S.word_count("text")


@register("length_stats", "WITH l AS (SELECT " + _WC + " AS x FROM documents) SELECT min(x)::BIGINT AS min_len, "
          "floor(avg(x))::BIGINT AS avg_len, max(x)::BIGINT AS max_len, round(quantile_cont(x, 0.5), 6) AS median, "
          "round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.99), 6) AS p99, "
          "CAST(trunc(quantile_cont(x, 0.99)) AS BIGINT) + 16 AS seq_cap, CAST(trunc(median(x)) AS BIGINT) AS median_int, "
          "count(*) FILTER (WHERE x > 2048) AS over_2048, round(count(*) FILTER (WHERE x > 2048) / count(*), 6) "
          "AS share_over_2048, count(*) FILTER (WHERE x > 4096) AS over_4096, "
          "round(count(*) FILTER (WHERE x > 4096) / count(*), 6) AS share_over_4096 FROM l")
def length_stats(spark, sf_dir):
    """A4 + A5 + A6 over whitespace-token lengths of every document."""
    d = table(spark, sf_dir, "documents").select(word_count("text").alias("x"))
    return ST.length_stats(d, "x")


@register("ascii_share", "SELECT doc_id, round(CASE WHEN length(substring(text, 1, 400)) > 0 THEN "
          "length(regexp_replace(substring(text, 1, 400), '[^\\x00-\\x7F]', '', 'g')) / length(substring(text, 1, 400)) "
          "ELSE 0.0 END, 6) AS share FROM documents")
def ascii_share_q(spark, sf_dir):
    """ASCII share of the first 400 characters."""
    return table(spark, sf_dir, "documents").select("doc_id", F.round(ascii_share("text"), 6).alias("share"))


_MARK = " OR ".join(f"contains(rj, {S.q(m)})" for m in ST.AGENTIC_MARKERS)
_KEYED = "coalesce(" + ", ".join(f"nullif(j->>{S.q(k)}, '')" for k in ST.RESPONSE_KEYS) + ")"
_MSGS = "CAST(json_extract(j, '$.messages') AS JSON[])"
_AUDIT = (
    "WITH " + S.TRACE_META + ", s AS (SELECT * FROM (SELECT event_id, first_source_dataset AS src, row_json AS rj, "
    "row_number() OVER (PARTITION BY first_source_dataset ORDER BY event_id) AS rn FROM trace_meta) WHERE rn <= 2000), "
    "p AS (SELECT *, json_valid(rj) AS valid, CASE WHEN json_valid(rj) THEN rj END AS j, (" + _MARK + ") AS marker "
    "FROM s), "
    "q AS (SELECT *, coalesce(json_type(j) = 'OBJECT', false) AS obj, CASE WHEN json_type(j, '$.messages') = 'ARRAY' "
    "THEN json_array_length(j, '$.messages') ELSE 0 END AS nm FROM p), "
    "r AS (SELECT *, CASE WHEN obj AND nm > 0 THEN list_reduce(list_prepend('', list_transform(list_filter(" + _MSGS
    + ", lambda e: e->>'role' = 'assistant'), lambda e: coalesce(e->>'content', ''))), lambda a, b: CASE WHEN "
    "length(b) > length(a) THEN b ELSE a END) END AS longest, CASE WHEN obj AND nm > 0 THEN CAST(" + _MSGS + "[-1] "
    "AS VARCHAR) END AS last_json, obj AND json_extract(j, '$.thinking') IS NOT NULL AS has_think, CASE WHEN obj THEN " + _KEYED
    + " END AS keyed FROM q), "
    "x AS (SELECT src, CASE WHEN NOT valid THEN substring(rj, 1, 4000) WHEN obj AND nm > 0 THEN coalesce(nullif(longest, ''), "
    "last_json) WHEN has_think THEN coalesce(j->>'thinking', '') WHEN keyed IS NOT NULL THEN keyed ELSE "
    "substring(rj, 1, 4000) END AS t, CASE WHEN has_think AND NOT (obj AND nm > 0) THEN true ELSE marker END AS mk, "
    "obj AND nm > 0 AS is_msgs FROM r), "
    "top AS (SELECT src, max(c) AS top_c FROM (SELECT src, count(*) AS c FROM x WHERE t <> '' GROUP BY src, "
    "md5(substring(t, 1, 120))) GROUP BY src), "
    "per AS (SELECT src, count(*) AS m, count(*) FILTER (WHERE CASE WHEN length(substring(t, 1, 400)) > 0 THEN "
    "length(regexp_replace(substring(t, 1, 400), '[^\\x00-\\x7F]', '', 'g')) / length(substring(t, 1, 400)) ELSE 0.0 "
    "END >= 0.9) AS n_eng, count(DISTINCT t) AS n_uniq, count(*) FILTER (WHERE mk) AS n_marker, count(*) FILTER "
    "(WHERE contains(t, " + S.q(ST.LARP) + ")) AS n_larp, list_sort(list(length(t))) AS lens, bool_or(is_msgs) AS hm "
    "FROM x GROUP BY src), "
    "g AS (SELECT per.src, m::BIGINT AS m, round(n_eng / m, 6) AS eng, round(coalesce(top_c / m, 1.0), 6) AS pfx_top, "
    "round(n_uniq / m, 6) AS uniq, round(n_marker / m, 6) AS agen, lens[m // 2 + 1]::BIGINT AS mlen, "
    "round(n_larp / m, 6) AS larp, hm FROM per LEFT JOIN top ON per.src = top.src) "
    "SELECT src AS first_source_dataset, m, eng, pfx_top, uniq, agen, mlen, larp, CASE WHEN (eng >= 0.8 AND pfx_top "
    "<= 0.15 AND uniq >= 0.6 AND larp <= 0.02 AND (agen >= 0.3 OR mlen >= 800)) AND agen < 0.05 AND mlen >= 800 AND "
    "NOT hm THEN 'DROP(non-agentic)' WHEN eng >= 0.8 AND pfx_top <= 0.15 AND uniq >= 0.6 AND larp <= 0.02 AND "
    "(agen >= 0.3 OR mlen >= 800) THEN 'KEEP' ELSE 'DROP' END AS verdict FROM g"
)


_AUDIT_WHOLE = _AUDIT.replace(" WHERE rn <= 2000", "").replace("substring(rj, 1, 4000)", "rj")


@register("source_audit", _AUDIT_WHOLE)
def source_audit(spark, sf_dir):
    """A7 + A8 + A9: per-source genuineness profile and KEEP/DROP verdict over every row."""
    from threadmill.plans.fixtures import trace_meta
    return ST.source_audit(trace_meta(spark, sf_dir), "first_source_dataset", "event_id", "row_json")


@register("source_audit_sample", _AUDIT)
def source_audit_sample(spark, sf_dir):
    """A7 + W3 with the reference's parameters: the first 2,000 rows of each source and 4,000
    characters of a row of unknown shape."""
    from threadmill.plans.fixtures import trace_meta
    return ST.source_audit(trace_meta(spark, sf_dir), "first_source_dataset", "event_id", "row_json",
                           ST.AUDIT_SAMPLE, ST.AUDIT_CHARS)


@register("top_event_types", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, "
          "event_type LIMIT 3")
def top_event_types(spark, sf_dir):
    """L3: most common values (top-k report)."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "event_type").limit(3))
