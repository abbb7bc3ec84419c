"""Registered queries: multi-source load with schema dispatch, scans and JSON columns
(S1, S3, S8, P3, P27e, T9, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import messages as M
from threadmill.functions.answers import parse_guess
from threadmill.functions.text import first_nonempty
from threadmill.functions.udfs import decode_repr_messages
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import conv_raw, flat_qa
from threadmill.sources.io import from_json_messages, load_sources, to_json_messages
from threadmill.sources.tables import table


def normalize_any(df):
    """Pick the normaliser from the schema at plan time (not per row):
    ``conversations`` -> P6, ``messages`` as text -> P5, ``messages`` -> P4, otherwise flat columns -> P2/P8."""
    cols = set(df.columns)
    if "conversations" in cols:
        n = M.normalize_conversations(df, "conversations")
        return n.drop("conversations")
    if "messages" in cols and df.schema["messages"].dataType.simpleString() == "string":
        n = M.normalize_repr(df.withColumn("_turns", decode_repr_messages("messages")), "_turns")
        return n.drop("_turns")
    if "messages" in cols:
        n = df.withColumn("_n", M.normalize_thinking_field("messages", M.element_fields(df, "messages")))
        return n.withColumn("ok", F.col("_n.ok")).withColumn("messages", F.col("_n.messages")).drop("_n")

    def pick(names):
        present = [c for c in names if c in cols]
        return first_nonempty(*present) if present else F.lit(None).cast("string")

    user = pick(["prompt", "question", "instruction", "input", "problem"])
    think = pick(["thinking", "reasoning_content", "reasoning", "think"])
    ans = pick(["content", "response", "output", "answer", "solution"])
    system = pick(["system", "system_prompt"])
    n = df.withColumn("_n", M.from_flat(user, ans, think, system))
    return n.withColumn("ok", F.col("_n.ok")).withColumn("messages", F.col("_n.messages")).drop("_n")


_PAGE_ANSWER = "regexp_replace(html, '<[^>]+>', ' ', 'g')"


@register("multi_source_load", "WITH " + S.TAGGED + ", " + S.CONV_NORM + ", " + S.FLAT + ", u AS ("
          "SELECT 'docs' AS source, 'model-a' AS model, (coalesce(problem, '') <> '' AND coalesce(solution, '') <> '') "
          "AS ok FROM flat UNION ALL SELECT 'convs', 'model-b', ok FROM norm UNION ALL SELECT 'pages', 'model-c', "
          "coalesce(url, '') <> '' AND coalesce(" + _PAGE_ANSWER + ", '') <> '' FROM pages) "
          "SELECT source, model, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok FROM u GROUP BY source, model")
def multi_source_load(spark, sf_dir):
    """S1 + U1 + P3: three sources of different shapes, each normalised by schema
    dispatch, tagged with source/model, concatenated by name; rows and kept rows per source."""
    docs = normalize_any(flat_qa(spark, sf_dir).drop("source"))
    convs = normalize_any(conv_raw(spark, sf_dir))
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("prompt"),
                                                  F.regexp_replace("html", "<[^>]+>", " ").alias("response"))
    pages = normalize_any(pages)
    u = load_sources(spark, [(docs.select("ok", "messages"), "docs", "model-a"),
                             (convs.select("ok", "messages"), "convs", "model-b"),
                             (pages.select("ok", "messages"), "pages", "model-c")])
    return u.groupBy("source", "model").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_ok"))


@register("source_scan", "SELECT doc_id, lang FROM documents WHERE source IN ('src1', 'src3', 'src5')")
def source_scan(spark, sf_dir):
    """S3: lazy parquet scan, source predicate pushed into the reader, two-column projection."""
    d = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return d.where(F.col("source").isin("src1", "src3", "src5")).select("doc_id", "lang")


@register("json_messages_roundtrip", "WITH " + S.TAGGED + ", " + S.CONV_NORM + " SELECT conv_id, len(m)::BIGINT AS "
          "n_msgs, m[-1].content AS last_content FROM norm WHERE ok")
def json_messages_roundtrip(spark, sf_dir):
    """Nested messages published as a JSON text column and parsed back at use."""
    from threadmill.plans.fixtures import normalized_conversations
    n = normalized_conversations(spark, sf_dir).where("ok").select("conv_id", "messages")
    back = from_json_messages(to_json_messages(n))
    return back.select("conv_id", F.size("messages").cast("long").alias("n_msgs"),
                       M.last_message("messages")["content"].alias("last_content"))


@register("problem_solution_chat", "SELECT p_partkey, 2::BIGINT AS n_msgs, md5('<|im_start|>user' || chr(10) || "
          "p_name || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || p_type || '<|im_end|>' || "
          "chr(10)) AS text_md5 FROM part")
def problem_solution_chat(spark, sf_dir):
    """P27e: problem/solution pairs as a two-turn chat, rendered."""
    p = table(spark, sf_dir, "part")
    chat = M.two_turn("p_name", "p_type")
    return p.select("p_partkey", F.size(chat).cast("long").alias("n_msgs"),
                    F.md5(M.render_chat(chat)).alias("text_md5"))


_OBJ = ("substring(text, strpos(text, '{'), length(text) - strpos(reverse(text), '}') + 1 - strpos(text, '{') + 1)")
_GUESS_SQL = (
    "SELECT conv_id, turn, CASE WHEN contains(text, 'guess') AND strpos(text, '{') > 0 THEN CASE WHEN "
    "length(text) - strpos(reverse(text), '}') + 1 > strpos(text, '{') AND json_valid(" + _OBJ + ") THEN coalesce("
    "CASE WHEN json_extract(" + _OBJ + ", '$.arguments') IS NOT NULL THEN json_extract_string(" + _OBJ + ", "
    "'$.arguments.guess') ELSE json_extract_string(" + _OBJ + ", '$.guess') END, '') END ELSE coalesce(nullif("
    "regexp_extract(text, '\\[([a-zA-Z]{5})\\]', 1), ''), substring(" + S.strip("text") + ", 1, 5)) END AS guess "
    "FROM conversations WHERE role = 'assistant'"
)


@register("guess_parse", _GUESS_SQL)
def guess_parse(spark, sf_dir):
    """Guesses parsed from assistant turns (JSON object, bracketed word or first five
    characters)."""
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    return c.select("conv_id", "turn", parse_guess("text").alias("guess"))
