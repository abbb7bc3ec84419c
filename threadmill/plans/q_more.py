"""Registered queries: trace-derived training rows, consumer filters, corpus checks,
staged samples, and the Arrow-UDF operators (P5, P12, P23, P24, P26, P36, P38, P39,
J3, A11, A19, A22, W8, S14, T17)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadmill.functions import messages as M
from threadmill.functions.answers import answer_integer
from threadmill.functions.text import strip, word_count
from threadmill.operators.quality import has_target
from threadmill.operators.splits import is_holdout
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.q_traces import _SQL as TRACE_SQL
from threadmill.plans.traces import events_trace_clean
from threadmill.sources.tables import table


def _kept_traces(spark, sf_dir):
    return events_trace_clean(spark, sf_dir).where(F.col("drop_reason").isNull())


def _trace_rows_sql() -> str:
    # the trace CTEs followed by the kept rows with their completion
    head = TRACE_SQL[:TRACE_SQL.rindex(" SELECT event_id, coalesce(r0")]
    return (head + ", k AS (SELECT event_id, msgs, context, CASE WHEN thinking <> '' THEN '<think>' || chr(10) || "
            "thinking || chr(10) || '</think>' || chr(10) || response ELSE response END AS completion FROM d WHERE "
            "coalesce(r0, CASE WHEN rn > 1 THEN 'dup' END) IS NULL)")


_FIRST_USER = "coalesce(list_filter(msgs, lambda x: x.role = 'user' AND coalesce(x.content, '') <> '')[1].content, context)"


@register("trainable_two_turn", _trace_rows_sql() + " SELECT event_id, md5('<|im_start|>user' || chr(10) || "
          + S.strip(_FIRST_USER) + " || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || "
          + S.strip("completion") + " || '<|im_end|>' || chr(10)) AS text_md5 FROM k WHERE length(" + S.strip("completion")
          + ") > 16")
def trainable_two_turn(spark, sf_dir):
    """P23 + P24 + P26 + P28 + S14: non-trivial completions rebuilt as [user, assistant] and rendered."""
    k = _kept_traces(spark, sf_dir).where(has_target("completion"))
    first = F.coalesce(F.try_element_at(F.filter("messages", lambda x: (x["role"] == "user")
                                                 & (F.coalesce(x["content"], F.lit("")) != "")), F.lit(1))["content"],
                       F.col("context"))
    chat = M.two_turn(strip(first), strip("completion"))
    text = M.render_chat(chat)
    return k.select("event_id", F.md5(text).alias("text_md5"))


@register("eval_pairs", _trace_rows_sql() + " SELECT event_id, " + S.strip(_FIRST_USER) + " AS prompt, "
          + S.strip("completion") + " AS gold FROM k WHERE length(" + S.strip("completion") + ") > 16 AND "
          "('0x' || md5('C:' || substring(completion, 1, 200)))::UHUGEINT % 20 = 0")
def eval_pairs(spark, sf_dir):
    """P38 + W1: (first user, gold completion) pairs of held-out rows with a target."""
    k = _kept_traces(spark, sf_dir).where(has_target("completion"))
    k = k.where(is_holdout(F.lit(None).cast("string"), "completion"))
    first = F.coalesce(F.try_element_at(F.filter("messages", lambda x: (x["role"] == "user")
                                                 & (F.coalesce(x["content"], F.lit("")) != "")), F.lit(1))["content"],
                       F.col("context"))
    return k.select("event_id", strip(first).alias("prompt"), strip("completion").alias("gold"))


@register("allow_list", "SELECT doc_id, source FROM documents WHERE source IN ('src0', 'src2', 'src4', 'src6', 'src8')")
def allow_list(spark, sf_dir):
    """J3 + P10: membership in a fixed allow-list (broadcast left semi join; the list is bounded)."""
    allow = spark.createDataFrame([(f"src{i}",) for i in (0, 2, 4, 6, 8)], "source string")
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return d.join(F.broadcast(allow), "source", "left_semi").select("doc_id", "source")


@register("length_cap_filter", "SELECT doc_id FROM documents WHERE " + S.word_count("text") + " <= 4096")
def length_cap_filter(spark, sf_dir):
    """Drop over-length rows (token count, whitespace tokenizer by default)."""
    d = table(spark, sf_dir, "documents")
    return d.where(word_count("text") <= 4096).select("doc_id")


@register("heldout_accuracy", "WITH a AS (SELECT user_id, regexp_extract(t, '\"answer\"[\\t-\\r ]*:[\\t-\\r ]*\"?(-?[0-9]+)\"?', 1) "
          "AS k, coalesce(regexp_extract_all(t, '(-?[0-9]+)', 1)[-1], '0') AS l FROM (SELECT user_id, CASE event_id % 3 "
          "WHEN 0 THEN '{\"answer\": ' || CAST(user_id AS VARCHAR) || '}' WHEN 1 THEN 'result ' || props ELSE event_type "
          "END AS t FROM events)) SELECT round(avg(CASE WHEN (CASE WHEN k <> '' THEN k ELSE l END) = CAST(user_id AS "
          "VARCHAR) THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy, round(avg(CASE WHEN k <> '' THEN 1.0 ELSE 0.0 END), "
          "6)::DOUBLE AS format_compliance FROM a")
def heldout_accuracy(spark, sf_dir):
    """Accuracy of extracted integers against the truth, and format compliance."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 3
    t = (F.when(k == 0, F.concat(F.lit('{"answer": '), F.col("user_id").cast("string"), F.lit("}")))
         .when(k == 1, F.concat(F.lit("result "), "props")).otherwise(F.col("event_type")))
    a = e.select("user_id", answer_integer(t).alias("a"))
    return a.agg(F.round(F.avg(F.when(F.col("a.answer") == F.col("user_id").cast("string"), 1.0).otherwise(0.0)), 6)
                 .alias("accuracy"),
                 F.round(F.avg(F.when(F.col("a.format_hit"), 1.0).otherwise(0.0)), 6).alias("format_compliance"))


@register("staged_samples", "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY " + S.md5_key(42, "o_orderkey")
          + ") AS hr FROM orders), s AS (SELECT CASE WHEN hr <= 10000 THEN 1 WHEN hr <= 70000 THEN 2 + (hr - 10001) // 20000 "
          "ELSE 0 END AS stage FROM r) SELECT stage::BIGINT AS stage, count(*) AS n, sum(count(*)) OVER (ORDER BY stage = 0, stage "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cumulative FROM s GROUP BY stage")
def staged_samples(spark, sf_dir):
    """Disjoint stages (10,000 then three of 20,000 rows) in seeded hash order over the whole
    table, with the running total; stage 0 is the remainder. Borders come from one histogram."""
    from threadmill.operators.splits import staged_split
    s = staged_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", [10000, 20000, 20000, 20000])
    c = s.groupBy(F.col("stage").cast("long").alias("stage")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.col("stage") == 0, "stage").rowsBetween(Window.unboundedPreceding, 0)
    return c.select("stage", "n", F.sum("n").over(w).alias("cumulative"))


def _repr_conversations(spark, sf_dir):
    from threadmill.plans.fixtures import tagged_turns
    t = tagged_turns(spark, sf_dir)

    def lit_repr(c):
        esc = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")),
                        F.lit("\n"), F.lit("\\n"))
        return F.concat(F.lit("'"), esc, F.lit("'"))

    elem = F.concat(F.lit("{'role': "), lit_repr(F.col("role")), F.lit(", 'content': "), lit_repr(F.col("text")),
                    F.lit(", 'reasoning': None}"))
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", elem.alias("e")))).alias("_t"))
    return g.select("conv_id", F.concat(F.lit("["), F.array_join(F.transform("_t", lambda x: x["e"]), ", "),
                                        F.lit("]")).alias("messages"))


@register("repr_messages_decode", "WITH " + S.TAGGED + " SELECT conv_id, (count(*) > 0 AND NOT bool_or(role = "
          "'assistant' AND contains(text, '<think>') AND NOT contains(text, '</think>')) AND bool_or(role = 'user') AND "
          "bool_or(role = 'assistant')) AS ok, count(*) FILTER (WHERE role = 'assistant' OR coalesce(text, '') <> '' OR "
          "role IN ('user', 'system'))::BIGINT AS n_msgs FROM tagged GROUP BY conv_id")
def repr_messages_decode(spark, sf_dir):
    """P5: Python-repr message lists decoded by an Arrow UDF, then normalised natively
    (reasoning field; an embedded tag only when no reasoning; blank non-user turns dropped).
    The oracle computes the same outcome from the turns the repr text was built from."""
    from threadmill.functions.udfs import decode_repr_messages
    r = _repr_conversations(spark, sf_dir).withColumn("raw", decode_repr_messages("messages"))
    n = M.normalize_repr(r, "raw", "ok", "m")
    return n.select("conv_id", "ok", F.size("m").cast("long").alias("n_msgs"))


@register("tool_call_scrub", "WITH " + S.TRACE_META + " SELECT event_id, " + S.scrub("row_json") + " AS row_json "
          "FROM trace_meta")
def tool_call_scrub(spark, sf_dir):
    """Nested tool-call trees scrubbed leaf by leaf (keys untouched) by an Arrow UDF.
    The oracle scrubs the serialized text, which on these rows (no rule can match across
    a quote) is the same as scrubbing every leaf."""
    from threadmill.functions.scrub import scrub_json_text
    from threadmill.plans.fixtures import trace_meta
    return trace_meta(spark, sf_dir).select("event_id", scrub_json_text("row_json").alias("row_json"))


@register("rouge_l_scores")
def rouge_l_scores(spark, sf_dir):
    """ROUGE-L F1 between each assistant turn and the user turn before it (Arrow UDF)."""
    from threadmill.functions.udfs import rouge_l
    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    p = c.withColumn("prev", F.lag("text").over(w)).where((F.col("role") == "assistant") & F.col("prev").isNotNull())
    return p.select("conv_id", "turn", rouge_l("prev", "text").alias("rouge_l"))
