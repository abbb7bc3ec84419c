"""Corpus statistics and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.functions.scrub import PREAMBLE_TEXT
from threadmill.functions.text import ColumnOrName, ascii_share, col
from threadmill.operators.splits import first_n_per_group
from threadmill.session import materialize


def count_share(df: DataFrame, key: str, out_key: str | None = None) -> DataFrame:
    """A1: rows per key and share of all rows, descending (L1). The share's denominator
    is a window over the aggregated table (one row per key), not over the data."""
    c = df.groupBy(F.col(key).alias(out_key or key)).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


def length_stats(df: DataFrame, length: ColumnOrName, limits: tuple[int, ...] = (2048, 4096)) -> DataFrame:
    """Min, floor(avg), max, exact median/P95/P99 (linear interpolation, as numpy),
    sequence cap P99 + 16 (A5), integer median (A6), count and share above each limit."""
    x = col(length)
    q = F.percentile(x, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))   # one state for all quantiles
    aggs = [F.min(x).cast("long").alias("min_len"), F.floor(F.avg(x)).cast("long").alias("avg_len"),
            F.max(x).cast("long").alias("max_len"),
            F.round(q[0], 6).alias("median"), F.round(q[1], 6).alias("p95"), F.round(q[2], 6).alias("p99"),
            (q[2].cast("long") + 16).alias("seq_cap"), q[0].cast("long").alias("median_int")]
    for lim in limits:
        aggs.append(F.count_if(x > lim).alias(f"over_{lim}"))
        aggs.append(F.round(F.count_if(x > lim) / F.count(F.lit(1)), 6).alias(f"share_over_{lim}"))
    return df.agg(*aggs)


# Markers, the synthetic opener and the KEEP gate; the reference's audit
# reads the first rows of a source only, and a prefix of rows of unknown shape.
AUDIT_SAMPLE = 2000
AUDIT_CHARS = 4000
AGENTIC_MARKERS = ["tool_calls", '"Bash"', '"Read"', '"Edit"', '"Write"', "sessionId",
                   "<think>", "reasoning_content", "[Tool:", "[tool:"]
LARP = PREAMBLE_TEXT  # the synthetic corpus opener
RESPONSE_KEYS = ["output", "response", "completion", "solution", "content", "text"]


def with_audit_response(df: DataFrame, json_col: str, max_chars: int | None = None) -> DataFrame:
    """Adds ``t`` (text), ``mk`` (marker), ``fmt`` for one raw row: longest assistant
    content of a ``messages`` list (else the last message as JSON text), else
    ``thinking``, else the first non-empty of six keys, else the raw text, whole or its
    first ``max_chars``. The JSON is parsed once per row into staged columns."""
    rj = F.col(json_col)

    def cut(c):
        return c if max_chars is None else F.substring(c, 1, max_chars)

    marker = F.lit(False)
    for m in AGENTIC_MARKERS:
        marker = marker | F.contains(rj, F.lit(m))
    d = df.withColumn("_v", F.try_parse_json(rj)).withColumn("_mk0", marker)
    d = d.withColumn("_obj", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    d = d.withColumn("_msgs", F.from_json(rj, "struct<messages:array<string>>")["messages"])
    d = d.withColumn("_has_msgs", F.col("_obj") & F.coalesce(F.size("_msgs") > 0, F.lit(False)))
    parsed = F.transform("_msgs", lambda e: F.from_json(e, "struct<role:string,content:string>"))
    contents = F.transform(F.filter(parsed, lambda m: m["role"] == "assistant"),
                           lambda m: F.coalesce(m["content"], F.lit("")))
    longest = F.aggregate(contents, F.lit(""), lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a))
    d = d.withColumn("_long", F.when(F.col("_has_msgs"), longest))
    keyed = F.coalesce(*[F.when(F.coalesce(F.try_variant_get("_v", f"$.{k}", "string"), F.lit("")) != "",
                                F.struct(F.try_variant_get("_v", f"$.{k}", "string").alias("t"), F.lit(k).alias("f")))
                         for k in RESPONSE_KEYS])
    d = d.withColumn("_keyed", F.when(F.col("_obj"), keyed))
    d = d.withColumn("_think", F.when(F.col("_obj") & F.try_variant_get("_v", "$.thinking", "variant").isNotNull(),
                                      F.coalesce(F.try_variant_get("_v", "$.thinking", "string"), F.lit(""))))
    # a session-style row: its ``message`` value as JSON text (compact JSON, not Python's spacing)
    d = d.withColumn("_sess", F.when(F.col("_obj") & F.try_variant_get("_v", "$.message", "variant").isNotNull(),
                                     cut(F.to_json(F.try_variant_get("_v", "$.message", "variant")))))
    raw = cut(rj)
    from_msgs = F.when(F.col("_long") != "", F.col("_long")).otherwise(F.try_element_at("_msgs", F.lit(-1)))
    t = (F.when(F.col("_v").isNull(), raw).when(F.col("_has_msgs"), from_msgs)
         .when(F.col("_think").isNotNull(), F.col("_think"))
         .when(F.col("_keyed").isNotNull(), F.col("_keyed.t"))
         .when(F.col("_sess").isNotNull(), F.col("_sess")).otherwise(raw))
    fmt = (F.when(F.col("_v").isNull(), "raw").when(F.col("_has_msgs"), "messages")
           .when(F.col("_think").isNotNull(), "thinking")
           .when(F.col("_keyed").isNotNull(), F.col("_keyed.f"))
           .when(F.col("_sess").isNotNull(), "session").otherwise("other"))
    mk = F.when(F.col("_think").isNotNull() & ~F.col("_has_msgs"), F.lit(True)).otherwise(F.col("_mk0"))
    return (d.withColumn("t", t).withColumn("mk", mk).withColumn("fmt", fmt)
            .drop("_v", "_mk0", "_obj", "_msgs", "_has_msgs", "_long", "_keyed", "_think", "_sess"))


def source_audit(rows: DataFrame, source_col: str, id_col: str, json_col: str,
                 sample: int | None = None, max_chars: int | None = None) -> DataFrame:
    """Per-source genuineness profile over all rows of each source and the KEEP/DROP
    gate. ``sample`` and ``max_chars`` give the reference's form: the first ``sample`` ids
    of a source, and a prefix of rows of unknown shape."""
    s = rows.select(source_col, id_col, json_col)
    if sample is not None:
        s = first_n_per_group(s, source_col, id_col, sample)
    s = with_audit_response(s, json_col, max_chars)
    # stage boundary: one narrow row per input row (hashes, length, flags), read by two passes
    s = materialize(s.select(
        F.col(source_col).alias("_src"), F.md5("t").alias("_t"),
        F.when(F.col("t") != "", F.md5(F.substring("t", 1, 120))).alias("pfx"), F.length("t").alias("len"),
        (ascii_share("t") >= 0.9).alias("eng"), "mk", F.contains("t", F.lit(LARP)).alias("larp"),
        (F.col("fmt") == "messages").alias("hm")), "audit_rows")
    # equal texts share a prefix, so the distinct counts per prefix add up
    by_pfx = (s.groupBy("_src", "pfx", "_t").agg(F.count(F.lit(1)).alias("c"))
              .groupBy("_src", "pfx").agg(F.sum("c").alias("c"), F.count("_t").alias("n_uniq"))
              .groupBy(F.col("_src").alias("_psrc"))
              .agg(F.sum("n_uniq").alias("n_uniq"), F.max(F.when(F.col("pfx").isNotNull(), F.col("c"))).alias("top_c")))
    # the upper median: the lower one of the lengths in descending order
    per = s.groupBy("_src").agg(
        F.count(F.lit(1)).alias("m"), F.count_if("eng").alias("n_eng"), F.count_if("mk").alias("n_marker"),
        F.count_if("larp").alias("n_larp"), F.bool_or("hm").alias("has_messages_fmt"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY len DESC)").alias("mlen"))
    per = per.join(by_pfx, F.col("_src").eqNullSafe(F.col("_psrc"))).withColumnRenamed("_src", source_col)
    m = F.col("m")
    out = per.select(
        source_col, m.cast("long").alias("m"),
        F.round(F.col("n_eng") / m, 6).alias("eng"),
        F.round(F.coalesce(F.col("top_c") / m, F.lit(1.0)), 6).alias("pfx_top"),
        F.round(F.col("n_uniq") / m, 6).alias("uniq"),
        F.round(F.col("n_marker") / m, 6).alias("agen"),
        F.col("mlen").cast("long").alias("mlen"),
        F.round(F.col("n_larp") / m, 6).alias("larp"), "has_messages_fmt")
    ok = ((F.col("eng") >= 0.8) & (F.col("pfx_top") <= 0.15) & (F.col("uniq") >= 0.6) & (F.col("larp") <= 0.02)
          & ((F.col("agen") >= 0.3) | (F.col("mlen") >= 800)))
    patch = ok & (F.col("agen") < 0.05) & (F.col("mlen") >= 800) & ~F.col("has_messages_fmt")
    verdict = F.when(patch, "DROP(non-agentic)").when(ok, "KEEP").otherwise("DROP")
    return out.withColumn("verdict", verdict).drop("has_messages_fmt")


def assertion_suite(sft: DataFrame, messages: str = "messages") -> DataFrame:
    """The publish checks as rows ``(check, violations, passed)`` over all rows.

    One aggregation pass for the per-row checks; user-prompt uniqueness counts all user
    turns (as the reference does), via explode + distinct count.
    """
    m = F.col(messages)
    roles = F.transform(m, lambda x: x["role"])
    last = F.try_element_at(m, F.lit(-1))
    prompt = F.filter(m, lambda x: x["role"] != "assistant")
    per_row = sft.agg(
        F.count_if(~F.array_contains(roles, "user")).alias("has_user"),
        F.count_if(~F.array_contains(roles, "assistant")).alias("has_assistant"),
        F.count_if(F.coalesce(last["role"], F.lit("")) != "assistant").alias("last_is_assistant"),
        F.count_if(F.length(F.coalesce(last["content"], F.lit(""))) < 50).alias("min_answer_len"),
        F.count_if(F.coalesce(F.try_element_at(prompt, F.lit(-1))["role"], F.lit("")) != "user")
        .alias("grpo_last_user"),
        F.count_if(F.exists(prompt, lambda x: x["role"] == "assistant")).alias("grpo_no_assistant"))
    users = sft.select(F.explode(F.filter(m, lambda x: x["role"] == "user")).alias("u"))
    uniq = users.agg((F.count(F.lit(1)) - F.count_distinct("u.content")).alias("unique_user_prompts"))
    checks = ["has_user", "has_assistant", "last_is_assistant", "min_answer_len", "grpo_last_user",
              "grpo_no_assistant"]
    rows = per_row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("violations"))
                                             for c in checks])).alias("r")).select("r.*")
    u = uniq.select(F.lit("unique_user_prompts").alias("check"), F.col("unique_user_prompts").alias("violations"))
    out = rows.unionByName(u)
    return out.withColumn("passed", F.col("violations") == 0)
