"""Trace clean over embedded-JSON rows (entry 2 of the reference).

scan -> source allow-list (P10/J3) -> JSON parse (S5) -> decoy drop -> format routing (P37)
-> message reduction (P13/P14) -> assistant gate (P34) -> context/completion/classes
(P15-P18) -> signature dedup (D1b) -> one drop reason per row (P21).

All steps before the dedup are narrow expressions over one row; the dedup is one
partial aggregation plus a join on the unique row id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.functions import messages as M
from threadmill.functions.scrub import scrub_columns
from threadmill.functions.text import nz
from threadmill.operators.dedup import flag_first_seen, signature_key
from threadmill.session import materialize

# Reference defaults for the keep-set and decoy rule are repository names of its
# corpora; callers pass their own source values.
DECOY_CATEGORY = "decoy"
# The reference compares these prefixes of context and response.
TRACE_PREFIX = (1000, 500)


def _field(v, name: str):
    return F.try_variant_get(v, f"$.{name}", "string")


def clean_traces(rows: DataFrame, id_col: str, keep_sources: list[str], decoy_source: str | None,
                 prefix: tuple[int, int] | None = None) -> DataFrame:
    """``rows``: (id, first_source_dataset, row_json). Returns every kept-source row with
    ``drop_reason`` and, for kept rows, the clean trace columns. Duplicates agree in the whole
    context and response, or with ``prefix`` in their first characters (``TRACE_PREFIX``)."""
    d = rows.where(F.col("first_source_dataset").isin(keep_sources))
    d = d.withColumn("_v", F.try_parse_json("row_json"))
    is_obj = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    d = d.withColumn("_obj", is_obj)
    decoy = (F.col("first_source_dataset") == F.lit(decoy_source)) & (_field("_v", "category") == DECOY_CATEGORY) \
        if decoy_source is not None else F.lit(False)
    d = d.withColumn("_decoy", F.coalesce(decoy, F.lit(False)))
    raw = F.from_json("row_json", "struct<messages:array<string>>")["messages"]
    d = d.withColumn("_raw", raw)
    has_msgs = F.coalesce(F.size("_raw") > 0, F.lit(False))
    has_qt = _field("_v", "thinking").isNotNull() | _field("_v", "query").isNotNull()
    d = d.withColumn("_fmt", F.when(has_msgs, "messages").when(has_qt, "thinking").otherwise("prompt"))
    # messages route
    d = M.reduce_trace(d.withColumn("_raw", F.when(F.col("_fmt") == "messages", F.col("_raw"))), "_raw", "_red")
    # query/thinking and prompt/response routes: pick the raw fields per format first,
    # then scrub each of user / response / thinking once
    is_qt, is_pr = F.col("_fmt") == "thinking", F.col("_fmt") == "prompt"
    raw_user = (F.when(is_qt, _field("_v", "query"))
                .when(is_pr, F.coalesce(_field("_v", "prompt"), _field("_v", "instruction"),
                                        _field("_v", "user_prompt"))))
    raw_resp = (F.when(is_qt, F.coalesce(_field("_v", "response"), _field("_v", "solution")))
                .when(is_pr, F.coalesce(_field("_v", "response"), _field("_v", "output"), _field("_v", "solution"),
                                        _field("_v", "completion"))))
    raw_think = F.when(is_qt, _field("_v", "thinking"))
    d = scrub_columns(d, {"_qu": raw_user, "_qr": raw_resp, "_qth": raw_think})
    d = d.withColumn("_q", F.struct(F.col("_qu").alias("u"), F.col("_qr").alias("r"), F.col("_qth").alias("th")))
    d = d.drop("_qu", "_qr", "_qth")
    null_tc = F.lit(None).cast("string")

    def turn(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"), null_tc.alias("parts"), null_tc.alias("tool_calls"))

    qx = F.col("_q")
    msgs = (F.when(F.col("_fmt") == "messages", F.col("_red_messages"))
            .when(is_qt, F.array(turn("user", qx["u"]), turn("assistant", F.coalesce(nz(qx["r"]), qx["th"]))))
            .otherwise(F.array(turn("user", qx["u"]), turn("assistant", qx["r"]))))
    thinking = (F.when(F.col("_fmt") == "messages", F.col("_red_thinking"))
                .when(is_qt, qx["th"]).otherwise(F.lit("")))
    response = F.when(F.col("_fmt") == "messages", F.col("_red_response")).otherwise(qx["r"])
    otype = F.when(F.col("_fmt") == "messages", F.col("_red_output_type")).otherwise(F.lit("text"))
    d = d.select("*", msgs.alias("messages"), thinking.alias("thinking"), response.alias("response"),
                 otype.alias("_otype0"))
    empty_pr = (F.col("_fmt") == "prompt") & (qx["u"] == "") & (qx["r"] == "")
    reason = (F.when(F.col("_v").isNull(), "noparse")
              .when(~F.col("_obj"), "empty")
              .when(F.col("_decoy"), "decoy")
              .when(empty_pr, "empty")
              .when(~M.has_assistant_output("messages"), "empty"))
    d = d.withColumn("drop_reason", reason)
    d = d.withColumn("output_type", F.when((F.col("_otype0") != "tool_use") & M.inline_tool_marker("messages"),
                                           "tool_use").otherwise(F.col("_otype0")))
    d = d.withColumn("context", M.render_context("messages"))
    d = d.withColumn("completion", M.build_completion("thinking", "response"))
    d = (d.withColumn("cot_length", F.length("thinking"))
         .withColumn("context_length", F.length("context"))
         .withColumn("response_length", F.length("response"))
         .withColumn("task_type", M.task_type("cot_length", "output_type")))
    d = d.withColumn("_sig", signature_key("context", "response", prefix))
    keep = [c for c in d.columns if c not in ("_v", "_raw", "_red_messages", "_red_thinking", "_red_response",
                                              "_red_output_type", "_q")]
    # stage boundary: every row-level step is done once and written to the shared
    # checkpoint folder; the dedup reads it twice (keys for the winners, rows for the flag)
    d = materialize(d.select(*keep), "trace_rows")
    d = flag_first_seen(d, F.col("_sig"), [id_col], "_first", eligible=F.col("drop_reason").isNull())
    d = d.withColumn("drop_reason", F.coalesce("drop_reason", F.when(~F.col("_first"), F.lit("dup"))))
    return d.drop("_obj", "_decoy", "_fmt", "_otype0", "_first", "_sig")


def events_trace_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadmill.plans.fixtures import trace_meta
    return clean_traces(trace_meta(spark, sf_dir), "event_id", ["click", "view", "purchase", "error"], "click")
