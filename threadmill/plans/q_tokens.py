"""Registered queries with a tokenizer: label mask and zero-signal gate (P33), lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import messages as M
from threadmill.functions import tokens as K
from threadmill.operators import stats as ST
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import conversation_messages
from threadmill.sources.tables import table

#: The vocabulary that the queries use, by name in the installed set of public tokenizers.
VOCABULARY = "byte_bpe_50k.json"


def _vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(VOCABULARY))


def _rendered(spark, sf_dir):
    """Every conversation as ChatML text with its assistant spans; the assistant turns of each
    tenth conversation come from a tool, so that nothing in it is trainable."""
    c = table(spark, sf_dir, "conversations")
    role = F.when((F.col("role") == "assistant") & (F.col("conv_id") % 10 == 0), "tool").otherwise(F.col("role"))
    m = conversation_messages(c.select("conv_id", "turn", role.alias("role"), "text"))
    return m.select("conv_id", M.render_chat("messages").alias("text"), M.assistant_spans("messages").alias("spans"))


_COUNT = "len(regexp_extract_all({t}, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\x20\\x09-\\x0D]'))"


@register("label_mask", "WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' AND conv_id % 10 = 0 THEN 'tool' ELSE role END AS role, "
          "coalesce(text, '') AS text FROM conversations), "
          "r AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS t, "
          "sum(CASE WHEN role = 'assistant' THEN " + _COUNT.format(t="text") + " ELSE 0 END)::BIGINT AS n_trainable FROM c GROUP BY conv_id) "
          "SELECT conv_id, " + _COUNT.format(t="t") + "::BIGINT AS n_tokens, n_trainable, n_trainable AS n_labels, "
          "CASE WHEN n_trainable = 0 THEN 'zero_signal' END AS drop_reason FROM r")
def label_mask(spark, sf_dir):
    """Labels of the rendered conversations (basic tokenizer), and the rows a loss cannot use."""
    d = K.label_rows(_rendered(spark, sf_dir), "text", "spans")
    n = F.size(F.filter("labels", lambda x: x != K.IGNORED)).cast("long")
    return d.select("conv_id", "n_tokens", "n_trainable", n.alias("n_labels"), "drop_reason")


@register("label_mask_bpe")
def label_mask_bpe(spark, sf_dir):
    """P33 with a byte-level vocabulary: ids, labels and drop reasons of every conversation."""
    d = K.label_rows(_rendered(spark, sf_dir), "text", "spans", _vocabulary())
    return d.select("conv_id", "n_tokens", "n_trainable", "input_ids", "labels", "drop_reason")


@register("token_length_stats")
def token_length_stats(spark, sf_dir):
    """A4 + A5 + A6 in tokens of a byte-level vocabulary, over every whole document."""
    d = table(spark, sf_dir, "documents").select(K.token_count("text", _vocabulary()).alias("x"))
    return ST.length_stats(d, "x")


@register("token_length_cap")
def token_length_cap(spark, sf_dir):
    """P39 in tokens: count and verdict of every document."""
    d = table(spark, sf_dir, "documents").select("doc_id", K.token_count("text", _vocabulary()).alias("n_tokens"))
    return d.select("doc_id", "n_tokens", (F.col("n_tokens") <= 4096).alias("kept"))
