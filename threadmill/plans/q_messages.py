"""Registered queries over message arrays built from conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import messages as M
from threadmill.operators.quality import quality_reason
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import normalized_conversations

NORM = "WITH " + S.TAGGED + ", " + S.CONV_NORM
ROLES = "array_to_string(list_transform(m, lambda x: x.role), ',')"


def _roles(m):
    return F.array_join(F.transform(m, lambda x: x["role"]), ",")


@register("conv_normalize", NORM + " SELECT conv_id, ok, len(m)::BIGINT AS n_msgs, " + ROLES + " AS roles, "
          "m[-1].thinking AS last_thinking, m[-1].content AS last_content FROM norm")
def conv_normalize(spark, sf_dir):
    """P1 + P6 + P7: role aliases, last-assistant think split, truncated/role-less flagged."""
    n = normalized_conversations(spark, sf_dir)
    last = M.last_message("messages")
    return n.select("conv_id", "ok", F.size("messages").cast("long").alias("n_msgs"),
                    _roles("messages").alias("roles"), last["thinking"].alias("last_thinking"),
                    last["content"].alias("last_content"))


@register("quality_filter", NORM + ", r AS (SELECT conv_id, m[-1].content AS a FROM norm WHERE ok) "
          "SELECT conv_id, CASE WHEN a IS NULL OR a = '' THEN 'empty' WHEN length(a) < 50 THEN 'short' WHEN "
          + S.refusal("a") + " THEN 'refusal' END AS reason FROM r")
def quality_filter(spark, sf_dir):
    """Last message (any role) empty / shorter than 50 / refusal."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    return n.select("conv_id", quality_reason(M.last_message("messages")["content"]).alias("reason"))


@register("think_split", "WITH " + S.TAGGED + " SELECT conv_id, turn, " + S.think_trunc("text") + " AS truncated, "
          + S.think_thinking("text") + " AS thinking, " + S.think_answer("text") + " AS answer FROM tagged "
          "WHERE role = 'assistant'")
def think_split(spark, sf_dir):
    """P7 on every assistant turn: truncated / tagged / untagged outcomes."""
    from threadmill.plans.fixtures import tagged_turns
    t = tagged_turns(spark, sf_dir).where(F.col("role") == "assistant")
    sp = M.think_split("text")
    return t.select("conv_id", "turn", sp["truncated"].alias("truncated"), sp["thinking"].alias("thinking"),
                    sp["answer"].alias("answer"))


_FIRST_USER = "list_filter(m, lambda x: x.role = 'user')[1].content"


@register("first_user_prompt", NORM + " SELECT conv_id, " + _FIRST_USER + " AS first_user, "
          "len(list_filter(m, lambda x: x.role <> 'assistant'))::BIGINT AS n_prompt, "
          "list_filter(m, lambda x: x.role <> 'assistant')[-1].role AS prompt_last_role FROM norm WHERE ok")
def first_user_prompt(spark, sf_dir):
    """P24 + P25: first user text and the GRPO prompt (all non-assistant turns)."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    p = M.prompt_only("messages")
    return n.select("conv_id", M.first_user_text("messages").alias("first_user"),
                    F.size(p).cast("long").alias("n_prompt"),
                    F.try_element_at(p, F.lit(-1))["role"].alias("prompt_last_role"))


def _render_sql(expr: str) -> str:
    r = S.render_chat(expr)
    return f"md5({r}) AS text_md5, length({r})::BIGINT AS text_len"


def _render_spark(m):
    r = M.render_chat(m)
    return [F.md5(r).alias("text_md5"), F.length(r).cast("long").alias("text_len")]


@register("render_chatml", NORM + " SELECT conv_id, " + _render_sql("m") + " FROM norm WHERE ok")
def render_chatml(spark, sf_dir):
    """ChatML render of every kept conversation."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    return n.select("conv_id", *_render_spark(F.col("messages")))


_FAMILIES = ("chatml", "qwen3.5", "lfm2", "lfm2.5", "gemma4", "other")
_MARKS = "VALUES " + ", ".join(f"({S.q(n)}, " + ", ".join(S.q(x) for x in t) + ")" for n, t in M.TEMPLATES.items())
_TURN = ("coalesce(t.pre, '<|im_start|>') || CASE WHEN x.role = 'assistant' THEN coalesce(t.bot, 'assistant') ELSE x.role END || coalesce(t.sep, '\n') "
         "|| coalesce(x.content, '') || coalesce(t.suf, '<|im_end|>\n')")


@register("render_families", NORM + f", t(fam, beg, pre, sep, suf, bot) AS ({_MARKS}), "
          f"f AS (SELECT conv_id, m, [{', '.join(map(S.q, _FAMILIES))}, NULL][conv_id % 7 + 1] AS fam FROM norm WHERE ok) "
          "SELECT conv_id, f.fam AS family, md5(r) AS text_md5, length(r)::BIGINT AS text_len FROM (SELECT conv_id, fam, coalesce(t.beg, '') || "
          f"array_to_string(list_transform(m, lambda x: {_TURN}), '') AS r FROM f LEFT JOIN t USING (fam)) f")
def render_families(spark, sf_dir):
    """Every kept conversation rendered by the template of its row's family; unknown and null families too."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    family = F.get(F.array(*map(F.lit, _FAMILIES), F.lit(None)), (F.col("conv_id") % 7).cast("int"))
    r = M.render_by_family(n.select("conv_id", "messages", family.alias("fam")), "messages", "fam")
    return r.select("conv_id", F.col("fam").alias("family"), F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("text_len"))


_EMBED = ("list_transform(m, lambda x: struct_pack(role := x.role, content := CASE WHEN x.role = 'assistant' AND "
          "coalesce(x.thinking, '') <> '' THEN '<think>' || x.thinking || '</think>\n' || x.content ELSE x.content END))")


@register("adapter_embed_think", NORM + " SELECT conv_id, " + _render_sql(_EMBED) + " FROM norm WHERE ok")
def adapter_embed_think(spark, sf_dir):
    """Thinking embedded as a tag block before the assistant content, then rendered."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    return n.select("conv_id", *_render_spark(M.adapt_embed_think("messages")))


_TRIG = ("CASE WHEN len(m) = 0 OR m[1].role <> 'system' THEN list_concat([struct_pack(role := 'system', "
         "content := '<|think|>')], list_transform(m, lambda x: struct_pack(role := x.role, content := x.content))) "
         "WHEN contains(coalesce(m[1].content, ''), '<|think|>') THEN list_transform(m, lambda x: "
         "struct_pack(role := x.role, content := x.content)) ELSE list_transform(m, lambda x, i: struct_pack("
         "role := x.role, content := CASE WHEN i = 1 THEN '<|think|>\n' || coalesce(x.content, '') "
         "ELSE x.content END)) END")


@register("adapter_system_trigger", NORM + " SELECT conv_id, " + _render_sql(_TRIG) + ", "
          "len(" + _TRIG + ")::BIGINT AS n_msgs FROM norm WHERE ok")
def adapter_system_trigger(spark, sf_dir):
    """System turn carrying the think trigger (prepended or extended), thinking dropped."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    a = M.adapt_system_trigger("messages")
    return n.select("conv_id", *_render_spark(a), F.size(a).cast("long").alias("n_msgs"))


@register("adapter_reasoning_field", NORM + " SELECT conv_id, len(list_filter(m, lambda x: x.role = 'assistant' "
          "AND coalesce(x.thinking, '') <> ''))::BIGINT AS n_reasoning, " + _render_sql("m") + " FROM norm WHERE ok")
def adapter_reasoning_field(spark, sf_dir):
    """P27a + P27d: thinking moved to reasoning_content (count) / dropped (render unchanged)."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    a = M.adapt_reasoning_field("messages")
    d = M.adapt_drop_thinking("messages")
    return n.select("conv_id", F.size(F.filter(a, lambda x: x["reasoning_content"].isNotNull()))
                    .cast("long").alias("n_reasoning"), *_render_spark(d))


_SPANS = ("list_filter(list_transform(m, lambda x, i: struct_pack(role := x.role, s := "
          "coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda y: 24 + length(y.role) + "
          "length(coalesce(y.content, '')))), 0) + 13 + length(x.role), len := length(coalesce(x.content, '')))), "
          "lambda z: z.role = 'assistant')")


@register("assistant_spans", NORM + ", sp2 AS (SELECT conv_id, m, " + _SPANS + " AS spans FROM norm WHERE ok) "
          "SELECT conv_id, len(spans)::BIGINT AS n_spans, coalesce(list_sum(list_transform(spans, lambda z: z.len)), 0)"
          "::BIGINT AS trainable, list_sum(list_transform(spans, lambda z: z.s))::BIGINT AS start_sum, "
          "round(coalesce(list_sum(list_transform(spans, lambda z: z.len)), 0) / length(" + S.render_chat("m")
          + "), 6) AS share FROM sp2")
def assistant_spans(spark, sf_dir):
    """Assistant character spans in the rendered chat, trainable share."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    sp = M.assistant_spans("messages")
    lens = F.transform(sp, lambda z: z["end"] - z["start"])
    total = F.aggregate(lens, F.lit(0).cast("long"), lambda a, b: a + b)
    return n.select("conv_id", F.size(sp).cast("long").alias("n_spans"), total.alias("trainable"),
                    F.aggregate(F.transform(sp, lambda z: z["start"]), F.lit(0).cast("long"),
                                lambda a, b: a + b).alias("start_sum"),
                    F.round(total / F.length(M.render_chat("messages")), 6).alias("share"))


@register("turn_stats", NORM + " SELECT count(*) AS n_conv, round(avg(len(m)), 6) AS avg_turns, "
          "min(len(m))::BIGINT AS min_turns, max(len(m))::BIGINT AS max_turns, "
          "sum(len(list_filter(m, lambda x: x.role = 'assistant')))::BIGINT AS asst_turns, "
          "sum(len(list_filter(m, lambda x: x.role = 'assistant' AND coalesce(x.thinking, '') <> '')))::BIGINT "
          "AS thinking_turns, round(avg(CASE WHEN m[-1].thinking IS NOT NULL THEN 1 ELSE 0 END), 6) AS share_last, "
          "round(avg(CASE WHEN list_bool_or(list_transform(m, lambda x: x.role = 'assistant' AND "
          "coalesce(x.thinking, '') <> '')) THEN 1 ELSE 0 END), 6) AS share_any FROM norm WHERE ok")
def turn_stats(spark, sf_dir):
    """A2 + A3: turn counts and thinking coverage (last-message and any-assistant definitions)."""
    n = normalized_conversations(spark, sf_dir).where("ok")
    m = F.col("messages")
    asst = F.size(F.filter(m, lambda x: x["role"] == "assistant"))
    think = F.size(F.filter(m, lambda x: (x["role"] == "assistant") & (F.coalesce(x["thinking"], F.lit("")) != "")))
    return n.agg(F.count(F.lit(1)).alias("n_conv"), F.round(F.avg(F.size(m)), 6).alias("avg_turns"),
                 F.min(F.size(m)).cast("long").alias("min_turns"), F.max(F.size(m)).cast("long").alias("max_turns"),
                 F.sum(asst).cast("long").alias("asst_turns"), F.sum(think).cast("long").alias("thinking_turns"),
                 F.round(F.avg(M.has_thinking_last(m).cast("int")), 6).alias("share_last"),
                 F.round(F.avg(M.has_thinking_any(m).cast("int")), 6).alias("share_any"))
