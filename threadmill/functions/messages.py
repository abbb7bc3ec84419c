"""Message arrays: normalisation, think-tag handling, adapters and rendering.

A conversation is ``array<struct<role:string, content:string, thinking:string>>``.
Every function is a Column expression over the whole array (``transform``,
``filter``, ``aggregate``), so a conversation is processed inside one row, with no
explode/regroup shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions.scrub import scrub_guarded, scrub_json_texts
from threadmill.functions.text import ColumnOrName, col, first_nonempty, nz, strip

MSG_TYPE = "array<struct<role:string,content:string,thinking:string>>"

# Role aliases (unknown roles are kept lower-cased).
ROLE_ALIASES = {"human": "user", "user": "user", "system": "system",
                "assistant": "assistant", "gpt": "assistant", "bot": "assistant"}

THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
_THINK_RE = r"(?s)<think>(.*?)</think>(.*)"

COT_REASONING_THRESHOLD = 450  # fixed value: CoT characters above which a trace is "reasoning"


def msg(role: Column, content: Column, thinking: Column | None = None) -> Column:
    return F.struct(role.alias("role"), content.alias("content"),
                    (thinking if thinking is not None else F.lit(None).cast("string")).alias("thinking"))


def canonical_role(raw: Column) -> Column:
    """Alias map over the lower-cased role."""
    low = F.lower(F.coalesce(raw, F.lit("")))
    out = None
    for k, v in ROLE_ALIASES.items():
        out = F.when(low == k, F.lit(v)) if out is None else out.when(low == k, F.lit(v))
    return out.otherwise(low)


# ---------------------------------------------------------------------------
# P7 think split
# ---------------------------------------------------------------------------

def think_truncated(text: ColumnOrName) -> Column:
    """Open tag without a closing tag anywhere: the sample must be dropped."""
    t = col(text)
    return F.contains(t, F.lit(THINK_OPEN)) & ~F.contains(t, F.lit(THINK_CLOSE))


def think_split(text: ColumnOrName) -> Column:
    """``struct(truncated, thinking, answer)``.

    truncated -> (true, null, null); tag block found -> (false, stripped block or
    null if empty, stripped text after the block); no block -> (false, null, stripped text).
    """
    t = F.coalesce(col(text), F.lit(""))
    found = t.rlike(r"(?s)<think>.*?</think>")
    inner = strip(F.regexp_extract(t, _THINK_RE, 1))
    tail = strip(F.regexp_extract(t, _THINK_RE, 2))
    trunc = think_truncated(t)
    return F.struct(
        trunc.alias("truncated"),
        F.when(~trunc & found, nz(inner)).alias("thinking"),
        F.when(trunc, F.lit(None).cast("string")).when(found, tail).otherwise(strip(t)).alias("answer"),
    )


# ---------------------------------------------------------------------------
# Normalisers (P4, P6, P8): return struct(ok, messages)
# ---------------------------------------------------------------------------

def _has_roles(m: Column) -> Column:
    return F.exists(m, lambda x: x["role"] == "user") & F.exists(m, lambda x: x["role"] == "assistant")


TURN_FIELDS = ("role", "from", "content", "value", "thinking", "reasoning_content")


def element_fields(df: DataFrame, column: str) -> list[str]:
    """The field names of a column of turns, known when the plan is made."""
    return df.schema[column].dataType.elementType.fieldNames()


def _pick(x: Column, fields, *names: str) -> Column:
    present = [x[n] for n in names if n in fields]
    return first_nonempty(*present) if present else F.lit(None).cast("string")


def normalize_thinking_field(raw: ColumnOrName, fields=TURN_FIELDS) -> Column:
    """Messages carrying a separate thinking field; an embedded tag overrides it.

    ``raw`` elements have any of ``TURN_FIELDS``; ``fields`` names those that are there
    (``element_fields``), the others count as null. Returns ``struct(ok, messages)``; ok is false for truncated tags or a missing role.
    """
    r = col(raw)

    def one(x):
        role = canonical_role(_pick(x, fields, "role", "from"))
        content = F.coalesce(_pick(x, fields, "content", "value"), F.lit(""))
        thinking = _pick(x, fields, "thinking", "reasoning_content")
        sp = think_split(content)
        has_tag = F.contains(content, F.lit(THINK_OPEN))
        a_think = F.when(has_tag & sp["thinking"].isNotNull(), sp["thinking"]).otherwise(thinking)
        a_content = F.when(has_tag, F.coalesce(nz(sp["answer"]), content)).otherwise(content)
        is_a = role == "assistant"
        return F.struct(
            F.when(is_a, F.lit("assistant")).otherwise(role).alias("role"),
            F.when(is_a, strip(a_content)).otherwise(content).alias("content"),
            F.when(is_a & a_think.isNotNull(), strip(a_think)).alias("thinking"),
            (is_a & has_tag & ~F.contains(content, F.lit(THINK_CLOSE))).alias("_trunc"),
        )

    m = F.transform(r, one)
    ok = (F.size(r) > 0) & ~F.exists(m, lambda x: x["_trunc"]) & _has_roles(m)
    clean = F.transform(m, lambda x: msg(x["role"], x["content"], x["thinking"]))
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), clean.alias("messages"))


def normalize_conversations(df: DataFrame, raw: str, out_ok: str = "ok",
                            out_messages: str = "messages") -> DataFrame:
    """``conversations`` turns; think tags are read from the last assistant turn only.

    No lambda refers to a per-row value outside its element: the rewritten last
    assistant turn is spliced in with ``slice``/``concat``. (Catalyst may inline a
    staged column into a lambda body, which would re-evaluate it per element.) The
    ``ok`` flag depends only on the canonical roles and the one think split, so a
    pushed-down ``where(ok)`` stays cheap.
    """
    fields = element_fields(df, raw)
    base = F.transform(F.col(raw), lambda x: msg(canonical_role(_pick(x, fields, "role", "from")),
                                                 F.coalesce(_pick(x, fields, "content", "value"), F.lit(""))))
    d = df.withColumn("_base", base).withColumn("_n_raw", F.coalesce(F.size(raw), F.lit(0)))
    d = d.withColumn("_last", F.aggregate(
        F.transform("_base", lambda x, i: F.when(x["role"] == "assistant", i).otherwise(-1)),
        F.lit(-1), lambda a, b: F.greatest(a, b)))
    d = d.withColumn("_sp", think_split(F.try_element_at("_base", F.greatest(F.col("_last") + 1, F.lit(1)))["content"]))
    last, sp, n = F.col("_last"), F.col("_sp"), F.size("_base")
    new_last = msg(F.lit("assistant"), F.coalesce(sp["answer"], F.lit("")), sp["thinking"])
    spliced = F.concat(F.slice("_base", F.lit(1), F.greatest(last, F.lit(0))), F.array(new_last),
                       F.slice("_base", last + 2, F.greatest(n - last - 1, F.lit(0))))
    d = d.withColumn(out_messages, F.when(last >= 0, spliced).otherwise(F.col("_base")))
    trunc = (last >= 0) & F.coalesce(sp["truncated"], F.lit(False))
    ok = (F.col("_n_raw") > 0) & ~trunc & _has_roles(F.col("_base"))
    return d.withColumn(out_ok, F.coalesce(ok, F.lit(False))).drop("_base", "_n_raw", "_last", "_sp")


def normalize_repr(df: DataFrame, raw: str, out_ok: str = "ok", out_messages: str = "messages") -> DataFrame:
    """P5 after decoding: turns with a reasoning field, an embedded tag read only where that
    is empty; blank turns of other roles are dropped."""
    fields = element_fields(df, raw)

    def one(x):
        role = canonical_role(_pick(x, fields, "role", "from"))
        content = F.coalesce(_pick(x, fields, "content", "value"), F.lit(""))
        reasoning = _pick(x, fields, "reasoning", "thinking")
        sp = think_split(content)
        use_tag = reasoning.isNull() & F.contains(content, F.lit(THINK_OPEN))
        is_a = role == "assistant"
        return F.struct(
            F.when(is_a, "assistant").otherwise(role).alias("role"),
            F.when(is_a, strip(F.when(use_tag, F.coalesce(nz(sp["answer"]), content)).otherwise(content)))
            .otherwise(content).alias("content"),
            F.when(is_a, F.when(use_tag, sp["thinking"]).otherwise(strip(reasoning))).alias("thinking"),
            (is_a & use_tag & sp["truncated"]).alias("_trunc"),
            (is_a | (content != "") | role.isin("user", "system")).alias("_keep"))

    d = df.withColumn("_m", F.transform(raw, one))
    d = d.withColumn("_trunc", F.exists("_m", lambda x: x["_trunc"])).withColumn("_m", F.filter("_m", lambda x: x["_keep"]))
    ok = (F.coalesce(F.size("_m"), F.lit(0)) > 0) & ~F.coalesce("_trunc", F.lit(True)) & _has_roles(F.col("_m"))
    clean = F.transform("_m", lambda x: msg(x["role"], x["content"], x["thinking"]))
    return d.withColumn(out_ok, F.coalesce(ok, F.lit(False))).withColumn(out_messages, clean).drop("_m", "_trunc")


def from_flat(user: ColumnOrName, answer: ColumnOrName, thinking: ColumnOrName | None = None,
              system: ColumnOrName | None = None) -> Column:
    """P2 + P8: flat triple -> struct(ok, messages); optional system turn first.

    ``user`` / ``answer`` / ``thinking`` / ``system`` are already coalesced over the
    name variants (``first_nonempty``). An embedded tag in the answer overrides thinking.
    """
    u, a = F.coalesce(col(user), F.lit("")), F.coalesce(col(answer), F.lit(""))
    th = col(thinking) if thinking is not None else F.lit(None).cast("string")
    sp = think_split(a)
    has_tag = F.contains(F.coalesce(a, F.lit("")), F.lit(THINK_OPEN))
    th2 = F.when(has_tag & sp["thinking"].isNotNull(), sp["thinking"]).otherwise(th)
    a2 = F.when(has_tag, F.coalesce(nz(sp["answer"]), a)).otherwise(a)
    turns = [msg(F.lit("user"), strip(u)),
             msg(F.lit("assistant"), strip(a2), F.when(nz(th2).isNotNull(), strip(th2)))]
    if system is not None:
        sys_msg = F.when(nz(col(system)).isNotNull(), msg(F.lit("system"), col(system)))
        arr = F.filter(F.array(sys_msg, *turns), lambda x: x.isNotNull())
    else:
        arr = F.array(*turns)
    ok = nz(u).isNotNull() & nz(a).isNotNull() & ~(has_tag & sp["truncated"])
    return F.struct(ok.alias("ok"), arr.alias("messages"))


# ---------------------------------------------------------------------------
# Projections over message arrays
# ---------------------------------------------------------------------------

def first_user_text(m: ColumnOrName) -> Column:
    """Content of the first user turn (null if none)."""
    return F.try_element_at(F.filter(col(m), lambda x: x["role"] == "user"), F.lit(1))["content"]


def last_message(m: ColumnOrName) -> Column:
    return F.try_element_at(col(m), F.lit(-1))


def prompt_only(m: ColumnOrName) -> Column:
    """P25: every non-assistant turn (GRPO prompt)."""
    return F.filter(col(m), lambda x: x["role"] != "assistant")


def two_turn(user: ColumnOrName, completion: ColumnOrName) -> Column:
    """P26 / P27e: [user, assistant] rebuilt from two texts."""
    return F.array(msg(F.lit("user"), col(user)), msg(F.lit("assistant"), col(completion)))


def has_thinking_last(m: ColumnOrName) -> Column:
    """A2 (card definition): last message has non-null thinking."""
    return last_message(m)["thinking"].isNotNull()


def has_thinking_any(m: ColumnOrName) -> Column:
    """A2 (notebook definition): some assistant turn has non-empty thinking."""
    return F.exists(col(m), lambda x: (x["role"] == "assistant") & (F.coalesce(x["thinking"], F.lit("")) != ""))


# ---------------------------------------------------------------------------
# Adapters (P27) and rendering
# ---------------------------------------------------------------------------

THINK_TRIGGER = "<|think|>"  # fixed value: system-prompt trigger token


def adapt_embed_think(m: ColumnOrName) -> Column:
    """Assistant content becomes ``<think>{thinking}</think>\\n{content}`` when thinking is set."""
    return F.transform(col(m), lambda x: msg(
        x["role"],
        F.when((x["role"] == "assistant") & (nz(x["thinking"]).isNotNull()),
               F.concat(F.lit(THINK_OPEN), x["thinking"], F.lit(THINK_CLOSE + "\n"), x["content"]))
        .otherwise(x["content"])))


def adapt_reasoning_field(m: ColumnOrName) -> Column:
    """Thinking moves to ``reasoning_content`` on assistant turns, dropped elsewhere."""
    return F.transform(col(m), lambda x: F.struct(
        x["role"].alias("role"), x["content"].alias("content"),
        F.when((x["role"] == "assistant") & (nz(x["thinking"]).isNotNull()), x["thinking"])
        .alias("reasoning_content")))


def adapt_system_trigger(m: ColumnOrName) -> Column:
    """Make sure a system turn carries the think trigger; thinking dropped."""
    m = col(m)
    first = F.try_element_at(m, F.lit(1))
    plain = F.transform(m, lambda x: msg(x["role"], x["content"]))
    prepend = F.concat(F.array(msg(F.lit("system"), F.lit(THINK_TRIGGER))), plain)
    extend = F.transform(plain, lambda x, i: msg(
        x["role"],
        F.when(i == 0, F.concat(F.lit(THINK_TRIGGER + "\n"), F.coalesce(x["content"], F.lit(""))))
        .otherwise(x["content"])))
    no_sys = (F.size(m) == 0) | (first["role"] != "system")
    has_trig = F.contains(F.coalesce(first["content"], F.lit("")), F.lit(THINK_TRIGGER))
    return F.when(no_sys, prepend).when(has_trig, plain).otherwise(extend)


def adapt_drop_thinking(m: ColumnOrName) -> Column:
    """P27d: thinking removed from every turn."""
    return F.transform(col(m), lambda x: msg(x["role"], x["content"]))


# Model family -> the adapter of its chat rows.
ADAPTERS = {
    "qwen3.5": adapt_reasoning_field,
    "qwen3": adapt_reasoning_field,
    "lfm2": adapt_embed_think,
    "lfm2.5": adapt_embed_think,
    "gemma4": adapt_system_trigger,
}


def adapt(family: str, m: ColumnOrName) -> Column:
    """K: the adapter of a model family, by name."""
    if family not in ADAPTERS:
        raise ValueError(f"unknown model family {family!r}; known: {', '.join(ADAPTERS)}")
    return ADAPTERS[family](m)


class Template(NamedTuple):
    """What a chat template writes: text before the first turn, ``prefix role sep content
    suffix`` per turn, and the name of the assistant's role."""

    begin: str = ""
    prefix: str = "<|im_start|>"
    sep: str = "\n"
    suffix: str = "<|im_end|>\n"
    assistant: str = "assistant"


CHATML = ("<|im_start|>", "\n", "<|im_end|>\n")
#: Turn markers as published with these families' tokenizers (the Gemma row is the
#: published form of its third generation). Other templates are passed as rows of this kind.
TEMPLATES = {
    "chatml": Template(),
    "qwen3": Template(),
    "qwen3.5": Template(),
    "lfm2": Template(begin="<|startoftext|>"),
    "lfm2.5": Template(begin="<|startoftext|>"),
    "gemma4": Template("<bos>", "<start_of_turn>", "\n", "<end_of_turn>\n", "model"),
}


def render_chat(m: ColumnOrName, template: tuple[str, str, str] = CHATML) -> Column:
    """Concatenated turns ``prefix role sep content suffix``."""
    pre, sep, suf = template
    return F.array_join(F.transform(col(m), lambda x: F.concat(
        F.lit(pre), x["role"], F.lit(sep), F.coalesce(x["content"], F.lit("")), F.lit(suf))), "")


def template_table(spark, templates: dict[str, Template] | None = None) -> "DataFrame":
    """Family -> template parameters as a small table; aliases are rows of their own."""
    rows = [(name, *t) for name, t in (templates or TEMPLATES).items()]
    return spark.createDataFrame(rows, "family string, t_begin string, t_prefix string, t_sep string, t_suffix string, t_assistant string")


def render_by_family(df: DataFrame, messages: str, family_col: str, out_col: str = "text",
                     templates: dict[str, Template] | None = None) -> DataFrame:
    """P28 per row: the template is looked up by family name (broadcast join with the
    template table, bounded by the number of families); unknown and null families take ChatML."""
    t = F.broadcast(template_table(df.sparkSession, templates))
    j = df.join(t, df[family_col] == t["family"], "left")
    got = {n: F.coalesce(F.col(f"t_{n}"), F.lit(d)) for n, d in Template()._asdict().items()}
    # the template columns are plain column references, cheap to read per element
    role = lambda x: F.when(x["role"] == "assistant", got["assistant"]).otherwise(x["role"])
    turns = F.transform(F.col(messages), lambda x: F.concat(got["prefix"], role(x), got["sep"], F.coalesce(x["content"], F.lit("")), got["suffix"]))
    return j.withColumn(out_col, F.concat(got["begin"], F.array_join(turns, ""))).drop("family", *[f"t_{n}" for n in got])


def assistant_spans(m: ColumnOrName, template: tuple[str, str, str] = CHATML) -> Column:
    """``array<struct<start,end>>`` char offsets of assistant content in ``render_chat``.

    A running ``aggregate`` over turn lengths; offsets are 0-based, end exclusive.
    """
    pre, sep, suf = template
    head = F.lit(len(pre) + len(sep))

    def step(acc, x):
        start = acc["pos"] + head + F.length(x["role"])
        end = start + F.length(F.coalesce(x["content"], F.lit("")))
        spans = F.when(x["role"] == "assistant",
                       F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))))\
            .otherwise(acc["spans"])
        return F.struct((end + F.lit(len(suf))).alias("pos"), spans.alias("spans"))

    init = F.struct(F.lit(0).alias("pos"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(col(m), init, step)["spans"]


def tool_call_text(arguments: Column) -> Column:
    """``<tool_call>`` block naming the answer tool with the ``answer`` argument of a
    JSON arguments string (JSON-encoded value; missing -> empty string)."""
    ans = F.coalesce(F.to_json(F.try_variant_get(F.try_parse_json(arguments), "$.answer", "variant")), F.lit('""'))
    return F.concat(F.lit('<tool_call>\n{"name": "answer", "arguments": {"answer": '), ans, F.lit("}}\n</tool_call>"))


def rollout_to_sft(m: ColumnOrName) -> Column:
    """Drop ``tool`` turns; an assistant turn with tool calls becomes the text of its
    first call; other turns pass through (role, content)."""
    kept = F.filter(col(m), lambda x: x["role"] != "tool")
    return F.transform(kept, lambda x: F.struct(
        x["role"].alias("role"),
        F.when((x["role"] == "assistant") & (F.coalesce(F.size(x["tool_calls"]), F.lit(0)) > 0),
               tool_call_text(F.try_element_at(x["tool_calls"], F.lit(1))["function"]["arguments"]))
        .otherwise(x["content"]).alias("content")))


# ---------------------------------------------------------------------------
# Trace reduction
# ---------------------------------------------------------------------------

TRACE_ELEM = "struct<role:string,content:string,reasoning_content:string,tool_calls:string>"


def parse_trace_message(e: Column) -> Column:
    """JSON text element -> struct; unparsable text -> {role: 'unknown', content: text}.

    Content that is no string (a list of parts, say) is not text: it is kept as JSON in
    ``parts``, and ``content`` is null.
    """
    none = F.lit(None).cast("string")
    v, parsed = F.try_parse_json(e), F.from_json(e, TRACE_ELEM)
    is_text = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.content", "variant")) == "STRING", F.lit(False))
    known = F.struct(parsed["role"].alias("role"), F.when(is_text, parsed["content"]).alias("content"),
                     F.when(~is_text, parsed["content"]).alias("parts"),
                     parsed["reasoning_content"].alias("reasoning_content"), parsed["tool_calls"].alias("tool_calls"))
    return F.when(v.isNotNull(), known).otherwise(
        F.struct(F.lit("unknown").alias("role"), e.alias("content"), none.alias("parts"),
                 none.alias("reasoning_content"), none.alias("tool_calls")))


def _nonempty_tool_calls(tc: Column) -> Column:
    return tc.isNotNull() & ~tc.isin("", "[]", "{}", "null", "false", "0")


def reduce_trace(df: DataFrame, raw: str, prefix: str = "_red") -> DataFrame:
    """``array<string>`` JSON messages -> columns ``{prefix}_messages``, ``_thinking``,
    ``_response``, ``_output_type``.

    Content is scrubbed; thinking is the last non-empty ``reasoning_content`` of an
    assistant turn, response the last non-empty assistant content; any tool call makes
    the output type ``tool_use``. Tool-call trees and content parts are kept as JSON text and
    scrubbed leaf by leaf, keys untouched. The parsed, scrubbed array is a column of its own so
    each element is parsed and scrubbed once.
    """
    msgs = F.transform(F.col(raw), lambda e: parse_trace_message(e))
    d = df.withColumn("_pm", msgs)
    # JSON trees leave the array for the Arrow helper; rows without any send it nothing
    trees = F.flatten(F.transform("_pm", lambda x: F.array(x["parts"], F.when(_nonempty_tool_calls(x["tool_calls"]), x["tool_calls"]))))
    d = d.withColumn("_trees", trees)
    d = d.withColumn("_trees", scrub_json_texts(F.when(F.exists("_trees", lambda t: t.isNotNull()), F.col("_trees"))))
    d = d.withColumn("_sm", F.transform("_pm", lambda x, i: F.struct(
        x["role"].alias("role"), scrub_guarded(x["content"]).alias("content"),
        F.try_element_at("_trees", 2 * i + 1).alias("parts"), F.try_element_at("_trees", 2 * i + 2).alias("tool_calls"),
        x["reasoning_content"].alias("reasoning_content"))))
    asst = F.filter("_sm", lambda x: x["role"] == "assistant")
    thinking = F.try_element_at(F.filter(asst, lambda x: nz(x["reasoning_content"]).isNotNull()), F.lit(-1))
    response = F.try_element_at(F.filter(asst, lambda x: x["content"] != ""), F.lit(-1))["content"]
    tool = F.exists("_sm", lambda x: x["tool_calls"].isNotNull())
    return d.select(
        "*",
        F.transform("_sm", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), x["parts"].alias("parts"),
                                              x["tool_calls"].alias("tool_calls"))).alias(f"{prefix}_messages"),
        F.coalesce(scrub_guarded(thinking["reasoning_content"]), F.lit("")).alias(f"{prefix}_thinking"),
        F.coalesce(response, F.lit("")).alias(f"{prefix}_response"),
        F.when(tool, "tool_use").otherwise("text").alias(f"{prefix}_output_type"),
    ).drop("_pm", "_sm", "_trees")


def has_assistant_output(m: ColumnOrName) -> Column:
    """An assistant turn with content (text or parts) or a tool call."""
    return F.exists(col(m), lambda x: (x["role"] == "assistant")
                    & ((F.coalesce(x["content"], F.lit("")) != "") | ~F.coalesce(x["parts"], F.lit("[]")).isin("", "[]", "{}")
                       | x["tool_calls"].isNotNull()))


def render_context(m: ColumnOrName) -> Column:
    """``ROLE: content`` of every turn with non-empty text, newline-joined."""
    return F.array_join(F.transform(F.filter(col(m), lambda x: F.coalesce(x["content"], F.lit("")) != ""),
                                    lambda x: F.concat(F.upper(x["role"]), F.lit(": "), x["content"])), "\n")


def build_completion(thinking: ColumnOrName, response: ColumnOrName) -> Column:
    """``<think>\\n{thinking}\\n</think>\\n{response}`` when thinking is non-empty."""
    t, r = col(thinking), F.coalesce(col(response), F.lit(""))
    return F.when(nz(t).isNotNull(), F.concat(F.lit("<think>\n"), t, F.lit("\n</think>\n"), r)).otherwise(r)


def inline_tool_marker(m: ColumnOrName) -> Column:
    """Inline ``[Tool:`` text in any turn also marks tool use."""
    return F.exists(col(m), lambda x: F.contains(F.coalesce(x["content"], F.lit("")), F.lit("[Tool:")))


def task_type(cot_len: ColumnOrName, output_type: ColumnOrName,
              threshold: int = COT_REASONING_THRESHOLD) -> Column:
    """P17: 'reasoning' if the CoT is longer than the threshold and no tool use, else 'agentic'."""
    return F.when((col(cot_len) > threshold) & (col(output_type) != "tool_use"), "reasoning").otherwise("agentic")
