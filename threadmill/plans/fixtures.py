"""Input shapes of the reference derived from the driver tables (FIXTURES.md part C).

Each derivation is a narrow projection (or, for message arrays, one ``groupBy`` per
conversation) over a full table, written identically in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.sources.tables import table

ESC = "\x1b"


def noisy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with harness noise appended when doc_id % 5 = 0 (path, ANSI, command block, key)."""
    d = table(spark, sf_dir, "documents")
    noise = F.concat(F.lit(" /home/u"), F.col("doc_id").cast("string"), F.lit("/x "),
                     F.lit(ESC + "[31m"), F.lit("<command-name>run</command-name> sk-"),
                     F.md5(F.col("doc_id").cast("string")))
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.col("text"), noise)).otherwise(F.col("text"))
    return d.select("doc_id", "source", "lang", text.alias("text"))


def flat_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flat_qa: problem = first 200 chars, solution = rest, thinking only for odd ids."""
    d = noisy_documents(spark, sf_dir)
    thinking = F.when(F.col("doc_id") % 2 == 1, F.substring("text", 1, F.col("doc_id") % 900))
    return d.select("doc_id", "source", F.substring("text", 1, 200).alias("problem"),
                    F.expr("substring(text, 201)").alias("solution"), thinking.alias("thinking"))


def tagged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations with embedded think tags on assistant turns and refusals on last turns.

    assistant: conv_id % 7 = 0 -> '<think>' + text (truncated); % 3 = 0 -> untouched;
    otherwise the first 40 chars wrapped in <think>...</think>, the rest after.
    conv_id % 11 = 0 -> 'I cannot ' prefixed to the conversation's last turn.
    """
    c = table(spark, sf_dir, "conversations")
    is_asst = F.col("role") == "assistant"
    tagged = (F.when(~is_asst, F.col("text"))
              .when(F.col("conv_id") % 7 == 0, F.concat(F.lit("<think>"), F.col("text")))
              .when(F.col("conv_id") % 3 == 0, F.col("text"))
              .otherwise(F.concat(F.lit("<think>"), F.substring("text", 1, 40), F.lit("</think>"),
                                  F.expr("substring(text, 41)"))))
    from pyspark.sql import Window
    last_turn = F.max("turn").over(Window.partitionBy("conv_id"))
    text = F.when((F.col("conv_id") % 11 == 0) & (F.col("turn") == last_turn),
                  F.concat(F.lit("I cannot "), tagged)).otherwise(tagged)
    return c.select("conv_id", "turn", "role", text.alias("text"))


def conv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_raw: ``conversations array<struct<role,from,content,value>>`` per conv_id."""
    t = tagged_turns(spark, sf_dir)
    msgs = (t.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_t")))
    null = F.lit(None).cast("string")
    return msgs.select("conv_id", F.transform("_t", lambda m: F.struct(
        m["role"].alias("role"), null.alias("from"), m["text"].alias("content"), null.alias("value")))
        .alias("conversations"))


def normalized_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_raw through the P6 normaliser: ``conv_id, ok, messages``."""
    from threadmill.functions.messages import normalize_conversations
    n = normalize_conversations(conv_raw(spark, sf_dir), "conversations")
    return n.select("conv_id", "ok", "messages")


def conversation_messages(turns: DataFrame, content_col: str = "text") -> DataFrame:
    """Turn rows -> one row per conversation with ``messages array<struct<role,content>>``.

    One ``groupBy(conv_id)``: a group is one conversation, bounded by its turn count.
    """
    msgs = (turns.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col(content_col).alias("content"))))
                 .alias("_t")))
    return msgs.select("conv_id", F.transform("_t", lambda m: F.struct(m["role"].alias("role"),
                                                                      m["content"].alias("content")))
                       .alias("messages"))


def _part_prompt() -> "F.Column":
    return F.concat(F.lit("<|user|>Part "), (F.col("p_partkey") % 1500).cast("string"), F.lit("<|end|>"))


def dealt(df: DataFrame) -> DataFrame:
    """The same rows over four tasks a core: a small file is one task, whatever is computed from its rows."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def math_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """math: problem/solution from part; the solution ends five ways by p_partkey % 5
    (boxed fraction, 'answer is', two boxes, unbalanced box, trailing '= n')."""
    p = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    size = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 5
    sol = (F.when(k == 0, F.concat("p_name", F.lit(". We compute the total. The answer is \\boxed{\\frac{"), size,
                                   F.lit("}{2}}")))
           .when(k == 1, F.concat("p_name", F.lit(". Therefore the answer is "), size, F.lit(".")))
           .when(k == 2, F.concat("p_name", F.lit(" first \\boxed{"), size, F.lit("} then \\boxed{"),
                                  (F.col("p_size") + 1).cast("string"), F.lit("}")))
           .when(k == 3, F.concat("p_name", F.lit(" \\boxed{"), size, F.lit(" unbalanced")))
           .otherwise(F.concat("p_name", F.lit(" gives x = "), size)))
    return p.select("p_partkey", _part_prompt().alias("problem"), sol.alias("solution"))


def math_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """completions: same/equal-decimal/substring/wrong/none/plain answers by p_partkey % 6."""
    p = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    size = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 6
    dec = F.concat((F.col("p_size") / 2).cast("int").cast("string"), F.lit("."),
                   ((F.col("p_size") % 2) * 5).cast("string"))
    comp = (F.when(k == 0, F.concat(F.lit("Let us solve step 1 first. Therefore we get \\boxed{\\frac{"), size,
                                    F.lit("}{2}}")))
            .when(k == 1, F.concat(F.lit("Since the total is known, the result is \\boxed{"), dec, F.lit("}")))
            .when(k == 2, F.concat(F.lit("The answer is "), size, F.lit("0 because of the sum")))
            .when(k == 3, F.lit("I don't know the answer to this problem."))
            .when(k == 4, F.lit("No idea here"))
            .otherwise(F.concat(F.lit("So, the answer is "), size)))
    return p.select("p_partkey", _part_prompt().alias("prompt"), comp.alias("completion"))


def trace_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trace_meta: ``first_source_dataset`` = event_type, ``row_json`` by event_id % 4:
    0 messages list (tool call on the assistant turn when event_id % 8 = 0),
    1 prompt/response with a category (decoy when user_id % 10 = 0), 2 query/thinking,
    3 broken JSON."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    eid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    k = F.col("event_id") % 4
    asst = F.when(F.col("event_id") % 8 == 0,
                  F.lit('{"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "Bash", '
                        '"arguments": "{\\"cmd\\": \\"ls /home/alice/\\"}"}}]}'))
    asst = asst.otherwise(F.concat(F.lit('{"role": "assistant", "content": "value '), uid,
                                   F.lit('", "reasoning_content": "'), F.repeat(F.lit("r"), F.col("event_id") % 600),
                                   F.lit('"}')))
    msgs = F.concat(F.lit('{"messages": [{"role": "user", "content": "Event '), eid, F.lit(" "),
                    F.col("event_type"), F.lit('"}, '), asst, F.lit("]}"))
    pr = F.concat(F.lit('{"prompt": "Event '), eid, F.lit('", "response": "'), F.col("event_type"),
                  F.lit(" by user "), uid, F.lit('", "category": "'),
                  F.when(F.col("user_id") % 10 == 0, "decoy").otherwise("real"), F.lit('"}'))
    qt = F.concat(F.lit('{"query": "Q'), eid, F.lit('", "thinking": "'),
                  F.repeat(F.lit("t"), F.col("event_id") % 1000), F.lit('"}'))
    broken = F.concat(F.lit('{"broken": '), eid)
    rj = F.when(k == 0, msgs).when(k == 1, pr).when(k == 2, qt).otherwise(broken)
    return e.select("event_id", F.col("event_type").alias("first_source_dataset"), rj.alias("row_json"))
