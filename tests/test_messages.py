"""Message normalisers and renderers on edge cases."""


from threadmill.functions import messages as M

RAW = "array<struct<role:string,from:string,content:string,value:string>>"


def test_conversations_normaliser(spark):
    data = [
        (1, [("human", None, "hi", None), ("gpt", None, "<think>r</think> ans", None)]),
        (2, [(None, "user", None, "q"), ("assistant", None, "<think>open", None)]),
        (3, [("user", None, "only user", None)]),
        (4, [("user", None, "a", None), ("assistant", None, "<think>x</think>b", None),
             ("assistant", None, "plain", None)]),
    ]
    df = spark.createDataFrame(data, f"id long, c {RAW}")
    n = M.normalize_conversations(df, "c").orderBy("id").collect()
    assert [r.ok for r in n] == [True, False, False, True]
    assert [(m.role, m.content, m.thinking) for m in n[0].messages] == [("user", "hi", None), ("assistant", "ans", "r")]
    assert [(m.content, m.thinking) for m in n[3].messages][1:] == [("<think>x</think>b", None), ("plain", None)]


def test_flat_and_render(spark):
    df = spark.createDataFrame([("q", "<think>t</think> a", None, "sys"), ("q", "", None, None)],
                               "u string, a string, th string, s string")
    f = df.select(M.from_flat("u", "a", "th", "s").alias("m")).collect()
    assert f[0].m.ok and [(x.role, x.content, x.thinking) for x in f[0].m.messages] == [
        ("system", "sys", None), ("user", "q", None), ("assistant", "a", "t")]
    assert not f[1].m.ok
    r = df.limit(1).select(M.from_flat("u", "a", "th")["messages"].alias("m")) \
        .select(M.render_chat("m").alias("t"), M.assistant_spans("m").alias("s")).collect()[0]
    assert r.t == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    s = r.s[0]
    assert r.t[s.start:s.end] == "a"


def test_adapters(spark):
    df = spark.createDataFrame([([("user", "q", None), ("assistant", "a", "t")],)],
                               "m array<struct<role:string,content:string,thinking:string>>")
    r = df.select(M.adapt_embed_think("m").alias("e"), M.adapt_system_trigger("m").alias("g"),
                  M.adapt_reasoning_field("m").alias("q")).collect()[0]
    assert r.e[1].content == "<think>t</think>\na"
    assert [(x.role, x.content) for x in r.g] == [("system", "<|think|>"), ("user", "q"), ("assistant", "a")]
    assert r.q[1].reasoning_content == "t" and r.q[0].reasoning_content is None


def test_trace_reduce(spark):
    msgs = ['{"role": "user", "content": "hi /home/bob/x"}',
            '{"role": "assistant", "content": "", "reasoning_content": "think", "tool_calls": [{"f": 1}]}',
            '{"role": "assistant", "content": "done"}', "not json"]
    df = spark.createDataFrame([(msgs,)], "m array<string>")
    r = M.reduce_trace(df, "m", "r").collect()[0]
    assert r.r_thinking == "think" and r.r_response == "done" and r.r_output_type == "tool_use"
    assert r.r_messages[0].content == "hi /home/user/x" and r.r_messages[3].role == "unknown"
    ctx = M.reduce_trace(df, "m", "r").select(M.render_context("r_messages").alias("x")).collect()[0].x
    assert ctx == "USER: hi /home/user/x\nASSISTANT: done\nUNKNOWN: not json"


def test_render_by_family(spark):
    df = spark.createDataFrame([("qwen3", [("user", "q", None), ("assistant", "a", None)]),
                                ("unknown-family", [("user", "x", None)])],
                               "fam string, m array<struct<role:string,content:string,thinking:string>>")
    got = {r.fam: r.text for r in M.render_by_family(df, "m", "fam").collect()}
    direct = df.select("fam", M.render_chat("m").alias("t")).collect()
    assert got == {r.fam: r.t for r in direct}


def test_family_templates(spark):
    m = [("user", "q", None), ("assistant", None, None)]
    df = spark.createDataFrame([("gemma4", m), ("lfm2.5", m), (None, m), ("gemma4", [])], "fam string, m array<struct<role:string,content:string,thinking:string>>")
    chatml = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    got = [(r.fam, r.text) for r in M.render_by_family(df, "m", "fam").collect()]
    assert sorted(got, key=repr) == sorted([
        ("gemma4", "<bos><start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\n<end_of_turn>\n"), ("lfm2.5", "<|startoftext|>" + chatml),
        (None, chatml), ("gemma4", "<bos>")], key=repr)
    own = M.render_by_family(df, "m", "fam", templates={"lfm2.5": M.Template("", "[", ":", "]", "bot")}).where("fam = 'lfm2.5'").collect()
    assert own[0].text == "[user:q][bot:]"


def test_log_history(spark):
    from threadmill.operators.history import explode_log_history
    full = '[{"step": 1, "loss": 0.5, "reward": 2, "completions/clipped_ratio": 0.25, "x": 1}, {"step": 2, "loss": "high"}, null, {}]'
    df = spark.createDataFrame([("a", full), ("b", None), ("c", "[]"), ("d", "no json"), ("e", "")], "run string, h string")
    got = [tuple(r) for r in explode_log_history(df, "h", "run").collect()]
    assert sorted(got, key=repr) == sorted([("a", 1, 0.5, 2.0, 0.25), ("a", 2, None, None, None), ("a", None, None, None, None)], key=repr)


def test_normalisers_take_the_fields_that_are_there(spark):
    from threadmill.plans.q_sources import normalize_any
    gpt = spark.createDataFrame([([("human", "q"), ("gpt", "<think>t</think>a")],)], "conversations array<struct<from:string,value:string>>")
    r = normalize_any(gpt).collect()[0]
    assert r.ok and [tuple(x) for x in r.messages] == [("user", "q", None), ("assistant", "a", "t")]
    think = spark.createDataFrame([([("user", "q", None), ("assistant", "a", "t")],)], "messages array<struct<role:string,content:string,thinking:string>>")
    r = normalize_any(think).collect()[0]
    assert r.ok and [tuple(x) for x in r.messages] == [("user", "q", None), ("assistant", "a", "t")]


def test_list_content_is_kept_but_is_no_text(spark):
    rows = ['{"role":"user","content":"hi"}', '{"role":"assistant","content":[{"type":"text","text":"/home/alice/x"}]}']
    df = M.reduce_trace(spark.createDataFrame([(rows,)], "m array<string>"), "m", "r")
    r = df.select("*", M.render_context("r_messages").alias("ctx"), M.has_assistant_output("r_messages").alias("out")).collect()[0]
    assert (r.ctx, r.r_response, r.out) == ("USER: hi", "", True)
    assert r.r_messages[1].content == "" and "/home/user/x" in r.r_messages[1].parts and "alice" not in r.r_messages[1].parts


def test_text_messages_are_decoded(spark):
    from threadmill.plans.q_sources import normalize_any
    rows = [("[{'role': 'user', 'content': 'q'}, {'role': 'assistant', 'content': '<think>t</think>a'}, {'role': 'tool', 'content': ''}]",), ("no list",), (None,)]
    got = [(r.ok, [tuple(x) for x in r.messages or []]) for r in normalize_any(spark.createDataFrame(rows, "messages string")).collect()]
    assert got[0] == (True, [("user", "q", None), ("assistant", "a", "t")])
    assert [g[0] for g in got[1:]] == [False, False]


def test_registries_by_name(spark):
    import pytest

    from threadmill.functions import rewards as R
    df = spark.sql("SELECT array(named_struct('role', 'assistant', 'content', 'a', 'thinking', 't')) AS m, 'x' AS c, 'x' AS a")
    r = df.select(*[M.adapt(f, "m").alias(f.replace(".", "_")) for f in M.ADAPTERS]).collect()[0]
    assert r["qwen3"] == r["qwen3_5"] and r["qwen3"][0]["reasoning_content"] == "t"
    assert r["lfm2"] == r["lfm2_5"] and r["lfm2"][0]["content"] == "<think>t</think>\na"
    assert r["gemma4"][0]["role"] == "system" and r["gemma4"][1]["content"] == "a"
    got = df.select(*R.rewards_by_name(["accuracy_reward", "format_reward"], "c", "a"))
    assert got.columns == ["accuracy_reward", "format_reward"] and got.collect()[0][1] == 0.0
    for call in (lambda: M.adapt("other", "m"), lambda: R.rewards_by_name(["other"], "c", "a")):
        with pytest.raises(ValueError):
            call()
