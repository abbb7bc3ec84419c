"""Token labels, boxed answers, result pairing, stages, scrubbed tool calls and the unbounded stream dedup against brute force."""

import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadmill.functions import answers as A
from threadmill.functions import messages as M
from threadmill.functions import tokens as K
from threadmill.operators import dedup as D
from threadmill.operators import splits as SP
from threadmill.operators.pairing import duplicate_keys, pair_results, paired_accuracy


def bpe():
    P = pytest.importorskip("public_tokenizers")
    return str(P.path("byte_bpe_50k.json"))


TEXTS = [None, "", " \n\t", "plain words here", "naïve café — 漢字 🙂 done", "<|endoftext|> is text", "a" * 3000, "word " * 2500, "x\n\ny  z"]


def offsets(text, name):
    """Tokens of a text and their code point offsets, from the libraries themselves."""
    if name == "basic":
        return [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t-\r]", text)]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(name)
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).offsets


@pytest.mark.parametrize("name", ["basic", "bpe"])
def test_labels_match_a_mask_by_character(spark, name):
    name = bpe() if name == "bpe" else name
    rnd = random.Random(2)
    rows = []
    for i, t in enumerate(TEXTS * 2):
        n, spans, at = len(t or ""), [], 0
        while at < n and rnd.random() < 0.8:
            a = rnd.randint(at, n)
            b = rnd.randint(a, n)
            spans.append((a, b))
            at = b + 1
        rows.append((i, t, spans if i % 5 else None))
    df = spark.createDataFrame(rows, "i int, text string, spans array<struct<start:int,end:int>>")
    got = {r.i: r for r in K.label_rows(df, "text", "spans", name).collect()}
    for i, t, spans in rows:
        mask = [False] * len(t or "")
        for a, b in spans or []:
            mask[a:b] = [True] * (b - a)
        tok = offsets(t or "", name)
        # inside one span: all characters marked, and no span border within
        starts = {a for a, _ in spans or []}
        want = [b > a and all(mask[a:b]) and not any(x in starts for x in range(a + 1, b)) for a, b in tok]
        r = got[i]
        assert r.n_tokens == len(tok) == len(r.input_ids) and r.n_trainable == sum(want)
        assert [x != K.IGNORED for x in r.labels] == want and all(y in (x, K.IGNORED) for x, y in zip(r.input_ids, r.labels))
        assert r.drop_reason == ("empty" if not tok else "zero_signal" if not any(want) else None)


def test_rendered_chat_is_trainable_only_in_assistant_turns(spark):
    turns = [("system", "be kind"), ("user", "hi there"), ("assistant", "hello you"), ("tool", "hello you"), ("assistant", None)]
    df = spark.createDataFrame([(1, turns), (2, [t for t in turns if t[0] != "assistant"])], "id int, m array<struct<role:string,content:string>>")
    d = df.select("id", M.render_chat("m").alias("text"), M.assistant_spans("m").alias("spans"))
    got = {r.id: r for r in K.label_rows(d, "text", "spans").collect()}
    assert got[1].n_trainable == 2 and got[1].drop_reason is None
    assert got[2].n_trainable == 0 and got[2].drop_reason == "zero_signal"


def test_token_counts_of_whole_documents(spark):
    name = bpe()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(name)
    tok.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.n for r in docs.select("doc_id", K.token_count("text", name).alias("n")).collect()}
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], [len(e.ids) for e in tok.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]))
    assert got == want
    few = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string").repartition(1)
    assert [r.n for r in few.orderBy("i").select(K.token_count("text").alias("n")).collect()] == [len(offsets(t or "", "basic")) for t in TEXTS]
    with pytest.raises(ValueError):
        K.load("nothing")


def scan_boxes(t):
    out, i = [], 0
    for m in re.finditer(r"\\boxed ?\{", t):
        depth, end = 1, None
        for j in range(m.end(), len(t)):
            depth += {"{": 1, "}": -1}.get(t[j], 0)
            if depth == 0:
                end = j
                break
        out.append(None if end is None else t[m.end():end].strip())
    return out


def test_boxed_contents(spark):
    rnd = random.Random(1)
    texts = ["", "no box", r"\boxed{1}", r"a \boxed {x} b \boxed{ y } ", r"\boxed{\frac{1}{2}} and \boxed{3", r"}} \boxed{\boxed{2}+1}", r"\boxed{}", "é🙂 \\boxed{漢{字}}"]
    for _ in range(150):
        texts.append("".join(rnd.choice(["\\boxed{", "\\boxed {", "{", "}", "}", "x", " ", "é", "\n", "\\boxed"]) for _ in range(rnd.randint(0, 25))))
    df = spark.createDataFrame(list(enumerate([*texts, None])), "i int, t string")
    got = {r.i: r.x for r in df.select("i", A.boxed_contents("t").alias("x")).collect()}
    assert got == {i: scan_boxes(t or "") for i, t in enumerate([*texts, None])}


def test_pairing(spark):
    rnd = random.Random(3)
    rows = lambda: [(rnd.choice([None, 1, 2, 3]), rnd.randint(0, 6), rnd.randint(0, 1)) for _ in range(60)]
    left, right = rows(), rows()
    schema = "example int, pos int, hit int"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = Counter((r.example, r.pos, r.side, r.l and r.l.hit, r.r and r.r.hit) for r in pair_results(a, b, ["example", "pos"]).collect())
    want = Counter()
    for e, p, h in left:
        met = [x for x in right if x[:2] == (e, p)]
        want.update([(e, p, "both", h, x[2]) for x in met] or [(e, p, "left", h, None)])
    want.update((e, p, "right", None, h) for e, p, h in right if not any(x[:2] == (e, p) for x in left))
    assert got == want
    acc = {r.example: r for r in paired_accuracy(pair_results(a, b, ["example", "pos"]), "example", F.col("l.hit"), F.col("r.hit")).collect()}
    for e in {k[0] for k in want}:
        both = [(k[3], k[4], n) for k, n in want.items() if k[0] == e and k[2] == "both"]
        n = sum(x[2] for x in both)
        assert acc[e].n_both == n and acc[e].n_left_only == sum(c for k, c in want.items() if k[0] == e and k[2] == "left")
        assert acc[e].acc_left == (round(sum(x * c for x, _, c in both) / n, 6) if n else None)
    assert {(r.example, r.pos): r.n for r in duplicate_keys(a, ["example", "pos"]).collect()} == {k: n for k, n in Counter(x[:2] for x in left).items() if n > 1}
    assert pair_results(a.limit(0), b.limit(0), ["example"]).count() == 0


def test_splits_with_repeated_and_null_ids(spark):
    one = spark.createDataFrame([(7,)] * 100, "id int")
    assert Counter(r.split for r in SP.seeded_global_split(one, "id").collect()) == {"test": 5, "train": 95}
    half = spark.createDataFrame([(None,)] * 50 + [(i,) for i in range(50)], "id int")
    assert Counter(r.split for r in SP.seeded_global_split(half, "id").collect()) == {"test": 5, "train": 95}
    # per stratum, with a null stratum, an id on very many rows and rows without id
    rows = [("a", 1)] * 300 + [("a", None)] * 100 + [(None, i % 3) for i in range(60)] + [("b", i) for i in range(40)]
    got = Counter((r.g, r.split) for r in SP.stratified_split(spark.createDataFrame(rows, "g string, id int"), "g", "id").collect())
    assert got == {("a", "test"): 20, ("a", "train"): 380, (None, "test"): 3, (None, "train"): 57, ("b", "test"): 2, ("b", "train"): 38}
    empty = one.limit(0)
    assert SP.seeded_global_split(empty, "id").count() == 0


def test_first_n_per_group_ties_and_nulls(spark):
    rows = [("a", 1)] * 5 + [("b", None), ("b", None), ("b", 4), ("b", 5), ("c", None)] + [(None, 2), (None, 2), (None, 1)] + [("h", i % 2) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, o int")
    for n in (1, 2, 3):
        got = Counter((r.g, r.o) for r in SP.first_n_per_group(df, "g", "o", n).collect())
        want = Counter()
        for g in {x for x, _ in rows}:
            want.update((g, o) for o in sorted((o for x, o in rows if x == g), key=lambda o: (o is not None, o or 0))[:n])
        assert got == want
    assert {r.rn for r in SP.first_n_per_group(df, "g", "o", 3).where("g = 'h'").collect()} == {1, 2, 3}


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1], [200, 400], [599, 1], [0, 5], [600, 5]])
def test_staged_split_matches_a_sorted_list(spark, sizes):
    import hashlib
    ids = list(range(600))
    got = {r.id: r.stage for r in SP.staged_split(spark.createDataFrame([(i,) for i in ids], "id int"), "id", sizes, seed=3).collect()}
    order = sorted(ids, key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
    at = 0
    for k, n in enumerate(sizes, 1):
        assert all(got[i] == k for i in order[at:at + n])
        at += n
    assert all(got[i] == 0 for i in order[at:])


def test_staged_split_keeps_an_id_together(spark):
    rows = [(5,)] * 300 + [(None,)] * 300 + [(i,) for i in range(100, 200)]
    got = SP.staged_split(spark.createDataFrame(rows, "id int"), "id", [50, 100]).collect()
    assert len(got) == 700 and len({r.stage for r in got if r.id == 5}) == 1 and len({r.stage for r in got if r.id is None}) == 1
    assert SP.staged_split(spark.createDataFrame([], "id int"), "id", [5]).count() == 0


def test_first_seen_with_null_ids(spark):
    rows = [(None, "x"), (1, "x"), (2, "x"), (None, "only"), (3, "y"), (9, None), (4, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    key = F.coalesce("t", F.lit(""))
    want = {(1, "x"), (None, "only"), (3, "y"), (4, "")}
    assert {tuple(r) for r in D.keep_first_seen(df, key, ["id"]).collect()} == want
    got = {(r.id, r.t): r.is_first for r in D.flag_first_seen(df, key, ["id"]).collect()}
    assert got == {r: r in want for r in map(tuple, rows)}
    two = spark.createDataFrame([(None, 1, "x"), (0, None, "x"), (0, 5, "x")], "a int, b int, t string")
    assert [tuple(r) for r in D.keep_first_seen(two, F.col("t"), ["a", "b"]).collect()] == [(0, 5, "x")]
    kept = D.flag_first_seen(df, key, ["id"], "f", eligible=F.col("id") > 1).collect()
    assert {(r.id, r.t): r.f for r in kept} == {(None, "x"): None, (1, "x"): None, (2, "x"): True, (None, "only"): None, (3, "y"): True, (9, None): False, (4, ""): True}


def test_tool_calls_are_scrubbed_leaf_by_leaf(spark):
    call = {"id": "c1", "bob@home.example": "k", "note": "\x1b[31mred\x1b[0m see C:\\Users\\bob\\x", "said": "USER: Set model to x",
            "function": {"name": "Bash", "arguments": json.dumps({"cmd": "type C:\\Users\\bob\\y", "to": ["bob@home.example", 3, None]})}, "n": 5}
    part = [{"type": "text", "text": "mail bob@home.example"}]
    raw = [json.dumps({"role": "user", "content": part}), json.dumps({"role": "assistant", "content": "", "tool_calls": [call]})]
    d = M.reduce_trace(spark.createDataFrame([(1, raw), (2, None), (3, [])], "id int, raw array<string>"), "raw")
    got = {r.id: r for r in d.collect()}
    out = json.loads(got[1]["_red_messages"][1].tool_calls)[0]
    args = json.loads(out["function"]["arguments"])
    assert "bob" not in json.dumps([out["note"], args]) and "\x1b" not in out["note"] and "Set model" not in out["said"]
    assert out["bob@home.example"] == "k" and set(out) == set(call) and out["n"] == 5 and args["to"][1:] == [3, None]
    assert got[1]["_red_output_type"] == "tool_use"
    assert "bob" not in (got[1]["_red_messages"][0].parts or "")
    # text that no rule touches keeps its spelling
    same = json.dumps({"a": '{"compact":1}'})
    from threadmill.functions.scrub import scrub_json_text
    one = spark.createDataFrame([(same,), ("not json",), (None,)], "s string").select(scrub_json_text("s").alias("s")).collect()
    assert [r.s for r in one] == [same, "not json", None]


def test_stream_first_seen_over_three_runs(spark, tmp_path):
    from threadmill.streaming import jobs as J
    schema = "id int, key string, ts timestamp"
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    runs = [[(3, "a"), (1, "a"), (2, "b"), (4, None)], [(5, "c"), (6, "a"), (0, "b"), (7, None)], [(8, "d"), (9, "c"), (9, "c"), (10, "e")]]
    seen, want = set(), []
    for i, rows in enumerate(runs):
        # the last run brings a row far older than everything before it
        ts = [f"200{0 if i == 2 else 9}-01-0{j + 1} 00:00:00" for j in range(len(rows))]
        spark.createDataFrame([(*r, t) for r, t in zip(rows, ts)], "id int, key string, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(src)
        J.incremental_first_seen(spark.readStream.schema(schema).parquet(src), "key", ["id"], out, ck).awaitTermination()
        for key in {k for _, k in rows} - seen:
            want.append((min(x for x, k in rows if k == key), key))
        seen |= {k for _, k in rows}
        assert sorted(((r.id, r.key) for r in spark.read.parquet(out).collect()), key=str) == sorted(want, key=str)
    # a batch that is run again (its commit was lost) overwrites its own rows and no others
    again = spark.createDataFrame(runs[2], "id int, key string").withColumn("ts", F.lit(None).cast("timestamp"))
    J.first_seen_writer("key", ["id"], out)(again, 2)
    assert sorted(((r.id, r.key) for r in spark.read.parquet(out).collect()), key=str) == sorted(want, key=str)


def test_labels_leave_by_slice(spark):
    """A batch of several slices: rows stay in order, each with its own labels."""
    import numpy as np
    import pandas as pd
    from threadmill.functions import tokens as K
    texts, spans = ["a b", "c " * K.SLICE_CHARS, "d", ""], [[(0, 1)], [(0, 1)], None, []]
    frames = [K._labelled(K.load("basic")(texts[a:b]), pd.Series([[s[0] for s in x or []] for x in spans])[a:b],
                          pd.Series([[s[1] for s in x or []] for x in spans])[a:b]) for a, b in K._slices(texts)]
    assert len(frames) > 1 and [r[:2] for f in frames for r in f] == [(2, 1), (K.SLICE_CHARS, 1), (1, 0), (0, 0)]
    assert all(r[2].dtype == np.int32 and r[3].dtype == np.int32 for f in frames for r in f)
    df = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(zip(texts, spans))], "i int, text string, spans array<struct<start:int,end:int>>").coalesce(1)
    got = K.label_rows(df, "text", "spans").orderBy("i").collect()
    assert [(r.n_tokens, r.n_trainable, len(r.labels)) for r in got] == [(2, 1, 2), (K.SLICE_CHARS, 1, K.SLICE_CHARS), (1, 0, 1), (0, 0, 0)]


def test_math_rows_are_dealt(spark, tmp_path):
    """One small file is one task; the rows made from it are not."""
    from pyspark.sql import functions as F
    from threadmill.plans.fixtures import math_completions, math_problems
    spark.range(200).select(F.col("id").alias("p_partkey"), F.lit("part").alias("p_name"), F.lit(5).alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for rows in (math_problems, math_completions):
        df = rows(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and df.count() == 200
