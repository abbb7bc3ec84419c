"""Arrow UDF helpers: bit-parallel LCS against the dynamic programme, ROUGE-L, repr decode."""

import random

from threadmill.functions.udfs import _decode_repr, lcs_length, rouge_l


def dp_lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_lcs_matches_dp():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 70))]
        b = [rng.choice("abcde") for _ in range(rng.randint(0, 70))]
        assert lcs_length(a, b) == dp_lcs(a, b)


def test_rouge_udf(spark):
    df = spark.createDataFrame([("the cat sat", "the cat sat on"), ("", "x"), ("a b", "c d")], "p string, g string")
    got = [r[0] for r in df.select(rouge_l("p", "g")).collect()]
    assert got == [2 * 1.0 * 0.75 / (1.0 + 0.75), 0.0, 0.0]
    assert abs(got[0] - 2 * 1.0 * 0.75 / 1.75) < 1e-12


def test_repr_decode():
    assert _decode_repr("[{'role': 'user', 'content': 'it\\'s'}]")[0]["content"] == "it's"
    assert _decode_repr("not a list") is None and _decode_repr("[]") is None


def test_py_list_lines(spark):
    from threadmill.functions.udfs import json_list_lines_py
    texts = ['[{"k": 1}, "a", true]', '{"a": 1, "b": 2}', "[1", "5", '["x", "y"]', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(json_list_lines_py("t")).collect()] == ["{'k': 1}\na\nTrue", "a\nb", "[1", "5", "x\ny", None]
