"""Text semantics against Python's str/re behaviour (T1, T6, T10, T15, T16, T18, strip)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from threadmill.functions import text as T

SAMPLES = ["", "  a  b\t\nc \n", "\u00a0x\u2003", "a\x0bb", "<|im_start|>hi<|end|> ", "Hello, World!! 42",
           "x{a{b}}{c}", "-3 and 4 and -5x", "Été à l'école", "---A--b---"]


def test_strip_words_count(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    got = df.select(T.strip("t").alias("s"), T.words("t").alias("w"), T.word_count("t").alias("n")).collect()
    for s, r in zip(SAMPLES, got):
        assert r.s == s.strip()
        assert list(r.w) == s.split()
        assert r.n == len(s.split())


def test_prompt_key_slug_ints_depth(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    got = df.select(T.prompt_key("t").alias("k"), T.slug("t").alias("g"), T.sum_of_integers("t").alias("i"),
                    T.max_brace_depth("t").alias("d")).collect()
    for s, r in zip(SAMPLES, got):
        assert r.k == re.sub(r"<\|[^|]*\|>", "", s).strip()
        assert r.g == re.sub(r"-+", "-", re.sub(r"[^a-z0-9]+", "-", s.lower())).strip("-")
        assert r.i == sum(int(x) for x in re.findall(r"(-?\d+)", s))
        depth = best = 0
        for ch in s:
            depth += ch == "{"
            depth -= ch == "}"
            best = max(best, depth)
        assert r.d == best


def test_json_list_lines(spark):
    df = spark.createDataFrame([('["a", "b"]',), ('[{"k": 1}]',), ("not json",), ('{"k": 1}',)], "t string")
    got = [r[0] for r in df.select(T.json_list_lines("t")).collect()]
    assert got == ["a\nb", '{"k":1}', "not json", '{"k": 1}']


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nab\u00a0é{}-1", max_size=12), min_size=1, max_size=8))
def test_strip_split_property(spark, texts):
    df = spark.createDataFrame([(s,) for s in texts], "t string")
    got = df.select(T.strip("t").alias("s"), T.word_count("t").alias("n")).collect()
    assert [r.s for r in got] == [s.strip() for s in texts]
    assert [r.n for r in got] == [len(s.split()) for s in texts]
