"""T2-T5, T8, T9 and R1-R3 on edge cases; expected values worked out by hand."""


from threadmill.functions import answers as A
from threadmill.functions import rewards as R


def one(spark, col_fn, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(col_fn("t")).collect()]


def test_extract_boxed(spark):
    vals = ["x \\boxed{1} y \\boxed{\\frac{3}{4}} z", "\\boxed {5}", "\\boxed{a{b}c", "none", "\\boxed{ 7 }",
            "\\boxed{} then"]
    assert one(spark, A.extract_boxed, vals) == ["\\frac{3}{4}", "5", None, None, "7", ""]


def test_extract_answer(spark):
    vals = ["The answer is 42.", "Final Answer: x+1\nmore", "so, the answer is 7", "blah = 3.5", "", None,
            "\\boxed{} and The answer is 9", "nothing here"]
    assert one(spark, A.extract_answer, vals) == ["42", "x+1", "7", "3.5", None, None, "9", None]


def test_normalize_and_parse(spark):
    vals = ["\\frac{5}{9}", " \\text{12 cm}. ", "\\sqrt{2}", "$x^{2}$", "3 / 4", "1_000", "abc", None]
    norm = one(spark, A.normalize_answer, vals)
    assert norm == ["5/9", "12 cm", "sqrt(2)", "x^2", "3/4", "1_000", "abc", ""]
    nums = one(spark, A.try_parse_number, ["5/9", "1_000", "1d", "3/0", " 2.5 ", "inf", "a/b/c"])
    assert abs(nums[0] - 5 / 9) < 1e-12 and nums[1] == 1000.0 and nums[2] is None and nums[3] is None
    assert nums[4] == 2.5 and nums[5] == float("inf") and nums[6] is None


def test_answer_integer_and_guess(spark):
    df = spark.createDataFrame([('{"answer": "12"}',), ("a 3 b -4",), ("none",)], "t string")
    got = df.select(A.answer_integer("t").alias("a")).collect()
    assert [(r.a.format_hit, r.a.answer) for r in got] == [(True, "12"), (False, "-4"), (False, "0")]
    g = one(spark, A.parse_guess, ['{"guess": "crane"} guess', "try [slate] now", "  hello world",
                                   'guess {"arguments": {"guess": "tiger"}}'])
    assert g == ["crane", "slate", "hello", "tiger"]


def test_reward_components(spark):
    df = spark.createDataFrame([("Let us see. Because 2+2 = 4, the answer is \\boxed{4}",), ("no",)], "c string")
    got = df.select(R.format_score("c").alias("f"), R.length_score("c").alias("l"),
                    R.reasoning_score("c").alias("r")).collect()
    assert (got[0].f, got[0].l, got[0].r) == (0.7, 0.3, 1.0)  # no step words
    assert (got[1].f, got[1].l, got[1].r) == (0.0, 0.0, 0.0)
    acc = spark.createDataFrame([("4", "4", "4", "4", 4.0, 4.0), ("40", "4", "40", "4", 40.0, 4.0),
                                 ("0.5", "1/2", "0.5", "1/2", 0.5, 0.5), ("x", None, "x", "", None, None),
                                 (None, "4", "", "4", None, 4.0)],
                                "p string, g string, pn string, gn string, pv double, gv double")
    a = [r[0] for r in acc.select(R.accuracy("p", "g", "pn", "gn", "pv", "gv")).collect()]
    assert a == [1.0, 0.7, 1.0, 0.3, 0.0]
    t = spark.createDataFrame([("<REASONING>a</REASONING><SOLUTION> 5 </SOLUTION>", "5"),
                               ("<SOLUTION>1</SOLUTION><SOLUTION>1</SOLUTION>", "1")], "c string, a string")
    got = t.select(R.tag_format_reward("c"), R.tag_accuracy_reward("c", "a")).collect()
    assert [tuple(r) for r in got] == [(2.0, 2.0), (0.0, 0.0)]
