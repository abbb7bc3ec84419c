"""The few per-row Python helpers, as Arrow (pandas) UDFs (P5, T17, tokenizer hook).

Each works on one value at a time inside Arrow batches; Spark partitions and
schedules the work. Nothing here collects data or calls out of the task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPR_MSG = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()), T.StructField("from", T.StringType()),
    T.StructField("content", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("reasoning", T.StringType()), T.StructField("thinking", T.StringType()),
]))


def _decode_repr(v):
    import ast
    if v is None or v == "":
        return None
    try:
        msgs = ast.literal_eval(v)
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        return None
    if not isinstance(msgs, list) or not msgs or not all(isinstance(m, dict) for m in msgs):
        return None

    def s(x):
        return None if x is None else str(x)

    return [{k: s(m.get(k)) for k in ("role", "from", "content", "value", "reasoning", "thinking")} for m in msgs]


@F.pandas_udf(REPR_MSG)
def decode_repr_messages(s: pd.Series) -> pd.Series:
    """P5: a Python-repr list of message dicts (single quotes) -> array of structs; null if unparsable."""
    return s.map(_decode_repr)


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence length, bit-parallel over ``a`` (Allison-Dix / Hyyro)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, t in enumerate(a):
        masks[t] = masks.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for t in b:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in ("lcs", "left", "right")]))
def _token_overlap(pred: pd.Series, gold: pd.Series) -> pd.DataFrame:
    """Length of the longest common subsequence of whitespace tokens, and both token counts."""
    sides = [s.fillna("").str.split() for s in (pred, gold)]
    return pd.DataFrame({"lcs": [lcs_length(a, b) if a and b else 0 for a, b in zip(*sides)],
                         "left": sides[0].str.len(), "right": sides[1].str.len()})


def rouge_l(pred: str, gold: str):
    """ROUGE-L F1 over whitespace tokens; only the subsequence length needs Python."""
    o = _token_overlap(pred, gold)
    precision, recall = o["lcs"] / o["left"], o["lcs"] / o["right"]
    return F.when(o["lcs"] > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _printed_elements(s: pd.Series) -> pd.Series:
    """``str`` of each element of a parsed JSON value; null where it has none or is not JSON."""
    import json

    def elements(text):
        try:
            return [*map(str, json.loads(text))]
        except (TypeError, ValueError):
            return None

    return s.map(elements)


def json_list_lines_py(c: str):
    """T6 with Python's own rendering: the elements of a JSON value printed with ``str``, one
    per line (an object gives its keys, a string its characters); text without elements stays
    as it is. ``str`` of nested values has no Spark built-in, hence the Arrow UDF."""
    return F.coalesce(F.array_join(_printed_elements(c), "\n"), F.col(c))
