"""Token counts and labels with a tokenizer chosen by name (K, A4, A5, P33, P39).

A tokenizer is loaded once per worker, inside an Arrow iterator, and sees whole texts in
slices of bounded size. Labels leave a slice at a time, and a finished task hands its memory back. Names:

* ``basic``: runs of ASCII letters, digits and ``_``, and every other character that is not
  ASCII white space (ids are crc32 values of the token);
* a path that ends in ``.json``: a file of the ``tokenizers`` library.

Offsets are code points, as Spark's ``length`` and ``substring`` count them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions.text import ColumnOrName, col

#: The label of a token that takes no part in the loss (fixed value).
IGNORED = -100
#: Code points tokenized at once; a longer text goes alone.
SLICE_CHARS = 1 << 18

BASIC_PATTERN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]"


def load(name: str):
    """texts -> list of (ids, starts, ends), one entry per text."""
    if name == "basic":
        import re
        import zlib
        rule = re.compile(BASIC_PATTERN)

        def basic(texts):
            for t in texts:
                found = list(rule.finditer(t))
                yield ([zlib.crc32(m[0].encode()) & 0x7FFFFFFF for m in found], [m.start() for m in found], [m.end() for m in found])
        return basic
    if not name.endswith(".json"):
        raise ValueError(f"unknown tokenizer {name!r}: 'basic' or the path of a tokenizers file")
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark runs one task a core
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(name)
    tok.encode_special_tokens = True                             # their strings in a text are ordinary text

    def library(texts):
        for e in tok.encode_batch(list(texts), add_special_tokens=False):
            yield e.ids, [a for a, _ in e.offsets], [b for _, b in e.offsets]
    return library


def _slices(texts: list[str]):
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def _release() -> None:
    """Hands freed memory back to the system, where the C library can: Spark keeps a worker for later
    tasks, which otherwise holds the most that any of its tasks took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def token_count(text: ColumnOrName, tokenizer: str = "basic") -> Column:
    """Number of tokens of the whole text (null: 0)."""
    @F.pandas_udf(T.LongType())
    def count(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load(tokenizer)
        try:
            for s in it:
                texts, out = s.tolist(), []
                for a, b in _slices(texts):
                    out += [len(ids) for ids, _, _ in encode(texts[a:b])]
                yield pd.Series(out, dtype="int64")
        finally:
            _release()
    return count(F.coalesce(col(text), F.lit("")))


def inside(starts, ends, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """Which tokens lie wholly inside a span: both lists are sorted, spans are disjoint.

    The span that can hold a token is the last one starting at or before it; empty tokens are in none.
    """
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    at = np.searchsorted(span_starts, starts, "right") - 1
    if not len(span_starts):
        return np.zeros(len(starts), bool)
    return (at >= 0) & (ends <= span_ends[np.maximum(at, 0)]) & (ends > starts)


LABELS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_trainable", T.LongType()),
                       T.StructField("input_ids", T.ArrayType(T.IntegerType())), T.StructField("labels", T.ArrayType(T.IntegerType()))])


def token_labels(text: ColumnOrName, spans: ColumnOrName, tokenizer: str = "basic") -> Column:
    """Ids of the text's tokens, and labels: the id inside a span (start, end), else ``IGNORED``.

    ``spans`` are sorted, disjoint ``array<struct<start,end>>`` of code points, end exclusive
    (``messages.assistant_spans``). Null text: no tokens; null spans: nothing is trainable.
    """
    @F.pandas_udf(LABELS)
    def label(it: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encode = load(tokenizer)
        try:
            for texts, lo, hi in it:
                texts = texts.tolist()
                # a frame per slice: the labels of a whole batch would be held at once otherwise
                for a, b in _slices(texts):
                    yield pd.DataFrame(_labelled(encode(texts[a:b]), lo[a:b], hi[a:b]), columns=["n_tokens", "n_trainable", "input_ids", "labels"])
        finally:
            _release()
    s = F.coalesce(col(spans), F.array().cast("array<struct<start:int,end:int>>"))
    return label(F.coalesce(col(text), F.lit("")), F.transform(s, lambda x: x["start"]), F.transform(s, lambda x: x["end"]))


def _labelled(encoded, lo, hi) -> list[tuple]:
    out = []
    for (ids, starts, ends), s, e in zip(encoded, lo, hi):
        keep = inside(starts, ends, np.asarray(s, np.int64), np.asarray(e, np.int64))
        ids = np.asarray(ids, np.int32)
        out.append((len(ids), int(keep.sum()), ids, np.where(keep, ids, np.int32(IGNORED))))
    return out


def label_rows(df: DataFrame, text: str, spans: str, tokenizer: str = "basic") -> DataFrame:
    """Adds n_tokens, n_trainable, input_ids, labels and ``drop_reason``: ``empty`` for rows without
    tokens, ``zero_signal`` for rows with no trainable token, null for rows that a loss can use."""
    d = df.withColumn("_lab", token_labels(text, spans, tokenizer)).select("*", "_lab.*").drop("_lab")
    return d.withColumn("drop_reason", F.when(F.col("n_tokens") == 0, "empty").when(F.col("n_trainable") == 0, "zero_signal"))
