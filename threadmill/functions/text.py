"""Text semantics shared by every operator (T*).

Python's ``str`` methods and ``re`` module define the behaviour to match. Java
regex differs in three ways that matter, so patterns here carry flags:

* ``(?U)``  Unicode ``\\w``, ``\\b``, ``\\s``, ``\\d`` and Unicode case folding, as ``re`` on str.
* ``(?d)``  only ``\\n`` ends a line for ``.`` and ``$``, as in ``re``.
* ``(?s)``  added where the original pattern was compiled with DOTALL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python ``str.isspace()`` characters; ``trim`` would only remove spaces.
WS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
#: The characters of ``WS``.
WS_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: ColumnOrName) -> Column:
    """``str.strip()``: remove leading/trailing whitespace. Read from both ends; a pattern would try
    every run of whitespace inside."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def nz(c: ColumnOrName) -> Column:
    """Python truthiness for text: null and '' are both 'missing' -> null."""
    c = col(c)
    return F.when(c != "", c)


def first_nonempty(*cols: ColumnOrName) -> Column:
    """``a or b or c``: first value that is neither null nor ''."""
    return F.coalesce(*[nz(c) for c in cols])


def words(c: ColumnOrName) -> Column:
    """``str.split()``: whitespace runs as separators, no empty tokens."""
    return F.filter(F.split(col(c), f"{WS}+"), lambda t: t != "")


def word_count(c: ColumnOrName) -> Column:
    """``len(text.split())``."""
    return F.size(words(F.coalesce(col(c), F.lit(""))))


def prompt_key(c: ColumnOrName) -> Column:
    """Drop ``<|...|>`` special markers, then strip."""
    return strip(F.regexp_replace(col(c), r"<\|[^|]*\|>", ""))


def slug(c: ColumnOrName) -> Column:
    """Lower-case, runs of non-alphanumerics -> '-', trimmed of '-'."""
    s = F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")


def sum_of_integers(c: ColumnOrName) -> Column:
    """Sum of all (optionally negative) integers appearing in the text."""
    nums = F.regexp_extract_all(col(c), F.lit(r"(-?\d+)"), 1)
    return F.aggregate(nums, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def max_brace_depth(c: ColumnOrName) -> Column:
    """Deepest ``{`` nesting reached while scanning left to right."""
    chars = F.split(F.regexp_replace(col(c), r"[^{}]", ""), "")
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("m"))

    def step(acc, ch):
        d = F.when(ch == "{", acc["d"] + 1).when(ch == "}", acc["d"] - 1).otherwise(acc["d"])
        return F.struct(d.alias("d"), F.greatest(acc["m"], d).alias("m"))

    return F.aggregate(chars, init, step)["m"]


def ascii_share(c: ColumnOrName, prefix: int = 400) -> Column:
    """Share of code points < 128 among the first ``prefix`` characters (0.0 if empty)."""
    s = F.substring(col(c), 1, prefix)
    n = F.length(s)
    ascii_n = F.length(F.regexp_replace(s, r"[^\x00-\x7F]", ""))
    return F.when(n > 0, ascii_n / n).otherwise(F.lit(0.0))


def json_list_lines(c: ColumnOrName) -> Column:
    """A JSON list rendered one element per line; non-list JSON keeps the raw text.

    Elements are emitted as JSON text (objects stay JSON, strings lose their quotes).
    """
    arr = F.from_json(col(c), "array<string>")
    return F.coalesce(F.array_join(arr, "\n"), col(c))
