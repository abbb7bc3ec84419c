"""Math answer extraction and normalisation.

All Column expressions. The only loop-like step, balanced-brace matching after the
last ``\\boxed{``, is an ``aggregate`` over the characters of that tail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmill.functions.text import ColumnOrName, col, nz, strip, words

_PY = "(?Ud)"  # Python-like classes and '\n'-only line ends


def boxed_tail(text: ColumnOrName) -> Column:
    """Text after the last ``\\boxed{`` (else after the last ``\\boxed {``); null if neither."""
    t = col(text)
    a = F.when(F.contains(t, F.lit("\\boxed{")), F.regexp_extract(t, r"(?s).*\\boxed\{(.*)", 1))
    b = F.when(F.contains(t, F.lit("\\boxed {")), F.regexp_extract(t, r"(?s).*\\boxed \{(.*)", 1))
    return F.coalesce(a, b)


def _close_index(tail: Column) -> Column:
    """0-based index of the brace closing depth 1 in ``tail``, or -1 if unbalanced."""
    chars = F.split(tail, "")
    init = F.struct(F.lit(1).alias("d"), F.lit(0).alias("i"), F.lit(-1).alias("end"))

    def step(acc, ch):
        d = F.when(ch == "{", acc["d"] + 1).when(ch == "}", acc["d"] - 1).otherwise(acc["d"])
        done = acc["end"] >= 0
        return F.struct(F.when(done, acc["d"]).otherwise(d).alias("d"),
                        (acc["i"] + 1).alias("i"),
                        F.when(done, acc["end"]).when(d == 0, acc["i"]).otherwise(F.lit(-1)).alias("end"))

    return F.aggregate(chars, init, step)["end"]


def extract_boxed(text: ColumnOrName) -> Column:
    """Content of the last ``\\boxed{...}`` with nested braces, stripped; null if unbalanced."""
    tail = boxed_tail(text)
    end = _close_index(F.coalesce(tail, F.lit("")))
    return F.when(tail.isNotNull() & (end >= 0), strip(F.substring(tail, F.lit(1), end)))


# Ordered answer patterns (Python ``re`` syntax), then a trailing number.
ANSWER_PATTERNS = [
    r"[Tt]he\s+(?:final\s+)?answer\s+is[:\s]+([^\n.]+)",
    r"[Ff]inal\s+[Aa]nswer[:\s]+([^\n.]+)",
    r"[Aa]nswer[:\s]+([^\n.]+)",
    r"[Tt]herefore[,\s]+(?:the\s+)?(?:answer\s+is\s+)?([^\n.]+)",
    r"[Ss]o[,\s]+(?:the\s+)?(?:answer\s+is\s+)?([^\n.]+)",
]
TRAILING_NUMBER = r"=\s*([+-]?\d+(?:\.\d+)?)\s*$"


def extract_answer(text: ColumnOrName) -> Column:
    """Boxed content if non-empty, else the first matching pattern's group, else a trailing number.

    Every pattern's group needs at least one character, so an empty extract means no
    match and each pattern runs once per row.
    """
    t = col(text)
    choices = [nz(extract_boxed(t))]
    for p in ANSWER_PATTERNS + [TRAILING_NUMBER]:
        raw = F.regexp_extract(t, _PY + p, 1)
        choices.append(F.when(raw != "", strip(raw)))
    return F.when(t.isNotNull() & (t != ""), F.coalesce(*choices))


# Normalisation rewrites, in order (Python ``re`` pattern, Java replacement).
NORMALIZE_RULES = [
    (r"\\frac\s*\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}\s*\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}", "$1/$2"),
    (r"\\text\s*\{([^}]+)\}", "$1"),
    (r"\\mathrm\s*\{([^}]+)\}", "$1"),
    (r"\\sqrt\s*\{([^}]+)\}", "sqrt($1)"),
    (r"\\[a-zA-Z]+", ""),
    (r"[{}$]", ""),
    (r"(\d+)\s*/\s*(\d+)", "$1/$2"),
    (r"[.,;:!?]+$", ""),
]


def normalize_answer(answer: ColumnOrName) -> Column:
    """T4: lower-case, LaTeX fractions/wrappers/commands removed, whitespace collapsed."""
    a = col(answer)
    out = F.lower(strip(a))
    for p, r in NORMALIZE_RULES:
        out = F.regexp_replace(out, _PY + p, r)
    out = F.array_join(words(out), " ")
    return F.when(a.isNull() | (a == ""), F.lit("")).otherwise(out)


# Python float() syntax: digits with single underscores, optional fraction/exponent, inf/nan.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_RE = (rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
            r"|(?i:inf|infinity|nan))$")


def py_float(s: ColumnOrName) -> Column:
    """``float(s)`` or null; whitespace around the number is allowed as in Python."""
    t = strip(col(s))
    low = F.lower(t)
    special = (F.when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
               .when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
               .when(low.isin("nan", "+nan", "-nan"), F.lit(float("nan"))))
    num = F.regexp_replace(t, "_", "").try_cast("double")
    return F.when(t.rlike(FLOAT_RE), F.coalesce(special, num))


def try_parse_number(s: ColumnOrName) -> Column:
    """T5: float, else ``a/b`` with exactly two parts (null on a zero divisor)."""
    t = strip(col(s))
    parts = F.split(t, "/")
    frac = F.when(F.contains(t, F.lit("/")) & (F.size(parts) == 2),
                  F.try_divide(py_float(F.get(parts, 0)), py_float(F.get(parts, 1))))
    return F.coalesce(py_float(t), frac)


def brace_class(answer: ColumnOrName) -> Column:
    """Simple / nested / deep_nested by maximum brace depth of an extracted answer."""
    from threadmill.functions.text import max_brace_depth
    d = max_brace_depth(answer)
    return F.when(d == 0, "simple").when(d == 1, "nested").otherwise("deep_nested")


def answer_integer(text: ColumnOrName) -> Column:
    """struct(format_hit, answer): ``"answer": n`` sets the hit, else the last integer, else '0'."""
    t = F.coalesce(col(text), F.lit(""))
    keyed = F.regexp_extract(t, r'"answer"\s*:\s*"?(-?\d+)"?', 1)
    ints = F.regexp_extract_all(t, F.lit(r"(-?\d+)"), 1)
    last = F.try_element_at(ints, F.lit(-1))
    return F.struct((keyed != "").alias("format_hit"),
                    F.when(keyed != "", keyed).otherwise(F.coalesce(last, F.lit("0"))).alias("answer"))


def parse_guess(text: ColumnOrName) -> Column:
    """With "guess" and '{' present, the JSON between the first '{' and the last '}'
    (its ``arguments`` object if any) gives ``guess``; else a bracketed five-letter word;
    else the first five characters of the stripped text. Unparsable JSON gives null."""
    t = F.coalesce(col(text), F.lit(""))
    i, j = F.instr(t, "{"), F.length(t) - F.instr(F.reverse(t), "}") + 1
    obj = F.substring(t, i, j - i + 1)
    args = F.coalesce(F.get_json_object(obj, "$.arguments"), obj)
    from_json = F.when(F.get_json_object(obj, "$").isNotNull(),
                       F.coalesce(F.get_json_object(args, "$.guess"), F.lit("")))
    bracket = F.regexp_extract(t, r"\[([a-zA-Z]{5})\]", 1)
    plain = F.when(bracket != "", bracket).otherwise(F.substring(strip(t), 1, 5))
    use_json = F.contains(t, F.lit("guess")) & (i > 0)
    return F.when(use_json, F.when(j > i, from_json)).otherwise(plain)



def boxed_contents(text: ColumnOrName) -> Column:
    """T2 for every box: ``array<string>`` with the content of each ``\\boxed{`` in order of the
    markers, stripped; null where its brace never closes.

    One pass over the text cut behind its braces: a stack holds the open ones, and a closing
    brace that meets a box gives its span, so nested and unbalanced boxes cost no second look.
    """
    parts = F.split(F.coalesce(col(text), F.lit("")), r"(?<=[{}])")
    init = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,box:boolean>>").alias("open"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("shut"), F.array().cast("array<int>").alias("marks"))

    def step(acc, part):
        end = acc["pos"] + F.length(part)
        opens, shuts = part.endswith("{"), part.endswith("}")
        box = part.endswith("\\boxed{") | part.endswith("\\boxed {")
        top = F.try_element_at(acc["open"], F.lit(-1))
        held = F.size(acc["open"])
        stack = (F.when(opens, F.concat(acc["open"], F.array(F.struct(end.alias("start"), box.alias("box")))))
                 .when(shuts & (held > 0), F.slice(acc["open"], F.lit(1), held - 1)).otherwise(acc["open"]))
        shut = F.when(shuts & F.coalesce(top["box"], F.lit(False)),
                      F.concat(acc["shut"], F.array(F.struct(top["start"].alias("start"), (end - 1).alias("end"))))).otherwise(acc["shut"])
        marks = F.when(opens & box, F.concat(acc["marks"], F.array(end))).otherwise(acc["marks"])
        return F.struct(end.alias("pos"), stack.alias("open"), shut.alias("shut"), marks.alias("marks"))

    def contents(acc):
        ends = F.map_from_arrays(F.transform(acc["shut"], lambda x: x["start"]), F.transform(acc["shut"], lambda x: x["end"]))
        return F.transform(acc["marks"], lambda m: strip(F.substring(col(text), m + 1, F.try_element_at(ends, m) - m)))

    return F.aggregate(parts, init, step, contents)
