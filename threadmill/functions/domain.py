"""Domain tagging (P22) and refusal detection."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmill.functions.text import ColumnOrName, col

# Refusal pattern and the ordered domain rules (Python ``re`` syntax,
# all compiled case-insensitive). First matching rule wins; no match -> "general".
REFUSAL_RE = r"\bI (cannot|can't|am unable|don't feel comfortable|must (decline|refuse))\b"

DOMAIN_RULES: list[tuple[str, str]] = [
    ("coding",
     r"```|\bcode\b|\bfunction\b|\bclass\b|\balgorithm\b|\bimplement\b"
     r"|\bpython\b|\bjavascript\b|\bsql\b|\bprogramm\w*\b"),
    ("math",
     r"\b(calculat|solv|proof|theorem|equation|integral|derivative|matrix"
     r"|algebra|geometry|probabilit|statistic|combinatori)\w*\b"
     r"|\$.*?\$|\\frac|\\sum|\\int|\d+\s*[+\-*/^]\s*\d+"),
    ("science",
     r"\b(physics|chemistry|biology|molecule|atom|force|energy|reaction"
     r"|evolution|genetics|neuron|quantum|thermodynam)\w*\b"),
    ("logic",
     r"\b(logic|reasoning|argument|fallacy|deductive|inductive|syllogism"
     r"|valid|sound|premise|paradox)\w*\b"),
    ("humanities",
     r"\b(histor|philosoph|ethic|moral|econom|polic|society|culture"
     r"|literature|art|music|religion|psychology)\w*\b"),
]
DEFAULT_DOMAIN = "general"

# Java flags giving Python semantics: Unicode classes/case folding, '\n'-only lines.
_CI = "(?iUd)"


def is_refusal(c: ColumnOrName) -> Column:
    return col(c).rlike(_CI + REFUSAL_RE)


def _parts(pattern: str) -> list[str]:
    """The top-level alternatives of a rule."""
    out, depth, at = [""], 0, 0
    while at < len(pattern):
        c = pattern[at:at + 2] if pattern[at] == "\\" else pattern[at]
        if c == "|" and depth == 0:
            out.append("")
        else:
            depth += (c in "([") - (c in ")]") if len(c) == 1 else 0
            out[-1] += c
        at += len(c)
    return out


def _literals(part: str) -> list[str]:
    """Literal texts of which every match of an alternative holds one (lower case)."""
    word = re.fullmatch(r"\\b(?:\((?P<many>[a-z|]+)\)|(?P<one>[a-z]+))(?:\\w\*)?\\b", part)
    if word:
        return (word["many"] or word["one"]).split("|")
    if part.startswith(r"\d+"):
        return list("+-*/^")
    return ["$"] if part.startswith(r"\$") else [part.replace("\\\\", "\\")]


def _hit(text: Column, folded: Column, part: str) -> Column:
    """Whether an alternative matches: its pattern runs only on texts that hold one of its literals.

    A digit run before an operator needs no more than its last digit, and one after it no more
    than its first, so the arithmetic pattern is cut to these and never scans a run again.
    """
    present = reduce(or_, [F.contains(folded, F.lit(x)) for x in _literals(part)])
    if part.isalnum() or part == "```" or part.startswith("\\\\"):
        return present                                    # a literal alone
    part = part.replace(r"\d+\s*", r"\d\s*").replace(r"\s*\d+", r"\s*\d")
    return present & text.rlike(_CI + part)


def tag_domain(c: ColumnOrName) -> Column:
    """Ordered CASE over the rules on the (first user) text.

    The text is folded once (as the patterns ignore case, with the letters that fold to ASCII
    outside lower-casing), and each alternative of a rule first looks for its literals in it.
    """
    value = F.coalesce(col(c), F.lit(""))

    def pick(x):
        text, folded = x["text"], x["folded"]
        out = None
        for name, pattern in DOMAIN_RULES:
            cond = reduce(or_, [_hit(text, folded, part) for part in _parts(pattern)])
            out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
        return out.otherwise(F.lit(DEFAULT_DOMAIN))

    both = F.transform(F.array(value), lambda t: F.struct(t.alias("text"), F.lower(F.translate(t, "\u017f\u0131\u0130", "sii")).alias("folded")))
    return F.transform(both, pick)[0]
