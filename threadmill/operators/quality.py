"""Quality gates and drop accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions.domain import is_refusal
from threadmill.functions.text import ColumnOrName, col, strip

MIN_ANSWER_LEN = 50   # fixed value: quality filter, characters
MIN_TARGET_LEN = 16   # fixed value: trainable completion must be longer than this


def quality_reason(answer: ColumnOrName, min_len: int = MIN_ANSWER_LEN) -> Column:
    """First failing check of the last message's content, or null if it passes."""
    a = col(answer)
    return (F.when(a.isNull() | (a == ""), F.lit("empty"))
            .when(F.length(a) < min_len, F.lit("short"))
            .when(is_refusal(a), F.lit("refusal")))


def has_target(completion: ColumnOrName, min_len: int = MIN_TARGET_LEN) -> Column:
    """Stripped completion longer than ``min_len`` characters."""
    return F.length(strip(F.coalesce(col(completion), F.lit("")))) > min_len


def first_reason(*checks: tuple[Column, str]) -> Column:
    """One ``drop_reason`` column, the first matching check in order, else null."""
    out = None
    for cond, name in checks:
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def reason_counts(df: DataFrame, reason_col: str = "drop_reason") -> DataFrame:
    """P21 report: rows per reason, kept rows under 'kept'; totals equal the input."""
    return (df.groupBy(F.coalesce(F.col(reason_col), F.lit("kept")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))
