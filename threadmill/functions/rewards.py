"""Reward columns over a completions table.

Each component is a Column; ``combined_reward`` is their weighted sum. Inputs are
the completion text, its extracted/normalised answers and the joined ground truth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmill.functions.text import ColumnOrName, col, strip, word_count

# Weights and tolerance of the combined reward.
W_ACCURACY, W_FORMAT, W_LENGTH, W_REASONING = 0.50, 0.25, 0.15, 0.10
NUM_TOLERANCE = 1e-6

# Format and reasoning cues (plain substrings of the lower-cased completion).
STEP_WORDS_RE = r"(step\s*\d|first|second|third|then|next|finally)"
REASONING_GROUPS = [
    (0.4, ["because", "therefore", "since", "thus", "hence"]),
    (0.3, ["let", "given", "we have", "we get", "we can"]),
    (0.3, ["answer", "result", "solution", "final"]),
]


def accuracy(pred: ColumnOrName, gt: ColumnOrName, pred_norm: ColumnOrName, gt_norm: ColumnOrName,
             pred_num: ColumnOrName, gt_num: ColumnOrName) -> Column:
    """1.0 equal; 0.7 substring either way (checked before numbers); 1.0 numerically
    within tolerance; 0.3 for a prediction without truth; else 0."""
    p, g, pn, gn = col(pred), col(gt), col(pred_norm), col(gt_norm)
    both = (F.coalesce(p, F.lit("")) != "") & (F.coalesce(g, F.lit("")) != "")
    close = F.abs(col(pred_num) - col(gt_num)) < NUM_TOLERANCE
    scored = (F.when(pn == gn, 1.0)
              .when(F.contains(gn, pn) | F.contains(pn, gn), 0.7)
              .when(col(pred_num).isNotNull() & col(gt_num).isNotNull() & close, 1.0)
              .otherwise(0.0))
    return (F.when(both, scored)
            .when(F.coalesce(p, F.lit("")) != "", F.lit(0.3))
            .otherwise(F.lit(0.0)))


def format_score(completion: ColumnOrName) -> Column:
    """Boxed 0.5, step words 0.3, an operator character 0.2 (capped at 1)."""
    c = F.coalesce(col(completion), F.lit(""))
    s = (F.when(c.rlike(r"\\boxed\{"), 0.5).otherwise(0.0)
         + F.when(F.lower(c).rlike("(?Ud)" + STEP_WORDS_RE), 0.3).otherwise(0.0)
         + F.when(c.rlike(r"[=+\-*/^]"), 0.2).otherwise(0.0))
    return F.least(s, F.lit(1.0))


def length_score(completion: ColumnOrName) -> Column:
    """Word-count bands."""
    n = word_count(completion)
    return (F.when(n < 10, 0.0).when(n < 30, 0.3).when(n < 100, 0.7).when(n < 300, 1.0).otherwise(0.8))


def reasoning_score(completion: ColumnOrName) -> Column:
    """R1d: cue groups (plain substrings, so 'let' also matches 'complete'), capped at 1."""
    low = F.lower(F.coalesce(col(completion), F.lit("")))
    total = F.lit(0.0)
    for w, cues in REASONING_GROUPS:
        hit = F.lit(False)
        for cue in cues:
            hit = hit | F.contains(low, F.lit(cue))
        total = total + F.when(hit, w).otherwise(0.0)
    return F.least(total, F.lit(1.0))


def combined(acc: ColumnOrName, fmt: ColumnOrName, length: ColumnOrName, rsn: ColumnOrName) -> Column:
    """Weighted sum."""
    return (col(acc) * W_ACCURACY + col(fmt) * W_FORMAT + col(length) * W_LENGTH + col(rsn) * W_REASONING)


# Tag-format reward blocks (R2/R3), DOTALL.
REASONING_BLOCK = r"(?s)<REASONING>(.*?)</REASONING>"
SOLUTION_BLOCK = r"(?s)<SOLUTION>(.*?)</SOLUTION>"


def tag_format_reward(completion: ColumnOrName) -> Column:
    """R2: +1 for exactly one REASONING block, +1 for exactly one SOLUTION block."""
    c = F.coalesce(col(completion), F.lit(""))
    n_r = F.size(F.regexp_extract_all(c, F.lit(REASONING_BLOCK), 1))
    n_s = F.size(F.regexp_extract_all(c, F.lit(SOLUTION_BLOCK), 1))
    return F.when(n_r == 1, 1.0).otherwise(0.0) + F.when(n_s == 1, 1.0).otherwise(0.0)


def tag_accuracy_reward(completion: ColumnOrName, answer: ColumnOrName) -> Column:
    """2.0 if exactly one SOLUTION block, stripped, equals the answer."""
    c = F.coalesce(col(completion), F.lit(""))
    sols = F.regexp_extract_all(c, F.lit(SOLUTION_BLOCK), 1)
    one = F.size(sols) == 1
    return F.when(one & (strip(F.try_element_at(sols, F.lit(1))) == col(answer)), 2.0).otherwise(0.0)


INVALID_MOVE = "You attempted an invalid move"  # fixed value


# Reward name -> Column of a completion and its reference answer.
REWARDS = {
    "format_reward": lambda completion, answer: tag_format_reward(completion),
    "accuracy_reward": tag_accuracy_reward,
}


def rewards_by_name(names: list[str], completion: ColumnOrName, answer: ColumnOrName) -> list[Column]:
    """K: the rewards of a run, given by name and in that order, each under its name."""
    unknown = [n for n in names if n not in REWARDS]
    if unknown:
        raise ValueError(f"unknown rewards {unknown}; known: {', '.join(REWARDS)}")
    return [REWARDS[n](completion, answer).alias(n) for n in names]


def invalid_move_reward(feedback: ColumnOrName, reward: ColumnOrName) -> Column:
    """Reward forced to 0 when the new feedback reports an invalid move."""
    return F.when(F.contains(F.coalesce(col(feedback), F.lit("")), F.lit(INVALID_MOVE)), 0.0).otherwise(col(reward))
