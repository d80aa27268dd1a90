"""Row-scope rewards over completions. Each builder returns one double Column and needs no shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, count_substring, is_non_english, ngrams, py_split, py_strip

# Tags, step markers and the code answer layout that the rewards look for.
OPEN_THINK = "<think>\n"
CLOSE_THINK = "\n</think>\n"
STEP_MARKERS = r"(Step \d+:|^\d+\.|\n-|\n\*|First,|Second,|Next,|Finally,)"
STEPS_FOR_FULL_REWARD = 3
ANSWER_START = "\n</think>\n<answer>\n"
ANSWER_END = "\n</answer>"
FENCE = "```"


def _one_if(cond: Column, value: float = 1.0) -> Column:
    return F.when(cond, F.lit(value)).otherwise(F.lit(0.0))


def format_reward(content: Column | str) -> Column:
    """1.0 iff the closing think line occurs exactly once."""
    return _one_if(count_substring(content, CLOSE_THINK) == 1)


def tag_count_reward(content: Column | str) -> Column:
    """Half a point for exactly one opening tag line and half for exactly one closing line."""
    return _one_if(count_substring(content, OPEN_THINK) == 1, 0.5) + _one_if(
        count_substring(content, CLOSE_THINK) == 1, 0.5
    )


def reasoning_steps_reward(content: Column | str) -> Column:
    """Step markers found, as a share of three, at most 1.0. A numbered item counts only at the start of the text."""
    found = F.regexp_count(as_col(content), F.lit("(?U)" + STEP_MARKERS))
    return F.least(F.lit(1.0), found / F.lit(STEPS_FOR_FULL_REWARD))


def with_repetition_penalty(
    df: DataFrame, content: str = "content", n: int = 3, max_penalty: float = -1.0, out: str = "repetition_penalty"
) -> DataFrame:
    """Share of repeated word n-grams times ``max_penalty``; 0.0 for texts shorter than ``n`` words.

    Row-local on purpose: exploding the n-grams would shuffle many times the text. Words and n-grams are bound as
    columns, each computed once.
    """
    if max_penalty > 0:
        raise ValueError(f"max_penalty {max_penalty} must not be positive")
    words = df.withColumn("_words", py_split(F.lower(content)))
    grams = words.withColumn("_grams", F.when(F.size("_words") >= n, ngrams("_words", n)))
    repeated = F.lit(1.0) - F.size(F.array_distinct("_grams")) / F.size("_grams")
    penalty = F.when(F.col("_grams").isNotNull(), repeated * F.lit(float(max_penalty))).otherwise(F.lit(0.0))
    return grams.select(*df.columns, penalty.alias(out))


def accuracy_reward(gold_norm: Column | str = "gold_norm", is_correct: Column | str = "is_correct") -> Column:
    """1.0 for a right answer, and also when the gold answer is unusable (the row is then skipped, not punished)."""
    return _one_if(as_col(gold_norm).isNull() | as_col(is_correct))


def cosine_scaled_reward(
    content: Column | str = "content",
    gold_norm: Column | str = "gold_norm",
    is_correct: Column | str = "is_correct",
    min_value_wrong: float = -1.0,
    max_value_wrong: float = -0.5,
    min_value_correct: float = 0.5,
    max_value_correct: float = 1.0,
    max_len: int = 1000,
) -> Column:
    """Half-cosine over text length between two end values that depend on correctness.

    Not clamped: past ``max_len`` the curve turns back. An unusable gold gives 1.0.
    """
    wave = (F.lit(1.0) + F.cos(F.length(as_col(content)) / F.lit(max_len) * F.lit(math.pi))) * F.lit(0.5)

    def between(at_full_length: float, at_zero_length: float) -> Column:
        return F.lit(float(at_full_length)) + F.lit(float(at_zero_length - at_full_length)) * wave

    return (
        F.when(as_col(gold_norm).isNull(), F.lit(1.0))
        .when(as_col(is_correct), between(min_value_correct, max_value_correct))
        .otherwise(between(max_value_wrong, min_value_wrong))
    )


def _past(needle: str, c: Column, start: Column) -> Column:
    """Position right after the first ``needle`` at or behind ``start``; null without one."""
    return F.nullif(F.position(F.lit(needle), c, start), F.lit(0)) + F.lit(len(needle))


def code_format_reward(content: Column | str, language: str = "python") -> Column:
    """1.0 iff the text opens with a think block followed by an answer block holding a fenced ``language`` block.

    The closing answer tag must end a line; more lines may follow. Taking the first occurrence of each part in turn
    leaves the most room for the next one, so a chain of linear searches decides it without a backtracking regex.
    """
    c = as_col(content)
    at = F.lit(len(OPEN_THINK) + 1)
    for part in (ANSWER_START, FENCE + language, FENCE):
        at = _past(part, c, at)
    rest = F.substring(c, at, F.length(c))
    closed = rest.contains(ANSWER_END + "\n") | rest.endswith(ANSWER_END)
    return _one_if(F.coalesce(c.startswith(OPEN_THINK) & closed, F.lit(False)))


def quality_checks(df: DataFrame, content: str = "content") -> DataFrame:
    c = F.col(content)

    def both(tag: str) -> Column:
        return c.contains(f"<{tag}>") & c.contains(f"</{tag}>")

    return df.select(
        "*",
        both("think").alias("has_think"),
        both("answer").alias("has_answer"),
        F.length(c).cast("bigint").alias("n_chars"),
    )


def gold_policies(df: DataFrame) -> DataFrame:
    """How the graded rewards treat a row whose gold answer cannot be used: three separate rules."""
    unusable = F.col("gold_norm").isNull()
    return df.select(
        "*",
        unusable.alias("gold_unusable"),
        F.when(unusable, F.lit(1.0)).alias("accuracy_default"),
        F.when(unusable, F.lit(1.0)).alias("cosine_default"),
        (unusable | F.col("is_correct")).alias("length_counts_as_correct"),
    )


def english_reward(content: Column | str) -> Column:
    return F.when(is_non_english(content), F.lit(0.0)).otherwise(F.lit(1.0))


def case_passes(stdout: Column, expected: Column) -> Column:
    """Line-by-line comparison after stripping, over the shorter of the two outputs.

    Zipping pads the shorter side with nulls, so a null comparison marks a line that does not count. Texts that are
    equal up to closing newlines pass without being split.
    """
    shown = py_strip(stdout)
    same = F.zip_with(
        F.split(shown, "\n", -1), F.split(expected, "\n", -1), lambda a, b: F.coalesce(py_strip(a) == py_strip(b), F.lit(True))
    )
    return F.when(shown == F.rtrim(expected, F.lit("\n")), F.lit(True)).otherwise(F.forall(same, lambda ok: ok))


def code_pass_rate(completions: DataFrame, runs: DataFrame, key: str = "completion_id") -> DataFrame:
    """Share of passed test cases per completion, from recorded runs.

    A case passes with return code 0 and matching output. One timeout, or no case at all, gives 0.0. The runs are
    pre-aggregated per completion on the map side, so a completion with very many cases does not load one task.
    """
    passed = (F.col("returncode") == 0) & case_passes(F.col("stdout"), F.col("expected"))
    rates = runs.groupBy(key).agg(
        F.avg(F.coalesce(passed, F.lit(False)).cast("double")).alias("_rate"),
        F.bool_or("timed_out").alias("_timed_out"),
    )
    rate = F.when(F.col("_timed_out"), F.lit(0.0)).otherwise(F.coalesce("_rate", F.lit(0.0)))
    return completions.join(rates, key, "left").withColumn("code_reward", rate).drop("_rate", "_timed_out")
