"""Evaluation prompts per task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import LETTERS
from ..functions.text import as_col, fill_template
from .shaping import math_prompt

# Which columns hold the question and the gold answer of each task family.
TASK_COLUMNS = {
    "aime24": ("problem", "answer"),
    "aime25": ("problem", "answer"),
    "math_500": ("problem", "solution"),
    "minerva": ("problem", "solution"),
    "amc23": ("problem", "answer"),
    "olympiadbench": ("question", "answer"),
}
GPQA_PROMPT = (
    "Answer the following multiple choice question. The last line of your response should be of the following format: "
    "'Answer: $LETTER' (without quotes) where LETTER is one of ABCD. Think step by step before answering.\n\n"
    "{Question}\n\nA) {A}\nB) {B}\nC) {C}\nD) {D}"
)


def eval_docs(df: DataFrame, task: str, keep: list[str] | None = None) -> DataFrame:
    """Prompt rows of one math task: filled prompt, the gold as only choice, gold index 0."""
    question, gold = TASK_COLUMNS[task]
    return df.select(
        *(keep or []),
        F.lit(task).alias("task_name"),
        math_prompt(question).alias("query"),
        F.array(F.col(gold)).alias("choices"),
        F.lit(0).alias("gold_index"),
        F.lit(None).cast("string").alias("instruction"),
    )


def eval_docs_union(inputs: dict[str, DataFrame], keep: list[str] | None = None) -> DataFrame:
    return reduce(DataFrame.unionByName, [eval_docs(df, task, keep) for task, df in inputs.items()])


def stable_slot(row_id: Column | str, seed: int, slots: int = 4) -> Column:
    """Repeatable pseudo-random slot of a row, the same on every engine that has md5 (``slots`` divides 16)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), as_col(row_id).cast("string")))
    return F.pmod(F.instr(F.lit("0123456789abcdef"), F.substring(digest, 1, 1)) - 1, F.lit(slots))


def gpqa_docs(
    df: DataFrame, row_id: str, question: str, correct: str, incorrect: list[str], seed: int = 42, task: str = "gpqa:diamond"
) -> DataFrame:
    """Multiple-choice rows: the right answer goes to a repeatable random place among the three wrong ones."""
    wrong = F.array(*[F.col(c) for c in incorrect])
    placed = df.withColumn("gold_index", stable_slot(row_id, seed)).withColumn(
        "_options", F.array_insert(wrong, F.col("gold_index") + 1, F.col(correct))
    )
    slots = {letter: F.element_at("_options", i + 1) for i, letter in enumerate(LETTERS)}
    query = fill_template(GPQA_PROMPT, Question=F.col(question), **slots)
    return placed.select(
        row_id,
        F.lit(task).alias("task_name"),
        query.alias("query"),
        F.array(*[F.lit(x) for x in LETTERS]).alias("choices"),
        "gold_index",
        query.alias("instruction"),
    )
