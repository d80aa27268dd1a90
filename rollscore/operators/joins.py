"""Keyed alignments. Column lists that would be zipped by position become joins, so nothing is cut to the shorter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import parse_task_key
from .skew import attach_by_key

UNKNOWN = "unknown"
CHECKPOINT = ["exp", "step"]


def join_gold(completions: DataFrame, gold: DataFrame, key: str = "prompt_id", row_id: str = "completion_id", **bounds: int) -> DataFrame:
    """Gold answer of each completion (inner). A prompt may own a large share of all completions."""
    joined = attach_by_key(completions, gold, [key], [row_id], **bounds)
    return joined.where("_matched").drop("_matched")


def join_verification(completions: DataFrame, info: DataFrame, key: str = "prompt_id", row_id: str = "completion_id", **bounds: int) -> DataFrame:
    """One row per completion and test case of its prompt."""
    joined = attach_by_key(completions, info, [key], [row_id], **bounds).where("_matched").drop("_matched")
    cases = F.posexplode("verification_info.test_cases").alias("case_id", "_case")
    rows = joined.select("*", F.col("verification_info.language").alias("language"), cases)
    return rows.select(
        *[c for c in joined.columns if c != "verification_info"],
        "language",
        "case_id",
        F.col("_case.input").alias("input"),
        F.col("_case.output").alias("expected"),
    )


def join_revision(runs: DataFrame, revisions: DataFrame) -> DataFrame:
    """Commit of each checkpoint, or ``unknown``. The revision table is fixed and tiny."""
    return runs.join(F.broadcast(revisions), CHECKPOINT, "left").withColumn(
        "revision", F.coalesce("revision", F.lit(UNKNOWN))
    )


def unknown_revision(runs: DataFrame, revisions: DataFrame) -> DataFrame:
    """Checkpoints with results but without a known commit."""
    return runs.select(*CHECKPOINT).distinct().join(F.broadcast(revisions), CHECKPOINT, "left_anti")


def join_task_config(runs: DataFrame, tasks: DataFrame, key: str = "task_key") -> DataFrame:
    """Task definition by the name inside the log key."""
    defs = tasks.select(F.col("task").alias("_task"), "dataset", "split", "prompt", "metric", "generation_size")
    named = runs.withColumn("_parsed", parse_task_key(key)["task"])
    return named.join(F.broadcast(defs), F.col("_parsed") == F.col("_task")).drop("_parsed", "_task")


def published_vs_logged(averages: DataFrame, published: DataFrame) -> DataFrame:
    """Published percentages next to averages from logs."""
    joined = averages.join(F.broadcast(published), CHECKPOINT)
    logged = F.col("macro_score") * F.lit(100.0)
    return joined.select(
        "model", *CHECKPOINT, "published", logged.alias("logged"), F.abs(F.col("published") - logged).alias("abs_diff")
    )
