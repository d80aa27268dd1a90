"""Checkpoint sweeps over run logs.

Step windows run over rows already aggregated to one per (experiment, task, step): a partition holds at most the number
of distinct steps of one experiment, whatever the number of samples behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import hash_ordinal, unit_dense_rank


def per_step(runs: DataFrame, keys: Sequence[str] = ("exp", "task"), step: str = "step") -> DataFrame:
    """One score per step: the mean of its runs."""
    return runs.groupBy(*keys, step).agg(F.avg("score").alias("score"))


def best_checkpoint(averages: DataFrame, by: Sequence[str] = ("exp",), score: str = "macro_score") -> DataFrame:
    """Top checkpoint of each experiment, the earliest one on ties. An aggregate, so no group is sorted."""
    best = F.max(F.struct(F.col(score).alias("score"), (-F.col("step")).alias("neg_step"))).alias("_best")
    return averages.groupBy(*by).agg(best).select(
        *by, (-F.col("_best.neg_step")).alias("step"), F.col("_best.score").alias(score)
    )


def step_delta(curve: DataFrame, keys: Sequence[str] = ("exp", "task")) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("step")
    return curve.withColumn("delta", F.col("score") - F.lag("score").over(w))


def running_best(curve: DataFrame, keys: Sequence[str] = ("exp", "task")) -> DataFrame:
    """Best score so far, and how far the current one has dropped from it."""
    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = F.max("score").over(w)
    return curve.withColumn("best_so_far", best).withColumn("drop", F.col("best_so_far") - F.col("score"))


def smoothed_curve(curve: DataFrame, keys: Sequence[str] = ("exp", "task"), width: int = 3) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(-(width - 1), 0)
    return curve.withColumn("smoothed", F.avg("score").over(w))


def latest_run(runs: DataFrame, by: Sequence[str] = ("suite", "exp", "step", "task")) -> DataFrame:
    """Newest run of every checkpoint and task, as an aggregate over (time, row) instead of a sorted window."""
    rest = [c for c in runs.columns if c not in by and c != "run_ts"]
    newest = F.max_by(F.struct("run_ts", *rest), F.struct(F.col("run_ts"), *[F.col(c) for c in rest])).alias("_r")
    return runs.groupBy(*by).agg(newest).select(*by, "_r.*")


def rank_models(averages: DataFrame, by: Sequence[str] = ("task",), score: str = "score", row_id: Sequence[str] = ("exp", "step")) -> DataFrame:
    """Dense rank with ties, best first. Scores lie in 0..1."""
    return unit_dense_rank(averages, by, score, "rank", row_id)


def leaderboard_topk(averages: DataFrame, k: int, score: str = "macro_score", tie: Sequence[str] = ("exp", "step")) -> DataFrame:
    return averages.orderBy(F.desc(score), *tie).limit(k)


def shuffle_digest(row_id: Column | str, seed: int) -> Column:
    c = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def seeded_shuffle(df: DataFrame, row_id: str, seed: int = 42, out: str = "position") -> DataFrame:
    """Position of every row in a repeatable random order that does not depend on partitioning."""
    return hash_ordinal(df, shuffle_digest(row_id, seed), [row_id], out)
