"""Group-scope rewards: statistics per prompt, attached to rows without a per-prompt window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import attach_group_stats

# Our choice of the small constant in the group-relative score.
ADVANTAGE_EPS = 1.0e-4


def with_len_reward(
    df: DataFrame,
    group: Sequence[str] = ("prompt_id",),
    row_id: Sequence[str] = ("completion_id",),
    content: str = "content",
    out: str = "len_reward",
    **bounds: int,
) -> DataFrame:
    """Shorter texts of a group score higher, from 0.5 down to -0.5; wrong answers never above 0.

    Equal lengths score 0.0. Rows with an unusable gold count as correct and still take part in min and max.
    """
    sized = df.withColumn("_len", F.length(content))
    stats = {"_min_len": F.min("_len"), "_max_len": F.max("_len")}
    joined = attach_group_stats(sized, group, row_id, stats, **bounds)
    span = F.col("_max_len") - F.col("_min_len")
    scaled = F.lit(0.5) - F.try_divide(F.col("_len") - F.col("_min_len"), span)
    correct = F.col("gold_norm").isNull() | F.col("is_correct")
    reward = F.when(span == 0, F.lit(0.0)).when(correct, scaled).otherwise(F.least(F.lit(0.0), scaled))
    return joined.select(*df.columns, reward.alias(out))


def with_group_advantage(
    df: DataFrame,
    reward: str = "reward",
    group: Sequence[str] = ("prompt_id",),
    row_id: Sequence[str] = ("completion_id",),
    out: str = "advantage",
    eps: float = ADVANTAGE_EPS,
    **bounds: int,
) -> DataFrame:
    """(reward - group mean) / (group sample deviation + eps); a single-row group has deviation 0."""
    stats = {"_mean": F.avg(reward), "_std": F.stddev_samp(reward)}
    joined = attach_group_stats(df, group, row_id, stats, **bounds)
    scale = F.coalesce("_std", F.lit(0.0)) + F.lit(eps)
    return joined.select(*df.columns, ((F.col(reward) - F.col("_mean")) / scale).alias(out))


def reward_summary(df: DataFrame, rewards: Sequence[str], by: Sequence[str] = ("step",)) -> DataFrame:
    """Count, mean, deviation and range of every reward per step, in long form."""
    long = df.select(
        *by, F.explode(F.array(*[F.struct(F.lit(r).alias("reward"), F.col(r).alias("value")) for r in rewards])).alias("r")
    ).select(*by, "r.reward", "r.value")
    return long.groupBy(*by, "reward").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
