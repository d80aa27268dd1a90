"""Rewards by name, their weighted sum, and user-defined rewards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import with_grading
from . import rewards as R
from .groups import with_group_advantage, with_len_reward

# Rewards used when none are named.
DEFAULT_REWARDS = ["accuracy", "format", "tag_count"]


@dataclass
class RewardConfig:
    """Plan-time constants of the parameterised rewards (fixed default values)."""

    cosine_min_value_wrong: float = 0.0
    cosine_max_value_wrong: float = -0.5
    cosine_min_value_correct: float = 0.5
    cosine_max_value_correct: float = 1.0
    cosine_max_len: int = 1000
    repetition_n_grams: int = 3
    repetition_max_penalty: float = -1.0
    code_language: str = "python"
    content: str = "content"
    gold: str = "solution"
    equivalence: bool = True
    group: Sequence[str] = ("prompt_id",)
    row_id: Sequence[str] = ("completion_id",)
    bounds: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class ByColumn:
    """A reward that is one expression over the row."""

    build: Callable[[RewardConfig], Column]


@dataclass(frozen=True)
class ByTable:
    """A reward that needs helper columns or statistics of its group."""

    add: Callable[[DataFrame, RewardConfig, str], DataFrame]
    grouped: bool = False


def _cosine(cfg: RewardConfig) -> Column:
    return R.cosine_scaled_reward(
        cfg.content,
        min_value_wrong=cfg.cosine_min_value_wrong,
        max_value_wrong=cfg.cosine_max_value_wrong,
        min_value_correct=cfg.cosine_min_value_correct,
        max_value_correct=cfg.cosine_max_value_correct,
        max_len=cfg.cosine_max_len,
    )


def _repetition(df: DataFrame, cfg: RewardConfig, out: str) -> DataFrame:
    return R.with_repetition_penalty(df, cfg.content, cfg.repetition_n_grams, cfg.repetition_max_penalty, out)


def _length(df: DataFrame, cfg: RewardConfig, out: str) -> DataFrame:
    return with_len_reward(df, cfg.group, cfg.row_id, cfg.content, out, **cfg.bounds)


REGISTRY: dict[str, ByColumn | ByTable] = {
    "accuracy": ByColumn(lambda cfg: R.accuracy_reward()),
    "format": ByColumn(lambda cfg: R.format_reward(cfg.content)),
    "reasoning_steps": ByColumn(lambda cfg: R.reasoning_steps_reward(cfg.content)),
    "cosine": ByColumn(_cosine),
    "repetition_penalty": ByTable(_repetition),
    "length": ByTable(_length, grouped=True),
    "code": ByColumn(lambda cfg: F.col("code_reward")),
    "code_format": ByColumn(lambda cfg: R.code_format_reward(cfg.content, cfg.code_language)),
    "tag_count": ByColumn(lambda cfg: R.tag_count_reward(cfg.content)),
}
GRADED = {"accuracy", "cosine", "length"}


def register(name: str, build: Callable[[], Column]) -> None:
    """Add a reward of your own: ``build`` returns a Column expression, or a pandas_udf call on columns."""
    REGISTRY[name] = ByColumn(lambda cfg: build())


def add_rewards(
    df: DataFrame, names: Sequence[str] = tuple(DEFAULT_REWARDS), config: RewardConfig | None = None
) -> DataFrame:
    """One ``reward_<name>`` column per chosen reward. An unknown name raises KeyError while the plan is built.

    The ``code`` reward reads a ``code_reward`` column (see ``code_pass_rate``). Gold and answer are parsed once for
    all graded rewards.
    """
    cfg = config or RewardConfig()
    chosen = {n: REGISTRY[n] for n in names}
    if GRADED & set(names) and "is_correct" not in df.columns:
        df = with_grading(df, cfg.content, cfg.gold, cfg.equivalence)
    # Row-local rewards first: whatever reads the text is done before the group shuffle, which then need not carry it.
    tables = sorted(((n, r) for n, r in chosen.items() if isinstance(r, ByTable)), key=lambda nr: nr[1].grouped)
    local = [(n, r) for n, r in tables if not r.grouped]
    for name, reward in local:
        df = reward.add(df, cfg, f"reward_{name}")
    df = df.withColumns({f"reward_{n}": r.build(cfg) for n, r in chosen.items() if isinstance(r, ByColumn)})
    for name, reward in tables[len(local) :]:
        df = reward.add(df, cfg, f"reward_{name}")
    return df


def normalized_weights(names: Sequence[str], weights: Sequence[float] | None = None) -> list[float]:
    """Weights scaled to sum 1; equal ones when absent."""
    if weights is None:
        return [1.0 / len(names)] * len(names)
    if len(weights) != len(names):
        raise ValueError(f"{len(weights)} weights for {len(names)} rewards")
    return [w / sum(weights) for w in weights]


def weighted_sum(names: Sequence[str], weights: Sequence[float]) -> Column:
    """Sum of weight times reward. A reward that could not be computed (null) adds 0; the others still count."""
    total = F.lit(0.0)
    for name, weight in zip(names, weights, strict=True):
        total = total + F.lit(float(weight)) * F.coalesce(F.col(f"reward_{name}").cast("double"), F.lit(0.0))
    return total


def score_rollouts(
    df: DataFrame,
    names: Sequence[str] = tuple(DEFAULT_REWARDS),
    weights: Sequence[float] | None = None,
    normalize: bool = False,
    config: RewardConfig | None = None,
    advantage: bool = True,
) -> DataFrame:
    """Rewards, their weighted sum and the group-relative score of every completion."""
    cfg = config or RewardConfig()
    if normalize or weights is None:
        used = normalized_weights(names, weights) if normalize else [1.0] * len(names)
    else:
        used = list(weights)
    scored = add_rewards(df, names, cfg).withColumn("reward", weighted_sum(names, used))
    if not advantage:
        return scored
    return with_group_advantage(scored, "reward", cfg.group, cfg.row_id, **cfg.bounds)
