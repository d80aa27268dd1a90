"""Whole jobs built from the operators: rollout scoring, prompt preparation, generation and sweep reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.answers import index_match, with_multi_gold
from ..operators.evaluation import macro_average, micro_average, task_stderr
from ..operators.mapping import external_step, resumable_step
from ..operators.registry import RewardConfig, score_rollouts
from ..operators.shaping import (
    MAX_PROMPT_LENGTH,
    SYSTEM_PROMPT,
    chat_render,
    drop_messages,
    generation_requests,
    group_generations,
    make_conversation,
    prune_for_tokens,
    replicate_generations,
    request_batches,
    truncate_prompt,
    whitespace_tokens,
)
from ..operators.sweeps import best_checkpoint, latest_run


@dataclass(frozen=True)
class Recipe:
    rewards: Sequence[str]
    weights: Sequence[float] | None
    normalize: bool
    generations: int = 6


# Rewards and weights of the two training recipes.
GROUP_RECIPE = Recipe(("accuracy", "format", "cosine", "reasoning_steps"), (2.0, 1.0, 1.0, 0.5), normalize=False)
POLICY_RECIPE = Recipe(("format", "tag_count"), (1.0, 1.0), normalize=True)


def score_with_recipe(
    completions: DataFrame, recipe: Recipe, config: RewardConfig | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rollout scoring: rewards in one projection, then one skew-safe statistics step per prompt.

    The result holds ids, rewards and the columns named in ``keep``. Texts are left out unless named, so that they are
    scored where they are read and never shuffled.
    """
    cfg = config or RewardConfig()
    scored = score_rollouts(completions, recipe.rewards, recipe.weights, recipe.normalize, cfg)
    rewards = [f"reward_{n}" for n in recipe.rewards]
    return scored.select(*cfg.row_id, *cfg.group, *keep, *rewards, "reward", "advantage")


def prepare_prompts(
    problems: DataFrame, system_prompt: str | None = SYSTEM_PROMPT, max_tokens: int = MAX_PROMPT_LENGTH
) -> DataFrame:
    """Problems to token inputs: conversation, chat text, tokens, truncation, pruning. No shuffle."""
    chats = drop_messages(make_conversation(problems, system_prompt))
    texts = chats.withColumn("text", chat_render("prompt", generation_prompt=True))
    tokens = texts.withColumn("tokens", whitespace_tokens("text")).drop("text")
    return prune_for_tokens(truncate_prompt(tokens, k=max_tokens)).drop("tokens")


def generate(
    prompts: DataFrame,
    key: str,
    prompt_column: str,
    make_client: Callable[[], Callable[[list[str]], Sequence[str]]],
    generations: int = 1,
    replicas: int | None = None,
    retries: int = 0,
    timeout: float | None = None,
    ledger: str | None = None,
    **request: object,
) -> DataFrame:
    """Synthetic generation around a user-supplied client: one row per prompt with its ordered generations and errors.

    The client is called once for each numbered batch. With a ``ledger`` folder a repeated or resumed run asks only for the
    requests, by key, generation and all request columns, that have no answer there.
    """
    requests = replicate_generations(generation_requests(prompts, prompt_column, **request), generations)
    batched = request_batches(requests, key, ("gen_idx",))
    numbers = ("load_unit", "batch")
    if ledger is None:
        answered = external_step(batched, make_client, replicas, retries=retries, batch=numbers, timeout=timeout)
    else:
        own = [c for c in requests.columns if c not in numbers]
        answered = resumable_step(
            batched, make_client, ledger, own, replicas, batch=numbers, retries=retries, timeout=timeout
        ).drop("run")
    return group_generations(answered, key, error="error")


def score_eval_samples(samples: DataFrame, tasks: DataFrame, equivalence: bool = True) -> DataFrame:
    """Add ``score`` to (task, content, choices, gold_index) rows by the metric of their task. A task that is not in ``tasks`` has a null score.

    Letter tasks compare the extracted letter with the gold one; the others compare the boxed answer with every choice.
    """
    metrics = tasks.select("task", "metric")
    by_letter = F.col("metric") == "letters"
    # Null inputs keep the answer parser off the letter rows.
    parsed = samples.join(metrics, "task", "left").withColumns(
        {"_text": F.when(~by_letter, F.col("content")), "_golds_in": F.when(~by_letter, F.col("choices"))}
    )
    graded = with_multi_gold(parsed, "_text", "_golds_in", "_math", equivalence)
    letters = index_match("content", "choices", "gold_index")
    by_metric = F.when(by_letter, letters).otherwise(F.col("_math"))
    scored = graded.withColumn("score", F.when(F.col("metric").isNotNull(), by_metric))
    return scored.drop("_math", "_text", "_golds_in")


def evaluate_tasks(samples: DataFrame, tasks: DataFrame, equivalence: bool = True) -> DataFrame:
    """Scores and standard errors per task from raw evaluated completions."""
    return task_stderr(score_eval_samples(samples, tasks, equivalence))


def sweep_report(runs: DataFrame) -> DataFrame:
    """Best checkpoint per suite and experiment with macro and micro average, from task-level run rows."""
    newest = latest_run(runs)
    by = ("suite", "exp", "step")
    macro = macro_average(newest, by)
    best = best_checkpoint(macro, ("suite", "exp"))
    micro = micro_average(newest, by)
    return best.join(micro, list(by)).select(*by, "macro_score", "micro_score", F.col("n_docs"))
