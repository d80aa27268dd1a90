"""Evaluation aggregates over samples and over run logs. All of them combine on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.dimensions import BASE_COST, BASE_GENERATIONS, BASE_SAMPLES, BASELINE_COSTS
from .skew import group_median


def task_score(samples: DataFrame, by: Sequence[str] = ("task",), score: str = "score") -> DataFrame:
    return samples.groupBy(*by).agg(F.avg(score).alias("score"), F.count(score).alias("n_docs"))


def task_stderr(samples: DataFrame, by: Sequence[str] = ("task",), score: str = "score") -> DataFrame:
    """Standard error of the mean; null for a single sample."""
    return samples.groupBy(*by).agg(
        F.avg(score).alias("score"),
        (F.stddev_samp(score) / F.sqrt(F.count(score))).alias("stderr"),
        F.count(score).alias("n_docs"),
    )


def multi_gold_max(matches: DataFrame, sample: Sequence[str], score: str = "score") -> DataFrame:
    """Score of a sample = best over its golds, for golds held as rows."""
    return matches.groupBy(*sample).agg(F.max(score).alias("score"), F.count(F.lit(1)).alias("n_golds"))


def macro_average(runs: DataFrame, by: Sequence[str] = ("exp", "step")) -> DataFrame:
    return runs.groupBy(*by).agg(F.avg("score").alias("macro_score"), F.count(F.lit(1)).alias("n_tasks"))


def micro_average(runs: DataFrame, by: Sequence[str] = ("exp", "step")) -> DataFrame:
    return runs.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("score") * F.col("n_docs")), F.sum("n_docs")).alias("micro_score"),
        F.sum("n_docs").alias("n_docs"),
    )


def rollup_scores(runs: DataFrame, levels: Sequence[str] = ("suite", "exp", "task"), score: str = "score") -> DataFrame:
    """Average on every prefix of ``levels``, the grand total included."""
    return runs.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level"), F.avg(score).alias("score"), F.count(F.lit(1)).alias("n")
    )


def score_pivot(runs: DataFrame, tasks: Sequence[str], by: Sequence[str] = ("exp", "step")) -> DataFrame:
    """Checkpoint by task matrix. The task list is given, so no job runs to find it."""
    return runs.groupBy(*by).pivot("task", list(tasks)).agg(F.max("score"))


def content_digest(*parts: Column | str) -> Column:
    """60 bits of an md5 over the parts, as bigint; combine over rows with ``bit_xor`` for an order-free digest."""
    joined = F.concat_ws("\x1f", *[F.col(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def prompt_drift(runs: DataFrame, by: Sequence[str] = ("task",), digest: str = "hash_full_prompts") -> DataFrame:
    """Distinct prompt digests per task; more than one means the inputs changed between runs."""
    return runs.groupBy(*by).agg(
        F.countDistinct(digest).alias("n_digests"), (F.countDistinct(digest) > 1).alias("drifted")
    )


def rerun_reproducibility(runs: DataFrame, by: Sequence[str] = ("exp", "step", "task")) -> DataFrame:
    """Checkpoint and task evaluated more than once: do outputs and scores agree?"""
    return (
        runs.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.countDistinct("hash_cont_tokens").alias("n_outputs"),
            F.countDistinct("score").alias("n_scores"),
        )
        .where(F.col("runs") > 1)
        .withColumn("reproduced", (F.col("n_outputs") == 1) & (F.col("n_scores") == 1))
    )


def truncation_stats(runs: DataFrame, by: Sequence[str] = ("task",)) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("truncated", "non_truncated", "padded", "non_padded")]
    total = F.col("truncated") + F.col("non_truncated")
    return runs.groupBy(*by).agg(*sums).withColumn("truncated_ratio", F.try_divide(F.col("truncated"), total))


def eval_throughput(runs: DataFrame, by: Sequence[str] = ("task",)) -> DataFrame:
    """Seconds per document: mean, extremes, exact lower median and total-time based."""
    by = list(by)
    per_doc = F.try_divide(F.col("seconds"), F.col("n_docs"))
    timed = runs.select(*by, "seconds", "n_docs").withColumn("_per_doc", per_doc)
    summed = timed.groupBy(F.struct(*by, F.lit(0).alias("_one")).alias("_keys")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("_per_doc").alias("mean_sec_per_doc"),
        F.min("_per_doc").alias("min_sec_per_doc"),
        F.max("_per_doc").alias("max_sec_per_doc"),
        F.try_divide(F.sum("seconds"), F.sum("n_docs")).alias("total_sec_per_doc"),
    )
    medians = group_median(timed, by, "_per_doc", "median_sec_per_doc")
    measures = [f"{m}_sec_per_doc" for m in ("mean", "min", "max", "median", "total")]
    return summed.join(medians, "_keys", "left").select(*[F.col("_keys")[c].alias(c) for c in by], "runs", *measures)


def cost_table(samples: DataFrame, generations: int = BASE_GENERATIONS) -> DataFrame:
    """Outputs of a training set (samples times generations), cost at the published rate, and ratio to each baseline.

    The sample side is one aggregated row; the published baselines are unrolled from a literal array.
    """
    rate = BASE_COST / (BASE_SAMPLES * BASE_GENERATIONS)
    rows = [F.struct(F.lit(m).alias("model"), F.lit(s).alias("size"), F.lit(c).alias("cost")) for m, s, c in BASELINE_COSTS]
    return (
        samples.agg(F.count(F.lit(1)).alias("samples"))
        .withColumn("outputs", F.col("samples") * F.lit(generations))
        .withColumn("base_cost", F.col("outputs") * F.lit(rate))
        .select("*", F.inline(F.array(*rows)))
        .withColumn("cost_ratio", F.try_divide(F.col("cost"), F.col("base_cost")))
    )
