"""Incremental versions: a live leaderboard over arriving result files, and evaluation jobs per saved checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import build_task_key, step_revision
from ..operators.filters import save_step_filter
from ..sources.dimensions import BENCHMARKS
from ..sources.eval_logs import LOG_SCHEMA, explode_results, locate, read_options


def stream_eval_logs(
    spark: SparkSession, root: str, files_per_trigger: int = 1000, compacted: bool = False
) -> DataFrame:
    """Result files as they appear below ``root``, in the columns of the batch scan."""
    reader = spark.readStream.schema(LOG_SCHEMA).options(**read_options(compacted))
    return locate(reader.option("maxFilesPerTrigger", files_per_trigger).json(root))


def task_bests(rows: DataFrame) -> DataFrame:
    """Best score and number of results per task; the same plan for batch and stream. State: one row per task."""
    return rows.groupBy("task").agg(
        F.max("score").alias("best_score"),
        F.max_by(F.struct("exp", "step"), F.struct(F.col("score"), -F.col("exp"), -F.col("step"))).alias("_at"),
        F.count(F.lit(1)).alias("results"),
    ).select("task", "best_score", F.col("_at.exp").alias("exp"), F.col("_at.step").alias("step"), "results")


def stream_leaderboard(
    spark: SparkSession, root: str, out: str, checkpoint: str, files_per_trigger: int = 1000, compacted: bool = False
) -> StreamingQuery:
    """Keep ``out`` up to date with the best result per task.

    Each micro-batch writes its own ``version`` folder; a replayed batch overwrites only the folder it wrote before.
    """
    board = task_bests(explode_results(stream_eval_logs(spark, root, files_per_trigger, compacted)))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/version={batch_id}")

    return (
        board.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_leaderboard(spark: SparkSession, out: str) -> DataFrame:
    versions = spark.read.parquet(out)
    newest = versions.agg(F.max("version").alias("newest"))
    return versions.join(F.broadcast(newest), F.col("version") == F.col("newest")).drop("version", "newest")


def checkpoint_jobs(saves: DataFrame, benchmarks: Sequence[str], watermark: str | None = None, revision: str = "main") -> DataFrame:
    """One evaluation job per run, saved step and benchmark, however often the save is announced.

    ``saves`` has run, step, ts. Without a ``watermark`` every save counts, however late, and the state holds one narrow
    row per save, since the benchmarks are unrolled after the repeats are gone. With one the state holds recent saves
    alone, but saves older than it are lost and repeats after it count again.
    """
    known = [(b, s, t) for b, s, t in BENCHMARKS if b in benchmarks]
    missing = set(benchmarks) - {b for b, _, _ in known}
    if missing:
        raise ValueError(f"unknown benchmarks: {sorted(missing)}")
    rows = [
        F.struct(F.lit(b).alias("benchmark"), build_task_key(F.lit(s), F.lit(t)).alias("task_key")) for b, s, t in known
    ]
    steps = save_step_filter(saves).select("run", "step", "ts")
    if steps.isStreaming and watermark is None:
        once = steps.dropDuplicates(["run", "step"])
    elif steps.isStreaming:
        once = steps.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["run", "step"])
    else:
        once = steps.groupBy("run", "step").agg(F.min("ts").alias("ts"))
    jobs = once.select("*", F.inline(F.array(*rows)))
    return jobs.withColumn("revision", step_revision(F.lit(revision), "step"))


def stream_checkpoint_jobs(
    saves: DataFrame, benchmarks: Sequence[str], out: str, checkpoint: str, watermark: str | None = None
) -> StreamingQuery:
    """Append the job table to ``out`` (parquet, exactly once through the sink's own commit log)."""
    jobs = checkpoint_jobs(saves, benchmarks, watermark)
    return (
        jobs.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
