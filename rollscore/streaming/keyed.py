"""Streams that keep what they need by key: a leaderboard that takes results back, and the saves that a run has announced."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.keys import build_task_key, step_revision
from ..operators.filters import save_step_filter
from ..operators.sweeps import latest_run
from ..sources.commits import commit, read_committed, vacuum
from ..sources.dimensions import BENCHMARKS
from ..sources.eval_logs import explode_results
from .streams import stream_eval_logs, task_bests

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts of a task's results, so that a task with very many of them is not kept by one partition.
BUCKETS = 16
BOARD = "task string, bucket int, best_score double, exp int, step int, results long"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """A query takes its settings when it starts; keyed state needs this store."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def live_bests(rows: DataFrame) -> DataFrame:
    """Best score and number of results per task, where only the newest run of each suite, experiment and step counts."""
    return task_bests(latest_run(rows.select("suite", "exp", "step", "task", "run_ts", "score")))


class NewestResults(StatefulProcessor):
    """The newest result of every (suite, experiment, step) of one part of a task, and the best of them.

    A newer run replaces the older one, whichever comes first. If it takes the best score back, the best is looked for
    again among all that is kept; in any other case the new results alone are compared. A part whose best and number of
    results stay as they were gives no row.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getMapState("newest", "run string", "ts string, score double, exp int, step int")
        self.best = handle.getValueState("best", "score double, exp int, step int, run string, results long")

    @staticmethod
    def rank(score: float | None, exp: int | None, step: int | None) -> tuple:
        """Order of results: score, then the earlier experiment and step; nulls are last."""
        return score is not None, score or 0.0, exp is not None, -(exp or 0), step is not None, -(step or 0)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        arrived: dict[str, tuple] = {}
        for frame in rows:
            columns = [frame[c].astype(object).where(frame[c].notna(), None) for c in ("run", "ts", "score", "exp", "step")]
            for run, ts, score, exp, step in zip(*columns, strict=True):
                own = arrived.get(run)
                if own is None or self.newer((ts, score), own):
                    arrived[run] = (ts, score, None if exp is None else int(exp), None if step is None else int(step))
        before = self.best.get() if self.best.exists() else (None, None, None, None, 0)
        best, results, taken_back = before[:4], before[4], False
        for run, (ts, score, exp, step) in arrived.items():
            old = self.newest.getValue((run,)) if self.newest.containsKey((run,)) else None
            if old is not None and not self.newer((ts, score), old):
                continue
            self.newest.updateValue((run,), (ts, score, exp, step))
            results += old is None
            if run == best[3]:
                taken_back |= self.rank(score, exp, step) < self.rank(*best[:3])
                best = (score, exp, step, run)
            elif best[3] is None or self.rank(score, exp, step) > self.rank(*best[:3]):
                best = (score, exp, step, run)
        if taken_back:
            kept = [(v[1], v[2], v[3], k[0]) for k, v in self.newest.iterator()]
            best = max(kept, key=lambda x: self.rank(*x[:3]))
        now = (*best, results)
        if tuple(before) != now:
            self.best.update(now)
        if (tuple(before)[:3], before[4]) != (now[:3], results):
            yield pd.DataFrame(
                {"task": [key[0]], "bucket": [key[1]], "best_score": [best[0]], "exp": [best[1]], "step": [best[2]], "results": [results]}
            )

    @staticmethod
    def newer(a: Sequence, b: Sequence) -> bool:
        """By time, then score."""
        return (a[0] or "", a[1] is not None, a[1] or 0.0) > (b[0] or "", b[1] is not None, b[1] or 0.0)

    def close(self) -> None:
        pass


def board_changes(rows: DataFrame) -> DataFrame:
    """Rows of a stream of results as changed parts of the board."""
    run = F.to_json(F.struct("suite", "exp", "step"), {"ignoreNullFields": "false"})
    ts = F.coalesce(F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(""))
    named = rows.select("task", run.alias("run"), ts.alias("ts"), "score", "exp", "step")
    parts = named.withColumn("bucket", F.pmod(F.xxhash64("run"), F.lit(BUCKETS)).cast("int"))
    return parts.groupBy("task", "bucket").transformWithStateInPandas(
        statefulProcessor=NewestResults(), outputStructType=BOARD, outputMode="Update", timeMode="None"
    )


def stream_live_leaderboard(
    spark: SparkSession, root: str, out: str, checkpoint: str, files_per_trigger: int = 1000, compacted: bool = False, keep: int = 10
) -> StreamingQuery:
    """Keep the table ``out`` equal to ``live_bests`` of all result files that have come.

    Late, repeated and lower results count as they should: a rerun that lowers a score takes the old best back. A batch
    commits the changed parts alone, and a batch that is repeated commits the same again. Only the newest ``keep`` states of
    ``out`` stay on disk.
    """
    changes = board_changes(explode_results(stream_eval_logs(spark, root, files_per_trigger, compacted)))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if not batch.isEmpty():
            commit(batch, out, ["task", "bucket"], folders=False, batch=batch_id)
            if batch_id % keep == 0:
                vacuum(batch.sparkSession, out, keep)
        batch.unpersist()

    with keyed_state(spark):
        return (
            changes.writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_live_leaderboard(spark: SparkSession, out: str) -> DataFrame:
    """The board: the best of the parts of each task."""
    parts = read_committed(spark, out)
    at = F.max_by(F.struct("exp", "step"), F.struct("best_score", -F.col("exp"), -F.col("step")))
    return (
        parts.groupBy("task")
        .agg(F.max("best_score").alias("best_score"), at.alias("_at"), F.sum("results").alias("results"))
        .select("task", "best_score", F.col("_at.exp").alias("exp"), F.col("_at.step").alias("step"), "results")
    )


#: Numbers of a block of a bitmap, and steps of one state of a run.
BLOCK, SPAN = 1 << 16, 1 << 24


class Bitmap:
    """A set of whole numbers from 0 on: blocks of bits, where there are any."""

    def __init__(self, data: bytes | None = None) -> None:
        self.blocks: dict[int, bytearray] = {}
        raw = zlib.decompress(data) if data else b""
        size = BLOCK // 8
        for at in range(0, len(raw), 4 + size):
            self.blocks[struct.unpack_from("<I", raw, at)[0]] = bytearray(raw[at + 4 : at + 4 + size])

    def add(self, n: int) -> bool:
        """Whether ``n`` is new."""
        block = self.blocks.setdefault(n // BLOCK, bytearray(BLOCK // 8))
        at, bit = n % BLOCK // 8, 1 << n % 8
        new = not block[at] & bit
        block[at] |= bit
        return new

    def bytes(self) -> bytes:
        return zlib.compress(b"".join(struct.pack("<I", k) + self.blocks[k] for k in sorted(self.blocks)), 1)


class FirstSaves(StatefulProcessor):
    """One bitmap of the announced steps of a run; passes each step on once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.steps = handle.getValueState("steps", "bits binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        known = Bitmap(self.steps.get()[0] if self.steps.exists() else None)
        new: dict[int, object] = {}
        for frame in rows:
            for step, ts in frame.groupby("step", dropna=False)["ts"].min().items():
                if known.add(int(step) % SPAN):
                    new[int(step)] = ts
                elif int(step) in new and ts is not pd.NaT and not new[int(step)] <= ts:
                    new[int(step)] = ts
        if new:
            self.steps.update((known.bytes(),))
            yield pd.DataFrame({"run": [key[0]] * len(new), "step": list(new), "ts": list(new.values())})

    def close(self) -> None:
        pass


def first_saves(saves: DataFrame) -> DataFrame:
    """A stream of (run, step, ts), each step of a run once, however late and however often it is announced.

    State: one bitmap per run (one for every 16 million steps). Steps are whole numbers from 0 on; other rows, and those that
    are no evaluation steps, are left out.
    """
    steps = save_step_filter(saves).where("step >= 0").select("run", F.col("step").cast("long").alias("step"), "ts")
    spans = steps.withColumn("span", F.expr(f"step div {SPAN}"))
    kind = saves.schema["run"].dataType.simpleString()
    return spans.groupBy("run", "span").transformWithStateInPandas(
        statefulProcessor=FirstSaves(), outputStructType=f"run {kind}, step long, ts timestamp", outputMode="Append", timeMode="None"
    )


def stream_save_jobs(
    saves: DataFrame, benchmarks: Sequence[str], out: str, checkpoint: str, revision: str = "main"
) -> StreamingQuery:
    """Append one evaluation job per run, saved step and benchmark to ``out`` (parquet, exactly once)."""
    known = [(b, s, t) for b, s, t in BENCHMARKS if b in benchmarks]
    missing = set(benchmarks) - {b for b, _, _ in known}
    if missing:
        raise ValueError(f"unknown benchmarks: {sorted(missing)}")
    rows = [F.struct(F.lit(b).alias("benchmark"), build_task_key(F.lit(s), F.lit(t)).alias("task_key")) for b, s, t in known]
    jobs = first_saves(saves).select("*", F.inline(F.array(*rows))).withColumn("revision", step_revision(F.lit(revision), "step"))
    with keyed_state(saves.sparkSession):
        return (
            jobs.writeStream.outputMode("append")
            .format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
