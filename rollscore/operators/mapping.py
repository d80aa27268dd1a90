"""Escape hatches: a user function over Arrow batches, and an external client called in batches, with or without a ledger."""

from __future__ import annotations

import os
import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path

#: Rows that one partition asks for before its answers are committed.
WAVE_ROWS = 1000


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """Apply a pandas function to every Arrow batch. For logic that column expressions cannot state."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def external_step(
    requests: DataFrame,
    make_client: Callable[[], Callable[[list[str]], Sequence[str]]],
    replicas: int | None = None,
    batch_rows: int = 64,
    retries: int = 0,
    pause: float = 1.0,
    prompt: str = "instruction",
    batch: Sequence[str] = (),
    timeout: float | None = None,
) -> DataFrame:
    """Send requests to a user-supplied client in batches and add ``text`` and ``error``.

    ``replicas`` partitions (by default as many as a shuffle has) call at the same time; each makes its own client once.
    A call that takes longer than ``timeout`` seconds counts as failed: it is left behind in its thread, and the next
    attempt gets a new client. The columns in ``batch`` number the batches, one call each; without them a call
    takes up to ``batch_rows`` rows as they come. A batch that still fails after the retries keeps its rows, with a null
    text and the error message. The functions sent to the executors are closures, so nothing but pandas has to be
    installed there.
    """
    numbers = list(batch)

    def call(client: Callable[[list[str]], Sequence[str]], prompts: list[str]) -> list | None:
        """The answers, or None if they take too long."""
        if timeout is None:
            return list(client(prompts))
        done: queue.Queue = queue.Queue(1)

        def work() -> None:
            try:
                done.put((list(client(prompts)), None))
            except BaseException as error:
                done.put((None, error))

        threading.Thread(target=work, daemon=True).start()
        try:
            texts, error = done.get(timeout=timeout)
        except queue.Empty:
            return None
        if error is not None:
            raise error
        return texts

    def ask(clients: list, prompts: list[str]) -> tuple[list, str | None]:
        """``clients`` holds the client in use, or none."""
        failure = None
        for attempt in range(retries + 1):
            try:
                if not clients:
                    clients.append(make_client())
                texts = call(clients[0], prompts)
                if texts is None:
                    clients.clear()
                    raise TimeoutError(f"no answer in {timeout} seconds")
                if len(texts) != len(prompts):
                    raise ValueError(f"{len(texts)} answers to {len(prompts)} prompts")
                return texts, None
            except Exception as error:
                failure = f"{type(error).__name__}: {error}"
                if attempt < retries:
                    time.sleep(pause * 2**attempt)
        return [None] * len(prompts), failure

    def by_size(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_rows):
                yield frame.iloc[at : at + batch_rows]

    def by_number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            parts = [p for _, p in frame.groupby(numbers, sort=False, dropna=False)]
            if held is not None and parts and held[numbers].iloc[0].equals(parts[0][numbers].iloc[0]):
                parts[0] = pd.concat([held, parts[0]])
            elif held is not None:
                yield held
            held = parts.pop() if parts else None
            yield from parts
        if held is not None:
            yield held

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients: list = []
        for part in by_number(frames) if numbers else by_size(frames):
            texts, failure = ask(clients, part[prompt].tolist())
            yield part.assign(text=texts, error=failure)

    schema = T.StructType(
        [*requests.schema.fields, T.StructField("text", T.StringType()), T.StructField("error", T.StringType())]
    )
    parts = replicas or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = requests.repartition(parts, *numbers)
    return (dealt.sortWithinPartitions(*numbers) if numbers else dealt).mapInPandas(run, schema)


ANSWERS = "_request string, text string, error string, run string"


def answered(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per request in the ledger: its answer if there is one, else its last failure."""
    runs = os.path.join(ledger, "answers")
    try:
        rows = spark.read.schema(ANSWERS).parquet(runs)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], ANSWERS)
    better = F.struct(F.col("error").isNull().cast("int").alias("good"), "run")
    return rows.groupBy("_request").agg(F.max_by(F.struct("text", "error", "run"), better).alias("a")).select("_request", "a.*")


def resumable_step(
    requests: DataFrame,
    make_client: Callable[[], Callable[[list[str]], Sequence[str]]],
    ledger: str,
    identity: Sequence[str] | None = None,
    replicas: int | None = None,
    wave_rows: int = WAVE_ROWS,
    batch: Sequence[str] = (),
    prompt: str = "instruction",
    run: str | None = None,
    **options: object,
) -> DataFrame:
    """``external_step`` with a ledger: adds ``text``, ``error`` and ``run``, and asks only for what the ledger lacks.

    A request is known by the digest of its ``identity`` columns (all columns without it). Requests without an answer
    in the folder ``ledger`` are found by an anti-join, written once, and sent in waves of ``wave_rows`` rows for each of
    the ``replicas`` partitions. A task's answers enter the ledger when the task ends, also if its wave is never finished, so a run
    that is killed, or a task that is repeated, asks again for at most ``wave_rows`` rows a partition. Equal requests are asked
    once. A failure is kept beside its request and asked again by the next run; answers are never asked again.

    Null columns count in the digest like any value. An empty table asks for nothing. Columns named ``text``, ``error`` or
    ``run`` are replaced. The calls are made when this function runs, not when its result is read.
    """
    spark, run = requests.sparkSession, run or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    kept = requests.drop("text", "error", "run")
    named = list(identity or kept.columns)
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in named]), {"ignoreNullFields": "false"}), 256)
    keyed = kept.withColumn("_request", digest)
    needed = list(dict.fromkeys([prompt, *batch, "_request"]))
    known = answered(spark, ledger).where("error is null").select("_request")
    open_ = keyed.select(*needed).dropDuplicates(["_request"]).join(known, "_request", "left_anti")

    parts = replicas or int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = F.xxhash64(*batch) if batch else F.xxhash64("_request")
    waiting = fresh_path(spark, "requests")
    # Waves are dealt out before their number is known: a wave takes as many of these parts as its rows allow.
    open_.withColumn("_deal", F.pmod(together, F.lit(DEALS)).cast("int")).write.partitionBy("_deal").parquet(waiting)
    schema = T.StructType([*open_.schema.fields, T.StructField("_deal", T.IntegerType())])
    dealt = spark.read.schema(schema).parquet(waiting)
    counts = dict(dealt.groupBy("_deal").agg(F.count(F.lit(1))).collect())
    for deals in waves(counts, parts * wave_rows):
        asked = external_step(dealt.where(F.col("_deal").isin(deals)).drop("_deal"), make_client, parts, batch=batch, prompt=prompt, **options)
        rows = asked.select("_request", "text", "error", F.lit(run).alias("run"))
        # With this committer the files of a task stay although its job fails.
        rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(os.path.join(ledger, "answers"))
    answers = answered(spark, ledger)
    return keyed.join(answers, "_request", "left").select(*[F.col(f"`{c}`") for c in kept.columns], "text", "error", "run")


#: Parts that waiting requests are dealt to; waves are made of whole parts.
DEALS = 1024


def waves(counts: dict[int, int], most: int) -> list[list[int]]:
    """Parts in order, gathered until a wave has ``most`` rows."""
    out, size = [], 0
    for part in sorted(counts):
        if not out or size >= most:
            out.append([])
            size = 0
        out[-1].append(part)
        size += counts[part]
    return out
