"""Keyed streams against batch after late, repeated and lower results, and repeated saves."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rollscore.session import fresh_path
from rollscore.sources.eval_logs import explode_results, scan_eval_logs
from rollscore.streaming.keyed import Bitmap, first_saves, live_bests, read_live_leaderboard, stream_live_leaderboard, stream_save_jobs
from rollscore.sources.commits import current_state
from test_logs_and_streams import write_log


def stats(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_board_equals_batch_after_reruns(spark, tmp_path):
    root, out, state = tmp_path / "logs", fresh_path(spark, "board"), fresh_path(spark, "state")
    tasks = ["aime24", "gpqa:diamond", "math_500"]
    rng = random.Random(4)

    def results(n, days):
        for _ in range(n):
            stamp = f"2025-03-{rng.choice(days):02d}T{rng.randrange(24):02d}-00-00.{rng.randrange(10**6):06d}"
            scores = {t: (rng.choice([None, 0.1, 0.5, 0.5, 0.9]), 30) for t in rng.sample(tasks, rng.randrange(1, 4))}
            write_log(root, rng.choice(["evals", "overall"]), rng.randrange(1, 3), rng.choice([50, 100]), stamp, scores)

    for days in ([10, 11], [5, 12], [20]):
        results(8, days)
        stream_live_leaderboard(spark, str(root), out, state, files_per_trigger=5).awaitTermination()
        batch = live_bests(explode_results(scan_eval_logs(spark, str(root))))
        assert stats(read_live_leaderboard(spark, out)) == stats(batch)


def test_a_lower_rerun_takes_the_best_back(spark, tmp_path):
    root, out, state = tmp_path / "logs", fresh_path(spark, "board"), fresh_path(spark, "state")

    def board(suite, exp, step, stamp, score):
        write_log(root, suite, exp, step, stamp, {"aime24": (score, 30)})
        stream_live_leaderboard(spark, str(root), out, state).awaitTermination()
        return tuple(read_live_leaderboard(spark, out).first())

    assert board("evals", 1, 100, "2025-03-14T00-00-00.000000", 0.9) == ("aime24", 0.9, 1, 100, 1)
    assert board("evals", 2, 50, "2025-03-14T00-00-00.000000", 0.4) == ("aime24", 0.9, 1, 100, 2)
    assert board("evals", 1, 100, "2025-03-15T00-00-00.000000", 0.2) == ("aime24", 0.4, 2, 50, 2)
    number = current_state(spark, out)[0]
    # A late result that is not the newest changes nothing, and nothing is committed for it.
    assert board("evals", 1, 100, "2025-03-13T00-00-00.000000", 1.0) == ("aime24", 0.4, 2, 50, 2)
    assert current_state(spark, out)[0] == number
    assert board("evals", 1, 100, "2025-03-16T00-00-00.000000", 0.4) == ("aime24", 0.4, 1, 100, 2)


def test_state_is_one_bitmap_per_run(spark):
    folder, out, state = fresh_path(spark, "saves"), fresh_path(spark, "jobs"), fresh_path(spark, "state")
    rng = random.Random(7)
    announced = [(run, 25 * rng.randrange(4000), t) for t in range(6) for run in ("a", "b", None) for _ in range(300)]
    rng.shuffle(announced)
    for k in range(3):
        part = spark.createDataFrame(announced[k::3], "run string, step long, t long")
        part.select("run", "step", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("run string, step long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
        stream_save_jobs(stream, ["math_500", "aime24"], out, state).awaitTermination()
    jobs = spark.read.parquet(out)
    want = {(r, s) for r, s, _ in announced if s % 50 == 0}
    got = [(r.run, r.step) for r in jobs.where("benchmark = 'aime24'").collect()]
    assert set(got) == want and len(got) == len(want) and jobs.count() == 2 * len(want)
    kept = spark.read.format("statestore").option("stateVarName", "steps").load(state)
    assert kept.count() == 3
    with pytest.raises(ValueError):
        stream_save_jobs(spark.readStream.schema("run string, step long, ts timestamp").parquet(folder), ["nope"], out, state)


def test_bitmap_is_a_set():
    rng = random.Random(1)
    numbers = [rng.choice([rng.randrange(100), rng.randrange(1 << 24)]) for _ in range(3000)]
    seen, bits = set(), Bitmap()
    for i, n in enumerate(numbers):
        assert bits.add(n) == (n not in seen)
        seen.add(n)
        if i % 500 == 0:
            bits = Bitmap(bits.bytes())
    assert first_saves and not Bitmap(b"").blocks
