from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from rollscore.operators import evaluation as E
from rollscore.operators import joins as J
from rollscore.operators import sweeps as W
from rollscore.session import fresh_path, shared_dir
from rollscore.sources.dimensions import dim_published, dim_revisions, dim_tasks
from rollscore.sources.eval_logs import explode_results, scan_eval_logs
from rollscore.sources.tables import scan_split, sink_generations, sink_metrics, write_splits
from rollscore.streaming.streams import (
    checkpoint_jobs,
    read_leaderboard,
    stream_checkpoint_jobs,
    stream_leaderboard,
    task_bests,
    stream_eval_logs,
)


def write_log(root, suite, exp, step, stamp, tasks):
    """Hand-written file in the result-log layout: dynamic task keys, numbers as strings, nulls, extra fields."""
    folder = root / suite / f"Exp{exp}_{step}" / "results" / "org" / "model"
    folder.mkdir(parents=True, exist_ok=True)
    key = {t: f"custom|{t}|0" for t in tasks}
    body = {
        "config_general": {"unknown_field": "?", "max_samples": None, "start_time": 1.5, "end_time": 2.5,
                           "total_evaluation_time_secondes": "701.25", "model_name": "org/model", "model_dtype": None},
        "results": {key[t]: {"extractive_match": s, "extractive_match_stderr": 0.1} for t, (s, _) in tasks.items()}
        | {"all": {"extractive_match": 0.0, "extractive_match_stderr": 0.0}},
        "versions": {key[t]: 1 for t in tasks},
        "config_tasks": {f"custom|{t}": {"name": t, "metric": [{"metric_name": "m"}], "original_num_docs": n, "effective_num_docs": n}
                         for t, (_, n) in tasks.items()},
        "summary_tasks": {key[t]: {"hashes": {"hash_full_prompts": f"p-{t}", "hash_cont_tokens": f"c-{s}"}, "truncated": 0,
                                   "non_truncated": n, "padded": 0, "non_padded": n} for t, (s, n) in tasks.items()},
    }
    (folder / f"results_{stamp}.json").write_text(json.dumps(body, indent=2))


@pytest.fixture
def log_root(tmp_path):
    root = tmp_path / "logs"
    write_log(root, "evals", 1, 100, "2025-03-14T23-12-53.542208", {"aime24": (0.3, 30)})
    write_log(root, "evals", 1, 100, "2025-03-15T13-49-09.435323", {"aime24": (0.3, 30)})
    write_log(root, "evals", 1, 500, "2025-03-15T02-52-04.589810", {"aime24": (0.2, 30), "gpqa:diamond": (0.5, 198)})
    write_log(root, "overall", 1, 100, "2025-03-15T18-04-10.796422", {"aime24": (0.4, 30), "math_500": (0.838, 500)})
    return root


def test_scan_and_explode(spark, log_root):
    rows = explode_results(scan_eval_logs(spark, str(log_root)))
    got = sorted((r.suite, r.exp, r.step, str(r.run_ts), r.task, r.score, r.n_docs, r.seconds) for r in rows.collect())
    assert got == [
        ("evals", 1, 100, "2025-03-14 23:12:53.542208", "aime24", 0.3, 30, 701.25),
        ("evals", 1, 100, "2025-03-15 13:49:09.435323", "aime24", 0.3, 30, 701.25),
        ("evals", 1, 500, "2025-03-15 02:52:04.589810", "aime24", 0.2, 30, 701.25),
        ("evals", 1, 500, "2025-03-15 02:52:04.589810", "gpqa:diamond", 0.5, 198, 701.25),
        ("overall", 1, 100, "2025-03-15 18:04:10.796422", "aime24", 0.4, 30, 701.25),
        ("overall", 1, 100, "2025-03-15 18:04:10.796422", "math_500", 0.838, 500, 701.25),
    ]


def test_log_analysis(spark, log_root):
    rows = explode_results(scan_eval_logs(spark, str(log_root)))
    assert [tuple(r) for r in J.unknown_revision(rows, dim_revisions(spark)).collect()] == [(1, 500)]
    revisions = {(r.exp, r.step): r.revision for r in J.join_revision(rows, dim_revisions(spark)).collect()}
    assert revisions[(1, 500)] == "unknown" and len(revisions[(1, 100)]) == 40
    assert J.join_task_config(rows, dim_tasks(spark)).count() == 6
    newest = W.latest_run(rows)
    assert newest.count() == 5
    again = E.rerun_reproducibility(rows.where("suite = 'evals'")).collect()
    assert [(r.step, r.runs, r.reproduced) for r in again] == [(100, 2, True)]


def test_missing_fields_become_null(spark, tmp_path):
    folder = tmp_path / "x" / "Exp2_50"
    folder.mkdir(parents=True)
    (folder / "results_bad.json").write_text('{"results": {"custom|aime24|0": {"extractive_match": 1.0}}}')
    row = explode_results(scan_eval_logs(spark, str(tmp_path))).first()
    assert (row.exp, row.step, row.task, row.score) == (2, 50, "aime24", 1.0)
    assert row.run_ts is None and row.n_docs is None and row.seconds is None


LOG_TREE = os.environ.get("RESULT_LOG_TREE", "")


@pytest.mark.skipif(not os.path.isdir(LOG_TREE), reason="set RESULT_LOG_TREE to a folder of published result logs")
def test_published_numbers(spark):
    rows = explode_results(scan_eval_logs(spark, LOG_TREE)).cache()
    assert rows.count() == 82
    overall = E.macro_average(rows.where("suite = 'overall'"))
    compared = J.published_vs_logged(overall, dim_published(spark)).collect()
    assert len(compared) == 3 and all(r.abs_diff < 0.1 for r in compared)
    micro = E.micro_average(rows.where("suite = 'overall'")).collect()
    assert {(r.exp, r.step): round(r.micro_score, 3) for r in micro} == {(1, 100): 0.586, (2, 50): 0.597, (3, 50): 0.583}
    evals = rows.where("suite = 'evals'")
    newest = W.latest_run(evals)
    assert evals.count() == 67 and newest.count() == 63
    best = {r.exp: r.step for r in W.best_checkpoint(E.macro_average(newest)).collect()}
    assert best == {1: 100, 2: 150, 3: 150}
    assert [tuple(r) for r in J.unknown_revision(rows, dim_revisions(spark)).collect()] == [(1, 500)]
    closed = F.sqrt(F.col("score") * (1 - F.col("score")) / (F.col("n_docs") - 1))
    assert rows.select(F.max(F.abs(closed - F.col("stderr")))).first()[0] < 1e-12
    assert all(r.n_digests == 1 for r in E.prompt_drift(rows).collect())
    reruns = E.rerun_reproducibility(rows).collect()
    assert len(reruns) == 10 and all(r.reproduced for r in reruns)


def stats_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_resumes(spark, log_root):
    out, state = fresh_path(spark, "board"), fresh_path(spark, "state")
    batch = task_bests(explode_results(scan_eval_logs(spark, str(log_root))))
    stream_leaderboard(spark, str(log_root), out, state, files_per_trigger=1).awaitTermination()
    assert stats_rows(read_leaderboard(spark, out)) == stats_rows(batch)
    write_log(log_root, "evals", 2, 50, "2025-03-16T00-00-00.000000", {"aime24": (0.9, 30)})
    stream_leaderboard(spark, str(log_root), out, state, files_per_trigger=1).awaitTermination()
    best = {r.task: (r.best_score, r.exp, r.step, r.results) for r in read_leaderboard(spark, out).collect()}
    assert best["aime24"] == (0.9, 2, 50, 5)


def test_checkpoint_jobs_once_per_step_and_benchmark(spark, tmp_path):
    folder = str(tmp_path / "saves")
    saves = spark.range(1, 101).select(
        F.lit("r").alias("run"), (F.col("id") * 25).alias("step"), F.timestamp_seconds(F.col("id")).alias("ts")
    )
    for _ in range(2):
        saves.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(saves.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = fresh_path(spark, "jobs")
    stream_checkpoint_jobs(stream, ["math_500", "aime24"], out, fresh_path(spark, "jobs-state")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 50 * 2
    assert got.select("run", "step", "benchmark").distinct().count() == 100
    assert checkpoint_jobs(spark.read.parquet(folder), ["math_500", "aime24"], "").count() == 100
    with pytest.raises(ValueError):
        checkpoint_jobs(saves, ["nope"], "")


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_split_scan_reads_one_split(spark, fmt):
    path = fresh_path(spark, "splits")
    rows = spark.range(100).select("id", F.concat(F.lit("a, b\\"), F.col("id")).alias("text"))
    write_splits(rows, path, F.when(F.col("id") < 10, "test").otherwise("train"), fmt)
    schema = "id bigint, text string, split string" if fmt in ("json", "csv") else None
    test = scan_split(spark, path, "test", fmt, schema)
    assert sorted((r.id, r.text) for r in test.collect()) == [(i, f"a, b\\{i}") for i in range(10)]


def test_cluster_session_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        shared_dir(Session())


def test_sinks_can_be_repeated(spark):
    path = fresh_path(spark, "gens")
    rows = spark.range(10).withColumn("load_unit", F.col("id") % 2)
    sink_generations(rows, path)
    sink_generations(rows.where("load_unit = 1"), path)
    assert spark.read.parquet(f"{path}/data").count() == 10
    metrics = fresh_path(spark, "metrics")
    sink_metrics(rows, metrics, "a", {"m": F.max("id")})
    sink_metrics(rows, metrics, "b", {"m": F.max("id")})
    assert sorted(r.train_samples for r in spark.read.json(metrics).collect()) == [10, 10]


def test_shared_folder_follows_the_session(spark):
    assert fresh_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
