"""Registered queries: sources, sinks and streams. Files are derived from the given tables and written by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluation import macro_average
from ..operators.shaping import replicate_generations, request_batches
from ..session import fresh_path
from ..sources.eval_logs import explode_results, scan_eval_logs, write_eval_logs
from ..sources.log_store import refresh_logs, scan_stored_logs
from ..sources.commits import commit_generations, commit_metrics, notes, read_committed
from ..sources.tables import read_table, scan_split, sink_generations, sink_metrics, write_splits
from ..streaming.keyed import read_live_leaderboard, stream_live_leaderboard, stream_save_jobs
from ..streaming.streams import read_leaderboard, stream_checkpoint_jobs, stream_leaderboard
from . import inputs as I
from .registry import query, r, rounded


def written_logs(spark: SparkSession, sf_dir: str) -> str:
    """Result logs of the derived runs below a fresh folder."""
    root = fresh_path(spark, "logs")
    write_eval_logs(I.eval_runs(spark, sf_dir), root)
    return root


@query("scan_split", "select doc_id, source, n_chars from documents where lang = 'fr'")
def scan_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a dataset with one split per language, of which one is read back."""
    path = fresh_path(spark, "splits")
    write_splits(read_table(spark, sf_dir, "documents"), path, F.col("lang"))
    return scan_split(spark, path, "fr").select("doc_id", "source", "n_chars")


@query(
    "scan_eval_logs",
    f"""select suite, exp, step, cast(run_ts as varchar) as run_ts, count(*) + 1 as n_results, {r('avg(score)')} as all_score
    from ({I.RUNS_SQL}) group by suite, exp, step, run_ts""",
)
def scan_eval_logs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = scan_eval_logs(spark, written_logs(spark, sf_dir), compacted=True)
    return logs.select(
        "suite",
        "exp",
        "step",
        F.col("run_ts").cast("string").alias("run_ts"),
        F.size("results").cast("bigint").alias("n_results"),
        rounded(F.col("results")["all"]["extractive_match"]).alias("all_score"),
    )


@query(
    "scan_eval_logs_again",
    f"""select suite, exp, step, cast(run_ts as varchar) as run_ts, count(*) + 1 as n_results, {r('avg(score)')} as all_score,
      true as read_once from ({I.RUNS_SQL}) group by suite, exp, step, run_ts""",
)
def scan_eval_logs_again_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs of one half of the runs are stored, then those of the other half come; no log is opened twice."""
    root, store = fresh_path(spark, "logs"), fresh_path(spark, "log-store")
    runs = I.eval_runs(spark, sf_dir)
    write_eval_logs(runs.where("exp <> 2"), f"{root}/first")
    first = refresh_logs(spark, root, store, compacted=True)
    write_eval_logs(runs.where("exp = 2"), f"{root}/second")
    second = refresh_logs(spark, root, store, compacted=True)
    read_once = first.opened + second.opened == second.listed
    return scan_stored_logs(spark, store).select(
        "suite",
        "exp",
        "step",
        F.col("run_ts").cast("string").alias("run_ts"),
        F.size("results").cast("bigint").alias("n_results"),
        rounded(F.col("results")["all"]["extractive_match"]).alias("all_score"),
        F.lit(read_once).alias("read_once"),
    )


@query(
    "explode_results",
    f"""select suite, exp, step, cast(run_ts as varchar) as run_ts, task, task_key, {r('score')} as score, {r('stderr')} as stderr,
      n_docs, truncated, padded, cast(prompt_hash as varchar) as hash_full_prompts,
      {r('max(seconds) over (partition by run_id)', 6)} as seconds from ({I.RUNS_SQL})""",
)
def explode_results_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_results(scan_eval_logs(spark, written_logs(spark, sf_dir), compacted=True))
    return rows.select(
        "suite",
        "exp",
        "step",
        F.col("run_ts").cast("string").alias("run_ts"),
        "task",
        "task_key",
        rounded("score").alias("score"),
        rounded("stderr").alias("stderr"),
        "n_docs",
        "truncated",
        "padded",
        "hash_full_prompts",
        rounded("seconds", 6).alias("seconds"),
    )


@query(
    "sink_generations",
    """with g as (select o_orderkey, cast((row_number() over (order by o_orderkey, g) - 1) // 64000 as integer) as load_unit
      from orders, (select unnest(range(2)) as g))
    select load_unit, count(*) as n, count(distinct o_orderkey) as prompts, true as private from g group by load_unit""",
)
def sink_generations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "generations")
    requests = replicate_generations(read_table(spark, sf_dir, "orders", "o_orderkey"), 2)
    sink_generations(request_batches(requests, "o_orderkey", ("gen_idx",)), path)
    private = spark.read.parquet(f"{path}/visibility")
    stored = spark.read.parquet(f"{path}/data").groupBy("load_unit").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("prompts")
    )
    flag = F.broadcast(private.withColumn("_one", F.lit(1)))
    return stored.withColumn("_one", F.lit(1)).join(flag, "_one").drop("_one")


@query(
    "sink_metrics",
    f"select 'train' as run, count(*) as train_samples, {r('avg(n_chars)', 6)} as mean_chars from documents",
)
def sink_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "metrics")
    docs = read_table(spark, sf_dir, "documents", "n_chars")
    sink_metrics(docs, path, "train", {"mean_chars": rounded(F.avg("n_chars"), 6)})
    return spark.read.schema("run string, train_samples bigint, mean_chars double").json(path)


@query(
    "sink_metrics_committed",
    f"""select 'all' as run, count(*) as train_samples, {r('avg(n_chars)', 6)} as mean_chars from documents
    union all select 'long', count(*), {r('avg(n_chars)', 6)} from documents where n_chars > 300""",
)
def sink_metrics_committed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run over all documents is made twice, and first of all over other rows: its last row counts."""
    path = fresh_path(spark, "metrics")
    docs = read_table(spark, sf_dir, "documents", "n_chars")
    mean = {"mean_chars": rounded(F.avg("n_chars"), 6)}
    for run, rows in (("all", docs.where("n_chars < 100")), ("long", docs.where("n_chars > 300")), ("all", docs), ("all", docs)):
        commit_metrics(rows, path, run, mean)
    return read_committed(spark, path)


@query(
    "sink_generations_committed",
    """with g as (select o_orderkey, cast((row_number() over (order by o_orderkey, g) - 1) // 64000 as bigint) as load_unit
      from orders, (select unnest(range(2)) as g))
    select load_unit, count(*) as n, count(distinct o_orderkey) as prompts, load_unit % 2 = 0 as second_load, true as private
    from g group by load_unit""",
)
def sink_generations_committed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All load units are committed, then the even ones again with a mark."""
    path = fresh_path(spark, "generations")
    requests = replicate_generations(read_table(spark, sf_dir, "orders", "o_orderkey"), 2)
    units = request_batches(requests, "o_orderkey", ("gen_idx",)).withColumn("second_load", F.lit(False))
    commit_generations(units, path, private=False)
    commit_generations(read_committed(spark, path).where("load_unit % 2 = 0").withColumn("second_load", F.lit(True)), path)
    stored = read_committed(spark, path).groupBy("load_unit").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("prompts"), F.bool_and("second_load").alias("second_load")
    )
    return stored.withColumn("private", F.lit(notes(spark, path)["private"]))


@query(
    "stream_leaderboard",
    f"""select task, {r('score')} as best_score, exp, step, results from (
      select *, row_number() over (partition by task order by score desc, exp, step) as rn,
        count(*) over (partition by task) as results from ({I.RUNS_SQL})) where rn = 1""",
)
def stream_leaderboard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, out = written_logs(spark, sf_dir), fresh_path(spark, "leaderboard")
    stream = stream_leaderboard(spark, root, out, fresh_path(spark, "leaderboard-state"), compacted=True)
    stream.awaitTermination()
    return read_leaderboard(spark, out).withColumn("best_score", rounded("best_score"))


def announced_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save events as a stream of the event table itself, each announced twice."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # Written as a pattern because a stream takes a single file only that way; a folder of files matches as well.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.sequence(F.lit(1), F.lit(2))).alias("announcement"),
    ).drop("announcement")


@query(
    "stream_live_leaderboard",
    f"""select task, {r('score')} as best_score, exp, step, results from (
      select *, row_number() over (partition by task order by score desc nulls last, exp, step) as rn, count(*) over (partition by task) as results
      from (select *, row_number() over (partition by suite, exp, step, task order by run_ts desc, score desc) as newest from ({I.RUNS_SQL}))
      where newest = 1) where rn = 1""",
)
def stream_live_leaderboard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs come in several batches; of a checkpoint's runs only the newest counts, whichever batch holds it."""
    root, out = written_logs(spark, sf_dir), fresh_path(spark, "live")
    state = fresh_path(spark, "live-state")
    stream_live_leaderboard(spark, root, out, state, files_per_trigger=4, compacted=True).awaitTermination()
    return read_live_leaderboard(spark, out).withColumn("best_score", rounded("best_score"))


@query(
    "stream_save_jobs",
    """select user_id as run, event_id as step, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, b.benchmark, b.task_key,
      concat('main-step-', lpad(cast(event_id as varchar), 9, '0')) as revision
    from events, (values ('math_500', 'custom|math_500|0|0'), ('gpqa', 'custom|gpqa:diamond|0|0')) as b(benchmark, task_key)
    where event_id % 50 = 0""",
)
def stream_save_jobs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saves of ``stream_checkpoint_jobs``, each announced twice, with one bitmap per run as state."""
    out = fresh_path(spark, "jobs")
    stream_save_jobs(announced_saves(spark, sf_dir), ["math_500", "gpqa"], out, fresh_path(spark, "jobs-state")).awaitTermination()
    return spark.read.parquet(out).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "stream_checkpoint_jobs",
    """select user_id as run, event_id as step, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, b.benchmark, b.task_key,
      concat('main-step-', lpad(cast(event_id as varchar), 9, '0')) as revision
    from events, (values ('math_500', 'custom|math_500|0|0'), ('gpqa', 'custom|gpqa:diamond|0|0')) as b(benchmark, task_key)
    where event_id % 50 = 0""",
)
def stream_checkpoint_jobs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save events read as a stream of the event table itself, each announced twice."""
    saves = announced_saves(spark, sf_dir)
    out = fresh_path(spark, "jobs")
    stream = stream_checkpoint_jobs(saves, ["math_500", "gpqa"], out, fresh_path(spark, "jobs-state"))
    stream.awaitTermination()
    jobs = spark.read.parquet(out)
    return jobs.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "logged_macro_average",
    f"select suite, exp, step, {r('avg(score)')} as macro_score, count(*) as n_tasks from ({I.RUNS_SQL}) group by suite, exp, step",
)
def logged_macro_average_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages computed from the written log files rather than from the run table."""
    rows = explode_results(scan_eval_logs(spark, written_logs(spark, sf_dir), compacted=True))
    out = macro_average(rows, ("suite", "exp", "step"))
    return out.withColumn("macro_score", rounded("macro_score"))
