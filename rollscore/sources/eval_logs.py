"""Result logs of evaluation runs: JSON records with task names as dynamic keys.

Logs come as one pretty-printed file per run, identified by its path, or compacted: many runs per JSON-lines file, each
record naming the path it stands for. Many small files are slow to list and open, so archives should be compacted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import parse_task_key

# The part of the log layout that the analysis reads. Task names are map keys, so the schema stays the
# same whatever tasks a file holds. The misspelt field name is the format's own.
LOG_SCHEMA = """
source_path string,
config_general struct<max_samples:int, job_id:int, start_time:double, end_time:double,
  total_evaluation_time_secondes:string, model_name:string, model_sha:string, model_dtype:string, model_size:string>,
results map<string, struct<extractive_match:double, extractive_match_stderr:double>>,
versions map<string, int>,
config_tasks map<string, struct<name:string, prompt_function:string, hf_subset:string, hf_revision:string,
  generation_size:int, suite:array<string>, evaluation_splits:array<string>, original_num_docs:int,
  effective_num_docs:int, must_remove_duplicate_docs:boolean, version:int>>,
summary_tasks map<string, struct<
  hashes:struct<hash_examples:string, hash_full_prompts:string, hash_input_tokens:string, hash_cont_tokens:string>,
  truncated:int, non_truncated:int, padded:int, non_padded:int, effective_few_shots:double,
  num_truncated_few_shots:int>>
"""
# Suite folder, checkpoint folder and file-name time stamp in a log path.
SUITE_PATTERN = r"(?:^|/)(?:suite=)?([^/=]+)/(?:[^/=]+=)?Exp\d+_\d+/"
CHECKPOINT_PATTERN = r"Exp(\d+)_(\d+)"
STAMP_PATTERN = r"results_(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}(?:\.\d+)?)"
ALL_TASKS = "all"
LOG_FILES = "*.json"


def path_columns(path: Column) -> dict[str, Column]:
    stamp = F.nullif(F.regexp_extract(path, STAMP_PATTERN, 1), F.lit(""))
    iso = F.regexp_replace(stamp, r"T(\d{2})-(\d{2})-(\d{2})", r"T$1:$2:$3")
    return {
        "suite": F.regexp_extract(path, SUITE_PATTERN, 1),
        "exp": F.regexp_extract(path, CHECKPOINT_PATTERN, 1).try_cast("int"),
        "step": F.regexp_extract(path, CHECKPOINT_PATTERN, 2).try_cast("int"),
        "run_ts": iso.try_cast("timestamp_ntz"),
    }


def read_options(compacted: bool) -> dict[str, object]:
    return {"multiLine": not compacted, "recursiveFileLookup": True, "pathGlobFilter": LOG_FILES}


def locate(raw: DataFrame, file: Column | None = None) -> DataFrame:
    """Add suite, checkpoint and run time, from the record's own path if it has one, else from the file's."""
    path = F.coalesce("source_path", F.col("_metadata.file_path") if file is None else file)
    named = raw.select("*", path.alias("_path"))
    return named.select(*[c.alias(n) for n, c in path_columns(F.col("_path")).items()], *raw.columns)


def scan_eval_logs(spark: SparkSession, root: str, compacted: bool = False) -> DataFrame:
    """One row per logged run below ``root``."""
    return locate(spark.read.schema(LOG_SCHEMA).options(**read_options(compacted)).json(root))


def explode_results(logs: DataFrame) -> DataFrame:
    """One row per (file, task); the ``all`` entry is an average of the others and is dropped."""
    rows = logs.select("*", F.explode("results").alias("task_key", "_result")).where(F.col("task_key") != ALL_TASKS)
    rows = rows.withColumn("_key", parse_task_key("task_key"))
    config_key = F.concat_ws("|", "_key.suite", "_key.task")
    rows = rows.withColumn("_config", F.try_element_at("config_tasks", config_key)).withColumn(
        "_summary", F.try_element_at("summary_tasks", F.col("task_key"))
    )
    return rows.select(
        "suite",
        "exp",
        "step",
        "run_ts",
        F.col("_key.task").alias("task"),
        "task_key",
        F.col("_result.extractive_match").alias("score"),
        F.col("_result.extractive_match_stderr").alias("stderr"),
        F.col("_config.original_num_docs").cast("bigint").alias("original_docs"),
        F.col("_config.effective_num_docs").cast("bigint").alias("n_docs"),
        F.col("config_general.total_evaluation_time_secondes").try_cast("double").alias("seconds"),
        F.col("config_general.model_name").alias("model_name"),
        F.col("_summary.hashes.hash_full_prompts").alias("hash_full_prompts"),
        F.col("_summary.hashes.hash_cont_tokens").alias("hash_cont_tokens"),
        F.col("_summary.truncated").cast("bigint").alias("truncated"),
        F.col("_summary.non_truncated").cast("bigint").alias("non_truncated"),
        F.col("_summary.padded").cast("bigint").alias("padded"),
        F.col("_summary.non_padded").cast("bigint").alias("non_padded"),
    )


def write_eval_logs(runs: DataFrame, root: str) -> None:
    """Write task-level run rows as compacted result logs.

    Expects the columns of ``explode_results`` with one row per run and task. The rows of a run, at most one per task,
    meet in one map.
    """
    key = F.concat_ws("|", F.lit("custom"), F.col("task"), F.lit("0"))
    result = F.struct(F.col("score").alias("extractive_match"), F.col("stderr").alias("extractive_match_stderr"))
    config = F.struct(
        F.col("task").alias("name"),
        F.col("original_docs").cast("int").alias("original_num_docs"),
        F.col("n_docs").cast("int").alias("effective_num_docs"),
    )
    summary = F.struct(
        F.struct("hash_full_prompts", "hash_cont_tokens").alias("hashes"),
        *[F.col(c).cast("int").alias(c) for c in ("truncated", "non_truncated", "padded", "non_padded")],
    )

    def as_map(k: Column, v: Column) -> Column:
        return F.map_from_entries(F.sort_array(F.collect_list(F.struct(k.alias("k"), v.alias("v")))))

    logs = runs.groupBy("suite", "exp", "step", "run_ts").agg(
        as_map(key, result).alias("results"),
        as_map(F.concat_ws("|", F.lit("custom"), F.col("task")), config).alias("config_tasks"),
        as_map(key, summary).alias("summary_tasks"),
        F.avg("score").alias("_mean"),
        F.max("seconds").alias("_seconds"),
        F.max("model_name").alias("_model"),
    )
    overall = F.create_map(
        F.lit(ALL_TASKS),
        F.struct(F.col("_mean").alias("extractive_match"), F.lit(None).cast("double").alias("extractive_match_stderr")),
    )
    stamp = F.date_format("run_ts", "yyyy-MM-dd'T'HH-mm-ss.SSSSSS")
    path = F.format_string("%s/Exp%d_%d/results_%s.json", F.col("suite"), F.col("exp"), F.col("step"), stamp)
    out = logs.select(
        path.alias("source_path"),
        F.struct(
            F.col("_model").alias("model_name"),
            F.format_string("%s", F.col("_seconds")).alias("total_evaluation_time_secondes"),
        ).alias("config_general"),
        F.map_concat("results", overall).alias("results"),
        "config_tasks",
        "summary_tasks",
    )
    out.write.mode("overwrite").json(root)
