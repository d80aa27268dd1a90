"""Registered queries: evaluation aggregates, sweeps, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import joins as J
from ..operators import sets as U
from ..operators import sweeps as W
from ..operators.sketches import bucket_scale, merge_sketches, quantile_sketch, sketch_quantiles
from ..sources import dimensions as D
from ..sources.tables import read_table, sample_counts
from . import inputs as I
from .jobs import evaluate_tasks, sweep_report
from .registry import query, r, rounded

RUNS = I.RUNS_SQL
REVISIONS_SQL = "(values " + ", ".join(f"({e}, {s}, '{c}')" for e, s, c in D.REVISIONS) + ") as rev(exp, step, revision)"
TASKS_SQL = (
    "(values "
    + ", ".join(f"('{t}', '{d}', '{sp}', '{p}', '{m}', {D.GENERATION_SIZE})" for t, d, _, sp, p, m in D.TASKS)
    + ") as def(task, dataset, split, prompt, metric, generation_size)"
)
LATEST_SQL = f"""
select * exclude (rn) from (
  select *, row_number() over (partition by suite, exp, step, task order by run_ts desc) as rn from ({RUNS})) where rn = 1
"""
MACRO_SQL = f"select exp, step, avg(score) as macro_score, count(*) as n_tasks from ({LATEST_SQL}) group by exp, step"
CURVE_SQL = f"select exp, task, step, avg(score) as score from ({RUNS}) group by exp, task, step"


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.macro_average(W.latest_run(I.eval_runs(spark, sf_dir)))


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.per_step(I.eval_runs(spark, sf_dir))


@query("task_score", f"select task, {r('avg(score)')} as score, count(*) as n_docs from ({I.LABELED_SQL}) group by task")
def task_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.task_score(I.labeled_samples(spark, sf_dir))
    return out.select("task", rounded("score").alias("score"), "n_docs")


@query(
    "task_stderr",
    f"""select suite, exp, step, task, {r('avg(score)')} as score,
      {r('sqrt(avg(score) * (1 - avg(score)) / nullif(count(*) - 1, 0))')} as stderr, count(*) as n_docs
    from ({I.SAMPLES_SQL}) group by suite, exp, step, task""",
)
def task_stderr_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["suite", "exp", "step", "task"]
    out = E.task_stderr(I.eval_samples(spark, sf_dir), by)
    return out.select(*by, rounded("score").alias("score"), rounded("stderr").alias("stderr"), "n_docs")


@query(
    "multi_gold_rows",
    f"select run_id, task, max(score) as score, count(*) as n_golds from ({I.SAMPLES_SQL}) group by run_id, task",
)
def multi_gold_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.multi_gold_max(I.eval_samples(spark, sf_dir), ["run_id", "task"])


@query("macro_average", f"select exp, step, {r('macro_score')} as macro_score, n_tasks from ({MACRO_SQL})")
def macro_average_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro(spark, sf_dir).select("exp", "step", rounded("macro_score").alias("macro_score"), "n_tasks")


@query(
    "micro_average",
    f"""select exp, step, {r('sum(score * n_docs) / sum(n_docs)')} as micro_score, cast(sum(n_docs) as bigint) as n_docs
    from ({RUNS}) group by exp, step""",
)
def micro_average_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.micro_average(I.eval_runs(spark, sf_dir))
    return out.select("exp", "step", rounded("micro_score").alias("micro_score"), "n_docs")


@query(
    "rollup_scores",
    f"""select suite, cast(exp as varchar) as exp, task, cast(grouping(suite, exp, task) as integer) as level, {r('avg(score)')} as score, count(*) as n
    from ({I.SAMPLES_SQL}) group by rollup (suite, exp, task)""",
)
def rollup_scores_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.rollup_scores(I.eval_samples(spark, sf_dir))
    return out.select("suite", F.col("exp").cast("string").alias("exp"), "task", "level", rounded("score").alias("score"), "n")


@query(
    "score_pivot",
    "select exp, step, "
    + ", ".join(f"{r(f'max(score) filter (task = {chr(39)}{t}{chr(39)})')} as {t}" for t in I.TASK_NAMES)
    + f" from ({CURVE_SQL}) group by exp, step",
)
def score_pivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.score_pivot(curve(spark, sf_dir), I.TASK_NAMES)
    return out.select("exp", "step", *[rounded(t).alias(t) for t in I.TASK_NAMES])


@query(
    "prompt_drift",
    f"""select task, count(distinct prompt_hash) as n_digests, count(distinct prompt_hash) > 1 as drifted from ({RUNS})
    group by task""",
)
def prompt_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.prompt_drift(I.eval_runs(spark, sf_dir))


@query(
    "content_digest",
    f"select source, {I.digest_sql('text')} as digest, count(*) as n from documents group by source",
)
def content_digest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "source", "text", spread=True)
    return docs.groupBy("source").agg(
        F.bit_xor(E.content_digest("text")).alias("digest"), F.count(F.lit(1)).alias("n")
    )


@query(
    "rerun_reproducibility",
    f"""select exp, step, task, count(*) as runs, count(distinct cont_hash) as n_outputs, count(distinct score) as n_scores,
      count(distinct cont_hash) = 1 and count(distinct score) = 1 as reproduced
    from ({RUNS}) group by exp, step, task having count(*) > 1""",
)
def rerun_reproducibility_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.rerun_reproducibility(I.eval_runs(spark, sf_dir))


@query(
    "truncation_stats",
    f"""select task, sum(truncated)::bigint as truncated, sum(non_truncated)::bigint as non_truncated, sum(padded)::bigint as padded,
      sum(non_padded)::bigint as non_padded, {r('sum(truncated) / nullif(sum(truncated + non_truncated), 0)')} as truncated_ratio
    from ({RUNS}) group by task""",
)
def truncation_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.truncation_stats(I.eval_runs(spark, sf_dir))
    return out.withColumn("truncated_ratio", rounded("truncated_ratio"))


@query(
    "eval_throughput",
    f"""select task, count(*) as runs, {r('avg(seconds / n_docs)', 6)} as mean_sec_per_doc, {r('min(seconds / n_docs)', 6)} as min_sec_per_doc,
      {r('max(seconds / n_docs)', 6)} as max_sec_per_doc, {r('quantile_disc(seconds / n_docs, 0.5)', 6)} as median_sec_per_doc,
      {r('sum(seconds) / sum(n_docs)', 6)} as total_sec_per_doc
    from ({RUNS}) group by task""",
)
def eval_throughput_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.eval_throughput(I.eval_runs(spark, sf_dir))
    return out.select("task", "runs", *[rounded(c, 6).alias(c) for c in out.columns[2:]])


SKETCH_ERROR = 0.02
SKETCH_PROBABILITIES = [0.1, 0.5, 0.95]


def quantiles_sql(rows: str, by: str) -> str:
    """Quantiles of the values ``v`` by sketch: the bucket that holds the exact rank, and the middle of its values."""
    width, shift = bucket_scale(SKETCH_ERROR)
    return f"""with b as (select {by}, measure, v,
        case when v = 0 then 0 else sign(v) * (ceil(ln(abs(v)) / {width!r}::double) + {shift}) end as bucket from ({rows})),
      s as (select {by}, measure, bucket, count(*) as n, min(v) as least, max(v) as most from b group by {by}, measure, bucket),
      q as (select *, sum(n) over (partition by {by}, measure order by bucket) as upto, sum(n) over (partition by {by}, measure) as total from s)
    select {by}, measure, p as probability, cast(total as bigint) as n, least as low, most as high,
      {r("case when least = most then least else least / ((1 + least / most) / 2) end", 6)} as value
    from q, (select unnest({SKETCH_PROBABILITIES}::double[]) as p) where greatest(ceil(p * total), 1) between upto - n + 1 and upto"""


@query(
    "throughput_quantiles",
    quantiles_sql(f"select task, (step - 50) // 200 as steps, 'value' as measure, value as v from ({I.SAMPLES_SQL})", "task, steps"),
)
def throughput_quantiles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds per sample over ranges of steps, from sketches that are kept per task and step."""
    kept = quantile_sketch(I.eval_samples(spark, sf_dir), ["value"], ["task", "step"], SKETCH_ERROR)
    ranges = kept.withColumn("steps", F.floor((F.col("step") - 50) / 200))
    out = sketch_quantiles(merge_sketches(ranges, ["task", "steps"]), SKETCH_PROBABILITIES, ["task", "steps"])
    return out.withColumn("value", rounded("value", 6))


@query(
    "reward_quantiles",
    quantiles_sql(
        f"""select step // 5 as steps, measure, v from (select c.prompt_id // 10 as step, length(content)::double as chars,
          length(problem)::double as problem_chars from ({I.COMPLETIONS_SQL}) c)
          unpivot (v for measure in (chars, problem_chars))""",
        "steps",
    ),
)
def reward_quantiles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of completions and problems over ranges of training steps, from sketches that are kept per step."""
    rows = I.completions(spark, sf_dir).select(
        F.floor(F.col("prompt_id") / 10).alias("step"), F.length("content").alias("chars"), F.length("problem").alias("problem_chars")
    )
    kept = quantile_sketch(rows, ["chars", "problem_chars"], ["step"], SKETCH_ERROR)
    out = sketch_quantiles(merge_sketches(kept.withColumn("steps", F.floor(F.col("step") / 5)), ["steps"]), SKETCH_PROBABILITIES, ["steps"])
    return out.withColumn("value", rounded("value", 6))


@query(
    "cost_table",
    "with b as (select count(*) as samples, count(*) * 6 as outputs, count(*) * 6 * (42.0::double / 42000) as base_cost "
    "from conversations where role = 'user') select samples, outputs, "
    + r("base_cost", 6)
    + " as base_cost, model, size, cost, "
    + r("cost / nullif(base_cost, 0)", 6)
    + " as cost_ratio from b, (values "
    + ", ".join(f"('{m}', '{s}', {c}::double)" for m, s, c in D.BASELINE_COSTS)
    + ") as k(model, size, cost)",
)
def cost_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = read_table(spark, sf_dir, "conversations", "role").where(F.col("role") == "user")
    out = E.cost_table(prompts)
    return out.withColumn("base_cost", rounded("base_cost", 6)).withColumn("cost_ratio", rounded("cost_ratio", 6))


@query("sample_counts", "select lang as split, count(*) as samples from documents group by lang")
def sample_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_counts(read_table(spark, sf_dir, "documents", "lang").withColumnRenamed("lang", "split"))


@query(
    "best_checkpoint",
    f"""select exp, step, {r('macro_score')} as macro_score from (
      select *, row_number() over (partition by exp order by macro_score desc, step) as rn from ({MACRO_SQL})) where rn = 1""",
)
def best_checkpoint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.best_checkpoint(macro(spark, sf_dir))
    return out.select("exp", "step", rounded("macro_score").alias("macro_score"))


@query(
    "step_delta",
    f"""select exp, task, step, {r('score')} as score,
      {r('score - lag(score) over (partition by exp, task order by step)')} as delta from ({CURVE_SQL})""",
)
def step_delta_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.step_delta(curve(spark, sf_dir))
    return out.select("exp", "task", "step", rounded("score").alias("score"), rounded("delta").alias("delta"))


@query(
    "running_best",
    f"""with c as (select *, max(score) over (partition by exp, task order by step) as best from ({CURVE_SQL}))
    select exp, task, step, {r('score')} as score, {r('best')} as best_so_far, {r('best - score')} as "drop" from c""",
)
def running_best_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.running_best(curve(spark, sf_dir))
    return out.select("exp", "task", "step", *[rounded(c).alias(c) for c in ("score", "best_so_far", "drop")])


@query(
    "smoothed_curve",
    f"""select exp, task, step, {r('score')} as score,
      {r('avg(score) over (partition by exp, task order by step rows between 2 preceding and current row)')} as smoothed
    from ({CURVE_SQL})""",
)
def smoothed_curve_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.smoothed_curve(curve(spark, sf_dir))
    return out.select("exp", "task", "step", rounded("score").alias("score"), rounded("smoothed").alias("smoothed"))


@query(
    "latest_run",
    f"select suite, exp, step, task, run_id, cast(run_ts as varchar) as run_ts, {r('score')} as score, n_docs from ({LATEST_SQL})",
)
def latest_run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.latest_run(I.eval_runs(spark, sf_dir))
    return out.select(
        "suite", "exp", "step", "task", "run_id", F.col("run_ts").cast("string").alias("run_ts"),
        rounded("score").alias("score"), "n_docs",
    )


@query(
    "rank_models",
    f"""select exp, step, task, score, cast(dense_rank() over (partition by task order by score desc) as integer) as rank
    from (select exp, step, task, {r('score', 3)} as score from ({CURVE_SQL}))""",
)
def rank_models_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = curve(spark, sf_dir).withColumn("score", rounded("score", 3))
    return W.rank_models(scores, row_id=("exp", "step")).select("exp", "step", "task", "score", "rank")


@query(
    "leaderboard_topk",
    f"select exp, step, {r('macro_score')} as macro_score, n_tasks from ({MACRO_SQL}) order by macro_score desc, exp, step limit 5",
)
def leaderboard_topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = macro(spark, sf_dir).withColumn("macro_score", rounded("macro_score"))
    return W.leaderboard_topk(averages, 5)


@query(
    "union_suites",
    f"select suite, exp, step, count(*) as runs, {r('avg(score)')} as score from ({RUNS}) group by suite, exp, step",
)
def union_suites_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = I.eval_runs(spark, sf_dir)
    trees = {s: runs.where(F.col("suite") == s).drop("suite") for s in ("evals", "overall")}
    out = U.union_suites(trees).groupBy("suite", "exp", "step")
    return out.agg(F.count(F.lit(1)).alias("runs"), rounded(F.avg("score")).alias("score"))


GOOD_SCORE = 0.45
SUITE_MACRO_SQL = f"select suite, exp, step, avg(score) as macro_score from ({RUNS}) group by suite, exp, step"


@query(
    "checkpoints_in_both",
    f"""select exp, step from ({SUITE_MACRO_SQL}) where suite = 'evals' and macro_score >= {GOOD_SCORE}
    intersect select exp, step from ({SUITE_MACRO_SQL}) where suite = 'overall' and macro_score >= {GOOD_SCORE}""",
)
def checkpoints_in_both_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints that reach a score in both suites."""
    averages = E.macro_average(I.eval_runs(spark, sf_dir), ("suite", "exp", "step"))
    good = averages.where(F.col("macro_score") >= GOOD_SCORE)
    return U.checkpoints_in_both(good.where(F.col("suite") == "evals"), good.where(F.col("suite") == "overall"))


REQUESTS_SQL = (
    "select distinct user_id as request_id, case when user_id % 10 = 0 then 'all' else case event_type "
    + " ".join(f"when '{e}' then '{t}'" for e, t in I.TASK_OF_EVENT.items())
    + " end end as benchmark from events"
)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as benchmark requests: the tasks of their events, or just ``all`` for every tenth."""
    events = read_table(spark, sf_dir, "events", "user_id", "event_type")
    task = F.element_at(F.create_map(*[F.lit(x) for kv in I.TASK_OF_EVENT.items() for x in kv]), F.col("event_type"))
    name = F.when(F.col("user_id") % 10 == 0, "all").otherwise(task)
    return events.select(F.col("user_id").alias("request_id"), name.alias("benchmark")).distinct()


KNOWN = [b for b, _, _ in D.BENCHMARKS]
KNOWN_SQL = "(" + ", ".join(f"'{b}'" for b in KNOWN) + ")"


@query(
    "expand_benchmarks",
    f"""with q as ({REQUESTS_SQL}), one as (select distinct request_id, benchmark from q where request_id in (
      select request_id from q group by request_id having not (count(*) = 1 and max(benchmark) = 'all')))
    select * from one union all select distinct request_id, b.benchmark from q, (select unnest({str(KNOWN)}) as benchmark) b
    where request_id in (select request_id from q group by request_id having count(*) = 1 and max(q.benchmark) = 'all')""",
)
def expand_benchmarks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.expand_benchmarks(requests(spark, sf_dir), KNOWN)


@query(
    "benchmarks_unsupported",
    f"""with q as ({REQUESTS_SQL}), lone as (select request_id from q group by request_id having count(*) = 1)
    select distinct request_id, benchmark from q where benchmark not in {KNOWN_SQL}
    and not (benchmark = 'all' and request_id in (select request_id from lone))""",
)
def benchmarks_unsupported_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.benchmarks_unsupported(requests(spark, sf_dir), KNOWN).distinct()


@query(
    "dim_revisions",
    f"""select s.exp, s.step, coalesce(revision, 'unknown') as revision, count(*) as n_samples from ({I.SAMPLES_SQL}) s
    left join {REVISIONS_SQL} on rev.exp = s.exp and rev.step = s.step group by all""",
)
def dim_revisions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = I.eval_samples(spark, sf_dir).groupBy("exp", "step").agg(F.count(F.lit(1)).alias("n_samples"))
    return J.join_revision(counts, D.dim_revisions(spark))


@query(
    "dim_tasks",
    f"""select s.task, dataset, split, prompt, metric, generation_size, count(*) as n_samples
    from ({I.SAMPLES_SQL}) s join {TASKS_SQL} on def.task = s.task group by all""",
)
def dim_tasks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = I.eval_samples(spark, sf_dir).groupBy("task").agg(F.count(F.lit(1)).alias("n_samples"))
    dims = D.dim_tasks(spark).select("task", "dataset", "split", "prompt", "metric", "generation_size")
    return counts.join(F.broadcast(dims), "task")


@query(
    "join_revision",
    f"""select n.suite, n.exp, n.step, n.run_id, n.task, coalesce(revision, 'unknown') as revision from ({RUNS}) n
    left join {REVISIONS_SQL} on rev.exp = n.exp and rev.step = n.step""",
)
def join_revision_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = J.join_revision(I.eval_runs(spark, sf_dir), D.dim_revisions(spark))
    return out.select("suite", "exp", "step", "run_id", "task", "revision")


@query(
    "unknown_revision",
    f"""select distinct exp, step from ({I.SAMPLES_SQL}) s
    where not exists (select 1 from {REVISIONS_SQL} where rev.exp = s.exp and rev.step = s.step)""",
)
def unknown_revision_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.unknown_revision(I.eval_samples(spark, sf_dir), D.dim_revisions(spark))


@query(
    "join_task_config",
    f"""select n.run_id, n.task, n.task_key, dataset, metric, generation_size from ({RUNS}) n
    join {TASKS_SQL} on def.task = string_split(n.task_key, '|')[2]""",
)
def join_task_config_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = J.join_task_config(I.eval_runs(spark, sf_dir), D.dim_tasks(spark))
    return out.select("run_id", "task", "task_key", "dataset", "metric", "generation_size")


@query(
    "published_vs_logged",
    f"""select model, m.exp, m.step, published, {r('macro_score * 100', 6)} as logged, {r('abs(published - macro_score * 100)', 6)} as abs_diff
    from ({MACRO_SQL}) m join (values (1, 1, 100, 53.0::double), (2, 2, 50, 55.7::double), (3, 3, 50, 56.3::double))
      as p(model, exp, step, published) on p.exp = m.exp and p.step = m.step""",
)
def published_vs_logged_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = J.published_vs_logged(macro(spark, sf_dir), D.dim_published(spark))
    return out.withColumn("logged", rounded("logged", 6)).withColumn("abs_diff", rounded("abs_diff", 6))


@query(
    "sweep_report",
    f"""with m as (select suite, exp, step, avg(score) as macro_score, sum(score * n_docs) / sum(n_docs) as micro_score,
      sum(n_docs)::bigint as n_docs from ({LATEST_SQL}) group by suite, exp, step),
    k as (select *, row_number() over (partition by suite, exp order by macro_score desc, step) as rn from m)
    select suite, exp, step, {r('macro_score')} as macro_score, {r('micro_score')} as micro_score, n_docs from k where rn = 1""",
)
def sweep_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sweep_report(I.eval_runs(spark, sf_dir))
    return out.withColumn("macro_score", rounded("macro_score")).withColumn("micro_score", rounded("micro_score"))


@query(
    "evaluate_tasks",
    f"""with {I.GRADED_SQL}, letters as (
      select case when substr('ABCDE', cast(event_id % 5 as integer) + 1, 1) = substr('ABCD', cast(user_id % 4 as integer) + 1, 1)
        then 1.0::double else 0.0::double end as score from events),
    s as (select case when prompt_id % 2 = 0 then 'math_500' else 'aime24' end as task,
        case when is_correct then 1.0::double else 0.0::double end as score from scored
      union all select 'gpqa:diamond', score from letters)
    select task, {r('avg(score)')} as score, {r('sqrt(avg(score) * (1 - avg(score)) / nullif(count(*) - 1, 0))')} as stderr,
      count(*) as n_docs from s group by task""",
)
def evaluate_tasks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Math completions from conversations and letter answers from events, each scored by its task's metric."""
    math = I.completions(spark, sf_dir).select(
        F.when(F.col("prompt_id") % 2 == 0, "math_500").otherwise("aime24").alias("task"),
        "content",
        F.array("solution").alias("choices"),
        F.lit(0).cast("bigint").alias("gold_index"),
    )
    events = read_table(spark, sf_dir, "events", "event_id", "user_id")
    letter = F.substring(F.lit("ABCDE"), (F.col("event_id") % 5 + 1).cast("int"), F.lit(1))
    letters = events.select(
        F.lit("gpqa:diamond").alias("task"),
        F.concat(F.lit("Thinking.\nAnswer: "), letter).alias("content"),
        F.array(*[F.lit(x) for x in "ABCD"]).alias("choices"),
        (F.col("user_id") % 4).alias("gold_index"),
    )
    out = evaluate_tasks(math.unionByName(letters), D.dim_tasks(spark), equivalence=False)
    return out.select("task", rounded("score").alias("score"), rounded("stderr").alias("stderr"), "n_docs")
