"""Inputs that the small tables do not hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollscore.functions.answers import boxed_answer, index_match, numeric_value
from rollscore.operators.mapping import external_step
from rollscore.operators.sets import benchmarks_unsupported
from rollscore.operators.shaping import chat_render, generation_requests, group_generations, render_conversations, request_batches
from rollscore.operators.skew import unit_dense_rank
from rollscore.plans.jobs import score_eval_samples
from rollscore.streaming.streams import stream_checkpoint_jobs


def test_only_a_leading_double_sign_folds(values):
    assert values(["5--3", "--7", "53"], numeric_value("content")) == [None, 7.0, 53.0]


def test_letter_stands_alone_and_the_last_counts(values):
    choices = F.array(*map(F.lit, "ABCD"))
    texts = ["Answer: Distance", "Answer: Because …\nAnswer: C", "Answer: D", "Answer: $D$"]
    assert values(texts, index_match("content", choices, F.lit(3))) == [0.0, 0.0, 1.0, 1.0]
    assert values(texts[1:2], index_match("content", choices, F.lit(2))) == [1.0]


def test_lone_all_is_known(spark):
    asked = spark.createDataFrame([(1, "all"), (2, "all"), (2, "x"), (3, "m")], "request_id int, benchmark string")
    got = {tuple(r) for r in benchmarks_unsupported(asked, ["m"]).collect()}
    assert got == {(2, "all"), (2, "x")}


def test_null_scores_and_keys_are_ranked(spark):
    rows = [(1, "a", 0.5), (2, "a", None), (3, "a", 0.9), (4, None, 0.1), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, task string, score double")
    got = {r.id: r["rank"] for r in unit_dense_rank(df, ["task"], "score", "rank", ["id"]).collect()}
    assert got == {1: 2, 2: 3, 3: 1, 4: 1, 5: 2}


def test_only_the_jinja_slot_is_filled(spark):
    df = spark.createDataFrame([("a",)], "prompt string")
    got = generation_requests(df, "prompt", "keep {instruction} and {{instruction}}{{ instruction }}").first().instruction
    assert got == "keep {instruction} and aa"


def test_unknown_task_stays_visible(spark):
    samples = spark.createDataFrame(
        [("m", "\\boxed{4}", ["4"], 0), ("other", "\\boxed{4}", ["4"], 0)],
        "task string, content string, choices array<string>, gold_index long",
    )
    tasks = spark.createDataFrame([("m", "math")], "task string, metric string")
    assert {r.task: r.score for r in score_eval_samples(samples, tasks).collect()} == {"m": 1.0, "other": None}


def test_late_saves_are_kept(spark, tmp_path):
    schema = "run string, step int, ts timestamp"
    for n, (step, day) in enumerate([(100, "2024-04-10"), (50, "2024-04-11"), (150, "2024-01-10")]):
        rows = spark.createDataFrame([("r", step, day)], "run string, step int, ts string")
        rows.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{n}")
    saves = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    stream_checkpoint_jobs(saves, ["math_500"], f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(r.step for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [50, 100, 150]


def test_boxes_nest_to_any_depth(values):
    deep = "{" * 40 + "x" + "}" * 40
    texts = ["\\boxed{" + deep + "} and \\boxed{never", "a \\boxed{1} b \\boxed{\\boxed{2}}", "\\boxed{ {3", "none", None]
    assert values(texts, boxed_answer("content")) == [deep, "\\boxed{2}", None, None, None]


def test_turns_above_ten_thousand_stay_in_one_text(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 10_000, "user", "b")], "conv_id int, turn int, role string, text string")
    rows = render_conversations(turns, eos="", generation_prompt=True).collect()
    assert [r.rendered for r in rows] == ["<|user|>\na\n<|user|>\nb\n<|assistant|>"]
    empty = spark.createDataFrame([([],)], "m array<struct<role:string,content:string>>")
    assert empty.select(chat_render("m", generation_prompt=True).alias("t")).first().t == ""
    many = spark.createDataFrame([(1, 10_000, "b", "e"), (1, 3, "a", None)], "prompt_id int, gen_idx int, text string, error string")
    assert [tuple(r) for r in group_generations(many, error="error").collect()] == [(1, ["a", "b"], [None, "e"])]


def test_one_call_for_each_numbered_batch(spark):
    def server():
        def make_client():
            return lambda prompts: [str(len(prompts))] * len(prompts)

        return make_client

    asked = spark.range(69).select((F.col("id") * 1_000_003).alias("id"), F.lit("p").alias("instruction"))
    batched = request_batches(asked, "id", batch_rows=32)
    got = external_step(batched, server(), replicas=2, batch=("load_unit", "batch")).collect()
    assert {(r.batch, r.text) for r in got} == {(0, "32"), (1, "32"), (2, "5")}
