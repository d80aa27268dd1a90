from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollscore.operators import shaping as S
from rollscore.operators.evaldocs import eval_docs, gpqa_docs
from rollscore.operators.filters import doc_counts, limit_docs, unique_docs
from rollscore.operators.mapping import external_step
from rollscore.operators.sets import benchmarks_unsupported, expand_benchmarks


def test_conversation_with_without_and_empty_system(spark):
    df = spark.createDataFrame([("2 + 2?",)], "problem string")
    assert [m.role for m in S.make_conversation(df, "be brief").first().prompt] == ["system", "user"]
    assert [m.role for m in S.make_conversation(df).first().prompt] == ["user"]
    assert S.make_conversation(df, "").first().prompt[0].content == ""


def test_drops(spark):
    df = spark.createDataFrame([("p", "s", 1)], "problem string, solution string, messages int")
    assert S.drop_messages(df).columns == ["problem", "solution"]
    assert S.prune_for_tokens(df).columns == ["messages"]
    assert S.prune_for_tokens(df.drop("problem")).columns == ["solution", "messages"]


def test_chat_render_skips_unknown_roles(spark):
    df = spark.createDataFrame([([("system", "s"), ("tool", "t"), ("user", "u%$")],)], f"m array<{S.MESSAGE}>")
    row = df.select(S.chat_render("m", "<eos>", True).alias("a"), S.chat_render("m", "<eos>").alias("b")).first()
    assert row.b == "<|system|>\ns<eos>\n<|user|>\nu%$<eos>\n"
    assert row.a == row.b + "<|assistant|>"


def test_long_conversations_come_in_ordered_parts(spark):
    turns = spark.range(25).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text")
    )
    rows = S.collect_messages(turns.repartition(5), rows_per_part=10).orderBy("part").collect()
    assert [r.part for r in rows] == [0, 1, 2]
    assert [m.content for r in rows for m in r.messages] == [str(i) for i in range(25)]


def test_generation_marker_only_ends_the_last_part(spark):
    rows = [(c, t, "user", f"m{t}") for c in (1, 2) for t in range(c * 10)]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    parts = S.render_conversations(turns, eos="", generation_prompt=True, rows_per_part=6).orderBy("conv_id", "part").collect()
    whole = {r.conv_id: r.rendered for r in S.render_conversations(turns, eos="", generation_prompt=True).collect()}
    for conv in (1, 2):
        mine = [r.rendered for r in parts if r.conv_id == conv]
        assert len(mine) == (2 if conv == 1 else 4)
        assert "".join(mine) == whole[conv]
    plain = S.render_conversations(turns, eos="").collect()
    assert all("assistant" not in r.rendered for r in plain)


def test_templates_keep_odd_characters(spark):
    odd = "50% of $x$ {Question} {A} \\boxed{1}"
    df = spark.createDataFrame([(1, odd, "b{B}", "x", "y", "z")], "id int, q string, c string, w1 string, w2 string, w3 string")
    assert df.select(S.math_prompt("q").alias("v")).first().v == S.MATH_PROMPT.replace("{Question}", odd)
    row = gpqa_docs(df, "id", "q", "c", ["w1", "w2", "w3"]).first()
    assert odd in row.query and row.query == row.instruction
    assert f"\n{'ABCD'[row.gold_index]}) b{{B}}" in row.query


def test_gpqa_places_use_all_letters_and_repeat(spark):
    df = spark.range(400).select(F.col("id"), *[F.lit(c).alias(c) for c in ("q", "c", "w1", "w2", "w3")])
    first = [r.gold_index for r in gpqa_docs(df, "id", "q", "c", ["w1", "w2", "w3"]).orderBy("id").collect()]
    again = [r.gold_index for r in gpqa_docs(df.repartition(7), "id", "q", "c", ["w1", "w2", "w3"]).orderBy("id").collect()]
    assert first == again
    assert all(60 < first.count(i) < 140 for i in range(4))


def test_eval_docs_columns(spark):
    df = spark.createDataFrame([("p", "sol", "ans", "que")], "problem string, solution string, answer string, question string")
    gold = {t: eval_docs(df, t).first().choices for t in ("math_500", "minerva", "aime24", "amc23", "olympiadbench")}
    assert gold == {"math_500": ["sol"], "minerva": ["sol"], "aime24": ["ans"], "amc23": ["ans"], "olympiadbench": ["ans"]}
    assert eval_docs(df, "olympiadbench").first().query.endswith("\n\nque")


def test_request_params_hold_only_what_is_set(spark):
    df = spark.createDataFrame([("p",)], "problem string")
    assert S.generation_requests(df, "problem").first().params.asDict() == {"max_new_tokens": 8192}
    full = S.generation_requests(df, "problem", temperature=0.5, top_p=0.9, max_new_tokens=10).first()
    assert full.params.asDict() == {"max_new_tokens": 10, "temperature": 0.5, "top_p": 0.9}


def test_batches_fill_up_inside_a_load_unit(spark):
    df = S.replicate_generations(spark.range(100), 2)
    rows = S.request_batches(df, "id", ("gen_idx",), batch_rows=8, load_batches=4).collect()
    assert len(rows) == 200
    sizes = {}
    for r in rows:
        assert (r.load_unit, r.batch) == ((r.id * 2 + r.gen_idx) // 32, (r.id * 2 + r.gen_idx) % 32 // 8)
        sizes[(r.load_unit, r.batch)] = sizes.get((r.load_unit, r.batch), 0) + 1
    assert max(sizes.values()) == 8


def test_sparse_ids_fill_batches(spark):
    sparse = spark.range(500).select(((F.col("id") - 250) * 1_000_003 * 1_000_003).alias("id"))
    rows = S.request_batches(sparse.repartition(7), "id", (), batch_rows=8, load_batches=10).orderBy("id").collect()
    assert [(r.load_unit, r.batch) for r in rows] == [(i // 80, i % 80 // 8) for i in range(500)]
    sizes = {}
    for r in rows:
        sizes[(r.load_unit, r.batch)] = sizes.get((r.load_unit, r.batch), 0) + 1
    assert sorted(sizes.values()) == [4] + [8] * 62
    assert max(u for u, _ in sizes) == 6


def test_padding_keeps_tokens(spark):
    df = spark.createDataFrame([(1, 0, [5, 6]), (2, 0, [7]), (3, 1, []), (4, 1, [1, 2, 3])], "id int, b int, ids array<int>")
    rows = {r.id: r for r in S.left_pad_batch(df, "ids", ["b"], F.lit(0)).collect()}
    assert rows[1].padded == [5, 6] and rows[2].padded == [0, 7] and rows[2].pad_mask == [0, 1]
    assert rows[3].padded == [0, 0, 0] and rows[4].pad_mask == [1, 1, 1]


@pytest.mark.parametrize("length", [1, 4, 7, 1000])
def test_packing_keeps_every_token_in_order(spark, length):
    docs = [(i * 999_983, [f"{i}.{j}" for j in range((i * 7) % 23)]) for i in range(60)]
    df = spark.createDataFrame(docs, "id int, tokens array<string>").repartition(5)
    rows = S.pack_sequences(df, "id", length=length).orderBy("packed_row").collect()
    assert [t for r in rows for t in r.tokens] == [t for _, toks in docs for t in toks]
    assert all(len(r.tokens) == length for r in rows[:-1])
    assert [r.packed_row for r in rows] == list(range(len(rows)))


def test_completion_text(spark):
    df = spark.createDataFrame([([("assistant", "a"), ("assistant", "b")],), ([],)], f"c array<{S.MESSAGE}>")
    rows = df.select(S.completion_text("c").alias("f"), S.completion_text("c", True).alias("l")).collect()
    assert [(r.f, r.l) for r in rows] == [("a", "b"), (None, None)]


def test_unique_docs_and_limits(spark):
    df = spark.range(90).select("id", (F.col("id") % 2).alias("src"), (F.col("id") % 10).cast("string").alias("text"))
    unique = unique_docs(df, "text", "id", ["src"])
    assert sorted(r.id for r in unique.collect()) == list(range(10))
    assert sorted(r.id for r in limit_docs(unique, ["src"], "id", 2).collect()) == [0, 1, 2, 3]
    assert limit_docs(df, ["src"], "id", None).count() == 90
    counts = {r.src: (r.original_num_docs, r.effective_num_docs) for r in doc_counts(df, ["src"], "text").collect()}
    assert counts == {0: (45, 5), 1: (45, 5)}


def test_benchmark_requests(spark):
    df = spark.createDataFrame([(1, "all"), (2, "gpqa"), (2, "amc23"), (3, "all"), (3, "gpqa"), (4, "all"), (4, "all")], "request_id int, benchmark string")
    known = ["math_500", "gpqa"]
    got = sorted(tuple(r) for r in expand_benchmarks(df, known).collect())
    assert got == [(1, "gpqa"), (1, "math_500"), (2, "amc23"), (2, "gpqa"), (3, "all"), (3, "gpqa"), (4, "all")]
    bad = sorted(tuple(r) for r in benchmarks_unsupported(df, known).collect())
    assert bad == [(2, "amc23"), (3, "all"), (4, "all")]


def test_unique_docs_keeps_one_row_per_text(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "a", "y"), (None, "b", "z"), (None, "b", "z"), (None, "a", "u"), (2, None, "v"), (3, None, "w")]
    df = spark.createDataFrame(rows, "id long, text string, note string")
    for parts in (1, 4):
        got = unique_docs(df.repartition(parts), "text", "id").collect()
        assert sorted((str(r.id), str(r.text)) for r in got) == [("1", "a"), ("2", "None"), ("None", "b")]
    assert unique_docs(df.where("id > 9"), "text", "id").count() == 0


def test_external_step_retries_and_keeps_failed_rows(spark):
    class Flaky:
        """Fails on the first call of every batch, and always for a batch with a poisoned prompt."""

        def __init__(self):
            self.seen = set()

        def __call__(self, prompts):
            if "poison" in prompts:
                raise RuntimeError("no")
            if prompts[0] not in self.seen:
                self.seen.add(prompts[0])
                raise TimeoutError("first call")
            return [p.upper() for p in prompts]

    df = spark.createDataFrame([(i, "poison" if i == 5 else f"p{i}") for i in range(12)], "id int, instruction string")
    out = external_step(df, Flaky, replicas=1, batch_rows=3, retries=1, pause=0.0).collect()
    assert len(out) == 12
    failed = [r for r in out if r.error]
    assert len(failed) == 3 and all(r.text is None and "RuntimeError" in r.error for r in failed)
    assert all(r.text == r.instruction.upper() for r in out if not r.error)
