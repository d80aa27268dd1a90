from __future__ import annotations

import math
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollscore.functions.text import FOREIGN_SCRIPTS, is_non_english, py_split, py_strip
from rollscore.operators import rewards as R
from rollscore.operators.groups import with_group_advantage, with_len_reward
from rollscore.operators.registry import RewardConfig, add_rewards, normalized_weights, register, score_rollouts

GOOD = "<think>\nA square of side 3 has area 9.\nx + y < 5 cuts off a corner.\n</think>\n\n<answer>\nIt is 7/18.\n</answer>"
BAD = "It is 7/18 because the square has area 9."
CLOSING_ONLY = "Thinking about it.\n\n</think>\n\nThe answer is 7/18."
NO_TAGS = "Let me work through this. The answer is 7/18."
BOTH_TAGS = "<think>\nThinking about it.\n</think>\n\nThe answer is 7/18."

EDGES = [
    GOOD,
    BAD,
    CLOSING_ONLY,
    NO_TAGS,
    BOTH_TAGS,
    "",
    " \n ",
    "two words",
    "\n</think>\n</think>\n",
    "\n</think>\n\n</think>\n",
    "<think>\n<think>\n\n</think>\n",
    "1. a\n2. b",
    "a\n1. b",
    "Step \u0661: one Step 2: two",
    "Step 1: a\nStep 2: b\n- c\n* d Finally, e",
    "a\u00a0b\x1cc d\u2003a\u00a0b\x1cc d",
    "a b a b a b a b",
    "\u0130stanbul \u03a3\u03a3 \u0130stanbul \u03a3\u03a3 \u0130stanbul \u03a3\u03a3",
    "\U0001f600 \U0001f600 \U0001f600 \U0001f600",
    "The the THE the the THE",
]


@pytest.mark.parametrize(
    "text, fmt, tags",
    [(GOOD, 1.0, 1.0), (BAD, 0.0, 0.0), (CLOSING_ONLY, 1.0, 0.5), (NO_TAGS, 0.0, 0.0), (BOTH_TAGS, 1.0, 1.0)],
)
def test_golden_rows(values, text, fmt, tags):
    assert values([text], R.format_reward("content")) == [fmt]
    assert values([text], R.tag_count_reward("content")) == [tags]
    combined = F.lit(0.5) * R.format_reward("content") + F.lit(0.5) * R.tag_count_reward("content")
    assert values([text], combined) == [0.5 * fmt + 0.5 * tags]


def test_counting_rewards_on_edge_strings(values):
    closing = [t.count("\n</think>\n") for t in EDGES]
    opening = [t.count("<think>\n") for t in EDGES]
    assert values(EDGES, R.format_reward("content")) == [float(n == 1) for n in closing]
    assert values(EDGES, R.tag_count_reward("content")) == [
        0.5 * (o == 1) + 0.5 * (c == 1) for o, c in zip(opening, closing, strict=True)
    ]
    found = [len(re.findall(R.STEP_MARKERS, t)) for t in EDGES]
    assert values(EDGES, R.reasoning_steps_reward("content")) == pytest.approx([min(1.0, n / 3) for n in found])


def penalty(text: str, n: int, most: float) -> float:
    words = text.lower().split()
    if len(words) < n:
        return 0.0
    grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    return (1 - len(set(grams)) / len(grams)) * most


@pytest.mark.parametrize("n, most", [(1, -1.0), (2, -0.5), (3, -1.0), (5, -2.0)])
def test_repetition_penalty(spark, n, most):
    df = spark.createDataFrame(list(enumerate(EDGES)), "id int, content string")
    rows = R.with_repetition_penalty(df, n=n, max_penalty=most).orderBy("id").collect()
    assert [r.repetition_penalty for r in rows] == pytest.approx([penalty(t, n, most) for t in EDGES])


def test_repetition_penalty_must_not_be_positive(spark):
    with pytest.raises(ValueError):
        R.with_repetition_penalty(spark.range(1).select(F.lit("x").alias("content")), max_penalty=0.5)


text_lists = st.lists(
    st.text(alphabet=st.sampled_from(list("ab AB\n\t\x1c\x1f\u00a0\u2003\u3000\x85.<>")), max_size=40), min_size=20, max_size=40
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(text_lists)
def test_whitespace_rules_match_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    rows = df.select("id", py_strip("content").alias("s"), py_split("content").alias("w")).orderBy("id").collect()
    assert [r.s for r in rows] == [t.strip() for t in texts]
    assert [r.w for r in rows] == [t.split() for t in texts]


def test_every_whitespace_character_is_known(spark):
    codes = [c for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, f"a{chr(c)}b", f"{chr(c)}a{chr(c)}") for c in codes], "code int, mid string, ends string")
    got = df.select("code", (F.size(py_split("mid")) == 2).alias("splits"), (py_strip("ends") == "a").alias("strips"))
    spaces = {c for c in codes if chr(c).isspace()}
    rows = got.collect()
    assert {r.code for r in rows if r.splits} == spaces
    assert {r.code for r in rows if r.strips} == spaces


CODE = "<think>\nx\n</think>\n<answer>\n```python\nprint(1)\n```\n</answer>"


@pytest.mark.parametrize(
    "text, want",
    [
        (CODE, 1.0),
        (CODE + "\nmore", 1.0),
        (CODE + " more", 0.0),
        ("Hi " + CODE, 0.0),
        ("\n" + CODE, 0.0),
        (CODE.replace("python", "java"), 0.0),
        (CODE.replace("\n", "\r\n"), 0.0),
        (CODE + "\r", 0.0),
        (CODE.replace("</think>\n", "</think>\n\n"), 0.0),
    ],
)
def test_code_format(values, text, want):
    assert values([text], R.code_format_reward("content")) == [want]


code_parts = st.lists(
    st.sampled_from(["<think>\n", "x", "\n", "</think>\n", "\n</think>\n<answer>\n", "```python", "```", "\n</answer>", "\r"]),
    max_size=14,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(code_parts, min_size=300, max_size=400))
def test_code_format_equals_a_regex(spark, parts):
    texts = ["<think>\n" * (i % 2) + "".join(p) for i, p in enumerate(parts)]
    layout = re.compile(r"<think>\n.*?\n</think>\n<answer>\n.*?```python.*?```.*?\n</answer>$", re.S | re.M)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    rows = df.select("id", R.code_format_reward("content").alias("v")).orderBy("id").collect()
    assert [r.v for r in rows] == [float(layout.match(t) is not None) for t in texts]


def test_code_format_other_language(values):
    assert values([CODE.replace("python", "java")], R.code_format_reward("content", "java")) == [1.0]


def curve(length, right, lo_wrong, hi_wrong, lo_right, hi_right, full):
    at_end, at_start = (lo_right, hi_right) if right else (hi_wrong, lo_wrong)
    return at_end + (at_start - at_end) * (1 + math.cos(math.pi * length / full)) / 2


@pytest.mark.parametrize("ends", [(-1.0, -0.5, 0.5, 1.0), (0.0, -0.5, 0.5, 1.0)])
def test_cosine(spark, ends):
    lengths = [0, 1, 10, 500, 999, 1000, 1500, 2000, 2500]
    rows = [(n, right, "x" * n, "1") for n in lengths for right in (True, False)]
    df = spark.createDataFrame(rows, "n int, is_correct boolean, content string, gold_norm string")
    reward = R.cosine_scaled_reward(
        min_value_wrong=ends[0], max_value_wrong=ends[1], min_value_correct=ends[2], max_value_correct=ends[3]
    )
    for r in df.select("n", "is_correct", reward.alias("v")).collect():
        assert r.v == pytest.approx(curve(r.n, r.is_correct, *ends, 1000))


def test_unusable_gold_policies(spark):
    df = spark.createDataFrame([(1, 1, "\\boxed{3}", "$ $"), (2, 1, "no", None), (3, 1, "longer \\boxed{3}", "4")],
                               "completion_id int, prompt_id int, content string, solution string")
    rows = {r.completion_id: r for r in add_rewards(df, ["accuracy", "cosine", "length"]).collect()}
    assert [rows[i].reward_accuracy for i in (1, 2, 3)] == [1.0, 1.0, 0.0]
    assert [rows[i].reward_cosine for i in (1, 2)] == [1.0, 1.0]
    longest = len("longer \\boxed{3}")
    assert rows[1].reward_length == pytest.approx(0.5 - (9 - 2) / (longest - 2))
    assert rows[2].reward_length == 0.5
    assert rows[3].reward_length == -0.5


def test_len_reward_of_equal_lengths_is_zero(spark):
    df = spark.createDataFrame(
        [(i, 1, "abcd", "1", i % 2 == 0) for i in range(4)],
        "completion_id int, prompt_id int, content string, gold_norm string, is_correct boolean",
    )
    assert {r.len_reward for r in with_len_reward(df).collect()} == {0.0}


def test_advantage_sums_to_zero_and_single_rows_are_zero(spark):
    df = spark.createDataFrame([(i, i % 5, float(i * i % 7)) for i in range(40)] + [(99, 99, 3.0)],
                               "completion_id int, prompt_id int, reward double")
    rows = with_group_advantage(df).collect()
    sums = {}
    for r in rows:
        sums[r.prompt_id] = sums.get(r.prompt_id, 0.0) + r.advantage
    assert all(abs(v) < 1e-9 for v in sums.values())
    assert [r.advantage for r in rows if r.prompt_id == 99] == [0.0]


def test_registry(spark):
    df = spark.createDataFrame([(1, 1, GOOD, "7/18"), (2, 1, BAD, "7/18")],
                               "completion_id int, prompt_id int, content string, solution string")
    with pytest.raises(KeyError):
        add_rewards(df, ["no_such_reward"])
    assert normalized_weights(["a", "b"], [1.0, 3.0]) == [0.25, 0.75]
    assert normalized_weights(["a", "b"]) == [0.5, 0.5]
    register("fails", lambda: F.expr("cast(null as double)"))
    rows = {r.completion_id: r.reward for r in score_rollouts(df, ["format", "fails"], [0.5, 0.5], advantage=False).collect()}
    assert rows == {1: 0.5, 2: 0.0}


def test_weighted_sum_orders_the_golden_texts(spark):
    texts = [GOOD, CLOSING_ONLY, BAD, NO_TAGS]
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "completion_id int, prompt_id int, content string")
    rows = score_rollouts(df, ["format", "tag_count"], [1.0, 1.0], normalize=True, config=RewardConfig()).orderBy("completion_id")
    assert [r.reward for r in rows.collect()] == [1.0, 0.75, 0.0, 0.0]


@pytest.mark.parametrize(
    "stdout, expected, want",
    [("1", "1\n2", True), ("5\nextra", "5", True), ("", "9", False), (" 5 \n", "5", True), ("5", " 5", True), ("4", "5", False)],
)
def test_case_comparison(spark, stdout, expected, want):
    df = spark.createDataFrame([(stdout, expected)], "stdout string, expected string")
    assert df.select(R.case_passes(F.col("stdout"), F.col("expected")).alias("v")).first().v is want


def test_code_pass_rate(spark):
    runs = spark.createDataFrame(
        [(1, 0, 0, False, "1", "1"), (1, 1, 1, False, "1", "1"), (2, 0, 0, False, "1", "1"), (2, 1, 0, True, "", "1")],
        "completion_id int, case_id int, returncode int, timed_out boolean, stdout string, expected string",
    )
    done = spark.createDataFrame([(1,), (2,), (3,)], "completion_id int")
    rates = {r.completion_id: r.code_reward for r in R.code_pass_rate(done, runs).collect()}
    assert rates == {1: 0.5, 2: 0.0, 3: 0.0}


SCRIPT_TEXTS = [
    "plain english", "", "  ", "\u043f\u0440\u0438\u0432\u0435\u0442", "$\u043f\u0440$ only", "\\(\u0430\\) x", "\\text{\u0431} x",
    "\\sqrt[\u0431]{x}", "5 \u00b5m", "\u2126 ohm", "\uff76 half", "caf\u00e9 na\u00efve", "\u4f60\u597d", "\u05d0", "\u0e01",
    "\\begin{a}\n\u03b1\n\\end{a} z", "\u03b1", "\ufb20", "\u00bd", "\uac00",
]


def foreign_after_decomposition(text: str) -> bool:
    text = re.sub(r"\$[^$]*\$|\\\(.*?\\\)|\\\[.*?\\\]|\\begin\{.*?\}.*?\\end\{.*?\}", "", text, flags=re.S)
    text = unicodedata.normalize("NFKD", re.sub(r"\\[a-zA-Z]+(?:\{[^{}]*\})*", "", text))
    ranges = [r for rs in FOREIGN_SCRIPTS.values() for r in rs]
    return any(lo <= ord(c) <= hi for c in text for lo, hi in ranges)


def test_non_english(values):
    assert values(SCRIPT_TEXTS, is_non_english("content")) == [foreign_after_decomposition(t) for t in SCRIPT_TEXTS]


def test_texts_are_not_shuffled_by_the_recipe(spark):
    from rollscore.plans.jobs import GROUP_RECIPE, score_with_recipe

    df = spark.createDataFrame([(1, 1, GOOD, "7/18"), (2, 1, BAD, "7/18")],
                               "completion_id int, prompt_id int, content string, solution string")
    scored = score_with_recipe(df.repartition(2), GROUP_RECIPE)
    assert "content" not in scored.columns
    assert {r.completion_id for r in scored.collect()} == {1, 2}
    assert "content" in score_with_recipe(df, GROUP_RECIPE, keep=["content"]).columns
