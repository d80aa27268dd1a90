from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollscore.functions.answers import (
    boxed_answer,
    extract_answer,
    extract_code,
    index_match,
    with_grading,
    with_multi_gold,
)
from rollscore.functions.keys import checkpoint_dir, param_count, parse_task_key, step_revision


@pytest.mark.parametrize(
    "text, want",
    [
        ("a <answer> 4 </answer> b", "4"),
        ("</answer> x <answer> y", ""),
        ("<answer>1</answer><answer>2</answer>", "1"),
        ("see \\boxed{12} and \\boxed{13}", "12"),
        ("see \\boxed{\\frac{1}{2}}", "\\frac{1"),
        ("see \\boxed{12", "1"),
        ("see \\boxed{", ""),
        ("<answer> only \\boxed{7}", "7"),
        ("line one\nline two \n\n", "line two"),
        ("", ""),
        (" \n ", ""),
        ("\\boxed{ 5\x1c}", "5"),
    ],
)
def test_extract_answer(values, text, want):
    assert values([text], extract_answer("content")) == [want]


@pytest.mark.parametrize(
    "text, want",
    [
        ("```python\na\n```\n```python\nb\nc\n```", "b\nc\n"),
        ("no code", ""),
        ("```java\nx\n```", ""),
        ("```python\nopen", ""),
    ],
)
def test_extract_code(values, text, want):
    assert values([text], extract_code("content")) == [want]


@pytest.mark.parametrize(
    "text, want",
    [
        ("\\boxed{\\frac{1}{2}}", "\\frac{1}{2}"),
        ("\\boxed{3} then \\boxed{4}", "4"),
        ("\\boxed{3} then \\boxed{4", "3"),
        ("\\boxed{\\sqrt{\\frac{\\sqrt{a}}{b}}}", "\\sqrt{\\frac{\\sqrt{a}}{b}}"),
        ("none", None),
        ("\\boxed{}", ""),
    ],
)
def test_boxed_answer(values, text, want):
    assert values([text], boxed_answer("content")) == [want]


def test_very_long_boxes_do_not_break_the_executor(values):
    flat = "\\boxed{" + "x" * 200_000 + "}"
    nested = "\\boxed{" + "{y}" * 50_000 + "}"
    unclosed = "\\boxed{" + "{z}" * 50_000
    got = values([flat, nested, unclosed], F.length(boxed_answer("content")))
    assert got == [200_000, 150_000, None]


@pytest.mark.parametrize(
    "content, gold, want",
    [
        ("\\boxed{\\frac{1}{2}}", "$0.5$", True),
        ("\\boxed{1,000}", "1000", True),
        ("\\boxed{7/18}", "\\dfrac{7}{18}", True),
        ("\\boxed{3} \\boxed{4}", "4", True),
        ("no box 4", "4", False),
        ("\\boxed{x+1}", "x + 1", True),
        ("\\boxed{0.333333}", "\\frac{1}{3}", True),
        ("\\boxed{50\\%}", "0.5", True),
        ("\\boxed{\\text{east}}", "east", True),
        ("\\boxed{2}", "3", False),
        ("\\boxed{1/0}", "2", False),
        ("\\boxed{-\\frac{3}{4}}", "-0.75", True),
        ("\\boxed{-\\frac{-3}{4}}", "0.75", True),
        ("\\boxed{.5}", "50%", True),
        ("\\boxed{3/4%}", "0.0075", False),
        ("\\boxed{1/3}", "0.33334", False),
        ("\\boxed{+7}", "7.0", True),
        ("\\boxed{1,234,567.5}", "1234567.5", True),
        ("\\boxed{(1,234)}", "(1234)", False),
        ("\\boxed{\\left(1, 2\\right)}", "(1,2)", True),
        ("\\boxed{5}", "so the result is $\\boxed{5}$.", True),
        ("\\boxed{4.}", "4", True),
    ],
)
def test_grading(spark, content, gold, want):
    df = spark.createDataFrame([(content, gold)], "content string, solution string")
    assert with_grading(df).first().is_correct is want


def test_empty_gold_is_unusable(spark):
    df = spark.createDataFrame([("\\boxed{5}", "")], "content string, solution string")
    assert with_grading(df).first().gold_norm is None


def test_multi_gold(spark):
    df = spark.createDataFrame(
        [(1, "\\boxed{2}", ["1", "2"]), (2, "\\boxed{3}", ["1", "2"]), (3, "none", ["1"]), (4, "\\boxed{0.5}", ["1", "1/2"])],
        "id int, content string, golds array<string>",
    )
    rows = with_multi_gold(df, "content", "golds").orderBy("id").collect()
    assert [r.score for r in rows] == [1.0, 0.0, 0.0, 1.0]


@pytest.mark.parametrize(
    "text, index, want",
    [("Answer: B", 1, 1.0), ("Answer: $B", 1, 1.0), ("Answer:  $C$", 1, 0.0), ("B", 1, 0.0), ("Answer: E", 1, 0.0)],
)
def test_index_match(values, text, index, want):
    choices = F.array(*[F.lit(x) for x in "ABCD"])
    assert values([text], index_match("content", choices, F.lit(index))) == [want]


@pytest.mark.parametrize(
    "model, want",
    [
        ("org/Qwen-1.5B", 1_500_000_000),
        ("Mixtral-8x7b-v0.1", 56_000_000_000),
        ("tiny-42m", 42_000_000),
        ("a-7b-draft-0.5b", 7_000_000_000),
        ("none", -1),
    ],
)
def test_param_count(values, model, want):
    assert values([model], param_count("content")) == [want]


def test_task_keys_and_revisions(values):
    got = values(["custom|gpqa:diamond|0|1", "custom|aime24|0", "custom|aime24"], parse_task_key("content"))
    assert [tuple(g) for g in got] == [
        ("custom", "gpqa:diamond", 0, 1), ("custom", "aime24", 0, None), ("custom", "aime24", None, None)
    ]
    assert values(["main"], step_revision("content", F.lit(50))) == ["main-step-000000050"]
    assert values(["out"], checkpoint_dir("content", F.lit(50))) == ["out/checkpoint-50"]


pieces = st.lists(
    st.sampled_from(["<answer>", "</answer>", "\\boxed{", "{", "}", "}", "x", " ", "\n", "7", "\x1c"]), max_size=14
).map("".join)


def shown(text: str) -> str:
    if "<answer>" in text and "</answer>" in text:
        return text.split("</answer>", 1)[0].partition("<answer>")[2].strip()
    if "\\boxed{" in text:
        head, brace, _ = text.partition("\\boxed{")[2].partition("}")
        return (head if brace else head[:-1]).strip()
    return text.strip().rsplit("\n", 1)[-1]


def last_box(text: str) -> str | None:
    found, at = None, 0
    while (start := text.find("\\boxed{", at)) >= 0:
        depth, end = 1, start + len("\\boxed{")
        while end < len(text) and depth:
            depth += {"{": 1, "}": -1}.get(text[end], 0)
            end += 1
        if depth:
            at = start + 1
        else:
            found, at = text[start + len("\\boxed{") : end - 1], end
    return found


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(pieces, min_size=300, max_size=400))
def test_extraction_equals_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    rows = df.select("id", extract_answer("content").alias("a"), boxed_answer("content").alias("b")).orderBy("id").collect()
    assert [r.a for r in rows] == [shown(t) for t in texts]
    assert [r.b for r in rows] == [last_box(t) for t in texts]
