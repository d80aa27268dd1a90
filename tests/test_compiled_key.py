"""The compiled key gives what the expression gives, and grading large tables walks no lambda for it."""

from __future__ import annotations

import random
import re
from importlib.resources import files

import pytest
from pyspark.sql import functions as F

from rollscore.functions.algebra import LEAST_SQUARE, MOST_CHARS, SMALL, SPELLINGS, P, Q, answer_key, compiled_key, expression_key
from rollscore.functions.answers import boxed_answer, normalize_answer, numeric_value
from rollscore.plans import inputs as I

PIECES = (
    r"1 2 0 10 72 0.5 .25 1.5.2 12345678901234567890 99999999999 2147483648 5041 10082 x y a \pi \alpha \infty + - * / ^ ( ) [ ] { } \{ \} , "
    r", \frac \frac{1}{2} \frac12 1\frac{1}{2} \sqrt \sqrt2 \sqrt[3] \root3 \cup \cdot \times \div % \% = \in ^\circ ° × ÷ − π ∞ ∪ é abc \pixyz "
    r"\begin{pmatrix} \end{pmatrix} \begin{vmatrix} \end{vmatrix} & \\ ^{ ^{2} ^{-1} ^{1/2} \sqrt{50} \sqrt[3]{-16} 😀 ; | \rho \root \ (1,2) [a,b) 0^0 1/0"
).split() + ["\x01", "\x02", "\x03", "\n", " "]


def expression(rng, depth):
    if depth == 0 or rng.random() < 0.15:
        return rng.choice(["x", "y", r"\pi", "2", "3", "7", "0.5", ".3", "100", "0", "46341", "5041", "123456"])
    a, b = expression(rng, depth - 1), expression(rng, depth - 1)
    return rng.choice(
        [f"{a}+{b}", f"{a}-{b}", a + b, f"({a})({b})", rf"\frac{{{a}}}{{{b}}}", f"({a})/({b})", f"{a}^{{{b}}}", rf"\sqrt{{{a}}}", rf"\sqrt[{rng.randrange(2, 10)}]{{{a}}}", f"-{a}", f"({a})^{b}"]
    )


def structure(rng):
    a, b, c, d = (expression(rng, rng.randrange(3)) for _ in range(4))
    return rng.choice(
        [rf"\{{{a},{b},{c}\}}", f"{a},{b}", rf"({a},{b})\cup[{c},{d})", rf"\begin{{bmatrix}}{a}&{b}\\{c}&{d}\end{{bmatrix}}", rf"\{{({a},{b}),({c},1)\}}", f"x={a}", f"({a},({b},{c}))"]
    )


def test_compiled_key_is_the_expression(spark):
    rng = random.Random(5)
    made = [lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 9))), lambda: expression(rng, 3), lambda: structure(rng)]
    texts = [rng.choice(made)() for _ in range(3000)] + ["", "x" * 5000, "x+" * 499 + "x", "x+" * 500 + "x", "1," * 600 + "1", "2^{" * 50 + "1" + "}" * 50]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").repartition(8)
    rows = rows.select(F.explode(F.array("t", normalize_answer("t"))).alias("t"))
    found = rows.select("t", expression_key("t").alias("a"), answer_key("t").alias("b")).collect()
    assert [r for r in found if str(r.a) != str(r.b)] == []
    assert sum("text:" not in r.b.key for r in found if r.b) > 2000


def test_key_walks_no_lambda(spark, capsys):
    spark.createDataFrame([("x",)], "t string").repartition(2).select(answer_key("t")).explain()
    plan = capsys.readouterr().out
    assert "lambdafunction" not in plan and "Python" not in plan


def test_constants_of_both():
    java = files("rollscore.functions").joinpath("AnswerKey.java").read_text("utf-8")
    found = dict(re.findall(r"\b([A-Z_]+) = (\d+)L?\b", java))
    assert {k: int(found[k]) for k in ("P", "Q", "SMALL", "LEAST_SQUARE", "MOST_CHARS")} == {"P": P, "Q": Q, "SMALL": SMALL, "LEAST_SQUARE": LEAST_SQUARE, "MOST_CHARS": MOST_CHARS}
    for pattern, _, signs in SPELLINGS:
        for sign in signs.split(" "):
            assert sign in pattern.replace("\\\\", "\\").replace("\\[", "[") or f"\\x{{{ord(sign):x}}}" in pattern


def last_box(text):
    """Content of the box that closes last."""
    depth, boxes, found = 0, [], None
    for t in re.finditer(r"\\boxed\{|[{}]", text):
        if t.group() != "}":
            depth += 1
            boxes += [(t.end(), depth)] if t.group() != "{" else []
        else:
            if boxes and boxes[-1][1] == depth:
                found = text[boxes.pop()[0] : t.start()]
            depth = max(depth - 1, 0)
    return found


def test_boxes_against_a_scan(values):
    rng = random.Random(3)
    pieces = [r"\boxed{", r"\boxed{", "{", "}", "}", "a", r"\frac{1}{2}", "\\", "\n", "é", r"\boxed", "{{{{{x}}}}}", "{{{x}}}"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(3000)] + [r"\boxed{" + "{}" * 20000 + "}"]
    # Braces that close before the first box are not looked at.
    assert values(texts, boxed_answer("content")) == [last_box(t[max(t.find(r"\boxed{"), 0) :]) for t in texts]


@pytest.mark.parametrize(
    "text, want",
    [("--3", 3.0), ("--3/4", 0.75), (r"-\frac{3}{4}", -0.75), (r"-\frac{-3}{4}", 0.75), (r"\frac{.5}{2}", 0.25), ("7%", 0.07), (r"7\%", 0.07), ("3/4%", None), ("1/0", None), ("3/", None), (r"\frac{3}{4}x", None), ("%", None), (r"2\frac{3}{4}", None), ("frac", None), (None, None)],
)
def test_numbers(values, text, want):
    assert values([text], numeric_value("content")) == [want]


@pytest.mark.parametrize("forms", [I.ALGEBRA_FORMS, I.STRUCTURED_FORMS])
def test_pairs_have_the_texts_of_their_form(spark, tmp_path, forms):
    rows = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double"
    keys = [None, *range(30), *range(30)]
    spark.createDataFrame([(k, 1 + i % 7, 3 * i, None if i == 5 else i, 1.0 + i) for i, k in enumerate(keys)], rows).write.parquet(f"{tmp_path}/lineitem.parquet")
    pairs = I.answer_pairs(spark, str(tmp_path), forms)
    base = spark.read.parquet(f"{tmp_path}/lineitem.parquet").selectExpr(
        "l_orderkey * 8 + l_linenumber as row_id", "l_partkey % 59 + 2 as a", "l_suppkey % 47 + 3 as b", "cast(l_quantity as bigint) % 45 + 2 as c", "if(l_linenumber % 3 = 0, 1, 0) as d"
    )
    form = (F.col("row_id") % len(forms)).cast("int")
    gold, answer = (F.element_at(F.array(*[F.expr(f[i]) for f in forms]), form + 1) for i in (0, 1))
    want = base.select("row_id", form.alias("form"), gold.alias("solution"), F.concat(F.lit("So it is \\boxed{"), answer, F.lit("}")).alias("content"))
    assert sorted(map(str, pairs.collect())) == sorted(map(str, want.collect()))
    assert pairs.schema == want.schema


def test_function_is_the_one_for_java(spark):
    """Two of Spark's functions of this name take it, and a call without types may find either."""
    found = compiled_key(spark.sparkContext.applicationId)
    assert "UDF1" in files("rollscore.functions").joinpath("AnswerKey.java").read_text("utf-8")
    assert "ToScalaUDF" in found.toString()
