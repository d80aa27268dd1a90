"""Answers that are equal as mathematics, against planted pairs and exact rational arithmetic."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rollscore.functions.algebra import LEAST_SQUARE, P, Q, answer_key
from rollscore.functions.answers import normalize_answer, with_grading, with_multi_gold

EQUAL = [
    ("1/2+x", "(2x+1)/2"),
    (r"\frac{1}{2}+x", r"\dfrac{2x+1}{2}"),
    ("x^2-1", r"(x-1)\cdot(x+1)"),
    (r"\sqrt{8}", r"2\sqrt2"),
    (r"\frac{\sqrt2}{2}", r"\frac{1}{\sqrt{2}}"),
    (r"\sqrt{10082}", r"71\sqrt{2}"),
    (r"\sqrt{5041}", "71"),
    (r"\sqrt[3]{-16}", r"-2\sqrt[3]{2}"),
    ("8^{2/3}", "4"),
    ("x^{1/2}", r"\sqrt{x}"),
    (r"(\sqrt{x})^2", "x"),
    (r"\sqrt{x^2y}", r"x\sqrt{y}"),
    ("2^{x+1}", r"2\cdot 2^x"),
    ("x^{y+1}/x", "x^y"),
    (r"1\frac{1}{2}", r"\frac32"),
    (r"50\%", r"\frac{1}{2}"),
    (r"90^\circ", "90"),
    (r"\pi r^2", r"r^2 \pi"),
    ("x-x", "0"),
    ("-(-3)", "3"),
    ("2^{-1}", "0.5"),
    ("10^{10}", "10000000000"),
    ("x=5", "5"),
    ("{2,1}", r"\{1,2\}"),
    (r"\{1,2,2\}", "2, 1"),
    (r"\{(1,2),(3,4)\}", r"\{(3,4),(1,\frac{4}{2})\}"),
    (r"\{5\}", "5"),
    ("(1,2)", r"\left(1,\frac{4}{2}\right)"),
    (r"(-\infty,3)\cup[4,\infty)", r"[4,+\infty)\cup(-\infty,3)"),
    (r"\begin{pmatrix}1&2\\3&4\end{pmatrix}", r"\begin{bmatrix} 1 & 2 \\ 3 & \frac{8}{2} \end{bmatrix}"),
    ("((1", "((1"),
    ("1/0", "1/0"),
    ("no answer", "no answer"),
]
DIFFERENT = [
    ("(1,2]", "[1,2]"),
    ("(1,2)", "(2,1)"),
    (r"\{1,2\}", r"\{1,3\}"),
    (r"\begin{pmatrix}1&2\\3&4\end{pmatrix}", r"\begin{pmatrix}1&3\\2&4\end{pmatrix}"),
    (r"\begin{pmatrix}1&2\\3&4\end{pmatrix}", r"\begin{vmatrix}1&2\\3&4\end{vmatrix}"),
    (r"\begin{pmatrix}1&2&3&4\end{pmatrix}", r"\begin{pmatrix}1&2\\3&4\end{pmatrix}"),
    ("-x^2", "(-x)^2"),
    (r"\sqrt{4}", "-2"),
    (r"\sqrt{5041}", "-71"),
    (r"\sqrt{x^2}", "-x"),
    ("east", "seat"),
    ("2x+3y=6", "y=2"),
    ("x", "y"),
    ("1/0", "2/0"),
    ("", "0"),
]


def keys(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    found = df.select("i", answer_key(normalize_answer("t"))["key"].alias("key"))
    return [r.key for r in sorted(found.collect(), key=lambda r: r.i)]


def test_prime():
    assert 2 * Q + 1 == P and pow(2, P - 1, P) == pow(3, Q - 1, Q) == 1
    small = [n for n in range(2, LEAST_SQUARE) if all(n % d for d in range(2, n))]
    assert all(pow(n, Q, P) == 1 for n in small)


def test_planted_pairs(spark):
    found = keys(spark, [t for pair in EQUAL + DIFFERENT for t in pair])
    same = [a is not None and a == b for a, b in zip(found[::2], found[1::2], strict=True)]
    assert [p for p, s in zip(EQUAL + DIFFERENT, same, strict=True) if s != (p in EQUAL)] == []


def tree(rng, depth):
    if depth == 0 or rng.random() < 0.15:
        return rng.choice(["x", "y", str(rng.randrange(1, 9)), str(rng.randrange(1, 9))])
    op = rng.choice("++--**/^")
    if op == "^":
        return (op, tree(rng, depth - 1), str(rng.randrange(0, 4)))
    return (op, tree(rng, depth - 1), tree(rng, depth - 1))


def value(t, at):
    if isinstance(t, str):
        return at.get(t) or Fraction(t)
    a, b = value(t[1], at), value(t[2], at)
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b, "^": lambda: a ** int(b)}[t[0]]()


def written(t, rng):
    """One of many ways to write it."""
    if isinstance(t, str):
        return rng.choice([t, t, f"({t})", f"{{{t}}}" if rng.random() < 0.2 else t])
    a, b = written(t[1], rng), written(t[2], rng)
    wrapped = lambda s: f"({s})"
    if t[0] == "/":
        return rng.choice([rf"\frac{{{a}}}{{{b}}}", f"({a})/({b})", rf"({a})\div({b})"])
    if t[0] == "^":
        return f"({a})^{{{b}}}"
    if t[0] == "*":
        return rng.choice([f"({a})({b})", rf"({a})\cdot({b})", rf"({a})\times ({b})"])
    return f"{a}{t[0]}{wrapped(b) if t[0] == '-' else b}"


def rearranged(t, rng):
    """An equal expression, or by chance one that is not."""
    if isinstance(t, str):
        return t if rng.random() < 0.97 else "3"
    a, b = rearranged(t[1], rng), rearranged(t[2], rng)
    if t[0] in "+*" and rng.random() < 0.5:
        a, b = b, a
    if t[0] == "-" and rng.random() < 0.3:
        return ("+", a, ("*", ("-", "1", "2"), b))
    if t[0] == "/" and rng.random() < 0.3:
        return ("*", a, ("/", "1", b))
    if t[0] == "*" and not isinstance(a, str) and a[0] == "+":
        return ("+", ("*", a[1], b), ("*", a[2], b))
    return (t[0], a, b)


def test_against_exact_arithmetic(spark):
    rng = random.Random(11)
    points = [{"x": Fraction(rng.randrange(2, 10**6), 7), "y": Fraction(rng.randrange(2, 10**6), 11)} for _ in range(3)]
    texts, want = [], []
    while len(want) < 600:
        a = tree(rng, rng.randrange(1, 5))
        b = rearranged(a, rng) if rng.random() < 0.8 else tree(rng, 2)
        try:
            equal = all(value(a, p) == value(b, p) for p in points)
        except ZeroDivisionError:
            continue
        texts += [written(a, rng), written(b, rng)]
        want.append(equal)
    found = keys(spark, texts)
    assert not any("text:" in k for k in found)
    wrong = [(texts[2 * i], texts[2 * i + 1], w) for i, w in enumerate(want) if (found[2 * i] == found[2 * i + 1]) != w]
    assert wrong == [] and 100 < sum(want) < 580


ODD = [None, "", " ", "{", "}", "\\", "\\frac", r"\frac{1}", "^", "-", ",", "()", "(,)", "[", "1" * 30, "1." + "0" * 40, "x" * 5000, "(" * 2000, "1+" * 3000, "é,ü", "a,b,", r"\cup", r"\begin{pmatrix}\end{pmatrix}"]


def test_odd_texts_equal_themselves_only(spark):
    found = keys(spark, ODD)
    assert found[0] is None and found[1] is None and found[2] is None
    given = [k for k in found if k is not None]
    assert len(set(given)) == len(given)


def test_grading_uses_keys_and_no_python(spark, capsys):
    rows = [(r"\boxed{(2x+1)/2}", "1/2+x", True), (r"\boxed{1.41421}", r"\sqrt{2}", True), (r"\boxed{3}", "4", False), (r"\boxed{x}", None, False), ("none", "x", False)]
    df = spark.createDataFrame(rows, "content string, solution string, want boolean")
    graded = with_grading(df)
    assert all(r.is_correct == r.want for r in graded.collect())
    assert sum(r.is_correct for r in with_grading(df, equivalence=False).collect()) == 0
    graded.explain()
    assert "Python" not in capsys.readouterr().out
    golds = df.withColumn("golds", F.array(F.lit("7"), "solution", F.lit(None).cast("string")))
    assert [r.score == 1.0 for r in with_multi_gold(golds, "content", "golds").collect()] == [w for *_, w in rows]


@pytest.mark.parametrize("text", ["a\x01b,c", "(1\x022,3)"])
def test_marks_in_answers(spark, text):
    assert keys(spark, [text, text])[0] is not None
