"""Whole numbers have the key that evaluation gives them, and symbols keep their kinds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollscore.functions.algebra import answer_key, coded

WHOLE = ["0", "007", "5", "-5", "999999999", "-999999999", "-0", "1000000000"]


def test_whole_numbers(spark):
    rows = spark.createDataFrame([(n, f"{n}+0") for n in WHOLE], "plain string, summed string")
    for r in rows.select("plain", answer_key("plain").alias("a"), answer_key("summed").alias("b")).collect():
        assert r.a == r.b and r.a["value"] == float(r.plain), r.plain


@pytest.mark.parametrize(
    "text, want",
    [
        (r"+x-\alpha2", ["xx", "1-", "x\\alpha", "2*", "d2"]),
        (r"-.5\frac{a}{2}", ["3-", "d.5", "2*", "0F", "0{", "xa", "9{", "0{", "d2", "9{"]),
        (r"2\root3{x}(y)", ["d2", "2*", "0R3", "0{", "xx", "9{", "2*", "0(", "xy", "9("]),
        ("a*-b^2", ["xa", "2*", "3-", "xb", "4^", "d2"]),
    ],
)
def test_codes(spark, text, want):
    assert spark.range(1).select(coded(F.lit(text)).alias("c")).first().c == want
