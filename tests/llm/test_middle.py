"""Fill-in-middle against a plain version, and the skip list against prefix sums."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.llm.middle import SkipList, fill_in_middle, heights, restored

ODD = [None, "", " ", "x", "word", "a <P> b", "<S>", "tail <M", "<", "Ünï cödé\x00 ▁ 😀 end", "é" * 50, "a" * 70, "word, " * 3000, "x1" * 150_000]


def plain_version(number, text, seed=1):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"{seed}:{'' if number is None else number}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    return len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_skip_list_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    at = np.concatenate([[0], np.cumsum(widths)])
    units = SkipList(at, heights(n))
    assert len(units.lanes) > 1 or n < 17
    assert [units.reach(r) for r in range(n + 1)] == at.tolist()


def test_equals_plain_version(spark):
    rows = [(i + 97 * k, t, "clash", "y") for k in range(12) for i, t in enumerate(ODD)] + [(None, t, "z", "y") for t in ODD]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, `_row` string").repartition(4)
    out = fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "_row", "n_units", "form", "prefix_chars", "middle_chars", "fim_text"]
    got = out.select("*", restored("fim_text", "form").alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[3:8] == plain_version(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(df).count() == 0


def test_seed_changes_cuts(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a, b = (fill_in_middle(df, seed=s).agg(F.sum("prefix_chars")).first()[0] for s in (1, 2))
    assert a != b
