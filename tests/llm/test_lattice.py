"""The lattice looks substrings up where the word is: no row for each of them, and nothing gathered by word."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rollscore.llm.pieces import Vocabulary, cut, lattice

PIECES = [("a", 1, 0.0), ("ab", 2, -1.0), ("abc", 3, -2.0), ("bc", 4, -3.0), ("cab", 5, -4.0), ("abcab", 6, -5.0)]


def test_edges(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcd", k=rng.randrange(1, 9))) for _ in range(200)] + ["a", "ab", "abc" * 3000, "d"]
    words = spark.createDataFrame([(w, 2) for w in dict.fromkeys(texts)], "word string, blocks long")
    for kind, least in (("bpe", 2), ("unigram", 1)):
        got = {r.word: [tuple(e) for e in r.edges] for r in lattice(words, Vocabulary(PIECES, None, 0, kind)).collect()}
        for w in dict.fromkeys(texts):
            want = [(-s, len(p), i) for p, _, s in PIECES if len(p) >= least for i in range(len(w)) if w.startswith(p, i)]
            assert got.get(w, []) == sorted(want)


def test_no_row_for_a_substring(spark, capsys):
    words = spark.range(10).select(F.lit("abcab").alias("word"), F.col("id").alias("blocks"))
    cut(words, Vocabulary(PIECES, None, 0)).explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "Aggregate" not in plan and "Exchange" not in plan
