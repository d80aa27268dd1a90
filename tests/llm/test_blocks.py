"""What travels beside each rare word, and how a block is spelled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rollscore.llm import pieces
from rollscore.llm.pieces import BITS, Speller, Vocabulary, blocks_of, encode, rare_words, spelled_words

PIECES = [("a", 1, 0.0), ("ab", 2, -1.0), ("abc", 3, -2.0), ("bc", 4, -3.0), ("b", 5, -4.0), ("c", 6, -5.0), ("▁", 7, -6.0)]


def test_blocks_have_short_names_of_their_own(spark):
    docs = spark.range(400, numPartitions=4).select("id", F.lit("ab abc").alias("text"))
    made = blocks_of(docs.union(docs.where("id < 8")), Vocabulary(PIECES, None, 0))
    assert made.schema["block"].dataType.simpleString() == "bigint"
    names = [r.block for r in made.select("block").collect()]
    assert len(names) > 4 and len(set(names)) == len(names)
    none = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert rare_words(made, none).schema["block"].dataType.simpleString() == "bigint"


def test_small_parts_give_the_same_ids(spark, monkeypatch):
    """Words short and long, frequent and not, are spelled as each one alone, however they are dealt over the steps."""
    vocabulary = Vocabulary(PIECES, None, 0)
    words = ["ab", "abc", "▁ab", "c" * (BITS - 1), "abc" * BITS, "x", "", "bc"]
    speller = Speller(vocabulary)
    cuts = np.array([0b101, 0b1001, 0, (1 << BITS) - 1, 0, 0, 0, 0b101], np.int64)
    long = {4: [(1 << BITS) - 1] * 3 + [1]}
    want = [speller.spell(w, long.get(i, int(c) or None)) for i, (w, c) in enumerate(zip(words, cuts, strict=True))]
    for step in (1, 3, 100):
        monkeypatch.setattr(pieces, "SPELLED", step)
        flat, sizes = spelled_words(words, cuts, long, speller)
        assert flat.tolist() == [x for ids in want for x in ids] and sizes.tolist() == [len(x) for x in want]
    texts = ["ab abc " * n + "abc" * (30 * n) for n in range(6)] + [None, "", "x\x00y"]
    docs = spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string").repartition(4)
    some, every = ({r.doc_id: r.ids for r in encode(docs, vocabulary, frequent=n).collect()} for n in (0, 1000))
    assert some == every and len(every) == 27 and all(every[i] == every[i + 9] for i in range(9))
