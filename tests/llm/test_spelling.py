"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.llm.queries import QUERIES
from rollscore.llm.spelling import ALPHABET, edits, filters, group_variants, near_words

ALL = "".join(map(chr, ALPHABET))


def near(a, b):
    """Whether one inserted, deleted or replaced letter parts two different words."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_version(rows, least_size=6, least_count=5, times=5, damage=199):
    count = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= least_size
    words = {w: n for w, n in count.items() if n >= least_count}
    found = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(found[w]), words.get(form[w])))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.choice([5, 6, 6, 7, 8]))) for _ in range(250)] + ["aaaaaa", "aaaaaaa", "Ünïçödé", "÷×÷×÷×", "x" * 300]
    weights = [rng.paretovariate(0.7) for _ in words]
    rows = [(i, " ".join(rng.choices(words, weights, k=80)) + rng.choice([".", "_", "4bbbbbb", "ſbbbbbb", " BBBBBB"])) for i in range(200)]
    rows += [(300 + i, " ".join(["chainaa"] * 60 + ["chainab"] * 8 + ["chainbb"])) for i in range(9)]
    rows += [(400 + i, "y" * 30_000 + " " + "y" * 29_999) for i in range(6)]
    return rows + rows[:20] + [(None, rows[3][1]), (1, None), (2, ""), (3, "😀bbbbbbb\x00aaaaaa"), (4, "word" * 50_000)]


@pytest.mark.parametrize(("damage", "most_bits"), [(199, 1 << 28), (7, 64), (None, 1 << 28)])
def test_equals_all_pairs(spark, damage, most_bits):
    rows = corpus(5)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)
    got = group_variants(df, damage=damage, most_bits=most_bits).collect()
    want = plain_version(rows, damage=damage)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r.form is not None for r in got) > 10
    assert any(r.root != r.form for r in got if r.form)


def test_whole_query_on_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r) for r in QUERIES["op11_spelling"](spark, sf_dir).collect()} == plain_version(rows)


def test_every_edit_passes_the_filters(spark):
    rng = random.Random(2)
    words = list({"".join(rng.choices(ALL, k=rng.choice([6, 7]))) for _ in range(300)})
    words += [w[:2] + rng.choice(ALL) + w[3:] for w in words] + [w[:-1] for w in words if len(w) == 7]
    vocabulary = spark.createDataFrame([(w, 1) for w in set(words)], "word string, n long")
    got = {(r.a, r.b) for r in near_words(vocabulary).collect()}
    every = sorted(set(words))
    want = {frozenset((a, b)) for i, a in enumerate(every) for b in every[:i] if near(a, b)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_filters_keep_out_most_edits(spark):
    rng = random.Random(3)
    words = list({"".join(rng.choices("abcdefgh", k=8)) for _ in range(2000)})
    shards, bits = filters(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    letters = np.array([[ord(c) for c in w] for w in words], np.uint32)
    passed = [v for _, found in edits(letters, shards, bits) for v in found]
    false = sum(v not in set(words) for v in passed)
    assert false < 0.02 * len(words) * 8 * len(ALPHABET) / 2


@pytest.mark.parametrize("texts", [[], [None, ""], ["short"] * 9, ["lonelyword " * 5]])
def test_small_tables(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in group_variants(df, damage=None).collect()]
    assert got == ([("lonelyword", None, "lonelyword", 5, 0, None)] if texts and texts[0] and "lonely" in texts[0] else [])
    assert df.select(F.count("*")).first()[0] == len(texts)
