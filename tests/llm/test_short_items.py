"""Benchmark items with fewer words than a shingle, inside longer texts."""

from __future__ import annotations

import random

from rollscore.llm.contamination import find_leaks


def test_short_items_inside_texts(spark):
    rng = random.Random(7)
    word = lambda: rng.choice("ant bee cat dog elk fox gnu hen".split())
    docs = [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    docs += ["He asked: who wrote Hamlet, exactly? Nobody knew.", "Who wrote Hamlet exactly", "Who wrote Hamlet", "", None]
    short = ["Who wrote Hamlet exactly", "ant bee cat", "Elk, fox", "gnu", "gnu gnu gnu gnu", "zebra", None, ""]
    items = [*short, "who wrote hamlet exactly nobody knew", " ".join(docs[3].split()[:12])]
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    plain = lambda t: " " + " ".join(w.strip(".,:?").lower() for w in (t or "").split()) + " "
    want = {i: {k for k, x in enumerate(short) if x and plain(x) in plain(d)} for i, d in enumerate(docs)}
    for chosen in (table, table.where("item_id < 8")):
        got = {r.doc_id: {k for k in r.leaked_items if k < 8} for r in find_leaks(df, chosen).collect()}
        assert got == want and len(want[200]) == 1 and want[202] == set()
    assert 9 in {r.doc_id: r.leaked_items for r in find_leaks(df, table).collect()}[3] or len(docs[3].split()) < 12
