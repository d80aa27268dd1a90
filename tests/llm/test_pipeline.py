"""The pipeline's stages on odd rows, planted copies, leaks and personal data, and on an empty table."""

from __future__ import annotations

import os
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from corpus_pipeline import PIECE_MODEL, STAGES


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """What each stage returns, over the small table with odd rows and clashing columns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    english = docs.where("lang = 'en' and n_chars between 400 and 900").orderBy("doc_id").limit(2).collect()
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    base, other = english[0].text, english[1].text
    odd = [
        (10_001, None), (10_002, ""), (10_003, " \n"), (10_004, "1234 5678"), (None, None), (None, base), (None, base),
        (20_001, base + " and a few more"), (20_002, base + " and a few more"), (20_003, other + " " + item), (20_004, "Write to ann.lee@corp.example.com. " + other + " " + other[::-1]),
    ]
    extra = spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    whole = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(extra).selectExpr("*", "'c' as component_id", "1 as id", "'i' as items", "'b' as block")
    out, now = [("documents", whole)], whole
    for name, stage in STAGES:
        now = corpus_pipeline.written(stage(spark, now, sf_dir), name)
        out.append((name, now))
    return {name: (df.columns, df.collect()) for name, df in out}


def ids(results, name):
    return Counter(r.doc_id for r in results[name][1])


def test_columns_stay(results):
    names = [n for n, _ in STAGES]
    assert all(results[n][0] == results["documents"][0] for n in names[:-1])


def test_language_drops_texts_without_letters(results):
    kept = ids(results, "language")
    assert not any(i in kept for i in range(10_001, 10_005)) and kept[None] == 2


def test_language_keeps_every_document(spark):
    """A thousand documents are enough to learn from; the few of the small table are not."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.known_language(spark, docs, folder).count() == docs.count()


def test_one_document_of_each_group(results):
    before, after = ids(results, "language"), ids(results, "near_copies")
    assert 20_001 in before and 20_002 not in after and after[None] == before[None]
    assert all(n == 1 for i, n in after.items() if i is not None)


def test_leaks_go(results):
    before, after = ids(results, "near_copies"), ids(results, "benchmark_leaks")
    assert 20_003 in before and 20_003 not in after and set(after) <= set(before)


def test_personal_data_is_replaced(results):
    rows = {r.doc_id: r for r in results["personal_data"][1]}
    assert "ann.lee@corp" not in rows[20_004].text and "@" in rows[20_004].text
    assert all(r.n_chars == len(r.text) for r in rows.values()) and ids(results, "personal_data") == ids(results, "benchmark_leaks")


def test_ids_are_the_public_library_s(results):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r.doc_id: r.text for r in results["personal_data"][1] if r.doc_id is not None}
    rows = [r for r in results["token_ids"][1] if r.doc_id is not None]
    assert len(rows) == len(texts) and all(r.ids == model.encode(texts[r.doc_id]) for r in rows)


def test_empty_table(spark, sf_dir):
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
    assert os.path.exists(PIECE_MODEL)
