"""Committed tables: repeated runs, crashes between the steps, and writers that meet."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rollscore.session import fresh_path
from rollscore.sources import commits
from rollscore.sources.commits import CommitConflict, commit, commit_generations, commit_metrics, current_state, notes, read_committed, vacuum


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def units(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, load_unit int")


def test_two_runs_one_row(spark):
    path = fresh_path(spark, "metrics")
    docs = spark.range(10)
    for _ in range(2):
        commit_metrics(docs, path, "a", {"top": F.max("id")})
    commit_metrics(docs.where("id < 5"), path, "b", {"top": F.max("id")})
    assert rows(read_committed(spark, path)) == [(10, 9, "a"), (5, 4, "b")]


def test_rewriting_a_unit_keeps_the_others(spark):
    path = fresh_path(spark, "generations")
    assert commit_generations(units(spark, (1, 0), (2, 0), (3, 1), (4, None)), path) == 1
    assert notes(spark, path) == {"private": True}
    assert commit_generations(units(spark, (5, 1), (6, 2), (7, None), (7, None)), path, private=False) == 2
    assert rows(read_committed(spark, path)) == [(1, 0), (2, 0), (5, 1), (6, 2), (7, None), (7, None)]
    assert rows(read_committed(spark, path, 1)) == [(1, 0), (2, 0), (3, 1), (4, None)]
    assert notes(spark, path) == {"private": False}


@pytest.mark.parametrize("step", ["_manifest", "_publish"])
def test_a_crash_between_the_steps_leaves_the_old_state(spark, monkeypatch, step):
    path = fresh_path(spark, "crash")
    commit(units(spark, (1, 0), (2, 1)), path, ["load_unit"])

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(commits, step, dies)
        with pytest.raises(KeyboardInterrupt):
            commit(units(spark, (9, 1), (9, 2)), path, ["load_unit"])
    assert rows(read_committed(spark, path)) == [(1, 0), (2, 1)]
    commit(units(spark, (3, 1)), path, ["load_unit"])
    assert rows(read_committed(spark, path)) == [(1, 0), (3, 1)]


def test_writers_that_meet_lose_nothing(spark, monkeypatch):
    path = fresh_path(spark, "meet")
    commit(units(spark, (1, 0)), path, ["load_unit"])
    real, met = commits._publish, []

    def overtaken(*args):
        if not met:
            met.append(1)
            commit(units(spark, (2, 5)), path, ["load_unit"])
        return real(*args)

    monkeypatch.setattr(commits, "_publish", overtaken)
    assert commit(units(spark, (3, 6)), path, ["load_unit"]) == 3
    assert rows(read_committed(spark, path)) == [(1, 0), (2, 5), (3, 6)]
    with pytest.raises(CommitConflict):
        real(spark, path, 2, {})


def test_empty_and_strange_tables(spark):
    path = fresh_path(spark, "empty")
    with pytest.raises(FileNotFoundError):
        read_committed(spark, path)
    empty = spark.createDataFrame([], "id long, day date, `a b` string")
    commit(empty, path, ["day"])
    assert rows(read_committed(spark, path)) == []
    full = spark.sql("select 1L as id, date'2020-01-02' as day, 'x/y=z' as `a b` union all select null, null, ''")
    commit(full, path, ["day", "a b"][:1])
    assert rows(read_committed(spark, path)) == rows(full.select("id", "a b", "day"))
    assert current_state(spark, path)[0] == 2
    with pytest.raises(ValueError):
        commit(spark.range(3).withColumn("day", F.current_date()), path, ["day"])


def test_replaced_commits_are_not_read(spark):
    path = fresh_path(spark, "pruned")
    for k in (0, 1, 1):
        commit(spark.range(100).withColumn("load_unit", F.lit(k)), path, ["load_unit"])
    plan = read_committed(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [commit" in plan and len(set(re.findall(r"\b[0-9a-f]{32}\b", re.search(r"commit#\d+ IN \(([^)]*)\)", plan)[1]))) == 2


def test_vacuum_keeps_what_is_named(spark):
    path = fresh_path(spark, "vacuum")
    for k in (0, 1, 1, 1, 2):
        commit(units(spark, (k, k), (k + 10, k)), path, ["load_unit"], folders=False)
    before = rows(read_committed(spark, path))
    assert vacuum(spark, path, keep=10) == 0 and vacuum(spark, path, keep=1) == 2
    assert rows(read_committed(spark, path)) == before and len(before) == 6
    with pytest.raises(Exception, match="(?i)not.exist|not.found"):
        read_committed(spark, path, 2).collect()
    assert commit(units(spark, (7, 1)), path, ["load_unit"]) == 6
