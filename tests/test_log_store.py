"""The log store: what a rescan opens, changed, copied and deleted logs, and a crash between its two commits."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest

from rollscore.session import fresh_path
from rollscore.sources import log_store
from rollscore.sources.eval_logs import scan_eval_logs
from rollscore.sources.log_store import Refresh, refresh_logs, scan_stored_logs


def put(root, name, score, indent=2):
    record = {"config_general": {"model_name": "m"}, "results": {"custom|aime24|0": {"extractive_match": score}}}
    path = Path(root, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(record, indent=indent))
    return path


def run_file(exp, step, second=0, suite="evals"):
    return f"{suite}/Exp{exp}_{step}/results_2025-03-14T23-12-{second:02d}.5.json"


def rows(df):
    return sorted(repr(r) for r in df.select("suite", "exp", "step", "run_ts", "source_path", "config_general", "results").collect())


@pytest.fixture
def place(spark):
    return fresh_path(spark, "raw-logs"), fresh_path(spark, "store")


def same_as_a_full_scan(spark, root, store):
    assert rows(scan_stored_logs(spark, store)) == rows(scan_eval_logs(spark, root))


def test_rescan_opens_only_what_is_new(spark, place):
    root, store = place
    for i in range(4):
        put(root, run_file(1, 50 * (i + 1), i), i / 10)
    assert refresh_logs(spark, root, store) == Refresh(4, 4, 0, 4)
    same_as_a_full_scan(spark, root, store)
    put(root, run_file(2, 50), 0.9)
    assert refresh_logs(spark, root, store) == Refresh(5, 1, 0, 1)
    same_as_a_full_scan(spark, root, store)
    assert refresh_logs(spark, root, store) == Refresh(5, 0, 0, 0)


def test_changed_touched_copied_and_deleted_logs(spark, place):
    root, store = place
    a, b, c = (put(root, run_file(1, 50 * i), i / 10) for i in (1, 2, 3))
    refresh_logs(spark, root, store)
    put(root, run_file(1, 50), 0.75)
    os.utime(b, (1, 1))
    put(root, run_file(3, 500, 7), 0.3)
    c.unlink()
    # The touched log and the copy are opened, but what they hold is known; that of the deleted one is the copy's.
    assert refresh_logs(spark, root, store) == Refresh(3, 3, 1, 1)
    same_as_a_full_scan(spark, root, store)


def test_odd_names_and_contents(spark, place):
    root, store = place
    put(root, "evals/Exp1_50/with space [1]{2}/results_2025-03-14T23-12-00.5.json", 0.5)
    put(root, "evals/Exp1_100/results_odd%20name.json", 0.25)
    put(root, "evals/Exp1_150/results_none.json", None)
    Path(root, "evals/notes.txt").write_text("no log")
    Path(root, "evals/Exp1_50/results_blank.json").write_text(" \n")
    assert refresh_logs(spark, root, store) == Refresh(4, 4, 0, 3)
    assert refresh_logs(spark, root, store) == Refresh(4, 0, 0, 0)
    assert scan_stored_logs(spark, store).count() == 3
    same_as_a_full_scan(spark, root, store)


def test_compacted_files(spark, place):
    root, store = place
    lines = [json.dumps({"source_path": run_file(1, 50 * i), "results": {"custom|a|0": {"extractive_match": i / 8}}}) for i in (1, 2, 3)]
    Path(root).mkdir(parents=True)
    Path(root, "one.json").write_text("\n".join([*lines, lines[0], ""]))
    Path(root, "two.json").write_text("\n".join([lines[2], lines[0], lines[1], lines[0]]))
    Path(root, "three.json").write_text(lines[2] + "\n" + lines[2])
    # The second file holds the first one's records in another order; the third one a record twice.
    assert refresh_logs(spark, root, store, compacted=True) == Refresh(3, 3, 0, 2)
    assert rows(scan_stored_logs(spark, store)) == rows(scan_eval_logs(spark, root, compacted=True))


def test_crash_between_the_commits_leaves_the_old_state(spark, place, monkeypatch):
    root, store = place
    put(root, run_file(1, 50), 0.5)
    refresh_logs(spark, root, store)
    old = rows(scan_stored_logs(spark, store))
    put(root, run_file(1, 100), 0.6)

    def fails_for_the_listing(df, path, *args, **options):
        if path.endswith("/files"):
            raise RuntimeError("lost")
        return commit(df, path, *args, **options)

    commit = log_store.commit
    monkeypatch.setattr(log_store, "commit", fails_for_the_listing)
    with pytest.raises(RuntimeError, match="lost"):
        refresh_logs(spark, root, store)
    assert rows(scan_stored_logs(spark, store)) == old
    monkeypatch.undo()
    assert refresh_logs(spark, root, store) == Refresh(2, 1, 0, 0)
    same_as_a_full_scan(spark, root, store)
