"""The external step with a ledger and timeouts: killed runs, repeated requests, failures."""

from __future__ import annotations

import os
import tempfile
import time

import pytest

from rollscore.operators.mapping import external_step, resumable_step, waves
from rollscore.plans.jobs import generate
from rollscore.session import fresh_path


def recorder(log, dies_after=None, poison=None):
    """A client that writes down what it is asked; once so many prompts are written, its worker is gone."""

    def make_client():
        def client(prompts):
            if dies_after is not None:
                with open(log) as f:
                    if len(f.readlines()) >= dies_after:
                        os._exit(1)
            with open(log, "a") as f:
                f.writelines(f"{p}\n" for p in prompts)
            if poison is not None and poison in prompts:
                raise RuntimeError("no")
            return [p.upper() if p is not None else "NULL" for p in prompts]

        return client

    return make_client


@pytest.fixture
def log():
    return tempfile.mkstemp()[1]


def asked(log):
    with open(log) as f:
        return sorted(f.read().split("\n")[:-1])


def requests(spark, n):
    return spark.createDataFrame([(i, f"p{i}") for i in range(n)], "id long, instruction string")


def test_a_killed_run_asks_only_for_the_rest(spark, log):
    df, ledger = requests(spark, 400), fresh_path(spark, "ledger")
    with pytest.raises(Exception, match="(?i)worker|exit|crash"):
        resumable_step(df, recorder(log, dies_after=250), ledger, replicas=2, batch_rows=5, wave_rows=50).count()
    first = asked(log)
    assert 250 <= len(first) < 400
    again = recorder(log)
    out = resumable_step(df, again, ledger, replicas=2, batch_rows=5, wave_rows=50).collect()
    assert {r.text for r in out} == {f"P{i}" for i in range(400)} and len(out) == 400
    every = asked(log)
    # Two waves of 100 rows were done; what the dead tasks of the third had asked is asked again.
    assert set(every) == {f"p{i}" for i in range(400)} and len(every) - 400 <= len(first) - 200 < 100
    resumable_step(df, again, ledger, replicas=2).count()
    assert asked(log) == every


def test_finished_tasks_of_an_unfinished_wave_count(spark, log):
    """One partition's worker dies; what the others have answered is in the ledger."""
    df, ledger = requests(spark, 200), fresh_path(spark, "ledger")
    record = recorder(log)

    def make_client():
        def client(prompts):
            if "p7" in prompts:
                time.sleep(5)
                os._exit(1)
            return record()(prompts)

        return client

    with pytest.raises(Exception, match="(?i)worker|exit|crash"):
        resumable_step(df, make_client, ledger, replicas=8, batch_rows=100).count()
    before = asked(log)
    assert len(before) > 100
    resumable_step(df, recorder(log), ledger, replicas=8).count()
    assert len(asked(log)) == 200 and len(set(asked(log))) == 200


def test_failures_are_asked_again_and_answers_are_not(spark, log):
    df, ledger = requests(spark, 10), fresh_path(spark, "ledger")
    out = resumable_step(df, recorder(log, poison="p3"), ledger, replicas=1, batch_rows=1).collect()
    assert [r.id for r in out if r.error] == [3] and [r.id for r in out if r.text is None] == [3]
    out = resumable_step(df, recorder(log), ledger, replicas=1, batch_rows=1).collect()
    assert not any(r.error for r in out) and asked(log).count("p3") == 2 and len(asked(log)) == 11


def test_repeated_null_and_clashing_requests(spark, log):
    rows = [(1, "a", "x"), (1, "a", "y"), (2, "a", None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "id long, instruction string, text string")
    ledger = fresh_path(spark, "ledger")
    out = resumable_step(df, recorder(log), ledger).collect()
    assert sorted((str(r.id), r.text) for r in out) == [("1", "A"), ("1", "A"), ("2", "A"), ("None", "NULL"), ("None", "NULL")]
    assert asked(log) == ["None", "a", "a"]
    assert resumable_step(df.where("id < 0"), recorder(log), ledger).count() == 0
    assert resumable_step(df.where("id < 0"), recorder(log), fresh_path(spark, "new")).count() == 0


def test_a_hanging_call_times_out_and_gets_a_new_client(spark):
    def make_client():
        def client(prompts):
            if "p3" in prompts and not os.path.exists(flag):
                open(flag, "w").close()
                time.sleep(60)
            if "p5" in prompts:
                time.sleep(60)
            return [p.upper() for p in prompts]

        return client

    flag = tempfile.mkdtemp() + "/hung"
    start = time.time()
    out = external_step(requests(spark, 8), make_client, replicas=1, batch_rows=1, retries=1, pause=0.0, timeout=1.0).collect()
    assert time.time() - start < 30
    assert [r.id for r in out if r.error] == [5] and "TimeoutError" in next(r.error for r in out if r.error)
    assert sorted(r.text for r in out if r.text) == [f"P{i}" for i in range(8) if i != 5]


def test_generation_resumes(spark, log):
    prompts = spark.createDataFrame([(i, f"q{i}") for i in range(6)], "id long, problem string")
    ledger = fresh_path(spark, "ledger")
    for _ in range(2):
        out = generate(prompts, "id", "problem", recorder(log), generations=2, replicas=2, ledger=ledger).collect()
        assert sorted((r.id, list(r.generations)) for r in out) == [(i, [f"Q{i}"] * 2) for i in range(6)]
    assert len(asked(log)) == 12


def test_waves():
    assert waves({}, 5) == [] and waves({0: 3, 1: 3, 2: 9, 5: 1}, 5) == [[0, 1], [2], [5]]
