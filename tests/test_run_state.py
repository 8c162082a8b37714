"""Recurring runs that remember what they processed."""

from datetime import datetime
from decimal import Decimal as D

import pytest

from recogna.operators import run_state
from recogna.operators.run_state import RunState

LINES = "line_id string, rc_id long, value decimal(18,2), updated_at timestamp"
OLD, NEW = datetime(2024, 1, 1, 9), datetime(2024, 2, 5, 9)


def due(state, spark, *rows):
    return {r["line_id"]: r["reason"] for r in state.due(spark.createDataFrame(list(rows), LINES)).collect()}


def run(state, spark, at, *rows, status="C"):
    todo = state.due(spark.createDataFrame(list(rows), LINES)).cache()
    out = {r["line_id"]: r["reason"] for r in todo.collect()}
    state.advance(todo, at, status)
    return out


def test_second_run_finds_nothing_and_a_moved_contract_comes_back(spark, tmp_path):
    state = RunState(spark, str(tmp_path), "P")
    rows = [("a", 1, D(10), OLD), ("b", 1, D(0), OLD), ("c", 1, None, OLD), ("d", 1, D(-999), OLD)]
    assert run(state, spark, datetime(2024, 2, 1), *rows) == {"a": "CHANGED", "b": "CHANGED"}
    assert run(state, spark, datetime(2024, 2, 2), *rows) == {}
    moved = [("a", 2, D(10), NEW), ("b", 0, D(0), NEW), ("c", 2, None, NEW), ("d", 2, D(5), NEW)]
    assert run(state, spark, datetime(2024, 2, 6), *moved) == {"a": "MOVED", "d": "CHANGED"}
    assert run(state, spark, datetime(2024, 2, 7), *moved) == {}
    assert due(state, spark, ("a", 3, D(10), OLD)) == {}  # not changed since the last run was requested
    assert due(state, spark, ("a", 2, None, OLD)) == {"a": "CHANGED"}


def test_the_day_of_the_request_counts(spark, tmp_path):
    state = RunState(spark, str(tmp_path), "P")
    run(state, spark, datetime(2024, 2, 5, 23), ("a", 1, D(10), OLD))
    assert due(state, spark, ("a", 2, D(10), NEW)) == {"a": "MOVED"}


def test_failed_runs_leave_no_trace(spark, tmp_path):
    state = RunState(spark, str(tmp_path), "P")
    assert run(state, spark, OLD, ("a", 1, D(10), OLD), status="E") == {"a": "CHANGED"}
    assert state.mark().first()["mark"] is None
    # values without a log row: the job ended between the two writes
    state._put(state.due(spark.createDataFrame([("a", 1, D(10), OLD)], LINES)).drop("reason", "updated_at"), "values", 2)
    assert run(state, spark, OLD, ("a", 1, D(11), OLD)) == {"a": "CHANGED"}
    assert due(state, spark, ("a", 1, D(11), OLD)) == {}


@pytest.mark.parametrize("after", [1, 2, 16])
def test_merging_changes_nothing(spark, tmp_path, monkeypatch, after):
    monkeypatch.setattr(run_state, "MERGE_AFTER", after)
    state = RunState(spark, str(tmp_path), "P")
    for i in range(5):
        rows = [("a", 1, D(i), OLD), ("b", 1, D(7), OLD), (f"n{i}", 1, D(1), OLD)]
        assert run(state, spark, OLD, *rows) == {"a": "CHANGED", f"n{i}": "CHANGED", **({"b": "CHANGED"} if i == 0 else {})}
    now = {r["line_id"]: r["value"] for r in state.processed().collect()}
    assert now == {"a": 4, "b": 7, **{f"n{i}": 1 for i in range(5)}}
