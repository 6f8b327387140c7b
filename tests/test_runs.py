from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from strata.operators import runs as rn

KEY = ("s", "e")
LOG = "source string, entity string, run_id string, status string, at_ms bigint, params map<string,string>, extra string"


def log(spark, *events):
    rows = [(*KEY, e[0], e[1], e[2], None, e[3] if len(e) > 3 else None) for e in events]
    return spark.createDataFrame(rows, LOG)


def requests(spark, *ids):
    return spark.createDataFrame([(*KEY, i, {"d": "1"}) for i in ids], "source string, entity string, run_id string, params map<string,string>")


def test_latest_state(spark):
    events = log(
        spark,
        ("r1", "REQUESTED", 10), ("r1", "BRONZE_WRITTEN", 20, '{"k":1}'), ("r1", "SILVER_WRITTEN", 20),
        ("r2", "SILVER_WRITTEN", 30, "not json"), ("r2", "REQUESTED", 40), ("r3", "FAILED", 5, '{"error":"x"}'),
    )
    state = rn.latest_state(events).withColumn("extra", F.to_json(rn.decode_extra(F.col("extra"))))
    got = {r.run_id: (r.status, r.requested_at_ms, r.updated_at_ms, r.extra) for r in state.collect()}
    assert got == {
        "r1": ("SILVER_WRITTEN", 10, 20, '{"k":1}'),
        "r2": ("SILVER_WRITTEN", 40, 30, '{"_raw":"not json"}'),
        "r3": ("FAILED", None, 5, '{"error":"x"}'),
    }


def test_durations(spark):
    events = log(spark, ("r", "REQUESTED", 10), ("r", "BRONZE_WRITTEN", 25), ("r", "SILVER_WRITTEN", 75), ("q", "REQUESTED", 1))
    got = {r.run_id: (r.ingest_ms, r.transform_ms, r.total_ms) for r in rn.run_durations(events).collect()}
    assert got == {"r": (15, 50, 65), "q": (None, None, None)}


def test_transitions_against_brute_force(spark):
    """One run has a third of all events; slices are far smaller than a run."""
    rng = random.Random(3)
    events = []
    for i in range(900):
        run = "hot" if i % 3 == 0 else f"r{rng.randrange(5)}"
        events.append((run, rng.choice(rn.STATUSES), rng.randrange(20_000), i))
    df = spark.createDataFrame([(*KEY, *e) for e in events], "source string, entity string, run_id string, status string, at_ms bigint, n int")
    steps = rn.run_transitions(df.repartition(4), tie_break=["n"], slice_ms=500)
    got = {r.n: (r.from_status, r.to_status, r.legal) for r in steps.collect()}
    want = {}
    before = {}
    for run, status, _, n in sorted(events, key=lambda e: (e[0], e[2], rn.STATUSES.index(e[1]), e[3])):
        last = before.get(run)
        rank = rn.STATUSES.index(status)
        legal = status == "FAILED" or rank == (0 if last is None else rn.STATUSES.index(last) + 1)
        want[n] = (last, status, legal)
        before[run] = status
    assert got == want


def test_pending(spark):
    events = log(spark, ("a", "BRONZE_WRITTEN", 1), ("b", "SILVER_WRITTEN", 1), ("b", "REQUESTED", 2), ("c", "REQUESTED", 1))
    asked = requests(spark, "a", "b", "c", "d")
    assert sorted(r.run_id for r in rn.pending_runs(asked, events, "bronze").collect()) == ["c", "d"]
    assert sorted(r.run_id for r in rn.pending_runs(asked, events, "silver").collect()) == ["a", "c", "d"]


def test_log_events(spark):
    asked = requests(spark, "a")
    requested = rn.log_requested(asked, 5).first()
    assert (requested.status, requested.at_ms, requested.params) == ("REQUESTED", 5, {"d": "1"})
    failed = rn.log_failed(asked, 6, F.lit("why")).first()
    assert (failed.status, failed.extra) == ("FAILED", '{"error":"why"}')
    with pytest.raises(ValueError):
        rn.log_status(asked, "DONE", 1)


def test_reconcile_summary_and_backlog(spark):
    asked = requests(spark, "ok", "failed", "half", "new", "moved")
    events = log(
        spark,
        ("ok", "SILVER_WRITTEN", 3), ("failed", "FAILED", 2), ("half", "BRONZE_WRITTEN", 2),
        ("moved", "SILVER_WRITTEN", 1), ("moved", "REQUESTED", 9),
    )
    files = spark.createDataFrame(
        [(*KEY, "ok", 1, 1), (*KEY, "half", 1, 0), (*KEY, "moved", 1, 2)],
        "source string, entity string, run_id string, bronze_files long, silver_files long",
    )
    result = rn.reconcile_runs(asked, rn.artifact_completeness(files, events), rn.latest_state(events))
    got = {r.run_id: (r.status, r.bronze_ok, r.silver_ok, r.verdict) for r in result.collect()}
    assert got == {
        "ok": ("SILVER_WRITTEN", True, True, "ok"),
        "failed": ("FAILED", False, False, "failed"),
        "half": ("BRONZE_WRITTEN", True, False, "incomplete"),
        "new": (None, False, False, "incomplete"),
        "moved": ("SILVER_WRITTEN", True, True, "ok"),
    }
    row = rn.verification_summary(result).first()
    assert tuple(row) == (5, 2, 1, 2, False)
    assert rn.verification_summary(result.where("verdict = 'none'")).first().all_ok is True
    counts = {r.stage: (r.waiting, r.in_flight) for r in rn.backlog(asked, events).collect()}
    assert counts == {"ingest": (1, 0), "transform": (1, 0)}


def test_rows_get_the_params_of_their_run(spark):
    rows = spark.createDataFrame([(*KEY, "a", 1), (*KEY, "z", 2)], "source string, entity string, run_id string, v int")
    joined = rn.rows_with_run_params(rows, requests(spark, "a", "a"))
    assert [(r.v, r.params) for r in joined.collect()] == [(1, {"d": "1"})]


def test_a_redelivered_request_resets_nothing(spark):
    from strata.operators.runs import RUN_LOG_DDL, latest_state

    events = [("a", "SILVER_WRITTEN", 5), ("a", "REQUESTED", 9), ("b", "FAILED", 3), ("b", "REQUESTED", 4), ("c", "BRONZE_WRITTEN", 2), ("c", "FAILED", 3), ("c", "REQUESTED", 7)]
    log = spark.createDataFrame([("s", "e", run, status, at, None, None) for run, status, at in events], RUN_LOG_DDL)
    assert {r.run_id: r.status for r in latest_state(log).collect()} == {"a": "SILVER_WRITTEN", "b": "REQUESTED", "c": "FAILED"}


def test_transitions_keep_events_without_key_or_time(spark):
    from strata.operators.runs import run_transitions

    rows = [("s", "e", None, "REQUESTED", 1), ("s", "e", "r", "REQUESTED", None), ("s", "e", "r", "REQUESTED", 2)]
    assert run_transitions(spark.createDataFrame(rows, "source string, entity string, run_id string, status string, at_ms bigint")).count() == 3
