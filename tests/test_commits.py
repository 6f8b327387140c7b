"""The stored run log, run commits, and jobs and streams that are repeated or given odd input."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from strata.operators import runs as rn
from strata.plans import pipeline as pl
from strata.plans import runlog as rl
from strata.plans.workspace import work_dir
from strata.queries import commits
from strata.queries.commits import forget_last_batch
from strata.sources.bronze import read_bronze
from strata.sources.silver import read_silver
from strata.streaming.streams import BATCH_BRONZE, bronze_stream, stream_bronze, stream_silver
from test_pipeline import BAD, SPEC, Flow, payloads
from test_streaming import SPEC as STREAM_SPEC
from test_streaming import send, stream


def events(spark, *rows):
    """(run, status, at_ms, extra)"""
    return spark.createDataFrame([("s", "e", r, s, at, None, x) for r, s, at, x in rows], rn.RUN_LOG_DDL)


def logged(spark, log):
    return sorted((r.run_id, r.status, r.at_ms) for r in rl.read_run_log(spark, log).collect())


def same_state(spark, log):
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    got = rows(rl.read_run_state(spark, log))
    assert got == rows(rn.latest_state(rl.read_run_log(spark, log)))
    return {r[2]: r[3] for r in got}


def test_a_commit_made_again_replaces_itself(spark, tmp_path):
    log = str(tmp_path / "log")
    assert logged(spark, log) == [] and same_state(spark, log) == {}
    for batch, at in ((0, 1), (1, 2), (1, 3)):
        rl.commit_events(events(spark, ("a", "SILVER_WRITTEN", at, None)), log, "silver", "query", batch)
    rl.append_run_log(events(spark, ("b", "REQUESTED", 1, None)), log)
    rl.append_run_log(events(spark, ("b", "REQUESTED", 1, None)), log)
    want = [("a", "SILVER_WRITTEN", 1), ("a", "SILVER_WRITTEN", 3), ("b", "REQUESTED", 1), ("b", "REQUESTED", 1)]
    assert logged(spark, log) == want
    # A commit that has no events any more takes away those it had.
    rl.commit_events(events(spark), log, "silver", "query", 1)
    assert logged(spark, log) == [w for w in want if w[2] != 3]
    with pytest.raises(ValueError):
        rl.commit_events(events(spark), log, "a/b", "query")


def test_snapshots(spark, tmp_path):
    log = str(tmp_path / "log")
    assert rl.compact_run_log(spark, log) == 0
    day = 86_400_000
    for batch in range(4):
        rows = [(f"r{i}", rn.STATUSES[(i + batch) % 4], day * batch + i, f'{{"b":{batch}}}' if i % 2 else None) for i in range(6)]
        rl.commit_events(events(spark, *rows), log, "silver", "query", batch)
        rl.commit_events(events(spark, (f"j{batch}", "FAILED", batch, "{}")), log, "job", f"job-{batch}")
    whole, state = logged(spark, log), same_state(spark, log)
    assert rl.compact_run_log(spark, log) == 1
    assert logged(spark, log) == whole and same_state(spark, log) == state
    # The newest batch of the stream may be played again, and a job may be repeated under its name: both count once, as they are now.
    rl.commit_events(events(spark, ("r0", "FAILED", 9 * day, None)), log, "silver", "query", 3)
    rl.commit_events(events(spark, ("j0", "SILVER_WRITTEN", 7 * day, None)), log, "job", "job-0")
    now = [w for w in whole if w[2] < 3 * day and w[0] != "j0"] + [("r0", "FAILED", 9 * day), ("j0", "SILVER_WRITTEN", 7 * day)]
    assert logged(spark, log) == sorted(now)
    rl.commit_events(events(spark, ("r1", "REQUESTED", 10 * day, None)), log, "silver", "query", 4)
    for n in (2, 2, 2):  # nothing is left to take the second time
        assert rl.compact_run_log(spark, log) == n
        assert logged(spark, log) == sorted([*now, ("r1", "REQUESTED", 10 * day)])
        assert same_state(spark, log)["j0"] == "SILVER_WRITTEN"


def test_files_read_for_the_state_do_not_grow(spark, tmp_path):
    log = str(tmp_path / "log")

    def files():
        return len(rl.read_run_state(spark, log).inputFiles())

    sizes = []
    for round_ in range(4):
        for batch in range(5):
            rl.commit_events(events(spark, ("a", "SILVER_WRITTEN", 10 * round_ + batch, None)), log, "silver", "query", 5 * round_ + batch)
        rl.compact_run_log(spark, log)
        sizes.append(files())
    assert max(sizes[1:]) == sizes[1] <= 16, sizes


def test_a_snapshot_that_was_not_published_does_not_count(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    rl.append_run_log(events(spark, ("a", "REQUESTED", 1, None)), log)
    with monkeypatch.context() as crash:
        crash.setattr(rl.rn, "fold_events", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rl.compact_run_log(spark, log)
    assert logged(spark, log) == [("a", "REQUESTED", 1)]
    assert rl.compact_run_log(spark, log) == 1
    assert logged(spark, log) == [("a", "REQUESTED", 1)] and same_state(spark, log) == {"a": "REQUESTED"}


def test_unknown_statuses_fail_by_name(spark):
    with pytest.raises(Exception, match="unknown status: WEIRD"):
        rn.latest_state(events(spark, ("a", "WEIRD", 1, None))).collect()


def test_a_retry_leaves_other_runs_alone(spark, tmp_path):
    flow, q, dead = Flow(spark, tmp_path), f"{tmp_path}/q", f"{tmp_path}/dead"
    df = payloads(spark, a='[{"i":1,"v":1},{"i":"x","v":1}]', b='[{"i":"y","v":3}]', c='[{"i":"z","v":3}]')
    flow.land(df.where("run_id <> 'c'"), at_ms=1)
    flow.silver(df, at_ms=2, on_error="quarantine", quarantine_base=q)
    places = (f"{tmp_path}/bronze", f"{tmp_path}/silver", flow.log, q, dead)
    pl.retry_silver(spark, SPEC, df.where("run_id in ('a', 'c')"), *places, at_ms=3)
    kept = sorted((r.run_id, r.attempt) for r in spark.read.parquet(q).collect())
    assert kept == [("a", 2), ("b", 1)]


def test_a_forced_failure_keeps_the_rows_before(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    df = payloads(spark, **BAD)
    flow.land(df, at_ms=1)
    flow.silver(df, at_ms=2, on_error="quarantine", quarantine_base=f"{tmp_path}/q")
    before = flow.rows()
    flow.silver(df, at_ms=3, on_error="fail_run", force=True)
    assert flow.rows() == before == [("a", 1, 1.0, "2024-01-05"), ("b", 3, 3.0, "2024-01-05")]


def test_commits_show_the_last_success(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    silver = f"{tmp_path}/silver"

    def rows():
        return sorted((r.run_id, r.id) for r in pl.read_committed(spark, silver, SPEC, flow.log).collect())

    good = payloads(spark, a='[{"i":1,"v":1}]', b='[{"i":3,"v":3}]', c="[]")
    flow.land(good, at_ms=1)
    flow.silver(good, at_ms=2, committed=True, job_id="one")
    assert rows() == [("a", 1), ("b", 3)]
    changed = Flow(spark, tmp_path / "changed")
    changed.land(payloads(spark, a='[{"i":5,"v":1}]', b='[{"i":"x","v":3}]'), at_ms=1)
    again = (spark, SPEC, good, f"{changed.base}/bronze", silver, flow.log)
    with pytest.raises(Exception, match="cast:id"):
        pl.run_silver(*again, force=True, committed=True, job_id="two", at_ms=3)
    assert rows() == [("a", 1), ("b", 3)]
    pl.run_silver(*again, "fail_run", force=True, committed=True, job_id="three", at_ms=4)
    assert rows() == [("a", 5), ("b", 3)]
    assert pl.remove_unpublished(spark, silver, SPEC, flow.log, before_ms=1) == 0
    assert pl.remove_unpublished(spark, silver, SPEC, flow.log, before_ms=4) == 1
    assert rows() == [("a", 5), ("b", 3)] and len(list((tmp_path / "silver").rglob("commit=*"))) == 2


def test_payloads_without_ids_and_with_several(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    named = payloads(spark, a='{"i":1}', b='{"i":2}')
    odd = payloads(spark, x='{"i":3}', y='{"i":4}').withColumn("run_id", F.when(F.col("run_id") == "y", F.lit("")))
    differing = payloads(spark, b='{"i":9}')
    both = named.unionByName(named).unionByName(odd).unionByName(odd).unionByName(differing)
    flow.land(both, at_ms=1)
    flow.land(both, at_ms=2)
    lines = spark.read.text(f"{tmp_path}/bronze")
    assert sorted(r.value for r in lines.collect()) == ['{"i":1}', '{"i":3}', '{"i":4}']
    assert flow.states()["b"] == ("FAILED", '{"error":"payloads of the run differ"}')
    log = [(r.run_id, r.extra) for r in pl.read_run_log(spark, flow.log).collect() if r.status == "BRONZE_WRITTEN"]
    assert len({run for run, _ in log}) == 3 and sum(x is None for _, x in log) == 3 and sum(x == '{"skipped":true}' for _, x in log) == 3


def test_skipped_runs_are_logged_and_jobs_are_repeatable(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    df = payloads(spark, a='[{"i":1,"v":1}]')
    for _ in range(2):
        flow.land(df, at_ms=1, job_id="land")
        flow.silver(df, at_ms=2, job_id="silver")
    flow.silver(df, at_ms=3, job_id="later")
    flow.silver(df, at_ms=3, job_id="later")
    got = sorted((r.status, r.at_ms, r.extra) for r in pl.read_run_log(spark, flow.log).collect())
    assert got == [("BRONZE_WRITTEN", 1, None), ("SILVER_WRITTEN", 2, '{"rows":1,"empty":false}'), ("SILVER_WRITTEN", 3, '{"skipped":true}')]
    assert flow.rows() == [("a", 1, 1.0, "2024-01-05")]


def test_bad_streamed_payloads(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/in", ("a", '{"i":1}'), ("a", "oops"), ("b", '{"i":2}'))
    strict = stream_bronze(stream(spark, f"{base}/in"), f"{base}/strict", f"{base}/c0", "ts", log_path=f"{base}/log0")
    with pytest.raises(Exception, match="bad payload: s: e: a: payload is not JSON"):
        strict.awaitTermination()
    assert logged(spark, f"{base}/log0") == [] and not list(tmp_path.glob("strict_landed/**/*.parquet"))
    stream_bronze(stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/c1", "ts", log_path=f"{base}/log", quarantine=f"{base}/q").awaitTermination()
    assert {r.run_id: r.status for r in rl.read_run_state(spark, f"{base}/log").collect()} == {"a": "FAILED", "b": "BRONZE_WRITTEN"}
    assert [(r.run_id, r.input) for r in spark.read.parquet(f"{base}/q").collect()] == [("a", "oops")]


def test_redelivery_is_safe_by_default_and_replays_count_once(spark, tmp_path):
    base = str(tmp_path)

    def land():
        stream_bronze(stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/c1", "ts", log_path=f"{base}/log").awaitTermination()

    def transform():
        stream_silver(bronze_stream(spark, f"{base}/bronze"), STREAM_SPEC, f"{base}/silver", f"{base}/c2", log_path=f"{base}/log").awaitTermination()

    send(spark, f"{base}/in", ("a", '{"i":1}'), ("a", '{"i":1}'), (None, '{"i":7}'))
    land()
    send(spark, f"{base}/in", ("a", '{"i":1}'), ("a", '{"i":2}'), (None, '{"i":7}'))
    for step, checkpoint in ((land, f"{base}/c1"), (transform, f"{base}/c2")):
        step()
        forget_last_batch(spark, checkpoint)
        step()
    values = read_bronze(spark, f"{base}/bronze", BATCH_BRONZE).select(F.try_variant_get("row", "$.i", "int").alias("i"))
    assert sorted(r.i for r in values.collect()) == [1, 2, 7]
    rows = [r.n for r in rl.read_run_log(spark, f"{base}/log").where("status = 'SILVER_WRITTEN'").select(F.get_json_object("extra", "$.rows").cast("int").alias("n")).collect()]
    assert sum(rows) == 3


@pytest.mark.parametrize("name", ["land_two_payloads", "land_missing_ids", "stream_bad_payloads"])
def test_files_do_not_go_by_the_number_of_runs(spark, sf_dir, tmp_path, monkeypatch, name):
    monkeypatch.setattr(commits, "work_dir", lambda *_: str(tmp_path))
    assert getattr(commits, name)(spark, sf_dir).count() > 0
    written = [p for layer in ("bronze", "quarantine") for p in (tmp_path / layer).rglob("part-*")]
    # Streamed days have folders of their own, here 30 of bronze.
    assert 0 < len({p.parent for p in written}) <= 31


def test_packed_bronze(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    base, odd = f"{tmp_path}/bronze", "r/=é"
    first = payloads(spark, a='[{"i":1,"v":"2.5"},{"i":2,"v":3.0}]', b="[]", bad="oops", **{odd: '{"i":4,"v":4}'})
    flow.land(first, at_ms=1, packed=True)
    want = [("a", '{"i":1,"v":"2.5"}'), ("a", '{"i":2,"v":3.0}'), (odd, '{"i":4,"v":4}')]

    def lines():
        return sorted((r.run_id, r.value) for r in pl.read_packed(spark, base, flow.log).collect())

    assert lines() == want
    # What a job left that ended before it was logged does not count, and runs landed before are not landed again.
    more = first.unionByName(payloads(spark, c='{"i":5,"v":5}'))
    pl.land_bronze(spark, more, base, f"{tmp_path}/lost", "at", at_ms=2, packed=True)
    assert lines() == want
    for at_ms in (3, 4):
        flow.land(more, at_ms=at_ms, packed=True)
        assert lines() == [*want[:2], ("c", '{"i":5,"v":5}'), want[2]]
    flow.silver(more, at_ms=5, packed=True)
    assert [r[:3] for r in flow.rows()] == [("a", 1, 2.5), ("a", 2, 3.0), ("c", 5, 5.0), (odd, 4, 4.0)]
    assert flow.states()["b"] == ("SILVER_WRITTEN", '{"rows":0,"empty":true}') and flow.states()["bad"][0] == "FAILED"


def test_packed_streams(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/in", ("a", '{"i":1}'), ("a", "oops"), ("b", '{"i":2}'))
    for _ in range(2):
        stream_bronze(
            stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/c1", "ts", log_path=f"{base}/log", quarantine=f"{base}/q", packed=True
        ).awaitTermination()
        forget_last_batch(spark, f"{base}/c1")
    stream_silver(bronze_stream(spark, f"{base}/bronze", packed=True), STREAM_SPEC, f"{base}/silver", f"{base}/c2").awaitTermination()
    got = read_silver(spark, f"{base}/silver", STREAM_SPEC, extra_partitions=["batch_id"])
    assert sorted((r.run_id, r.id) for r in got.collect()) == [("a", 1), ("b", 2)]
    assert [(r.run_id, r.input) for r in spark.read.parquet(f"{base}/q").collect()] == [("a", "oops")]
    assert {r.run_id: r.status for r in rl.read_run_state(spark, f"{base}/log").collect()} == {"a": "FAILED", "b": "BRONZE_WRITTEN"}


def test_rows_of_few_runs_stay_in_their_tasks(spark, tmp_path, monkeypatch):
    """Requests that come out of a large table are few, and the lines are not brought together by run for them."""
    flow, plans = Flow(spark, tmp_path), []
    df = payloads(spark, a='[{"i":1,"v":1},{"i":2,"v":2}]', b='{"i":3,"v":3}')
    flow.land(df, at_ms=1)
    run = F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("run_id")
    params = F.create_map(F.lit("date"), F.lit("2024-01-05")).alias("params")
    asked = spark.range(100_000).select(run).distinct().select(F.lit("s").alias("source"), F.lit("e").alias("entity"), "run_id", params)
    check = pl.check_rows

    def checked(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return check(rows, *args, **options)

    monkeypatch.setattr(pl, "check_rows", checked)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 20_000)
    try:
        flow.silver(asked, at_ms=2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert [r[:2] for r in flow.rows()] == [("a", 1), ("a", 2), ("b", 3)]


def test_streamed_payloads_are_parsed_twice_at_most(spark, tmp_path, monkeypatch):
    from strata.streaming import streams

    base, parsed, rows = str(tmp_path), spark.sparkContext.accumulator(0), streams.payload_rows

    def seen(error):
        parsed.add(1)
        return error

    counted = F.udf(seen, "string").asNondeterministic()
    monkeypatch.setattr(streams, "payload_rows", lambda *a: rows(*a).withColumn("error", counted("error")))
    send(spark, f"{base}/in", ("a", '{"i":1}'), ("a", "oops"), ("b", '{"i":2}'), ("c", "oops too"))
    stream_bronze(stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/c1", "ts", log_path=f"{base}/log", quarantine=f"{base}/q").awaitTermination()
    assert parsed.value == 2 * 4
    assert {r.run_id: r.status for r in rl.read_run_state(spark, f"{base}/log").collect()} == {"a": "FAILED", "b": "BRONZE_WRITTEN", "c": "FAILED"}
    assert sorted(r.input for r in spark.read.parquet(f"{base}/q").collect()) == ["oops", "oops too"]


@pytest.mark.parametrize("on_error", ["fail_run", "quarantine"])
def test_lines_are_parsed_once(spark, tmp_path, monkeypatch, on_error):
    flow, parsed, parse = Flow(spark, tmp_path), spark.sparkContext.accumulator(0), pl.parse_lines
    df = payloads(spark, a='[{"i":1,"v":1},{"i":2,"v":"2.5"}]', b='[{"i":3,"v":true},{"i":4,"v":"x"}]')
    flow.land(df, at_ms=1)

    def seen(value):
        parsed.add(1)
        return value

    counted = F.udf(seen, "string").asNondeterministic()
    monkeypatch.setattr(pl, "parse_lines", lambda lines: parse(lines.withColumn("value", counted("value"))))
    options = {"quarantine_base": f"{tmp_path}/q"} if on_error == "quarantine" else {}
    flow.silver(df, at_ms=2, on_error=on_error, **options)
    assert parsed.value == 4
    assert [r[:3] for r in flow.rows()] == [("a", 1, 1.0), ("a", 2, 2.5), *([("b", 3, 1.0)] if on_error == "quarantine" else [])]
    if on_error == "quarantine":
        kept = [(r.run_id, r.input, r.reasons) for r in spark.read.parquet(f"{tmp_path}/q").collect()]
        assert kept == [("b", '{"i":4,"v":"x"}', ["cast:v"])]
    else:
        assert flow.states()["b"][0] == "FAILED"
    assert not list(Path(work_dir(spark, "none").removeprefix("file://")).parent.glob("checked-*"))
