from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from strata.operators import runs as rn
from strata.plans import pipeline as pl
from strata.plans.gold import run_gold
from strata.plans.spec import Schema, SpecError, parse_schema
from strata.plans.workspace import work_dir
from strata.sinks.layers import write_silver
from strata.sources.silver import merged_silver, read_silver, register_silver

SPEC = Schema(
    1, "t", "s", "e",
    columns={"id": "int64", "v": "float64", "date": "string"},
    transforms={
        "keep": ["i", "v"], "rename": {"i": "id"}, "add_columns": [{"name": "date", "from_param": "date"}],
        "cast": {"id": "int64", "v": "float64"}, "required": ["id"], "non_null": ["v"], "unique_key": ["id"],
    },
    by_params=("date",),
)


def payloads(spark, **by_run):
    rows = [("s", "e", run, {"date": "2024-01-05", "hour": "00"}, text) for run, text in by_run.items()]
    df = spark.createDataFrame(rows, "source string, entity string, run_id string, params map<string,string>, payload string")
    return df.withColumn("at", F.expr("timestamp_ntz'2024-01-05 00:10:00'"))


class Flow:
    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)
        self.log = f"{base}/log"

    def land(self, df, **options):
        pl.land_bronze(self.spark, df, f"{self.base}/bronze", self.log, "at", **options)

    def silver(self, df, **options):
        pl.run_silver(self.spark, options.pop("spec", SPEC), df, f"{self.base}/bronze", f"{self.base}/silver", self.log, **options)

    def rows(self, spec=SPEC):
        got = read_silver(self.spark, f"{self.base}/silver", spec).select("run_id", *spec.columns).collect()
        return sorted(tuple(r) for r in got)

    def states(self):
        return {r.run_id: (r.status, r.extra) for r in rn.latest_state(pl.read_run_log(self.spark, self.log)).collect()}


def test_land_transform_rerun(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    first = payloads(spark, a='[{"i":1,"v":"2.5"},{"i":2,"v":3}]', b="[]")
    flow.land(first, at_ms=1)
    flow.silver(first, at_ms=2)
    want = [("a", 1, 2.5, "2024-01-05"), ("a", 2, 3.0, "2024-01-05")]
    assert flow.rows() == want
    assert flow.states() == {
        "a": ("SILVER_WRITTEN", '{"rows":2,"empty":false}'), "b": ("SILVER_WRITTEN", '{"rows":0,"empty":true}'),
    }
    # First write wins, until it is forced.
    again = payloads(spark, a='[{"i":9,"v":9}]')
    flow.land(again, at_ms=3)
    flow.silver(again, at_ms=4)
    assert flow.rows() == want
    flow.silver(again, at_ms=5, force=True)
    assert flow.rows() == want
    # A later run is added and nothing else is touched.
    more = payloads(spark, c='[{"i":1,"v":1}]')
    flow.land(more, at_ms=6)
    flow.silver(first.unionByName(more), at_ms=7)
    assert flow.rows() == [*want, ("c", 1, 1.0, "2024-01-05")]
    verdicts = pl.verify_runs(spark, first.unionByName(more), f"{tmp_path}/bronze", f"{tmp_path}/silver", flow.log)
    assert {r.run_id: (r.bronze_ok, r.silver_ok, r.verdict) for r in verdicts.collect()} == {
        "a": (True, True, "ok"), "b": (False, False, "ok"), "c": (True, True, "ok"),
    }


def test_bad_payloads_do_not_hold_up_others(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    flow.land(payloads(spark, good='{"i":1,"v":1}', bad="oops"), at_ms=1)
    assert flow.states()["bad"] == ("FAILED", '{"error":"payload is not JSON"}')
    assert flow.states()["good"][0] == "BRONZE_WRITTEN"
    mapped = Flow(spark, tmp_path / "mapped")
    mapped.land(payloads(spark, good="[[1,2,3]]", bad="[[1,2],[1]]"), mapping_columns=["i", "v"], at_ms=1)
    assert mapped.states()["bad"] == ("FAILED", '{"error":"too short: 1"}')
    mapped.silver(payloads(spark, good="", bad=""), at_ms=2)
    assert mapped.rows() == [("good", 1, 2.0, "2024-01-05")]


BAD = {"a": '[{"i":1,"v":1},{"i":"x","v":1}]', "b": '[{"i":3,"v":3}]'}


def test_fail_stops_the_batch_and_is_logged(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    df = payloads(spark, **BAD)
    flow.land(df, at_ms=1)
    with pytest.raises(Exception, match="cast:id"):
        flow.silver(df, at_ms=2)
    assert {s for s, _ in flow.states().values()} == {"FAILED"}


def test_fail_run_stops_only_its_run(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    df = payloads(spark, **BAD)
    flow.land(df, at_ms=1)
    flow.silver(df, at_ms=2, on_error="fail_run")
    assert flow.rows() == [("b", 3, 3.0, "2024-01-05")]
    assert flow.states()["a"] == ("FAILED", '{"error":"cast:id"}')
    assert flow.states()["b"][0] == "SILVER_WRITTEN"


def test_quarantine_sets_rows_aside_and_retries(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    df = payloads(spark, **BAD)
    flow.land(df, at_ms=1)
    flow.silver(df, at_ms=2, on_error="quarantine", quarantine_base=f"{tmp_path}/q")
    assert flow.rows() == [("a", 1, 1.0, "2024-01-05"), ("b", 3, 3.0, "2024-01-05")]
    kept = spark.read.parquet(f"{tmp_path}/q")
    assert [(r.run_id, r.input, r.reasons, r.attempt) for r in kept.collect()] == [("a", '{"i":"x","v":1}', ["cast:id"], 1)]
    good, again, dead = pl.retry_quarantine(kept, SPEC, params={"date": "d"})
    assert (good.count(), dead.count()) == (0, 0)
    assert [(r.run_id, r.attempt) for r in again.collect()] == [("a", 2)]
    _, again, dead = pl.retry_quarantine(kept.withColumn("attempt", F.lit(4)), SPEC, params={"date": "d"})
    assert (again.count(), [r.attempt for r in dead.collect()]) == (0, [5])
    fixed = Schema(1, "t", "s", "e", columns={"id": "string"}, transforms={"keep": ["i"], "rename": {"i": "id"}})
    assert [(r.run_id, r.id) for r in pl.retry_quarantine(kept, fixed)[0].collect()] == [("a", "x")]
    with pytest.raises(ValueError):
        flow.silver(df, on_error="quarantine")


def test_deduplicate_key_is_per_run(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    spec = Schema(1, "t", "s", "e", SPEC.columns, {**SPEC.transforms, "deduplicate": {"order_by": ["v"]}}, ("date",))
    df = payloads(spark, a='[{"i":1,"v":1},{"i":1,"v":5},{"i":2,"v":1}]', b='[{"i":1,"v":2}]')
    flow.land(df, at_ms=1)
    flow.silver(df, at_ms=2, spec=spec)
    assert [r[:3] for r in flow.rows(spec)] == [("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, 2.0)]


def test_partitioning_errors(spark, tmp_path):
    df = spark.sql("SELECT 1L AS id, 1.0D AS v, 'x' AS date")
    with pytest.raises(SpecError, match="date"):
        write_silver(df, str(tmp_path), SPEC, {}, run_id="r")
    by_column = Schema(1, "t", "s", "e", SPEC.columns, {}, (), ("absent",))
    with pytest.raises(SpecError, match="absent"):
        write_silver(df, str(tmp_path), by_column, {}, run_id="r")
    with_params = df.withColumn("params", F.create_map(F.lit("other"), F.lit("x")))
    needs = Schema(1, "t", "s", "e", {"id": "int64"}, {}, ("region",))
    with pytest.raises(Exception, match="region"):
        write_silver(with_params.select("id", "params"), str(tmp_path), needs, params_col="params", run_id="r")


def test_partition_pruning_and_text_partitions(spark, tmp_path):
    spec = Schema(1, "t", "s", "e", {"id": "int64", "hour": "string"}, {}, ("day",), ("hour",))
    df = spark.sql("SELECT 1L AS id, '00' AS hour UNION ALL SELECT 2L, '01'")
    write_silver(df, str(tmp_path), spec, {"day": "2024-01-05"}, run_id="r")
    one = read_silver(spark, str(tmp_path), spec, hour="00")
    assert [tuple(r) for r in one.select("id", "hour", "day", "source").collect()] == [(1, "00", "2024-01-05", "s")]
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "hour" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    merged = merged_silver(spark, str(tmp_path))
    assert dict(merged.dtypes)["hour"] == "string" and merged.count() == 2


def test_writes_are_rebalanced_by_folder(spark, tmp_path):
    from strata.sinks.layers import _cluster

    text = _cluster(spark.range(5).withColumn("run_id", F.lit("r")), ["run_id"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    """Nine of ten rows belong to one run; both ways of clustering spread them."""
    from strata.sinks.layers import _cluster

    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("run_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1MB")
        for salts in (None, 4):
            out = str(tmp_path / f"out{salts}")
            _cluster(df, ["run_id"], salts).write.partitionBy("run_id").parquet(out)
            files = spark.read.parquet(out).select("run_id", F.input_file_name().alias("f")).distinct().groupBy("run_id").count()
            n = {r.run_id: r["count"] for r in files.collect()}
            assert n["hot"] > 1, (salts, n)
            assert spark.read.parquet(out).count() == 200_000
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_register_adds_columns(spark, tmp_path):
    base = str(tmp_path)
    old = Schema(1, "t", "s", "evolving", {"id": "int64"}, {})
    new = Schema(1, "t", "s", "evolving", {"id": "int64", "v": "string"}, {})
    write_silver(spark.sql("SELECT 1L AS id"), base, old, run_id="one")
    name = register_silver(spark, base, old)
    assert name == "silver_s_evolving"
    write_silver(spark.sql("SELECT 2L AS id, 'x' AS v"), base, new, run_id="two")
    register_silver(spark, base, new)
    assert sorted((r.id, r.v, r.run_id) for r in spark.table(name).collect()) == [(1, None, "one"), (2, "x", "two")]


def test_gold_file(spark, tmp_path):
    path = tmp_path / "gold.sql"
    path.write_text("CREATE TABLE gold_ctas USING parquet AS SELECT id % 2 AS odd, count(*) AS n FROM range(10) GROUP BY 1")
    assert run_gold(spark, str(path)).state == "SUCCEEDED"
    assert spark.table("gold_ctas").count() == 2
    path.write_text("SELECT id FROM range(:n)")
    for n in (3, 4):
        run_gold(spark, str(path), "gold_rows", str(tmp_path / "out"), {"n": n}, replace=True)
        assert spark.table("gold_rows").count() == n
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        run_gold(spark, str(path), "gold_rows", args={"n": 1})
    path.write_text("SELECT nothing FROM nowhere")
    with pytest.raises(Exception, match="nowhere"):
        run_gold(spark, str(path), "gold_bad")


def test_work_dir_is_below_the_shared_folder(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_quarantine_without_work_and_without_good_rows(spark, tmp_path):
    from strata.plans.pipeline import land_bronze, read_run_log, run_silver
    from strata.plans.spec import Schema

    spec, base = Schema(1, "t", "s", "e", {"id": "int64"}, {"cast": {"id": "int64"}}), str(tmp_path)
    keys = "source string, entity string, run_id string, params map<string,string>"
    requests = spark.createDataFrame([("s", "e", "r", {})], keys)
    payloads = spark.createDataFrame([("s", "e", "r", {}, '[{"id":"x"}]')] * 2, f"{keys}, payload string").withColumn("t", F.expr("timestamp_ntz'2024-01-05 10:00:00'"))
    land_bronze(spark, payloads, f"{base}/bronze", f"{base}/log", "t")
    for _ in range(2):  # the second time nothing is pending
        run_silver(spark, spec, requests, f"{base}/bronze", f"{base}/silver", f"{base}/log", on_error="quarantine", quarantine_base=f"{base}/q")
    assert spark.read.parquet(f"{base}/q").count() == 1
    log = [(r.status, r.extra) for r in read_run_log(spark, f"{base}/log").orderBy("at_ms").collect()]
    assert [s for s, _ in log] == ["BRONZE_WRITTEN", "SILVER_WRITTEN", "SILVER_WRITTEN"] and log[2][1] == '{"skipped":true}'


def test_a_landing_repeated_after_a_crash_replaces_the_first(spark, tmp_path, monkeypatch):
    flow = Flow(spark, tmp_path)
    first = payloads(spark, a='[{"i":1,"v":5.0}, {"i":2,"v":[1.10,1e5,-0.0]}]', b='{"i":3,"v":"{"}', c='["{", 7.0]')
    with monkeypatch.context() as crash:
        crash.setattr(pl.rn, "log_status", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pl.land_bronze(spark, first.where("run_id <> 'none'"), f"{tmp_path}/bronze", flow.log, "at", at_ms=1)
    hour_later = first.withColumn("at", F.expr("at + interval 1 hour"))
    flow.land(hour_later, at_ms=2)
    lines = spark.read.text(f"{tmp_path}/bronze")
    assert sorted((r.run_id, r.value) for r in lines.collect()) == [
        ("a", '{"i":1,"v":5.0}'), ("a", '{"i":2,"v":[1.1,100000.0,-0.0]}'), ("b", '{"i":3,"v":"{"}'), ("c", '"{"'), ("c", "7"),
    ]


def test_a_forced_rerun_leaves_no_stale_folder(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    old = Schema(1, "t", "s", "e", {"id": "string", "k": "string"}, {}, (), ("k",))
    new = Schema(1, "t", "s", "e", {"id": "string", "k": "string"}, {"lower": ["k"]}, (), ("k",))
    df = payloads(spark, **{"a+b c": '[{"id":"1","k":"X+ Y"}]', "other": '[{"id":"2","k":"X+ Y"}]'})
    flow.land(df, at_ms=1)
    flow.silver(df, at_ms=2, spec=old)
    flow.silver(df.where("run_id <> 'other'"), at_ms=3, spec=new, force=True)
    assert flow.rows(old) == [("a+b c", "1", "x+ y"), ("other", "2", "X+ Y")]


def test_retries_end_in_silver_or_dead_letters(spark, tmp_path):
    flow, q, dead = Flow(spark, tmp_path), f"{tmp_path}/q", f"{tmp_path}/dead"
    df = payloads(spark, **BAD)
    flow.land(df, at_ms=1)
    flow.silver(df, at_ms=2, on_error="quarantine", quarantine_base=q)
    places = (f"{tmp_path}/bronze", f"{tmp_path}/silver", flow.log, q, dead)
    pl.retry_silver(spark, SPEC, df, *places, at_ms=3)
    assert [(r.run_id, r.attempt) for r in spark.read.parquet(q).collect()] == [("a", 2)]
    pl.write_quarantine(spark.read.parquet(q).drop("layer", "batch_id").withColumn("attempt", F.lit(4)), q, "late")
    pl.retry_silver(spark, SPEC, df, *places, at_ms=4)
    assert [(r.run_id, r.input, r.attempt) for r in spark.read.parquet(dead).collect()] == [("a", '{"i":"x","v":1}', 5)]
    assert not list((tmp_path / "q").rglob("*.parquet"))
    assert flow.rows() == [("a", 1, 1.0, "2024-01-05"), ("b", 3, 3.0, "2024-01-05")]
    pl.retry_silver(spark, SPEC, df, *places, at_ms=5)  # nothing is left


def test_files_of_runs_are_listed_and_not_read(spark, tmp_path):
    """Also those without rows, of runs with odd names, below a folder that is named like a run."""
    from strata.plans.pipeline import _files_of

    base = str(tmp_path / "run_id=other" / "silver")
    schema = parse_schema({"version": 1, "id": "x", "source": "s", "entity": "e", "silver": {"columns": [{"name": "id", "type": "int64"}]}}, strict=False)
    for run in ("a/b", "c"):
        write_silver(spark.sql("SELECT 1L AS id"), base, schema, run_id=run)
    folder = f"{base}/source=s/entity=e/run_id=a%2Fb"
    spark.sql("SELECT 1L AS id WHERE false").coalesce(1).write.mode("append").parquet(folder)
    runs = spark.sql("SELECT 's' AS source, 'e' AS entity, 'a/b' AS run_id")
    found = [(r.file, r.folder) for r in _files_of(spark, schema, runs, base).collect()]
    assert len(found) == 2 and {f.removeprefix("file:") for _, f in found} == {folder}
    assert _files_of(spark, schema, None, base).count() == 3
