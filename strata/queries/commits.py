"""What jobs and streams leave behind when they fail, are repeated, or are given odd input."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import runs as rn
from strata.plans.pipeline import land_bronze, read_committed, read_packed, retry_silver, run_silver
from strata.plans.runlog import commit_events, compact_run_log, read_run_log, read_run_state
from strata.plans.workspace import work_dir
from strata.queries.registry import query, table
from strata.queries.runs import _EVENT_LOG, event_log
from strata.queries.silver import _orders_pipeline
from strata.queries.stream import _COLUMNS, _messages, _SPEC, schema_of
from strata.sinks.layers import remove_folders
from strata.sources.silver import read_silver
from strata.streaming.streams import bronze_stream, stream_bronze, stream_silver

_ORDERS = """
    SELECT 'run-' || o_orderstatus AS run_id, o_orderkey AS key,
           {total} AS total, o_orderstatus AS status FROM orders
"""


@query(
    """
    SELECT 'silver' AS place, 'run-' || o_orderstatus AS run_id, o_orderkey AS key FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 'quarantine', 'run-P', o_orderkey FROM orders WHERE o_orderstatus = 'P'
    """
)
def silver_retry_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs have rows set aside, and only one is tried again: it arrives, and the rows of the other stay where they are."""
    total = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    spec, base, requests = _orders_pipeline(spark, sf_dir, total)
    mended = replace(spec, transforms={**spec.transforms, "non_null": ["key"]})
    layers, aside = (f"{base}/bronze", f"{base}/silver", f"{base}/log"), f"{base}/quarantine"
    run_silver(spark, spec, requests, *layers, on_error="quarantine", quarantine_base=aside, at_ms=2)
    retry_silver(spark, mended, requests.where("run_id = 'run-F'"), *layers, aside, f"{base}/dead", at_ms=3)
    silver = read_silver(spark, f"{base}/silver", mended).select(F.lit("silver").alias("place"), "run_id", "key")
    kept = spark.read.parquet(aside).select(F.lit("quarantine").alias("place"), "run_id", F.get_json_object("input", "$.o_orderkey").cast("bigint").alias("key"))
    return silver.unionByName(kept)


@query(_ORDERS.format(total="CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END"))
def silver_forced_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs done again by force over bronze lines that changed, of which two fail: they keep the rows they had before."""
    spec, base, requests = _orders_pipeline(spark, sf_dir)
    again, changed, _ = _orders_pipeline(spark, sf_dir, F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1))
    silver, log = f"{base}/silver", f"{base}/log"
    run_silver(spark, spec, requests, f"{base}/bronze", silver, log, at_ms=2)
    run_silver(spark, again, requests, f"{changed}/bronze", silver, log, on_error="fail_run", at_ms=3, force=True)
    return read_silver(spark, silver, spec).select("run_id", "key", "total", "status")


@query(_ORDERS.format(total="o_totalprice + CASE o_orderstatus WHEN 'O' THEN 2 ELSE 0 END"))
def silver_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs with folders of their own: one succeeds, one fails as a whole after it has written, one fails for two of three runs. Each run
    shows what its last successful event published."""
    spec, base, requests = _orders_pipeline(spark, sf_dir)
    silver, log = f"{base}/silver", f"{base}/log"
    run_silver(spark, spec, requests, f"{base}/bronze", silver, log, at_ms=2, committed=True, job_id="first")
    for at_ms, total, mode in ((3, F.col("o_totalprice") + 1, "lost"), (4, F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 2), "fail_run")):
        changed, place, _ = _orders_pipeline(spark, sf_dir, total)
        on_error, own = ("fail", f"{base}/log-{mode}") if mode == "lost" else (mode, log)
        if mode == "lost":  # its events go where nobody reads them, as if it had ended before them
            commit_events(read_run_log(spark, log), own, "copy", "copy")
        run_silver(spark, changed, requests, f"{place}/bronze", silver, own, on_error=on_error, at_ms=at_ms, force=True, committed=True, job_id=mode)
    return read_committed(spark, silver, spec, log).select("run_id", "key", "total", "status")


@query(
    """
    SELECT 'run-' || o_orderstatus AS run_id, status, n_events FROM (SELECT DISTINCT o_orderstatus FROM orders),
    (VALUES ('BRONZE_WRITTEN', CAST(1 AS BIGINT)), ('SILVER_WRITTEN', CAST(1 AS BIGINT)), ('skipped', CAST(2 AS BIGINT))) AS t(status, n_events)
    """
)
def silver_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs asked for three times are done once and logged as skipped twice; a job repeated under its id adds nothing."""
    spec, base, requests = _orders_pipeline(spark, sf_dir)
    for at_ms, job in ((2, "one"), (3, "two"), (4, "three"), (5, "three")):
        run_silver(spark, spec, requests, f"{base}/bronze", f"{base}/silver", f"{base}/log", at_ms=at_ms, job_id=job)
    skipped = F.get_json_object("extra", "$.skipped") == "true"
    kind = F.when(F.coalesce(skipped, F.lit(False)), F.lit("skipped")).otherwise(F.col("status"))
    return read_run_log(spark, f"{base}/log").groupBy("run_id", kind.alias("status")).agg(F.count(F.lit(1)).alias("n_events"))


def _customer_payloads(spark: SparkSession, sf_dir: str, run_id, extra=None) -> DataFrame:
    columns = [F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), *([extra] if extra is not None else [])]
    return table(spark, sf_dir, "customer").select(
        F.lit("crm").alias("source"), F.lit("customer").alias("entity"), run_id.alias("run_id"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("params"), F.to_json(F.struct(*columns)).alias("payload"),
        F.lit("2024-01-05 07:10:00").cast("timestamp_ntz").alias("at"),
    )


@query("SELECT c_custkey AS key, c_custkey % 3 <> 0 AS named, CAST(1 AS BIGINT) AS n_events FROM customer")
def land_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third customer comes without a run id and is a run of its own; all are delivered in two jobs, and landed and logged once."""
    base = work_dir(spark, "missing-ids")
    run_id = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("c-"), F.col("c_custkey")))
    payloads = _customer_payloads(spark, sf_dir, run_id)
    for at_ms in (1, 2):
        land_bronze(spark, payloads, f"{base}/bronze", f"{base}/log", "at", at_ms=at_ms, packed=True)
    lines = read_packed(spark, f"{base}/bronze", f"{base}/log")
    keyed = lines.select("run_id", F.get_json_object("value", "$.key").cast("bigint").alias("key"))
    log = read_run_log(spark, f"{base}/log").where(F.get_json_object("extra", "$.skipped").isNull())
    counted = log.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_events"))
    return keyed.join(counted, "run_id").select("key", F.col("run_id").startswith("c-").alias("named"), "n_events")


@query(
    """
    SELECT 'c-' || c_custkey AS run_id, CASE WHEN c_custkey % 5 = 0 THEN 'FAILED' ELSE 'BRONZE_WRITTEN' END AS status,
           CASE WHEN c_custkey % 5 = 0 THEN 'payloads of the run differ' END AS error,
           CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_lines
    FROM customer
    """
)
def land_two_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run comes twice; where its two payloads differ it fails by name, and where they are equal it is landed once."""
    base, run_id = work_dir(spark, "two-payloads"), F.concat(F.lit("c-"), F.col("c_custkey"))
    differs = F.when(F.col("c_custkey") % 5 == 0, F.lit("new")).alias("note")
    both = _customer_payloads(spark, sf_dir, run_id).unionByName(_customer_payloads(spark, sf_dir, run_id, differs))
    land_bronze(spark, both, f"{base}/bronze", f"{base}/log", "at", at_ms=1, packed=True)
    lines = read_packed(spark, f"{base}/bronze", f"{base}/log").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    state = read_run_state(spark, f"{base}/log").join(lines, "run_id", "left")
    return state.select("run_id", "status", F.get_json_object("extra", "$.error").alias("error"), F.coalesce("n", F.lit(0)).alias("n_lines"))


def _bad_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user; some payloads are not JSON."""
    return _messages(spark, sf_dir).withColumn("run_id", F.concat(F.lit("u-"), F.regexp_extract("payload", '"user_id":(\\d+)', 1)))


@query(
    """
    SELECT 'u-' || user_id AS run_id, CASE WHEN bool_or(event_id % 25 = 0) THEN 'FAILED' ELSE 'BRONZE_WRITTEN' END AS status,
           CAST(count(*) FILTER (event_id % 25 = 0) AS BIGINT) AS n_bad
    FROM events GROUP BY user_id
    """
)
def stream_bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed payloads that are not JSON are kept, and their runs end as failed. Without a quarantine the stream stops and lands nothing."""
    base = work_dir(spark, "bad-payloads")
    strict = stream_bronze(
        _bad_run(spark, sf_dir), f"{base}/strict", f"{base}/checkpoint-strict", "day", cluster=True, log_path=f"{base}/log-strict", packed=True,
    )
    try:
        strict.awaitTermination()
    except Exception as error:
        if "bad payload" not in str(error):
            raise
    if strict.exception() is None or read_run_log(spark, f"{base}/log-strict").take(1):
        raise RuntimeError("bad payloads were passed over")
    stream_bronze(
        _bad_run(spark, sf_dir), f"{base}/bronze", f"{base}/checkpoint", "day", cluster=True, log_path=f"{base}/log", quarantine=f"{base}/quarantine",
        packed=True,
    ).awaitTermination()
    kept = spark.read.parquet(f"{base}/quarantine").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    return read_run_state(spark, f"{base}/log").join(kept, "run_id", "left").select("run_id", "status", F.coalesce("n", F.lit(0)).alias("n_bad"))


def forget_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """As after a crash between a batch and its commit: the stream plays its last batch again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    names = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    last = max(int(n) for n in names if n.isdigit())
    remove_folders(spark, [f"{checkpoint}/commits/{last}", f"{checkpoint}/commits/.{last}.crc"])


@query(
    """
    SELECT 'run-' || event_type AS run_id, 'SILVER_WRITTEN' AS status, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_logged,
           CAST(2 AS BIGINT) AS n_events
    FROM events WHERE event_id % 25 <> 0 AND user_id <> 7 GROUP BY event_type
    """
)
def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch of both streams is played again, before and after the log is compacted: rows and events count once."""
    base = work_dir(spark, "replayed")
    spec = schema_of("events", _COLUMNS, _SPEC)
    spec = type(spec)(**{**spec.__dict__, "source": "web", "by_params": ("channel",)})

    def land() -> None:
        stream_bronze(
            _messages(spark, sf_dir), f"{base}/bronze", f"{base}/c-bronze", "day", cluster=True, log_path=f"{base}/log", quarantine=f"{base}/q-bronze",
        ).awaitTermination()

    def transform() -> None:
        stream_silver(
            bronze_stream(spark, f"{base}/bronze"), spec, f"{base}/silver", f"{base}/c-silver", params={"channel": "app"},
            quarantine=f"{base}/quarantine", log_path=f"{base}/log",
        ).awaitTermination()

    for step, checkpoint in ((land, f"{base}/c-bronze"), (transform, f"{base}/c-silver")):
        for _ in range(2):
            step()
            forget_last_batch(spark, checkpoint)
        compact_run_log(spark, f"{base}/log")
        step()
    log, written = read_run_log(spark, f"{base}/log"), F.col("status") == "SILVER_WRITTEN"
    logged = F.sum(F.when(written, F.get_json_object("extra", "$.rows").cast("bigint")))
    counted = log.groupBy("run_id").agg(logged.alias("n_logged"), F.count(F.lit(1)).alias("n_events"))
    rows = rn.run_metrics(read_silver(spark, f"{base}/silver", spec, extra_partitions=["batch_id"]))
    state = read_run_state(spark, f"{base}/log").select("run_id", "status")
    return rows.join(counted, "run_id").join(state, "run_id").select("run_id", "status", "n_rows", "n_logged", "n_events")


@query(
    _EVENT_LOG
    + """,
    reached AS (SELECT DISTINCT run_id FROM log WHERE status IN ('BRONZE_WRITTEN', 'SILVER_WRITTEN')),
    last AS (
      SELECT run_id, status FROM log
      WHERE status <> 'REQUESTED' OR run_id NOT IN (SELECT run_id FROM reached)
      QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY at_ms DESC, rank DESC) = 1)
    SELECT run_id, any_value(last.status) AS status, CAST(count(*) AS BIGINT) AS n_events,
           max(at_ms) FILTER (rank = 0) AS requested_at_ms, max(at_ms) FILTER (rank > 0) AS updated_at_ms,
           CAST(json_extract_string(max_by(extra, at_ms * 4 + rank) FILTER (extra IS NOT NULL), '$.k') AS BIGINT) AS k
    FROM log JOIN last USING (run_id) GROUP BY 1
    """
)
def run_log_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events committed in six parts, two of them twice, with two snapshots in between: the state from the last snapshot and what came
    after it, and the number of events ever committed."""
    log = work_dir(spark, "snapshots")
    events = event_log(spark, sf_dir)
    parts = events.withColumn("params", F.lit(None).cast("map<string,string>"))
    for part in range(6):
        own = parts.where(F.col("event_id") % 6 == part).drop("event_id")
        commit_events(own, log, "load", f"part-{part}")
        if part == 1:
            commit_events(own, log, "load", "part-1")
        if part in (2, 4):
            compact_run_log(spark, log)
        if part == 4:
            commit_events(parts.where(F.col("event_id") % 6 == 0).drop("event_id"), log, "load", "part-0")
    counted = read_run_log(spark, log).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_events"))
    k = F.try_variant_get(rn.decode_extra(F.col("extra")), "$.k", "bigint").alias("k")
    state = read_run_state(spark, log).join(counted, "run_id")
    return state.select("run_id", "status", "n_events", "requested_at_ms", "updated_at_ms", k)
