"""Streams over the sample tables; each query runs a stream to its end and reads what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.runs import latest_state
from strata.plans.pipeline import read_run_log, retry_quarantine
from strata.plans.workspace import work_dir
from strata.queries.registry import query, table
from strata.queries.silver import schema_of
from strata.sources.bronze import read_bronze
from strata.sources.silver import read_silver
from strata.streaming.streams import BATCH_BRONZE, bronze_stream, deduplicated, stream_bronze, stream_silver


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A file stream takes a folder or a pattern, so a single file is named by a pattern.
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, the type being the run; some payloads are not JSON."""
    bad = F.col("event_id") % 25 == 0
    good = F.to_json(F.struct("event_id", "user_id", "value"))
    return _events(spark, sf_dir).select(
        F.lit("web").alias("source"), F.lit("events").alias("entity"),
        F.concat(F.lit("run-"), F.col("event_type")).alias("run_id"),
        F.when(bad, F.concat(good, F.lit(" x"))).otherwise(good).alias("payload"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("day"),
    )


def _landed(spark: SparkSession, sf_dir: str) -> str:
    base = work_dir(spark, "stream")
    landing = stream_bronze(
        _messages(spark, sf_dir), f"{base}/bronze", f"{base}/checkpoint-bronze", "day", cluster=True,
        log_path=f"{base}/log", quarantine=f"{base}/quarantine-bronze",
    )
    landing.awaitTermination()
    return base


@query(
    """
    SELECT 'run-' || event_type AS run_id, strftime(ts, '%Y-%m-%d') AS ingestion_dt, event_id, user_id, value
    FROM events WHERE event_id % 25 <> 0
    """
)
def stream_bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed(spark, sf_dir)
    rows = read_bronze(spark, f"{base}/bronze", BATCH_BRONZE)
    typed = {"event_id": "bigint", "user_id": "bigint", "value": "double"}
    return rows.select(
        "run_id", "ingestion_dt", *[F.try_variant_get("row", f"$.{n}", t).alias(n) for n, t in typed.items()]
    )


@query(
    """
    SELECT 'run-' || event_type AS run_id, event_id FROM events WHERE event_id % 25 <> 0
    """
)
def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams land the same messages below one base, and each is landed once."""
    base = work_dir(spark, "redelivered")
    for name in ("first", "second"):
        stream_bronze(
            _messages(spark, sf_dir), f"{base}/bronze", f"{base}/checkpoint-{name}", "day", cluster=True, landed=f"{base}/landed",
            quarantine=f"{base}/quarantine",
        ).awaitTermination()
    rows = read_bronze(spark, f"{base}/bronze", BATCH_BRONZE)
    return rows.select("run_id", F.try_variant_get("row", "$.event_id", "bigint").alias("event_id"))


@query(
    """
    SELECT 'run-' || event_type AS run_id, ts, event_id FROM events WHERE event_id % 25 <> 0
    """
)
def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, of odd and of even messages, land below one base, and neither replaces what the other wrote."""
    base = work_dir(spark, "two-streams")
    for odd in (0, 1):
        messages = _messages(spark, sf_dir).where(F.get_json_object("payload", "$.event_id").try_cast("bigint") % 2 == odd)
        stream_bronze(messages, f"{base}/bronze", f"{base}/checkpoint-{odd}", "day", cluster=True, quarantine=f"{base}/quarantine").awaitTermination()
    rows = read_bronze(spark, f"{base}/bronze", BATCH_BRONZE)
    landed = rows.select("run_id", F.try_variant_get("row", "$.event_id", "bigint").alias("event_id"))
    return landed.join(table(spark, sf_dir, "events").select("event_id", "ts"), "event_id")


_SPEC = {
    "keep": ["event_id", "user_id", "value"],
    "cast": {"event_id": "int64", "user_id": "int64", "value": "float64"},
    "add_columns": [{"name": "channel", "from_param": "channel"}],
    "null_if": {"user_id": [7]},
    "non_null": ["user_id"],
}
_COLUMNS = {"event_id": "int64", "user_id": "int64", "value": "float64", "channel": "string"}


def _transformed(spark: SparkSession, sf_dir: str) -> tuple[str, object]:
    base = _landed(spark, sf_dir)
    spec = schema_of("events", _COLUMNS, _SPEC)
    spec = type(spec)(**{**spec.__dict__, "source": "web", "by_params": ("channel",)})
    transform = stream_silver(
        bronze_stream(spark, f"{base}/bronze"), spec, f"{base}/silver", f"{base}/checkpoint-silver",
        params={"channel": "app"}, quarantine=f"{base}/quarantine", log_path=f"{base}/log",
    )
    transform.awaitTermination()
    return base, spec


@query(
    """
    SELECT 'run-' || event_type AS run_id, event_id, user_id, value, 'app' AS channel
    FROM events WHERE event_id % 25 <> 0 AND user_id <> 7
    """
)
def stream_silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads to bronze to silver, both as streams."""
    base, spec = _transformed(spark, sf_dir)
    return read_silver(spark, f"{base}/silver", spec, extra_partitions=["batch_id"]).select("run_id", *_COLUMNS)


@query(
    """
    SELECT 'run-' || event_type AS run_id, 'null:user_id' AS outcome, CAST(2 AS INTEGER) AS attempt, count(*) AS n_rows
    FROM events WHERE event_id % 25 <> 0 AND user_id = 7 GROUP BY 1
    """
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the stream set aside, tried once more and rejected again."""
    base, spec = _transformed(spark, sf_dir)
    kept = spark.read.parquet(f"{base}/quarantine").withColumn("attempt", F.col("attempt").cast("int"))
    _, again, _ = retry_quarantine(kept, spec, params={"channel": "app"})
    return again.groupBy("run_id", F.array_join("reasons", ",").alias("outcome"), "attempt").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    """
    SELECT 'run-' || event_type AS run_id, 'SILVER_WRITTEN' AS status, count(*) AS n_rows
    FROM events WHERE event_id % 25 <> 0 AND user_id <> 7 GROUP BY event_type
    """
)
def stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log the two streams leave: the state of each run, and its rows over all batches."""
    base, _ = _transformed(spark, sf_dir)
    log = read_run_log(spark, f"{base}/log")
    rows = F.sum(F.get_json_object("extra", "$.rows").cast("bigint")).alias("n_rows")
    counted = log.where("status = 'SILVER_WRITTEN'").groupBy("run_id").agg(rows)
    return latest_state(log).select("run_id", "status").join(counted, "run_id")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice comes out once."""
    base = work_dir(spark, "dedup")
    twice = _events(spark, sf_dir).withColumn("delivery", F.explode(F.sequence(F.lit(1), F.lit(2))))
    unique = deduplicated(twice, ["event_id"], "ts").select("event_id", "user_id", "event_type")
    written = (
        unique.writeStream.format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    written.awaitTermination()
    return spark.read.parquet(f"{base}/out")
