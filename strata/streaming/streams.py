"""Micro-batch forms of landing and transforming.

Each batch writes its own folders, below the run, and replaces only those; a batch that is played
again after a failure leaves no duplicates. Folders are named by the stream as well, so a second stream, or one that
begins anew with another checkpoint, never replaces what is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions import times as tm
from strata.operators import runs as rn
from strata.operators.transforms import check_rows
from strata.plans.pipeline import now_ms, payload_rows, with_given_run_ids
from strata.plans.runlog import commit_events
from strata.plans.spec import Schema
from strata.plans.workspace import work_dir
from strata.sinks.layers import remove_files, write_bronze, write_quarantine, write_silver
from strata.sources.bronze import BRONZE_PARTITIONS, parse_lines, with_ingestion_partitions

BATCH = "batch_id"
BATCH_BRONZE = (*BRONZE_PARTITIONS, BATCH)
# How many tasks may write the rows of one folder of a batch, unless the caller says so.
SALTS = 8


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping[str, Any] | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _query_id(batch: DataFrame) -> str:
    """The id that the checkpoint gives the query of a batch."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("a batch outside a streaming query")
    return query


# Folders that landed keys are dealt to by their digest.
LANDED_BUCKETS = 64
# Up to so many keys of a batch are looked up by value, which the Bloom filters of the files answer; it is the most that Spark sends to a scan one by one.
FEW_KEYS = 10
_LANDED_DDL = "_message string, bucket string, batch_id string"


def _with_message_key(batch: DataFrame) -> DataFrame:
    """The digest of each message, and the bucket that it falls in."""
    key = F.sha2(F.to_json(F.struct(*rn.RUN_KEY, "payload"), {"ignoreNullFields": "false"}), 256)
    bucket = F.pmod(F.conv(F.substring("_message", 1, 8), 16, 10).cast("bigint"), F.lit(LANDED_BUCKETS)).cast("string")
    return batch.withColumn("_message", key).withColumn("_bucket", bucket)


def _known_keys(spark: SparkSession, landed: str, fresh: DataFrame, writer: str) -> DataFrame | None:
    """Keys that other batches have landed, as far as those of ``fresh`` may be among them: only the buckets of the batch are listed and read, and of
    their files, if the batch has few keys, only those row groups whose Bloom filters hold one. Keys of the batch itself, written before a
    failure, don't count."""
    try:
        known = spark.read.schema(_LANDED_DDL).parquet(landed)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    few = [r[0] for r in fresh.select("_message").limit(FEW_KEYS + 1).collect()]
    if len(few) <= FEW_KEYS:
        known = known.where(F.col("_message").isin(few))
    buckets = [r[0] for r in fresh.select("_bucket").distinct().collect()]
    return known.where(F.col("bucket").isin(buckets) & (F.col(BATCH) != writer)).select("_message")


def _not_landed(batch: DataFrame, landed: str, writer: str) -> DataFrame:
    """First deliveries of a batch: one row per message, without those that other batches have landed. ``batch`` should be persisted."""
    fresh = _with_message_key(batch).dropDuplicates(["_message"])
    known = _known_keys(batch.sparkSession, landed, fresh, writer)
    return fresh if known is None else fresh.join(known, "_message", "left_anti")


def _write_landed(keys: DataFrame, landed: str, writer: str) -> None:
    """One sorted file per bucket, with a Bloom filter over its keys."""
    named = keys.select("_message", F.col("_bucket").alias("bucket"), F.lit(writer).alias(BATCH))
    (
        named.repartition("bucket").sortWithinPartitions("bucket", "_message").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#_message", "true")
        .partitionBy("bucket", BATCH).parquet(landed)
    )


def compact_landed(spark: SparkSession, landed: str) -> None:
    """Bring the keys of all batches but the newest of each stream into one file per bucket. A key that is there twice, as after a crash in between, does
    no harm. Not while a batch is under way, which could miss a file that it listed and would be played again."""
    files = spark.read.schema(_LANDED_DDL).parquet(landed).withColumn("file", F.col("_metadata.file_path"))
    number = F.substring_index(BATCH, "-", -1).try_cast("bigint")
    stream = F.regexp_replace(BATCH, "-[^-]*$", "")
    batches = files.select(BATCH).distinct().select(BATCH, number.alias("_n"), stream.alias("_stream"))
    newest = batches.groupBy("_stream").agg(F.max("_n").alias("_newest"))
    old = batches.join(newest, "_stream").where((F.col("_n") < F.col("_newest")) | F.col(BATCH).startswith("compacted-")).select(BATCH)
    folder = work_dir(spark, "landed")
    files.join(old, BATCH, "left_semi").select("file").distinct().write.parquet(folder)
    listed = spark.read.schema("file string").parquet(folder)
    if not listed.take(1):
        return
    keys = files.join(listed, "file", "left_semi").select("_message", F.col("bucket").alias("_bucket")).distinct()
    _write_landed(keys, landed, f"compacted-{uuid.uuid4().hex}-0")
    remove_files(spark, (r.file for r in listed.toLocalIterator()))


def deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop redelivered messages; keys are remembered for ``delay`` of event time.

    For sources in about the order of their event time only: Spark drops first deliveries that come later than the
    delay as well. ``stream_bronze`` with ``landed`` loses none.
    """
    ntz = tm.utc_ntz(F.col(ts), stream.schema[ts].dataType)
    timed = stream.withColumn("_event_time", F.timestamp_millis(tm.epoch_ms(ntz)))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def stream_bronze(
    messages: DataFrame,
    base: str,
    checkpoint: str,
    ingested_at: str,
    mapping_columns: Sequence[str] | None = None,
    log_path: str | None = None,
    quarantine: str | None = None,
    cluster: bool = False,
    trigger: Mapping[str, Any] | None = None,
    landed: str | None = None,
    redelivery: bool = True,
    salts: int = SALTS,
    packed: bool = False,
) -> StreamingQuery:
    """Land a stream of messages with source, entity, run_id, payload and a timestamp.

    Set ``cluster`` where the rows of a run come in many messages. ``landed`` is a folder for the digests of messages, beside the base unless
    it is given: a message that is delivered again, whenever and by whichever stream, is not landed again, unless ``redelivery`` is off.
    A message without a run id is a run of its own.

    A bad payload fails the batch, so that nothing of it is landed or logged; with a ``quarantine`` it is kept there instead, and its run is
    logged as failed. ``packed`` is for very many small runs: bronze and quarantine hold the run as a column, and a folder per batch.
    """
    keys_at = landed or base.rstrip("/") + "_landed"

    def each(batch: DataFrame, batch_id: int) -> None:
        query = _query_id(batch)
        writer = f"{query}-{batch_id}"
        batch = with_given_run_ids(batch, ingested_at)
        # Kept for the batch, since its keys, rows, failures and runs all come from it.
        whole = batch.persist()
        if redelivery:
            batch = _not_landed(whole, keys_at, writer).drop("_bucket")
            batch.persist()
        bad = None
        try:
            rows = with_ingestion_partitions(payload_rows(batch, mapping_columns), ingested_at)
            if quarantine is None:
                named = F.concat_ws(": ", F.lit("bad payload"), "source", "entity", "run_id", "error")
                rows = rows.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(named).cast("string")))
            good = rows.where(F.col("error").isNull()).drop("error", "payload")
            write_bronze(good.drop("_message").withColumn(BATCH, F.lit(writer)), base, cluster, [BATCH], salts, packed=packed)
            if quarantine is not None:
                # Kept as well: payloads are parsed once for the good rows and once for the bad ones, not for each use of these.
                bad = rows.where(F.col("error").isNotNull()).select(*rn.RUN_KEY, "pos", "payload", "error").persist()
                kept = bad.select(*rn.RUN_KEY, "pos", F.col("payload").alias("input"), F.array("error").alias("reasons"))
                write_quarantine(kept, quarantine, writer, layer="bronze", packed=packed)
            if log_path is not None:
                failed = bad.groupBy(*rn.RUN_KEY).agg(F.min("error").alias("error")) if quarantine is not None else None
                runs, at_ms = batch.select(*rn.RUN_KEY).distinct(), now_ms()
                written = runs if failed is None else runs.join(failed, list(rn.RUN_KEY), "left_anti")
                events = rn.log_status(written, "BRONZE_WRITTEN", at_ms)
                if failed is not None:
                    events = events.unionByName(rn.log_failed(failed, at_ms, F.col("error")))
                commit_events(events, log_path, "bronze", query, batch_id)
            if redelivery:
                _write_landed(_with_message_key(batch).select("_message", "_bucket"), keys_at, writer)
        finally:
            if bad is not None:
                bad.unpersist()
            batch.unpersist()
            whole.unpersist()

    return _start(messages, each, checkpoint, trigger)


def bronze_stream(
    spark: SparkSession, base: str, partitions: Sequence[str] = BATCH_BRONZE, max_files: int = 1000, packed: bool = False
) -> DataFrame:
    """New bronze lines as a stream of ``value`` and folder columns; ``packed`` as they were landed."""
    ddl = ", ".join(["value string", *(f"`{p}` string" for p in partitions)])
    reader = spark.readStream.schema(ddl).option("maxFilesPerTrigger", max_files)
    return reader.parquet(base) if packed else reader.text(base)


def stream_silver(
    lines: DataFrame,
    schema: Schema,
    silver_base: str,
    checkpoint: str,
    params: Mapping[str, Any] | None = None,
    requests: DataFrame | None = None,
    quarantine: str | None = None,
    log_path: str | None = None,
    trigger: Mapping[str, Any] | None = None,
    salts: int = SALTS,
) -> StreamingQuery:
    """Transform a stream of bronze lines.

    Bad rows go to the quarantine with their reasons if there is one, and fail the batch if not.
    ``requests`` gives every run its own params.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        query = _query_id(batch)
        writer = f"{query}-{batch_id}"
        wanted = (F.col("source") == schema.source) & (F.col("entity") == schema.entity)
        own = batch.where(wanted).select("value", *rn.RUN_KEY)
        params_col = None
        if requests is not None:
            own, params_col = rn.rows_with_run_params(own, requests), "params"
        # Kept for the batch, since accepted rows, rejected rows and counts all come from it.
        parsed = parse_lines(own).persist()
        try:
            carry = [*rn.RUN_KEY, *([params_col] if params_col else [])]
            checked = check_rows(parsed, schema, params, params_col=params_col, carry=carry)
            good = checked.enforced() if quarantine is None else checked.accepted()
            write_silver(
                good.withColumn(BATCH, F.lit(writer)), silver_base, schema, params,
                params_col=params_col, extra_partitions=[BATCH], salts=salts,
            )
            if quarantine is not None:
                write_quarantine(checked.rejected(), quarantine, writer)
            if log_path is not None:
                counts = rn.run_metrics(good)
                extra = F.to_json(F.struct(F.col("n_rows").alias("rows"), F.lit(writer).alias("batch")))
                commit_events(rn.log_status(counts, "SILVER_WRITTEN", now_ms(), extra), log_path, "silver", query, batch_id)
        finally:
            parsed.unpersist()

    return _start(lines, each, checkpoint, trigger)
