"""Batch jobs over many runs at once: payloads to bronze, bronze to silver, verification.

The run is a column and a folder; a batch of runs is one Spark job, not one job per run.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from strata.operators import runs as rn
from strata.operators.mapping import mapped_items, mapped_payloads
from strata.operators.transforms import check_rows
from strata.plans.runlog import append_run_log, commit_events, compact_run_log, has_commit, read_commits, read_run_log, read_run_state
from strata.plans.spec import Schema
from strata.plans.workspace import work_dir
from strata.sinks.layers import ITEM_TEXT, remove_folders, write_bronze, write_quarantine, write_silver
from strata.sources.bronze import (
    BRONZE_PARTITIONS,
    PACKED_PARTITIONS,
    folder_of,
    packed_lines,
    parse_lines,
    text_lines,
    with_ingestion_partitions,
    with_payload_items,
)
from strata.sources.files import folder_value, list_files, scan_artifacts
from strata.sources.silver import dataset_path, read_silver

RUN_KEY = rn.RUN_KEY
MAX_ATTEMPTS = 5
#: The folder level, below the run, of what one job wrote.
COMMIT = "commit"


def now_ms() -> int:
    return int(time.time() * 1000)


def with_given_run_ids(payloads: DataFrame, ingested_at: str | Column) -> DataFrame:
    """Payloads without a run id get one of their own, made from all that is known of them: what is delivered again or evaluated again gets the
    same id, and payloads that differ in anything, the time included, get different ones."""
    at = F.col(ingested_at) if isinstance(ingested_at, str) else ingested_at
    known = [F.col("source"), F.col("entity"), F.col("payload"), at.alias("at")]
    if "params" in payloads.columns:
        known.append(F.array_sort(F.map_entries("params")).alias("params"))
    digest = F.sha2(F.to_json(F.struct(*known), {"ignoreNullFields": "false"}), 256)
    cut = F.regexp_replace(F.substring(digest, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return payloads.withColumn("run_id", F.coalesce(F.when(F.col("run_id") != "", F.col("run_id")), cut))


def one_payload_per_run(payloads: DataFrame) -> DataFrame:
    """One row per run, however often its payload was delivered, with ``several`` where its payloads differ. One shuffle."""
    digest = F.coalesce(F.sha2("payload", 256), F.lit(""))
    rows = payloads.select(*RUN_KEY, F.struct(*payloads.columns).alias("_row"), digest.alias("_digest"))
    same = rows.groupBy(*RUN_KEY).agg(F.first("_row").alias("_row"), (F.min("_digest") != F.max("_digest")).alias("several"))
    return same.select("_row.*", "several")


def payload_rows(payloads: DataFrame, mapping_columns: Sequence[str] | None = None) -> DataFrame:
    """Payload items, mapped to objects where the contract says so, with ``error`` for bad ones."""
    if mapping_columns is not None:
        return mapped_items(payloads, "payload", mapping_columns)
    checked = with_payload_items(payloads)
    none = F.array(F.lit(None).cast(checked.schema["items"].dataType.elementType))
    items = checked.select(*payloads.columns, "error", F.posexplode(F.coalesce("items", none)).alias("pos", "_item"))
    return items.withColumns({"row": F.col("_item.row"), ITEM_TEXT: F.col("_item.text")}).drop("_item")


def land_bronze(
    spark: SparkSession,
    payloads: DataFrame,
    base: str,
    log_path: str,
    ingested_at: str | Column,
    mapping_columns: Sequence[str] | None = None,
    at_ms: int | None = None,
    job_id: str | None = None,
    packed: bool = False,
) -> None:
    """Write the payloads of runs that are not landed yet, and log each run.

    ``payloads`` has one row per run with source, entity, run_id, params and the payload text. A payload without a run id
    is a run of its own. A run whose payload is bad, or which has several that differ, is logged as failed and not written; the
    others are not held up by it. Runs landed before are logged as skipped. A job that is repeated under its ``job_id`` does nothing if it
    came to its end, or else all again, and its events replace those of the first time.

    ``packed`` is for very many small runs: they share the files of a folder of their job, which the events of the runs name, and ``read_packed``
    shows what the last event of each run names. Use it for a base always or never.
    """
    at_ms, job = at_ms or now_ms(), job_id or uuid.uuid4().hex
    if job_id and has_commit(spark, log_path, "bronze", job):
        return
    log = read_run_log(spark, log_path, job)
    # Payloads that name their run are not read for that.
    named = F.coalesce(F.col("run_id") != "", F.lit(False))
    unnamed = with_given_run_ids(payloads.where(~named), ingested_at)
    asked = payloads.where(named).select(*RUN_KEY).unionByName(unnamed.select(*RUN_KEY))
    _log_skipped(spark, asked, log, "bronze", log_path, at_ms, job)
    todo = one_payload_per_run(rn.pending_runs(with_given_run_ids(payloads, ingested_at), log, "bronze"))
    placed = _with_fixed_partitions(spark, with_ingestion_partitions(todo, ingested_at), log_path, at_ms)
    checked = with_payload_items(placed) if mapping_columns is None else mapped_payloads(placed, "payload", mapping_columns)
    # A payload is good or bad as a whole.
    several = F.when(F.col("several"), F.lit("payloads of the run differ"))
    checked = checked.withColumn("error", F.coalesce(several, "error")).drop("several")
    failed = _log_failures(checked.where(F.col("error").isNotNull()).select(*RUN_KEY, "error"), log_path, at_ms, "bronze-failed", job)
    good = checked.where(F.col("error").isNull()).drop("error", "payload")
    rows = good.select(*[c for c in good.columns if c != "items"], F.posexplode("items").alias("pos", "row"))
    if mapping_columns is None:
        rows = rows.withColumns({ITEM_TEXT: F.col("row.text"), "row": F.col("row.row")})
    extra = None
    if packed:
        # Named anew each time, so that what an attempt left behind never counts for the next one.
        own = F.lit(uuid.uuid4().hex)
        rows, extra = rows.withColumn(COMMIT, own), F.to_json(F.struct(own.alias(COMMIT)))
    write_bronze(rows, base, extra_partitions=[COMMIT] if packed else (), packed=packed)
    done = todo.join(failed, list(RUN_KEY), "left_anti")
    commit_events(rn.log_status(done, "BRONZE_WRITTEN", at_ms, extra, params="params"), log_path, "bronze", job)


def read_packed(spark: SparkSession, base: str, log_path: str, path: str | None = None) -> DataFrame:
    """Lines of packed bronze, each run as its last landing left it; of ``path`` below the base, if it is given."""
    lines = packed_lines(spark, path or base, (*PACKED_PARTITIONS, COMMIT), base)
    published = published_commits(read_run_log(spark, log_path), "BRONZE_WRITTEN")
    return lines.join(published, [*RUN_KEY, COMMIT], "left_semi").drop(COMMIT)


def _log_skipped(spark: SparkSession, runs: DataFrame, log: DataFrame, stage: str, log_path: str, at_ms: int, job: str) -> None:
    """Runs that an event marks as done already get one more event, which says so. Written only where there are any."""
    done = log.where(F.col("status").isin(*rn.DONE[stage])).select(*RUN_KEY)
    skipped = runs.select(*RUN_KEY).distinct().join(done, list(RUN_KEY), "left_semi")
    extra = F.to_json(F.struct(F.lit(True).alias("skipped")))
    folder = work_dir(spark, "skipped")
    rn.log_status(skipped, rn.DONE[stage][0], at_ms, extra).write.parquet(folder)
    kept = spark.read.schema(rn.RUN_LOG_DDL).parquet(folder)
    if kept.take(1):
        commit_events(kept, log_path, f"{stage}-skipped", job)


def attempts_path(log_path: str) -> str:
    """Where the first attempts of landings are kept: beside the run log, since they are no state of a run."""
    return log_path.rstrip("/") + "_attempts"


def _with_fixed_partitions(spark: SparkSession, todo: DataFrame, log_path: str, at_ms: int) -> DataFrame:
    """Give every run the day and hour of its first attempt, which is kept before anything is written, so that an
    attempt after a crash replaces the folder of the one before instead of adding another."""
    levels, path = ["ingestion_dt", "ingestion_hr"], attempts_path(log_path)
    ddl = "source string, entity string, run_id string, at_ms bigint, ingestion_dt string, ingestion_hr string"

    def first_attempts() -> DataFrame:
        try:
            kept = spark.read.schema(ddl).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = spark.createDataFrame([], ddl)
        return kept.groupBy(*RUN_KEY).agg(F.min(F.struct("at_ms", *levels)).alias("_first"))

    new = todo.join(first_attempts(), list(RUN_KEY), "left_anti")
    new.select(*RUN_KEY, F.lit(at_ms).cast("bigint").alias("at_ms"), *levels).write.mode("append").parquet(path)
    joined = todo.drop(*levels).join(first_attempts(), list(RUN_KEY))
    return joined.withColumns({c: F.col(f"_first.{c}") for c in levels}).drop("_first")


def _log_failures(failed: DataFrame, log_path: str, at_ms: int, stage: str, job: str) -> DataFrame:
    """Log runs with their error as failed and return their keys. They are kept in a folder of the job, so that jobs of one
    moment never take each other's failures for their own."""
    folder = work_dir(failed.sparkSession, "failed")
    failed.write.parquet(folder)
    kept = failed.sparkSession.read.schema(failed.schema).parquet(folder)
    commit_events(rn.log_failed(kept, at_ms, F.col("error")), log_path, stage, job)
    return kept.select(*RUN_KEY)


def _written(runs: DataFrame, name: str) -> DataFrame:
    """A table of runs, written down: its size is known then, and one that is small enough is sent to the rows, which stay in the tasks that
    read them. Brought together by run, the rows of few runs would end in as few tasks."""
    return _kept(runs, work_dir(runs.sparkSession, name))


def _kept(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def run_silver(
    spark: SparkSession,
    schema: Schema,
    requests: DataFrame,
    bronze_base: str,
    silver_base: str,
    log_path: str,
    on_error: str = "fail",
    quarantine_base: str | None = None,
    force: bool = False,
    logical_types: bool = False,
    at_ms: int | None = None,
    tried: DataFrame | None = None,
    dead_letter_base: str | None = None,
    job_id: str | None = None,
    committed: bool = False,
    packed: bool = False,
) -> None:
    """Transform every landed run that is not in silver yet, and log each run.

    A bad row fails the job (``fail``), fails its run and no other (``fail_run``), or is set aside
    (``quarantine``). Bronze is read once; for ``fail_run`` and ``quarantine`` the checked rows are kept in a work folder meanwhile. ``force`` redoes
    finished runs, and removes the folders that a run had and has no more; a run that fails keeps what it had. Only folders of this dataset are listed.
    Runs in silver already are logged as skipped. ``tried`` says how often the rows of a run were tried before; ``retry_silver`` gives it. A job that is
    repeated under its ``job_id`` does nothing if it came to its end, or else all again, and its events replace those of the first time.

    With ``committed`` every job writes folders of its own, one level below the run, and the last successful event of a run names the ones
    that count: ``read_committed`` shows what that event published, whatever a later job wrote before it failed. Use it for a dataset always or never.
    ``packed`` says that bronze was landed so.
    """
    if on_error not in ("fail", "fail_run", "quarantine"):
        raise ValueError(f"unknown on_error: {on_error}")
    if on_error == "quarantine" and quarantine_base is None:
        raise ValueError("quarantine needs a folder for rejected rows")
    at_ms, job = at_ms or now_ms(), job_id or uuid.uuid4().hex
    if job_id and has_commit(spark, log_path, "silver", job):
        return
    log = read_run_log(spark, log_path, job)
    landed = log.where(F.col("status").isin(*rn.DONE["bronze"])).select(*RUN_KEY)
    own = requests.where((F.col("source") == schema.source) & (F.col("entity") == schema.entity))
    todo = own.select(*RUN_KEY, "params").join(landed, list(RUN_KEY), "left_semi")
    if not force:
        _log_skipped(spark, todo, log, "silver", log_path, at_ms, job)
        todo = rn.pending_runs(todo, log, "silver")
    todo = _written(todo, "runs")
    own_bronze = folder_of(bronze_base, source=schema.source, entity=schema.entity)
    if packed:
        lines = read_packed(spark, bronze_base, log_path, own_bronze)
    else:
        lines = text_lines(spark, own_bronze, BRONZE_PARTITIONS, bronze_base)
    before = _files_of(spark, schema, todo, silver_base) if force and not committed else None
    rows = parse_lines(rn.rows_with_run_params(lines.drop("ingestion_dt", "ingestion_hr"), todo))
    carry = [*RUN_KEY, "params"]
    checked = check_rows(rows, schema, params_col="params", carry=carry, logical_types=logical_types)
    aside = work_dir(spark, "checked")
    try:
        if on_error != "fail":
            checked = checked.kept(lambda rows: _kept(rows, aside))
        if on_error == "fail":
            good = checked.enforced()
        elif on_error == "fail_run":
            reason = F.min(F.element_at("reasons", 1)).alias("error")
            failed = checked.rejected().groupBy(*RUN_KEY).agg(reason)
            failed = _log_failures(failed, log_path, at_ms, "silver-failed", job)
            good = checked.accepted().join(failed, list(RUN_KEY), "left_anti")
        else:
            # Rejected rows are set aside first: a run is not logged as done before they are kept.
            rejected = checked.rejected()
            if tried is not None:
                rejected = rejected.join(tried, list(RUN_KEY), "left")
                rejected = rejected.withColumn("attempt", F.coalesce("_tried", F.lit(0)) + 1).drop("_tried")
                write_quarantine(rejected.where(F.col("attempt") >= MAX_ATTEMPTS), dead_letter_base, f"{at_ms}-{job}")
                rejected = rejected.where(F.col("attempt") < MAX_ATTEMPTS)
            write_quarantine(rejected, quarantine_base, f"{at_ms}-{job}")
            good = checked.accepted()
        own = _deduplicated(good, schema)
        extra = [COMMIT] if committed else []
        write_silver(own.withColumns({c: F.lit(job) for c in extra}), silver_base, schema, params_col="params", extra_partitions=extra)
    except Exception as error:
        commit_events(rn.log_failed(todo, at_ms, F.lit(str(error))), log_path, "silver-failed", job)
        raise
    finally:
        remove_folders(spark, [aside])
    finished = todo
    if on_error == "fail_run":
        finished = todo.join(failed, list(RUN_KEY), "left_anti")
    if before is not None:
        left = _files_of(spark, schema, finished, silver_base).join(before, "file", "left_semi")
        remove_folders(spark, (r["folder"] for r in left.select("folder").distinct().toLocalIterator()))
    commit_events(_silver_events(spark, schema, finished, silver_base, at_ms, job if committed else None), log_path, "silver", job)


def published_commits(log: DataFrame, status: str = "SILVER_WRITTEN") -> DataFrame:
    """For each run the commit that its last event of a status published; runs written without commits are not among them."""
    commit = F.get_json_object("extra", f"$.{COMMIT}")
    events = log.where((F.col("status") == status) & commit.isNotNull()).select(*RUN_KEY, "at_ms", commit.alias(COMMIT))
    return events.groupBy(*RUN_KEY).agg(F.max_by(COMMIT, F.struct("at_ms", COMMIT)).alias(COMMIT))


def read_committed(spark: SparkSession, base: str, schema: Schema, log_path: str, **where: Any) -> DataFrame:
    """The rows of a dataset that successful jobs published, each run as its last such job left it. Folders that don't count are not read, as
    far as the planner can send the commits to the scan."""
    rows = read_silver(spark, base, schema, extra_partitions=[COMMIT], **where)
    published = published_commits(read_run_log(spark, log_path))
    return rows.join(published, [*RUN_KEY, COMMIT], "left_semi").drop(COMMIT)


def remove_unpublished(spark: SparkSession, base: str, schema: Schema, log_path: str, before_ms: int) -> int:
    """Remove folders of commits that don't count: those of failed jobs, and those that later ones took the place of. Commits of jobs that
    logged nothing at or before ``before_ms`` stay, since they may be under way. The number of removed folders."""
    log = read_run_log(spark, log_path)
    folders = _files_of(spark, schema, None, base)
    level = F.regexp_extract("folder", f"/{COMMIT}=([^/]*)$", 1).alias(COMMIT)
    keyed = folders.select("folder", level, *[folder_value(F.concat("folder", F.lit("/")), k).alias(k) for k in RUN_KEY]).distinct()
    ended = read_commits(spark, log_path).where(F.col("at_ms") <= before_ms).select(F.col("writer").alias(COMMIT)).distinct()
    stale = keyed.join(published_commits(log), [*RUN_KEY, COMMIT], "left_anti").join(ended, COMMIT, "left_semi")
    n = 0
    for row in stale.select("folder").toLocalIterator():
        remove_folders(spark, [row.folder])
        n += 1
    return n


def _files_of(spark: SparkSession, schema: Schema, runs: DataFrame | None, silver_base: str) -> DataFrame:
    """The silver files of runs, or of all, written down, since they may go. Files are listed, and no row of them is read."""
    try:
        found = list_files(spark, dataset_path(silver_base, schema), "*.parquet").select("path")
        if runs is not None:
            run_id = folder_value(F.regexp_extract("path", "^.*(/run_id=[^/]*/)", 1), "run_id")
            found = found.withColumns({"source": F.lit(schema.source), "entity": F.lit(schema.entity), "run_id": run_id})
            found = found.join(runs.select(*RUN_KEY).distinct(), list(RUN_KEY), "left_semi")
        found = found.select(F.col("path").alias("file"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "file string")
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    kept = work_dir(spark, "files")
    found.select("file", folder.alias("folder")).write.parquet(kept)
    return spark.read.schema("file string, folder string").parquet(kept)


def retry_silver(
    spark: SparkSession,
    schema: Schema,
    requests: DataFrame,
    bronze_base: str,
    silver_base: str,
    log_path: str,
    quarantine_base: str,
    dead_letter_base: str,
    **options,
) -> None:
    """Redo the runs that have rows in quarantine, with the spec as it is now.

    A run is redone from bronze as a whole and replaces its folders, so that mended rows arrive once however often this is
    repeated. Rows that fail again go back with one attempt more, and from the fifth on to the dead letters; what was in
    quarantine before is removed at the end.
    """
    own = folder_of(quarantine_base, source=schema.source, entity=schema.entity, layer="silver")
    try:
        ddl = "source string, entity string, layer string, run_id string, attempt int, batch_id string"
        kept = spark.read.schema(ddl).option("basePath", quarantine_base).parquet(own)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    landed = read_run_log(spark, log_path).where(F.col("status").isin(*rn.DONE["bronze"])).select(*RUN_KEY)
    again = _written(requests.join(landed, list(RUN_KEY), "left_semi"), "again")
    # Only folders of runs that are done again, written down before new ones come; those of other runs stay.
    folder = work_dir(spark, "tried")
    asked = kept.join(again.select(*RUN_KEY), list(RUN_KEY), "left_semi")
    asked.groupBy(*RUN_KEY, "attempt", "batch_id").agg(F.lit(1).alias("_one")).drop("_one").write.parquet(folder)
    folders = spark.read.schema("source string, entity string, run_id string, attempt int, batch_id string").parquet(folder)
    tried = folders.groupBy(*RUN_KEY).agg(F.max("attempt").alias("_tried"))
    run_silver(
        spark, schema, again.join(tried.select(*RUN_KEY), list(RUN_KEY), "left_semi"), bronze_base, silver_base, log_path, "quarantine", quarantine_base,
        force=True, tried=tried, dead_letter_base=dead_letter_base, **options,
    )
    old = folders.select("run_id", "attempt", "batch_id").toLocalIterator()
    remove_folders(spark, (folder_of(own, run_id=r["run_id"], attempt=str(r["attempt"]), batch_id=r["batch_id"]) for r in old))


def _deduplicated(good: DataFrame, schema: Schema) -> DataFrame:
    """The ``deduplicate`` key: one row per key and run; ``true`` means the declared unique key."""
    from strata.operators.keys import deduplicate

    asked = schema.transforms.get("deduplicate")
    if not asked:
        return good
    asked = {} if asked is True else {"keys": asked} if isinstance(asked, list) else asked
    keys = asked.get("keys") or schema.transforms.get("unique_key")
    return deduplicate(good, [*RUN_KEY, *keys], asked.get("order_by") or [], asked.get("keep", "last"))


def _silver_events(
    spark: SparkSession, schema: Schema, runs: DataFrame, silver_base: str, at_ms: int, commit: str | None = None
) -> DataFrame:
    """Silver events with the rows of each run, counted from file footers; no rows means empty."""
    try:
        rows = read_silver(spark, silver_base, schema, extra_partitions=[COMMIT] if commit else [])
        rows = rows.where(F.col(COMMIT) == commit) if commit else rows
        counts = rn.run_metrics(rows.join(runs.select(*RUN_KEY), list(RUN_KEY), "left_semi"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        counts = runs.select(*RUN_KEY, F.lit(0).cast("bigint").alias("n_rows")).limit(0)
    joined = runs.join(counts, list(RUN_KEY), "left")
    n_rows = F.coalesce("n_rows", F.lit(0))
    named = [F.lit(commit).alias(COMMIT)] if commit else []
    extra = F.to_json(F.struct(n_rows.alias("rows"), (n_rows == 0).alias("empty"), *named))
    return rn.log_status(joined, "SILVER_WRITTEN", at_ms, extra)


def retry_quarantine(rejected: DataFrame, schema: Schema, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Try set-aside rows again: rows now accepted, rows to try once more, and dead letters.

    A row is tried five times in all.
    """
    carry = [c for c in rejected.columns if c not in ("input", "reasons", "params", "batch_id", "layer")]
    rows = parse_lines(rejected.withColumnRenamed("input", "value").drop("reasons", "batch_id", "layer"))
    checked = check_rows(rows, schema, carry=carry, **options)
    again = checked.rejected().withColumn("attempt", F.col("attempt") + 1)
    good = checked.accepted().drop("attempt")
    return good, again.where(F.col("attempt") < MAX_ATTEMPTS), again.where(F.col("attempt") >= MAX_ATTEMPTS)


def verify_runs(
    spark: SparkSession, requests: DataFrame, bronze_base: str, silver_base: str, log_path: str
) -> DataFrame:
    """One pass over requests, files and log: a verdict per requested run."""
    log = read_run_log(spark, log_path)
    complete = rn.artifact_completeness(scan_artifacts(spark, bronze_base, silver_base), log)
    return rn.reconcile_runs(requests, complete, read_run_state(spark, log_path))


__all__ = [
    "append_run_log",
    "commit_events",
    "compact_run_log",
    "land_bronze",
    "payload_rows",
    "read_committed",
    "read_packed",
    "read_run_log",
    "read_run_state",
    "remove_unpublished",
    "retry_quarantine",
    "retry_silver",
    "run_silver",
    "verify_runs",
]
