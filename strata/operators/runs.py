"""The run log and what follows from it.

The log only grows: one event per run and status. The current state of a run is computed from its
events, so a redelivered request never resets a finished run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RUN_KEY = ("source", "entity", "run_id")

# The statuses of a run, in the order of its life.
STATUSES = ("REQUESTED", "BRONZE_WRITTEN", "SILVER_WRITTEN", "FAILED")

RUN_LOG_DDL = (
    "source string, entity string, run_id string, status string, at_ms bigint, "
    "params map<string,string>, extra string"
)
HOUR_MS = 3_600_000


def status_rank(status: Column) -> Column:
    """The place of a status in a run's life, null for null; any other status fails by its name."""
    place = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), status)
    unknown = F.raise_error(F.concat(F.lit("unknown status: "), status)).cast("bigint")
    return (F.when(place == 0, unknown).otherwise(place) - 1).cast("int")


def _at(at_ms: int | Column) -> Column:
    return (F.lit(at_ms) if isinstance(at_ms, int) else at_ms).cast("bigint")


def log_status(
    runs: DataFrame, status: str, at_ms: int | Column, extra: Column | None = None, params: str | None = None
) -> DataFrame:
    """Log events that give every run a status."""
    if status not in STATUSES:
        raise ValueError(f"unknown status: {status}")
    none = F.lit(None)
    return runs.select(
        *RUN_KEY,
        F.lit(status).alias("status"),
        _at(at_ms).alias("at_ms"),
        (F.col(params) if params else none.cast("map<string,string>")).alias("params"),
        (none if extra is None else extra).cast("string").alias("extra"),
    )


def log_requested(requests: DataFrame, at_ms: int | Column) -> DataFrame:
    return log_status(requests, "REQUESTED", at_ms, params="params")


def log_failed(runs: DataFrame, at_ms: int | Column, error: Column) -> DataFrame:
    return log_status(runs, "FAILED", at_ms, extra=F.to_json(F.struct(error.alias("error"))))


def decode_extra(extra: Column) -> Column:
    """Stored JSON text as a VARIANT; text that is not JSON is wrapped under ``_raw``."""
    wrapped = F.to_variant_object(F.named_struct(F.lit("_raw"), extra))
    return F.coalesce(F.try_parse_json(extra), F.when(extra.isNotNull(), wrapped))


def latest_state(run_log: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """Per run: its current status, when it was requested and updated, and the last extra.

    A request counts only while the run has not reached bronze or silver, so a redelivered one resets nothing.
    Time and status are packed into one number.
    """
    return folded_state(fold_events(run_log, keys), keys)


# What the state of a run is made of, in a form that later events can be merged with.
FOLDED_DDL = (
    "source string, entity string, run_id string, reached boolean, moment bigint, moment_done bigint, "
    "requested_at_ms bigint, updated_at_ms bigint, extra_moment bigint, extra string"
)


def fold_events(run_log: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """One row per run: the last moments with and without requests, and the last extra with its moment."""
    rank = status_rank(F.col("status"))
    moment = F.col("at_ms") * 4 + rank
    with_extra = F.when(F.col("extra").isNotNull(), moment)
    return run_log.groupBy(*keys).agg(
        F.bool_or(rank.isin(1, 2)).alias("reached"),
        F.max(moment).alias("moment"),
        F.max(F.when(rank > 0, moment)).alias("moment_done"),
        F.max(F.when(rank == 0, F.col("at_ms"))).alias("requested_at_ms"),
        F.max(F.when(rank > 0, F.col("at_ms"))).alias("updated_at_ms"),
        F.max(with_extra).alias("extra_moment"),
        F.max_by("extra", with_extra).alias("extra"),
    )


def merge_folded(folded: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """Several folded rows of a run, as of a snapshot and of the events after it, as one."""
    most = ("moment", "moment_done", "requested_at_ms", "updated_at_ms", "extra_moment")
    return folded.groupBy(*keys).agg(
        F.bool_or("reached").alias("reached"), *[F.max(c).alias(c) for c in most], F.max_by("extra", "extra_moment").alias("extra")
    )


def folded_state(folded: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    last = F.when(F.col("reached"), F.col("moment_done")).otherwise(F.col("moment"))
    status = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (F.pmod(last, F.lit(4)) + 1).cast("int"))
    return folded.select(*keys, status.alias("status"), "requested_at_ms", "updated_at_ms", "extra")


def run_durations(run_log: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """Per run: first time of each status and the milliseconds between stages."""

    def first(status: str) -> Column:
        return F.min(F.when(F.col("status") == status, F.col("at_ms")))

    times = run_log.groupBy(*keys).agg(
        first("REQUESTED").alias("requested_at_ms"),
        first("BRONZE_WRITTEN").alias("bronze_at_ms"),
        first("SILVER_WRITTEN").alias("silver_at_ms"),
    )
    return times.withColumns(
        {
            "ingest_ms": F.col("bronze_at_ms") - F.col("requested_at_ms"),
            "transform_ms": F.col("silver_at_ms") - F.col("bronze_at_ms"),
            "total_ms": F.col("silver_at_ms") - F.col("requested_at_ms"),
        }
    )


def run_transitions(
    run_log: DataFrame, keys: Sequence[str] = RUN_KEY, tie_break: Sequence[str] = (), slice_ms: int = HOUR_MS
) -> DataFrame:
    """Every step of every run: the status before, the status after, and whether the step is legal.

    A run is cut into time slices, so that one run with a large share of all events is ordered by
    many tasks. Within a slice the previous status is the row before; the first row of a slice takes
    the last status of the slice before it, from a table with one row per run and slice.
    """
    order = ["at_ms", "_rank", *tie_break]
    sliced = run_log.select(
        *keys, "status", "at_ms", *tie_break,
        status_rank(F.col("status")).alias("_rank"),
        F.floor(F.col("at_ms") / slice_ms).alias("_slice"),
    )
    inside = W.partitionBy(*keys, "_slice").orderBy(*order)
    steps = sliced.withColumn("_before", F.lag("status").over(inside))
    ends = sliced.groupBy(*keys, "_slice").agg(F.max_by("status", F.struct(*order)).alias("_end"))
    carried = ends.withColumn("_carried", F.lag("_end").over(W.partitionBy(*keys).orderBy("_slice")))
    named = [c for c in (*keys, "_slice")]
    carried = carried.select(*[F.col(c).alias(f"_c_{c}") for c in named], "_carried")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in named])
    joined = steps.join(carried, same)
    before = F.coalesce("_before", "_carried")
    legal = F.when(F.col("status") == "FAILED", F.lit(True)).otherwise(
        F.col("_rank") == F.coalesce(status_rank(before) + 1, F.lit(0))
    )
    return joined.select(
        *keys, *tie_break, "at_ms", before.alias("from_status"), F.col("status").alias("to_status"), legal.alias("legal")
    )


# The statuses that show a stage of a run is done.
DONE = {"bronze": ("BRONZE_WRITTEN", "SILVER_WRITTEN"), "silver": ("SILVER_WRITTEN",)}


def pending_runs(
    requests: DataFrame, run_log: DataFrame, stage: str = "bronze", keys: Sequence[str] = RUN_KEY
) -> DataFrame:
    """Requests whose stage no event marks as done; first write wins."""
    done = run_log.where(F.col("status").isin(*DONE[stage])).select(*keys)
    return requests.join(done, list(keys), "left_anti")


def rows_with_run_params(rows: DataFrame, requests: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """Rows of requested runs, each with the params of its run.

    Where the requests are small the join is a broadcast that also skips the folders of other runs;
    where they are not, a run with very many rows is split by the adaptive skew join.
    """
    return rows.join(requests.select(*keys, "params").dropDuplicates(list(keys)), list(keys))


def run_metrics(rows: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def artifact_completeness(artifacts: DataFrame, run_log: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """Per run and layer: complete when its log event and its data files exist."""

    def marked(stage: str) -> Column:
        return F.bool_or(F.col("status").isin(*DONE[stage]))

    marks = run_log.groupBy(*keys).agg(marked("bronze").alias("_bronze"), marked("silver").alias("_silver"))
    joined = artifacts.join(marks, list(keys), "left")

    def ok(mark: str, files: str) -> Column:
        return F.coalesce(F.col(mark), F.lit(False)) & (F.col(files) > 0)

    return joined.select(
        *keys, ok("_bronze", "bronze_files").alias("bronze_ok"), ok("_silver", "silver_files").alias("silver_ok")
    )


def reconcile_runs(
    requests: DataFrame, completeness: DataFrame, state: DataFrame, keys: Sequence[str] = RUN_KEY
) -> DataFrame:
    """Requests against files against state: one verdict per requested run."""
    joined = requests.select(*keys).join(state.select(*keys, "status"), list(keys), "left")
    joined = joined.join(completeness, list(keys), "left")
    bronze_ok = F.coalesce("bronze_ok", F.lit(False))
    silver_ok = F.coalesce("silver_ok", F.lit(False))
    ok = F.coalesce(F.col("status") == "SILVER_WRITTEN", F.lit(False)) | silver_ok
    verdict = F.when(ok, F.lit("ok")).when(F.col("status") == "FAILED", F.lit("failed")).otherwise(F.lit("incomplete"))
    return joined.select(
        *keys, "status", bronze_ok.alias("bronze_ok"), silver_ok.alias("silver_ok"),
        ok.alias("ok"), verdict.alias("verdict"),
    )


def verification_summary(reconciled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return reconciled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("verdict") == "ok").alias("ok_runs"),
        F.count_if(F.col("verdict") == "failed").alias("failed_runs"),
        F.count_if(F.col("verdict") == "incomplete").alias("incomplete_runs"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("all_ok"),
    )


def backlog(requests: DataFrame, run_log: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """Waiting and in-flight runs per dataset and stage, from the latest state of each request."""
    state = latest_state(run_log, keys).select(*keys, "status")
    joined = requests.select(*keys).join(state, list(keys), "left")
    at = F.col("status")
    stage = F.when(at.isNull() | (at == "REQUESTED"), F.lit("ingest")).when(at == "BRONZE_WRITTEN", F.lit("transform"))
    group = [k for k in keys if k != keys[-1]]
    return (
        joined.withColumn("stage", stage)
        .where(F.col("stage").isNotNull())
        .groupBy(*group, "stage")
        .agg(F.count_if(F.coalesce(at != "REQUESTED", F.lit(True))).alias("waiting"), F.count_if(at == "REQUESTED").alias("in_flight"))
    )
