"""The stored run log: commits of events, each written once, and snapshots of what came before.

A commit is a folder named by who wrote it: a stage, a writer (a job or a stream) and, for a stream, the number of the batch. Whoever
commits again under the same name, as a batch that is played a second time or a job that is repeated under its id, replaces the
folder, so events never count twice.

Folders below the log's path:

- ``events/stage=/writer=/batch=``: commits since the last snapshot;
- ``history/n=/day=``: events that snapshot n took in, by the day they happened;
- ``state/n=/day=``: one row per run as of snapshot n, by the day of its last event, in a form that can be merged with later events;
- ``replaced/n=``: commits that snapshot n took in although one before it had, since they were made again;
- ``published/n=``: the files that snapshot n took in. A snapshot counts from the moment this folder is complete.

``compact_run_log`` makes a snapshot. Files it took in stay until the next one, so that readers under way find what they listed. The newest
batch of a stream is left out, as it is the one that may be played again; a commit that is replaced after it was taken in counts
instead of the old one.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import runs as rn
from strata.sinks.layers import remove_files, remove_folders
from strata.sources.files import folder_value, list_files

COMMIT = ("stage", "writer", "batch")
_COMMIT_DDL = "stage string, writer string, batch string"
#: The batch of a writer that commits once.
ONCE = "once"


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows below a folder, or none where it doesn't exist yet."""
    try:
        return spark.read.schema(ddl).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl).withColumn("_metadata", F.lit(None).cast("struct<file_path:string>"))


def commit_events(events: DataFrame, log: str, stage: str, writer: str, batch: int | str = ONCE) -> None:
    """Write events as one commit, instead of what was committed under its name before."""
    if not all(re.fullmatch("[A-Za-z0-9._-]+", str(part)) for part in (stage, writer, batch)):
        raise ValueError(f"not a name of a commit: {stage}, {writer}, {batch}")
    folder = f"{log}/events/stage={stage}/writer={writer}/batch={batch}"
    # No marker file, so that an emptied folder is empty.
    events.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)


def has_commit(spark: SparkSession, log: str, stage: str, writer: str, batch: int | str = ONCE) -> bool:
    """Whether a commit was made: its folder is there, or a snapshot took in its events."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/events/stage={stage}/writer={writer}/batch={batch}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return True
    last, _ = _published(spark, log)
    own = (F.col("stage") == stage) & (F.col("writer") == writer) & (F.col("batch") == str(batch))
    return bool(last) and bool(_history(spark, log, last).where(own).take(1))


def append_run_log(events: DataFrame, log: str) -> None:
    """Add events whose writer has no name: a second call adds them again."""
    commit_events(events, log, "added", uuid.uuid4().hex)


def _files(spark: SparkSession, log: str) -> DataFrame:
    """The files of all commits that are there, those without events as well: file, stage, writer, batch."""
    try:
        files = list_files(spark, f"{log}/events", "*.parquet").select(F.col("_metadata.file_path").alias("file"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "file string")
    return files.select("file", *[folder_value(F.col("file"), c).alias(c) for c in COMMIT])


def _published(spark: SparkSession, log: str) -> tuple[int, DataFrame]:
    """The number of the last snapshot, 0 if there is none, and the files it took in."""
    rows = _read(spark, f"{log}/published", f"{_COMMIT_DDL}, file string, n int")
    last = rows.agg(F.max("n")).first()[0] or 0
    return last, rows.where(F.col("n") == last)


def _tail(spark: SparkSession, log: str, covered: DataFrame) -> DataFrame:
    """Events after the last snapshot, with the commit and the file they are in."""
    events = _read(spark, f"{log}/events", f"{rn.RUN_LOG_DDL}, {_COMMIT_DDL}").withColumn("file", F.col("_metadata.file_path"))
    return events.join(covered.select("file"), "file", "left_anti")


def read_run_log(spark: SparkSession, log: str, besides: str | None = None) -> DataFrame:
    """All events ever committed, but for those of the writer ``besides``; an empty log where nothing was written yet."""
    columns = [f.name for f in spark.createDataFrame([], rn.RUN_LOG_DDL).schema.fields]
    last, covered = _published(spark, log)
    tail = _tail(spark, log, covered)
    # A writer that commits anew replaces files under the eyes of whoever reads them.
    others = F.lit(True) if besides is None else F.col("writer") != besides
    tail = tail.where(others)
    if not last:
        return tail.select(*columns)
    # A commit that was made again later counts as it is now.
    kept = _history(spark, log, last).where(others).join(tail.select(*COMMIT).distinct(), list(COMMIT), "left_anti")
    return kept.select(*columns).unionByName(tail.select(*columns))


def _history(spark: SparkSession, log: str, last: int) -> DataFrame:
    """Events of all snapshots up to the last, without commits that a later one took in again."""
    rows = _read(spark, f"{log}/history", f"{rn.RUN_LOG_DDL}, {_COMMIT_DDL}, n int, day string").where(F.col("n") <= last)
    again = _read(spark, f"{log}/replaced", f"{_COMMIT_DDL}, n int").where(F.col("n") <= last)
    same = [F.col(f"h.{c}") == F.col(f"r.{c}") for c in COMMIT]
    return rows.drop("_metadata").alias("h").join(again.drop("_metadata").alias("r"), [*same, F.col("h.n") < F.col("r.n")], "left_anti")


def read_commits(spark: SparkSession, log: str) -> DataFrame:
    """The commits since the last snapshot and those taken in: stage, writer, batch, at_ms (of their last event)."""
    columns = [*COMMIT, "at_ms"]
    last, covered = _published(spark, log)
    rows = _tail(spark, log, covered).select(*columns)
    if last:
        rows = rows.unionByName(_history(spark, log, last).select(*columns))
    return rows.groupBy(*COMMIT).agg(F.max("at_ms").alias("at_ms"))


def _state(spark: SparkSession, log: str, n: int) -> DataFrame:
    return _read(spark, f"{log}/state", f"{rn.FOLDED_DDL}, n int, day string").where(F.col("n") == n).drop("n", "day", "_metadata")


def read_run_state(spark: SparkSession, log: str) -> DataFrame:
    """What ``latest_state`` gives for all events, from the last snapshot and the events after it: what is read grows with
    the number of runs and with what happened since, not with the number of events or commits before."""
    last, covered = _published(spark, log)
    folded = rn.fold_events(_tail(spark, log, covered))
    if last:
        folded = rn.merge_folded(_state(spark, log, last).unionByName(folded))
    return rn.folded_state(folded)


def compact_run_log(spark: SparkSession, log: str) -> int:
    """Take the commits since the last snapshot into a new one; the number of the last snapshot afterwards.

    One job at a time. A job that ends before it publishes leaves nothing that counts, and the next one writes the same folders
    anew. What a snapshot took in is removed by the job after it, with the state before it.
    """
    last, covered = _published(spark, log)
    remove_files(spark, (r.file for r in covered.select("file").toLocalIterator()))
    tail = _tail(spark, log, covered)
    commits = _files(spark, log).join(covered.select("file"), "file", "left_anti")
    number = F.col("batch").try_cast("bigint")
    newest = commits.groupBy("stage", "writer").agg(F.max(number).alias("_newest"))
    taken = commits.join(newest, ["stage", "writer"]).where(number.isNull() | (number < F.col("_newest"))).select(*COMMIT, "file")
    n = last + 1
    published = f"{log}/published/n={n}"
    draft = f"{log}/drafts/{uuid.uuid4().hex}"
    taken.coalesce(1).write.parquet(draft)
    taken = spark.read.schema(f"{_COMMIT_DDL}, file string").parquet(draft)
    if not taken.take(1):
        remove_folders(spark, [draft])
        return last
    events = tail.join(taken.select("file"), "file", "left_semi").drop("file", "_metadata")
    days = lambda at: F.date_format(F.timestamp_millis(at), "yyyy-MM-dd")
    by_day = events.withColumn("day", F.coalesce(days("at_ms"), F.lit("none"))).hint("rebalance", "day")
    by_day.write.mode("overwrite").partitionBy("day").parquet(f"{log}/history/n={n}")
    replaced = f"{log}/replaced/n={n}"
    if last:
        known = _history(spark, log, last).select(*COMMIT)
        taken.select(*COMMIT).distinct().join(known, list(COMMIT), "left_semi").coalesce(1).write.mode("overwrite").parquet(replaced)
    if last and spark.read.schema(_COMMIT_DDL).parquet(replaced).take(1):
        # What the old commits said can't be taken out of the state, so it is made anew.
        folded = rn.fold_events(_history(spark, log, n))
    else:
        folded = rn.fold_events(events)
        if last:
            folded = rn.merge_folded(_state(spark, log, last).unionByName(folded))
    moment = F.coalesce("updated_at_ms", "requested_at_ms")
    dated = folded.withColumn("day", F.coalesce(days(moment), F.lit("none"))).hint("rebalance", "day")
    dated.write.mode("overwrite").partitionBy("day").parquet(f"{log}/state/n={n}")
    taken.coalesce(1).write.mode("overwrite").parquet(published)
    remove_folders(spark, [draft, *([f"{log}/state/n={last - 1}", f"{log}/published/n={last - 1}"] if last > 1 else [])])
    return n
