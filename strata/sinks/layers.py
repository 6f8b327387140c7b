"""Partitioned, rerun-safe writes of the bronze and silver layers.

Both layers keep one folder per run. A write replaces the folders it writes and no others, so
repeating a failed write leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.spec import Schema, SpecError
from strata.sources.bronze import BRONZE_PARTITIONS, PACKED_PARTITIONS

# A column with the JSON text of a payload item as it was delivered.
ITEM_TEXT = "_item_text"
# Keeps a file well below the size a whole-file digest can hold in one row.
MAX_RECORDS_PER_FILE = 1_000_000


def _cluster(df: DataFrame, partitions: Sequence[str], salts: int | None = None) -> DataFrame:
    """Bring the rows of a folder together for few files, and yet not into one task.

    Adaptive execution splits a folder that holds a large share of the rows over several tasks, and
    merges small ones. It is off inside a stream; there ``salts`` spreads each folder over that many
    tasks, by the task the rows come from, which is the same when a task is run again.
    """
    if salts is None:
        return df.hint("rebalance", *partitions)
    return df.repartition(*[F.col(f"`{p}`") for p in partitions], F.pmod(F.spark_partition_id(), F.lit(salts)))


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders that a later write has made obsolete."""
    files = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        folder = files.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_files(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove files, and the folders they leave empty. Paths are written as links, as Spark shows them."""
    files = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        file = files.Path(spark._jvm.java.net.URI(path))
        system = file.getFileSystem(spark._jsc.hadoopConfiguration())
        system.delete(file, False)
        folder = file.getParent()
        if system.exists(folder) and not len(system.listStatus(folder)):
            system.delete(folder, False)


def _write(
    df: DataFrame, base: str, file_format: str, partitions: Sequence[str], max_records: int, **options: Any
) -> None:
    (
        df.write.format(file_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .options(**options)
        .partitionBy(*partitions)
        .save(base)
    )


def to_json_line(df: DataFrame, row: str | None = "row", carry: Sequence[str] = ()) -> Column:
    """A row as a JSON text that keeps null fields: a VARIANT column, or all columns besides carried ones."""
    if row is not None and row in df.columns and isinstance(df.schema[row].dataType, T.VariantType):
        # A JSON null is a row, too.
        return F.coalesce(F.to_json(row), F.lit("null"))
    own = [F.col(f"`{c}`") for c in df.columns if c not in carry]
    return F.to_json(F.struct(*own), {"ignoreNullFields": "false"})


def write_bronze(
    df: DataFrame,
    base: str,
    cluster: bool = False,
    extra_partitions: Sequence[str] = (),
    salts: int | None = None,
    max_records: int = MAX_RECORDS_PER_FILE,
    packed: bool = False,
) -> None:
    """Write JSON lines under source, entity, ingestion day and hour, and run.

    Payload items already lie together in payload order, so nothing is shuffled by default; set
    ``cluster`` for rows whose runs are spread over many tasks. ``packed`` is for very many small runs: the run is a column
    beside the line, in Parquet, so that files go by the size of the data and not by the number of runs. What such a write may replace is
    for its caller to say, by a folder of its own in ``extra_partitions``.
    """
    partitions = [*(PACKED_PARTITIONS if packed else BRONZE_PARTITIONS), *extra_partitions]
    missing = [p for p in (*partitions, "run_id") if p not in df.columns]
    if missing:
        raise ValueError(f"bronze rows lack {missing}")
    carry = [*partitions, "run_id", "pos", "params"]
    line = to_json_line(df, "row", carry)
    if ITEM_TEXT in df.columns:
        # Objects are written as they came.
        line = F.when(F.col(ITEM_TEXT).startswith("{") & (F.schema_of_variant("row") != "STRING"), F.col(ITEM_TEXT)).otherwise(line)
    lines = df.select(line.alias("value"), *(["run_id"] if packed else []), *partitions)
    _write(_cluster(lines, partitions, salts) if cluster else lines, base, "parquet" if packed else "text", partitions, max_records)


def silver_partitions(schema: Schema) -> list[str]:
    """The folder levels of a silver dataset."""
    return ["source", "entity", *dict.fromkeys((*schema.by_params, *schema.by_columns)), "run_id"]


def with_silver_partitions(
    df: DataFrame,
    schema: Schema,
    params: Mapping[str, Any] | None = None,
    params_col: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Add the folder columns. A data column of the same name as a parameter stands for both."""
    params = params or {}
    added: dict[str, Column] = {}
    if "source" not in df.columns:
        added["source"] = F.lit(schema.source)
    if "entity" not in df.columns:
        added["entity"] = F.lit(schema.entity)
    if run_id is not None:
        added["run_id"] = F.lit(run_id)
    for name in schema.by_params:
        if params_col is not None:
            unknown = F.raise_error(F.lit(f"partitioning param missing: {name}"))
            value = F.when(F.map_contains_key(F.col(params_col), name), F.col(params_col)[name]).otherwise(unknown)
        elif name in params:
            value = F.lit(str(params[name]))
        else:
            raise SpecError(f"partitioning param missing: {name}")
        if name not in df.columns:
            added[name] = value
    for name in schema.by_columns:
        if name not in df.columns:
            raise SpecError(f"partitioning column missing: {name}")
    return df.withColumns(added)


def write_silver(
    df: DataFrame,
    base: str,
    schema: Schema,
    params: Mapping[str, Any] | None = None,
    *,
    params_col: str | None = None,
    run_id: str | None = None,
    extra_partitions: Sequence[str] = (),
    salts: int | None = None,
    max_records: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Write snappy Parquet, one folder per run below the partition values of the spec."""
    placed = with_silver_partitions(df, schema, params, params_col, run_id)
    partitions = [*silver_partitions(schema), *extra_partitions]
    data = [c for c in placed.columns if c not in partitions and c != params_col]
    placed = placed.select(*[f"`{c}`" for c in (*data, *partitions)])
    placed = _cluster(placed, partitions, salts)
    _write(placed, base, "parquet", partitions, max_records, compression="snappy")


QUARANTINE_PARTITIONS = ("source", "entity", "layer", "run_id", "attempt", "batch_id")


def write_quarantine(
    rejected: DataFrame, base: str, batch_id: str | int, attempt: int = 1, layer: str = "silver", packed: bool = False
) -> None:
    """Write rejected rows with their reasons, one folder per run, layer, attempt and batch, so that no writer
    replaces the rows of another and a run can be taken out by itself. ``batch_id`` must name the writer, too; a counted ``attempt`` column is kept. ``packed``: the run is a column, not
    a folder."""
    added = {"layer": F.lit(layer), "batch_id": F.lit(str(batch_id))}
    if "attempt" not in rejected.columns:
        added["attempt"] = F.lit(attempt)
    folders = [p for p in QUARANTINE_PARTITIONS if not (packed and p == "run_id")]
    _write(rejected.withColumns(added), base, "parquet", folders, MAX_RECORDS_PER_FILE)
