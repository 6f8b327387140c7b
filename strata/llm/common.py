"""What several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.workspace import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: this cuts the lineage and survives lost executors."""
    return kept(df, name)[0]


def kept(df: DataFrame, name: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """The same, and the folder it was written to, for those who remove it once nothing reads it any more."""
    path = work_dir(df.sparkSession, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def folders_made() -> Iterator[list[str]]:
    """The folders that `saved` and `kept` write meanwhile, for those who know when nothing reads them any more. Who asked before learns of them, too."""
    token = _MADE.set(made := [])
    try:
        yield made
    finally:
        _MADE.reset(token)
        if (outer := _MADE.get()) is not None:
            outer.extend(made)


def free_name(df: DataFrame, name: str) -> str:
    """A column name like this one that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def record_batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, field.type) for c, field in zip((columns[f.name] for f in schema), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def worker_memory(key: Hashable, make: Callable[[], Any]) -> Any:
    """What this Python process keeps from task to task, made when first asked for. Functions sent by value have globals of their own in each
    task, so it hangs on a module that isn't sent."""
    memory = sys.modules.setdefault("_strata_worker_memory", types.ModuleType("_strata_worker_memory")).__dict__.setdefault("kept", {})
    if key not in memory:
        memory[key] = make()
    return memory[key]


def release_worker_memory() -> None:
    """Drop what tasks of this process kept. For tasks that need much room of their own and may follow those of another operator."""
    sys.modules.get("_strata_worker_memory", types.ModuleType("none")).__dict__.pop("kept", None)
