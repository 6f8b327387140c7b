"""Declared keys: violations and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) by ``order_by``, ties decided by all other columns.

    An aggregate rather than a row number: every task reduces its rows to one per key before the
    shuffle, so a key that holds a third of all rows sends one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"unknown keep: {keep}")
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not rest and not order_by:
        return df.dropDuplicates(list(keys))
    ranked = [*order_by, *(c for c in rest if _orderable(types[c]))]
    unranked = [c for c in rest if c not in ranked]
    rank = F.struct(*[F.col(f"`{c}`") for c in ranked])
    if unranked:
        pick = F.max_by if keep == "last" else F.min_by
        best = pick(F.struct(*[F.col(f"`{c}`") for c in (*ranked, *unranked)]), rank)
    else:
        best = F.max(rank) if keep == "last" else F.min(rank)
    reduced = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best.alias("_best"))
    return reduced.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`") for c in df.columns])
