"""Helpers for whole frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that filters on it do not compute it again below.

    Spark pushes a filter through a projection by repeating the expression; a generator of exactly
    one row stops that. The value is computed before the generator, which then sees a plain column:
    evaluated inside it, an expression with a lambda would be interpreted row by row.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    computed = df.select(*others, value.alias("_once"))
    return computed.select(*others, F.explode(F.array("_once")).alias(name))


def texts(*candidates: Column) -> Column:
    """The non-null ones of some non-empty texts, without the lambda of array_compact, so that it
    stays inside generated code."""
    return F.array_remove(F.array(*[F.coalesce(c, F.lit("")) for c in candidates]), F.lit(""))
