"""Aggregated and denormalised gold shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def exact_sum(value: Column, scale: int = 8) -> Column:
    """A sum that does not depend on the order of the tasks: values are rounded to ``scale`` decimals and summed exactly."""
    return F.sum(value.cast(f"decimal({20 + scale},{scale})")).cast("double")


def gold_aggregate(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[measure.alias(name) for name, measure in measures.items()])


def gold_bars(
    df: DataFrame, by: Sequence[str], bucket: str, value: str, order_by: Sequence[str], bucket_name: str = "bucket", scale: int = 8
) -> DataFrame:
    """Open, high, low, close and sum of a value per key and bucket of a sortable column.

    First and last are partial aggregates over (time, tie-breaker), not a sorted window, so a
    bucket with most of the rows is reduced before it is shuffled. ``scale`` is that of ``exact_sum``.
    """
    order = F.struct(*order_by)
    return gold_aggregate(
        df.withColumn(bucket_name, F.expr(bucket)),
        [*by, bucket_name],
        {
            "open": F.min_by(value, order),
            "high": F.max(value),
            "low": F.min(value),
            "close": F.max_by(value, order),
            "volume": exact_sum(F.col(value), scale),
            "n_rows": F.count(F.lit(1)),
        },
    )


def gold_denormalise(facts: DataFrame, *dimensions: tuple[DataFrame, Mapping[str, str]], how: str = "left") -> DataFrame:
    """Join dimensions onto facts in turn; each maps columns so far to columns of the dimension.

    No side is forced to be broadcast: the planner does that for dimensions below its size limit.
    """
    wide = facts
    for dimension, keys in dimensions:
        conditions = [wide[left] == dimension[right] for left, right in keys.items()]
        drop = [right for left, right in keys.items()]
        wide = wide.join(dimension, conditions, how).drop(*[dimension[right] for right in drop])
    return wide
