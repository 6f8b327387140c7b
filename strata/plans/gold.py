"""Gold tables from SQL files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class GoldResult:
    table: str | None
    state: str


def read_sql(spark: SparkSession, path: str) -> str:
    texts = spark.read.text(path, wholetext=True).head(2)
    if len(texts) != 1:
        raise ValueError(f"not a single SQL file: {path}")
    return texts[0][0]


def run_gold(
    spark: SparkSession,
    sql_path: str,
    table: str | None = None,
    location: str | None = None,
    args: Mapping[str, Any] | None = None,
    replace: bool = False,
) -> GoldResult:
    """Run the SQL text of a file to its end; a failing query raises.

    A file with a complete CREATE TABLE ... AS SELECT needs no ``table``. With ``table`` the file
    holds the SELECT, and its result is saved as that table, at ``location`` if given.
    """
    text = read_sql(spark, sql_path)
    result = spark.sql(text, args=dict(args or {}))
    if table is not None:
        writer = result.write.format("parquet").mode("overwrite" if replace else "errorifexists")
        if location is not None:
            writer = writer.option("path", location)
        writer.saveAsTable(table)
    return GoldResult(table, "SUCCEEDED")
