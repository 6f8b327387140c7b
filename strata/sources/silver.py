"""Reading and registering the silver layer."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.casts import storage_type
from strata.plans.spec import Schema
from strata.sinks.layers import silver_partitions
from strata.sources.bronze import folder_of


def silver_struct(schema: Schema, logical_types: bool = False, extra_partitions: Sequence[str] = ()) -> T.StructType:
    """The stored columns of a dataset, with folder columns as text (inference would turn 00 into 0)."""
    partitions = [*silver_partitions(schema), *extra_partitions]
    data = [
        T.StructField(name, storage_type(logical, logical_types))
        for name, logical in schema.columns.items()
        if name not in partitions
    ]
    typed = {n: storage_type(t, logical_types) for n, t in schema.columns.items()}
    folders = [
        T.StructField(p, T.StringType() if p in schema.by_params else typed.get(p, T.StringType())) for p in partitions
    ]
    return T.StructType([*data, *folders])


def dataset_path(base: str, schema: Schema) -> str:
    return folder_of(base, source=schema.source, entity=schema.entity)


def read_silver(
    spark: SparkSession,
    base: str,
    schema: Schema,
    logical_types: bool = False,
    extra_partitions: Sequence[str] = (),
    **where: Any,
) -> DataFrame:
    """A dataset from its declared columns: no file is opened to infer a schema, and ``where``
    values on folder columns leave other folders unread."""
    struct = silver_struct(schema, logical_types, extra_partitions)
    df = spark.read.schema(struct).option("basePath", base).parquet(dataset_path(base, schema))
    for name, value in where.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def merged_silver(spark: SparkSession, base: str, path: str | None = None) -> DataFrame:
    """A dataset without a spec: the union of the columns of all files, folder columns as text."""
    found = spark.read.option("mergeSchema", "true").option("basePath", base).parquet(path or base)
    # Folder columns come last; read again with their types fixed to text.
    first = found.select(F.col("_metadata.file_path").alias("path")).first()
    below = "" if first is None else first["path"].partition(base.rstrip("/"))[2]
    folders = {p.split("=")[0] for p in below.split("/")[:-1] if "=" in p}
    fields = [T.StructField(f.name, T.StringType()) if f.name in folders else f for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).option("basePath", base).parquet(path or base)


def register_silver(
    spark: SparkSession,
    base: str,
    schema: Schema,
    logical_types: bool = False,
    extra_partitions: Sequence[str] = (),
    table: str | None = None,
) -> str:
    """Create or extend the catalog table ``silver_<source>_<entity>`` over written folders.

    Columns new in the spec are added to an existing table, older partitions read null for them, and
    partitions written since the last call are found. Only folders of this dataset are listed and added.
    """
    name = table or f"silver_{schema.source}_{schema.entity}".lower()
    struct = silver_struct(schema, logical_types, extra_partitions)
    folders = [*silver_partitions(schema), *extra_partitions]
    quoted = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields}
    if not spark.catalog.tableExists(name):
        columns = ", ".join(quoted.values())
        keys = ", ".join(f"`{p}`" for p in folders)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{base}'")
    else:
        known = {c.lower() for c in spark.table(name).columns}
        new = [ddl for column, ddl in quoted.items() if column.lower() not in known]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    written = read_silver(spark, base, schema, logical_types, extra_partitions).select(*folders).distinct().toLocalIterator()
    while batch := list(islice(written, 200)):
        added = " ".join(f"PARTITION ({', '.join(f'`{k}` = {_literal(row[k])}' for k in folders)})" for row in batch)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    return name


def _literal(value: Any) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
