"""File metadata as data: manifests, artifacts per run, inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import byte_length, sha256_hex

RUN_KEY = ("source", "entity", "run_id")
_LANES = 4


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Every file below a path with its length; contents are read only if a query uses them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def folder_value(path: Column, name: str) -> Column:
    """The value of a ``name=value`` folder of a path, with its escapes undone."""
    raw = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def with_run_key(files: DataFrame) -> DataFrame:
    return files.withColumns({name: folder_value(F.col("path"), name) for name in RUN_KEY})


def _lanes(digest: Column) -> list[Column]:
    """A 256-bit digest in hex as four 64-bit numbers."""

    def half(start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")

    return [F.shiftleft(half(16 * i + 1), 32).bitwiseOR(half(16 * i + 9)) for i in range(_LANES)]


def combined_digest(digest: Column, name: Column) -> Column:
    """One digest for a set of files: their digest where there is one file, else the bitwise sum of
    the digests of name and content. The state is four numbers, however many files a run has."""
    lanes = _lanes(sha256_hex(F.concat_ws(":", name, digest)))
    summed = F.concat(*[F.lpad(F.lower(F.hex(F.bit_xor(lane))), 16, "0") for lane in lanes])
    return F.when(F.count(F.lit(1)) == 1, F.max(digest)).otherwise(summed)


def build_manifest(spark: SparkSession, bronze_path: str, runs: DataFrame | None = None) -> DataFrame:
    """Per run: files, bytes, digest, and time of the last write of its bronze data.

    ``runs`` adds the columns it holds besides the run key, such as params and contract id.
    """
    files = with_run_key(list_files(spark, bronze_path, "*.txt"))
    name = F.substring_index("path", "/", -1)
    manifest = files.groupBy(*RUN_KEY).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("bytes"),
        combined_digest(sha256_hex(F.col("content")), name).alias("sha256"),
        F.min("path").alias("bronze_key"),
        F.max("modificationTime").alias("ingested_at"),
    )
    return manifest if runs is None else manifest.join(runs, list(RUN_KEY), "left")


def text_manifest(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Digest and byte length of a text column, row by row."""
    return df.select(
        *keys, byte_length(F.col(text)).cast("bigint").alias("bytes"), sha256_hex(F.col(text)).alias("sha256")
    )


def scan_artifacts(spark: SparkSession, bronze: str | None, silver: str | None) -> DataFrame:
    """Per run: how many data files, with one key of each kind, lie in the bronze and silver layers."""
    parts = []
    for layer, path, pattern in (("bronze", bronze, "*.txt"), ("silver", silver, "*.parquet")):
        if path is not None:
            files = with_run_key(list_files(spark, path, pattern)).withColumn("layer", F.lit(layer))
            parts.append(files.select(*RUN_KEY, "layer", "path", "length"))
    if not parts:
        raise ValueError("no layer to scan")
    files = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    bronze_file = F.col("layer") == "bronze"
    return files.groupBy(*RUN_KEY).agg(
        F.count_if(bronze_file).alias("bronze_files"),
        F.count_if(~bronze_file).alias("silver_files"),
        F.max(F.when(bronze_file, F.col("path"))).alias("bronze_data"),
        F.max(F.when(~bronze_file, F.col("path"))).alias("silver_parquet"),
        F.sum("length").alias("bytes"),
    )


def inventory_row(key: Column, content: Column) -> list[Column]:
    size = byte_length(content)
    return [
        key,
        F.round(size / F.lit(1024.0), 2).alias("size_kb"),
        F.substring(sha256_hex(content), 1, 12).alias("sha256_12"),
    ]


def config_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Per file: its size in KB and the first twelve hex digits of its digest."""
    files = list_files(spark, path, pattern)
    return files.select(*inventory_row(F.col("path"), F.col("content")))
