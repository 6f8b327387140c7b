"""Raw payloads and bronze JSON lines.

A bronze row is a VARIANT column named ``row``: keys stay case-sensitive, JSON types are kept, and
an absent key stays apart from a null one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import text as tx
from strata.functions import times as tm
from strata.functions.frames import once

BRONZE_PARTITIONS = ("source", "entity", "ingestion_dt", "ingestion_hr", "run_id")
# Folders of packed bronze, where the run is a column beside the line.
PACKED_PARTITIONS = BRONZE_PARTITIONS[:-1]
_END = "end of text"
_JSON_SPACE = " \t\r\n"


def _last_of_each_key(entries: Column) -> Column:
    def repeated_later(entry: Column, i: Column) -> Column:
        return F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == entry["key"])

    return F.map_from_entries(F.filter(entries, lambda e, i: ~repeated_later(e, i)))


def _lenient_object(text: Column) -> Column:
    """What the strict parser refuses and a JSON decoder allows: NaN, infinities and repeated keys,
    of which the last one counts."""
    marker = F.lit(f',{{"{_END}":0}}]')
    pairs = F.from_json(
        F.concat(F.lit("["), text, marker), "array<map<string,variant>>", {"allowSingleQuotes": "false"}
    )
    whole = F.when((F.size(pairs) == 2) & F.map_contains_key(F.get(pairs, 1), _END), F.get(pairs, 0))
    return tx.let(F.map_entries(whole), lambda e: F.when(e.isNotNull(), F.to_variant_object(_last_of_each_key(e))))


def _ends_with_value(text: Column) -> Column:
    """True where nothing follows the first JSON value; the parser itself stops after that value.

    A text whose first closing brace is its last character needs no second look. Any other is
    counted as a list with one more item behind it.
    """
    first_brace = F.locate("}", text)
    # Most lines end with the brace, and need no look at the space behind it either.
    first_brace_is_last = (first_brace == F.length(text)) | (first_brace == F.length(F.rtrim(text, F.lit(_JSON_SPACE))))
    return first_brace_is_last | (F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))) == 2)


def with_json_object(df: DataFrame, text: str, name: str = "row") -> DataFrame:
    """Parse a text column: one JSON object as a VARIANT, or null for anything else."""
    value = F.col(text)
    is_object = value.startswith("{") | F.ltrim(value, F.lit(_JSON_SPACE)).startswith("{")
    strict = once(df, name, F.when(is_object & _ends_with_value(value), F.try_parse_json(value)))
    return strict.withColumn(name, F.coalesce(name, F.when(is_object, _lenient_object(value))))


def folder_of(base: str, **levels: str) -> str:
    """The path of partition folders below a base, with values escaped as Spark writes them."""

    def escaped(value: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^' or c < " " or c == "\x7f" else c for c in value)

    return "/".join([base.rstrip("/"), *(f"{name}={escaped(value)}" for name, value in levels.items())])


def text_lines(
    spark: SparkSession, path: str | list[str], partitions: tuple[str, ...] = (), base: str | None = None
) -> DataFrame:
    """Text lines plus string-typed partition columns (inference would turn hour 00 into 0). With ``base``, ``path`` may be
    a folder below it, and is the only one listed; without any folder there are no lines."""
    ddl = ", ".join(["value string", *(f"`{p}` string" for p in partitions)])
    reader = spark.read.schema(ddl)
    if base is None:
        return reader.text(path)
    try:
        return reader.option("basePath", base).text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def packed_lines(spark: SparkSession, path: str, partitions: tuple[str, ...] = PACKED_PARTITIONS, base: str | None = None) -> DataFrame:
    """What ``text_lines`` gives, from packed bronze; ``path`` may be a folder below ``base``."""
    ddl = ", ".join(["value string", "run_id string", *(f"`{p}` string" for p in partitions)])
    try:
        return spark.read.schema(ddl).option("basePath", base or path).parquet(path)
    except AnalysisException as error:
        if base is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Skip blank lines and parse the others; ``row`` is null where a line is not a JSON object."""
    kept = lines.where(F.col(column).startswith("{") | ~tx.is_blank(F.col(column)))
    return with_json_object(kept, column)


def split_lines(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the lines that did not with a reason."""
    good = parsed.where(F.col("row").isNotNull()).drop("value")
    bad = parsed.where(F.col("row").isNull()).drop("row").withColumn("reasons", F.array(F.lit("malformed")))
    return good, bad


def read_bronze(
    spark: SparkSession,
    path: str | list[str],
    partitions: tuple[str, ...] = BRONZE_PARTITIONS,
    on_error: str = "fail",
) -> DataFrame:
    """Bronze rows. A malformed line fails the job, or stays as a null ``row`` with its ``value``."""
    parsed = parse_lines(text_lines(spark, path, partitions))
    if on_error == "quarantine":
        return parsed
    if on_error != "fail":
        raise ValueError(f"unknown on_error: {on_error}")
    error = F.raise_error(F.concat(F.lit("malformed bronze line: "), F.col("value")))
    return once(parsed, "row", F.coalesce("row", error)).drop("value")


def payload_values(payload: Column) -> Column:
    """A payload as an array of VARIANT: the items of a list, or the one value of anything else."""
    listed = F.from_json(
        F.concat(F.lit("["), payload, F.lit(f',"{_END}"]')), "array<variant>", {"allowSingleQuotes": "false"}
    )
    complete = (F.size(listed) == 2) & (F.try_variant_get(F.get(listed, 1), "$", "string") == _END)
    value = F.get(listed, 0)
    items = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))
    return F.when(complete, items)


def payload_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``items``, null where the payload is not JSON."""
    return once(df, "items", payload_values(F.col(payload)))


def item_texts(payload: Column) -> Column:
    """The items of a payload as JSON texts with numbers as they were delivered (a VARIANT turns 5.0 into 5), for items
    that are objects; those of other items are of no use."""
    options = {"allowSingleQuotes": "false"}
    listed = F.from_json(payload, "array<string>", options)
    single = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), "array<string>", options)
    return F.when(F.ltrim(payload, F.lit(_JSON_SPACE)).startswith("["), listed).otherwise(single)


def with_payload_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``items``, structs of row and text, and ``error``."""
    parsed = once(payload_items(df, payload), "_texts", item_texts(F.col(payload)))
    zipped = F.transform("items", lambda row, i: F.struct(row.alias("row"), F.get(F.col("_texts"), i).alias("text")))
    error = F.when(F.col("items").isNull(), F.lit("payload is not JSON"))
    return parsed.withColumn("error", error).withColumn("items", zipped).drop("_texts")


def explode_payload(df: DataFrame, payload: str = "payload", on_error: str = "fail") -> DataFrame:
    """One row per item of a payload list, any other payload as one row, none for an empty list.

    Items keep their place in ``pos``. All items of a payload stay in the task that read it, in
    order, and nothing is shuffled. With ``on_error="quarantine"`` a payload that is not JSON gives
    one row without ``row``; otherwise it fails the job.
    """
    items = payload_items(df, payload)
    others = [c for c in df.columns if c != payload]
    if on_error == "fail":
        # Inside the generator, since null lists are filtered out before it.
        checked = F.coalesce("items", F.raise_error(F.lit("payload is not JSON")))
        return items.select(*others, F.posexplode(checked).alias("pos", "row"))
    none = F.array(F.lit(None).cast("variant"))
    return items.select(*others, payload, F.posexplode(F.coalesce("items", none)).alias("pos", "row")).withColumn(
        payload, F.when(F.col("row").isNull(), F.col(payload))
    )


def with_ingestion_partitions(df: DataFrame, ts: str | Column) -> DataFrame:
    """Add the UTC day and two-digit hour of a timestamp as text."""
    value = F.col(ts) if isinstance(ts, str) else ts
    ntz = tm.utc_ntz(value, df.select(value).schema[0].dataType)
    return df.withColumn("ingestion_dt", tm.day_text(ntz)).withColumn("ingestion_hr", tm.hour_text(ntz))
