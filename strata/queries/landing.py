"""Bronze: parsing, payloads, partitions, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.mapping import array_to_object
from strata.plans.pipeline import attempts_path, land_bronze
from strata.plans.workspace import work_dir
from strata.queries.registry import query, table
from strata.sinks.layers import write_bronze
from strata.sources.bronze import (
    BRONZE_PARTITIONS,
    explode_payload,
    parse_lines,
    read_bronze,
    text_lines,
    with_ingestion_partitions,
)
from strata.sources.files import build_manifest, config_inventory, folder_value, inventory_row, text_manifest


def _field(name: str, sql_type: str):
    return F.try_variant_get("row", f"$.{name}", sql_type).alias(name)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return parse_lines(lines).select("event_id", _field("k", "bigint"))


@query(
    """
    SELECT CASE WHEN event_id % 10 IN (1, 2, 3, 4) THEN 'malformed' ELSE 'parsed' END AS outcome,
           count(*) AS n_rows,
           sum(CASE WHEN event_id % 10 NOT IN (1, 2, 3, 4)
                    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS sum_k
    FROM events WHERE event_id % 10 <> 0 GROUP BY 1
    """
)
def bronze_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults put into the lines of the whole table: blank, cut, followed by text, a list, two objects."""
    fault = F.col("event_id") % 10
    props = F.col("props")
    line = (
        F.when(fault == 0, F.lit(" \t "))
        .when(fault == 1, F.substring(props, F.lit(1), F.length(props) - 1))
        .when(fault == 2, F.concat(props, F.lit(" x")))
        .when(fault == 3, F.concat(F.lit("["), props, F.lit("]")))
        .when(fault == 4, F.concat(props, F.lit(","), props))
        .otherwise(F.concat(F.lit("  "), props, F.lit(" ")))
    )
    parsed = parse_lines(table(spark, sf_dir, "events").select(line.alias("value")))
    outcome = F.when(F.col("row").isNull(), F.lit("malformed")).otherwise(F.lit("parsed"))
    return parsed.groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.try_variant_get("row", "$.k", "bigint")).alias("sum_k")
    )


@query(
    """
    SELECT o_orderkey, CAST(0 AS INTEGER) AS pos, 'status' AS field, o_orderstatus AS text FROM orders
    WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, CAST(1 AS INTEGER), 'priority', o_orderpriority FROM orders WHERE o_orderstatus = 'O'
    """
)
def payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of two items, a single object, and an empty list, by order status."""
    orders = table(spark, sf_dir, "orders")

    def item(field: str, value: str):
        return F.struct(F.lit(field).alias("field"), F.col(value).alias("text"))

    status, priority = item("status", "o_orderstatus"), item("priority", "o_orderpriority")
    payload = (
        F.when(F.col("o_orderstatus") == "O", F.to_json(F.array(status, priority)))
        .when(F.col("o_orderstatus") == "P", F.lit("[]"))
        .otherwise(F.to_json(status))
    )
    rows = explode_payload(orders.select("o_orderkey", payload.alias("payload")))
    return rows.select("o_orderkey", "pos", _field("field", "string"), _field("text", "string"))


def _positional(spark: SparkSession, sf_dir: str, short_line: int | None) -> DataFrame:
    """Line items as payloads of two positional arrays, the second too short on one line number."""
    number = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_quantity")]
    values = F.concat_ws(",", *number)
    flag = F.concat(F.lit(',"'), F.col("l_returnflag"), F.lit('"'))
    full = F.concat(F.lit("["), values, flag, F.lit(',"more"]'))
    second = full if short_line is None else F.when(
        F.col("l_linenumber") == short_line, F.concat(F.lit("["), values, F.lit("]"))
    ).otherwise(full)
    payload = F.concat(F.lit("["), full, F.lit(","), second, F.lit("]"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", payload.alias("payload"))


NAMES = ["key", "line", "quantity", "flag"]


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(pos AS INTEGER) AS pos, l_orderkey AS key,
           CAST(l_linenumber AS BIGINT) AS line, l_quantity AS quantity, l_returnflag AS flag
    FROM lineitem, (VALUES (0), (1)) AS p(pos)
    """
)
def array_to_object_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = array_to_object(_positional(spark, sf_dir, None), "payload", NAMES)
    return rows.select(
        "l_orderkey", "l_linenumber", "pos",
        _field("key", "bigint"), _field("line", "bigint"), _field("quantity", "double"), _field("flag", "string"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(1 AS INTEGER) AS pos, 'too short: 1' AS error
    FROM lineitem WHERE l_linenumber = 7
    """
)
def array_to_object_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = array_to_object(_positional(spark, sf_dir, 7), "payload", NAMES, "quarantine")
    return rejected.select("l_orderkey", "l_linenumber", "pos", "error")


@query(
    """
    SELECT strftime(ts, '%Y-%m-%d') AS ingestion_dt, strftime(ts, '%H') AS ingestion_hr, count(*) AS n_rows
    FROM events GROUP BY 1, 2
    """
)
def ingest_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_ingestion_partitions(table(spark, sf_dir, "events"), "ts")
    return placed.groupBy("ingestion_dt", "ingestion_hr").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT page_id, octet_length(encode(html)) AS bytes, sha256(html) AS sha256 FROM pages")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_manifest(table(spark, sf_dir, "pages"), ["page_id"], "html")


@query(
    """
    SELECT 'n-' || n_nationkey AS run_id, '10' AS ingestion_hr, '{"nation":' || n_nationkey || ',"share":' || n_nationkey || '.0}' AS line
    FROM nation
    """
)
def land_retry_next_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations landed as one run each; the job ends before it is logged, and is repeated an hour later: every line is there
    once, below the hour of the first attempt, with its numbers as they were."""
    base, key = work_dir(spark, "nation-landing"), F.col("n_nationkey")
    payload = F.concat(F.lit('[{"nation":'), key, F.lit(',"share":'), key, F.lit(".0}]"))
    payloads = table(spark, sf_dir, "nation").select(
        F.lit("world").alias("source"), F.lit("nation").alias("entity"), F.concat(F.lit("n-"), key).alias("run_id"),
        F.create_map(F.lit("date"), F.lit("2024-01-05")).alias("params"), payload.alias("payload"),
    )
    for log, hour in (("lost", 10), ("log", 11)):
        at = F.lit(f"2024-01-05 {hour}:30:00").cast("timestamp_ntz")
        land_bronze(spark, payloads.withColumn("at", at), f"{base}/bronze", f"{base}/{log}", "at", at_ms=hour)
        if log == "lost":
            spark.read.parquet(attempts_path(f"{base}/lost")).write.parquet(attempts_path(f"{base}/log"))
    lines = text_lines(spark, f"{base}/bronze", BRONZE_PARTITIONS)
    return lines.select("run_id", "ingestion_hr", F.col("value").alias("line"))


def _land_customers(spark: SparkSession, sf_dir: str) -> str:
    """Customers as bronze lines, one run per market segment."""
    base = work_dir(spark, "customers-bronze")
    customers = table(spark, sf_dir, "customer").withColumns(
        {
            "source": F.lit("crm"),
            "entity": F.lit("customer"),
            "ingestion_dt": F.lit("2024-01-05"),
            "ingestion_hr": F.lit("07"),
            "run_id": F.concat(F.lit("r+"), F.col("c_mktsegment")),
        }
    )
    write_bronze(customers, base, cluster=True)
    return base


@query(
    """
    SELECT 'r+' || c_mktsegment AS run_id, '07' AS ingestion_hr, c_custkey, c_name, c_nationkey,
           c_acctbal, c_mktsegment
    FROM customer
    """
)
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_bronze(spark, _land_customers(spark, sf_dir))
    return rows.select(
        "run_id", "ingestion_hr", _field("c_custkey", "bigint"), _field("c_name", "string"),
        _field("c_nationkey", "int"), _field("c_acctbal", "double"), _field("c_mktsegment", "string"),
    )


@query(
    """
    SELECT 'crm' AS source, 'customer' AS entity, 'r+' || c_mktsegment AS run_id,
           true AS has_files, CAST(sum(octet_length(encode(
             '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}'
           )) + 1) AS BIGINT) AS bytes
    FROM customer GROUP BY c_mktsegment
    """
)
def bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "manifest-bronze")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.lit("crm").alias("source"), F.lit("customer").alias("entity"),
        F.lit("2024-01-05").alias("ingestion_dt"), F.lit("07").alias("ingestion_hr"),
        F.concat(F.lit("r+"), F.col("c_mktsegment")).alias("run_id"),
    )
    write_bronze(customers, base, cluster=True)
    found = build_manifest(spark, base)
    complete = (F.col("n_files") > 0) & (F.length("sha256") == 64)
    return found.select("source", "entity", "run_id", complete.alias("has_files"), "bytes")


@query(
    """
    SELECT doc_id, round(octet_length(encode(text)) / 1024.0, 2) AS size_kb, substr(sha256(text), 1, 12) AS sha256_12
    FROM documents
    """
)
def config_inventory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*inventory_row(F.col("doc_id"), F.col("text")))


@query("SELECT 'r+' || c_mktsegment AS run_id, true AS digested FROM customer GROUP BY c_mktsegment")
def config_inventory_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and digest of every written bronze file, by run."""
    files = config_inventory(spark, _land_customers(spark, sf_dir), "*.txt")
    digested = F.bool_and((F.length("sha256_12") == 12) & (F.col("size_kb") > 0))
    return files.groupBy(folder_value(F.col("path"), "run_id").alias("run_id")).agg(digested.alias("digested"))
