"""Silver: the row algebra, checks, keys, and partitioned writes."""

from __future__ import annotations

from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.keys import deduplicate, unique_key_violations
from strata.operators.runs import log_status
from strata.functions.times import epoch_ms
from strata.operators.transforms import apply_transforms, check_rows
from strata.plans.pipeline import append_run_log, read_run_log, retry_silver, run_silver
from strata.plans.spec import Schema, parse_schema
from strata.plans.workspace import work_dir
from strata.queries.registry import query, table
from strata.sinks.layers import write_bronze, write_silver
from strata.sources.bronze import parse_lines
from strata.sources.silver import read_silver, register_silver


def schema_of(entity: str, columns: dict[str, str], transforms: dict[str, Any], **partitioning: list[str]) -> Schema:
    return parse_schema(
        {
            "version": 1, "id": f"shop_{entity}", "source": "shop", "entity": entity,
            "silver": {
                "columns": [{"name": n, "type": t} for n, t in columns.items()],
                "transforms": transforms,
                "partitioning": partitioning,
            },
        },
        strict=False,
    )


def _outcome(reasons: str = "reasons") -> Column:
    return F.array_join(reasons, ",").alias("outcome")


@query("SELECT p_size, p_partkey, p_name FROM part")
def silver_keep_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"keep": ["p_size", "p_partkey", "absent", "p_brand", "p_name"], "drop": ["p_brand", "gone"]}
    return apply_transforms(table(spark, sf_dir, "part"), spec)


@query(
    """
    SELECT o_custkey, o_orderstatus AS o_totalprice, o_orderkey AS key, o_orderpriority
    FROM orders
    """
)
def silver_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of two renames, and a rename onto a column that exists."""
    spec = {
        "drop": ["o_orderdate"],
        "rename": {"o_orderkey": "step", "step": "key", "o_orderstatus": "o_totalprice", "absent": "other"},
    }
    return apply_transforms(table(spark, sf_dir, "orders"), spec)


@query(
    """
    SELECT c_custkey, c_name, '2024-01-05' AS dt, CAST(NULL AS VARCHAR) AS nothing, CAST(7 AS BIGINT) AS batch,
           'crm' AS c_mktsegment, c_name AS label, 'crm' AS again
    FROM customer
    """
)
def silver_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "keep": ["c_custkey", "c_name", "c_mktsegment"],
        "add_columns": [
            {"name": "dt", "from_param": "date"},
            {"name": "nothing", "from_param": "absent"},
            {"name": "batch", "literal": 7},
            {"name": "c_mktsegment", "literal": "crm"},
            {"name": "label", "from_column": "c_name"},
            {"name": "again", "from_column": "c_mktsegment"},
        ],
    }
    return apply_transforms(table(spark, sf_dir, "customer"), spec, {"date": "2024-01-05"})


def _json_rows(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Lines with one JSON value each, next to the key columns."""
    line = F.concat(F.lit('{"v":'), value, F.lit("}"))
    return parse_lines(df.select(*keys, line.alias("value")))


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE CAST(trunc(l_quantity) AS BIGINT) END AS v,
           CASE l_linenumber WHEN 3 THEN 'cast:v' ELSE '' END AS outcome
    FROM lineitem
    """
)
def silver_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions in numbers are cut, in texts they fail; text is stripped; null stays null."""
    whole = F.col("l_quantity").cast("bigint").cast("string")
    line = F.col("l_linenumber")
    value = (
        F.when(line == 1, F.concat(whole, F.lit(".7")))
        .when(line == 2, F.concat(F.lit('"  '), whole, F.lit(' "')))
        .when(line == 3, F.concat(F.lit('"'), whole, F.lit('.7"')))
        .when(line == 4, F.lit("null"))
        .otherwise(whole)
    )
    keys = ["l_orderkey", "l_linenumber"]
    spec = schema_of("ints", {"v": "int64"}, {"keep": ["v"], "cast": {"v": "int64"}})
    rows = _json_rows(table(spark, sf_dir, "lineitem"), keys, value)
    return check_rows(rows, spec).flagged().select(*keys, "v", _outcome())


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 1.0 WHEN 4 THEN 'inf'::DOUBLE
                ELSE l_extendedprice END AS v,
           CASE WHEN l_linenumber IN (1, 2) THEN 'cast:v' ELSE '' END AS outcome
    FROM lineitem
    """
)
def silver_cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("l_extendedprice").cast("string")
    line = F.col("l_linenumber")
    value = (
        F.when(line == 1, F.lit('"1d"'))
        .when(line == 2, F.lit('"0x1p3"'))
        .when(line == 3, F.lit("true"))
        .when(line == 4, F.lit('" Infinity "'))
        .when(line == 5, F.concat(F.lit('" '), text, F.lit('"')))
        .otherwise(text)
    )
    keys = ["l_orderkey", "l_linenumber"]
    spec = schema_of("floats", {"v": "float64"}, {"keep": ["v"], "cast": {"v": "float64"}})
    rows = _json_rows(table(spark, sf_dir, "lineitem"), keys, value)
    return check_rows(rows, spec).flagged().select(*keys, "v", _outcome())


@query(
    """
    SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN false
                   WHEN 4 THEN true WHEN 5 THEN quality <> 0 WHEN 6 THEN toxic <> 0 ELSE NULL END AS v
    FROM labels
    """
)
def silver_cast_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few texts are true and every other text is false; numbers count by being zero or not."""
    pick = F.col("doc_id") % 8
    value = (
        F.when(pick == 0, F.lit('"YES"'))
        .when(pick == 1, F.lit('"t"'))
        .when(pick == 2, F.lit('" true"'))
        .when(pick == 3, F.lit('"2"'))
        .when(pick == 4, F.lit("2"))
        .when(pick == 5, F.col("quality").cast("string"))
        .when(pick == 6, F.when(F.col("toxic") == 1, F.lit("true")).otherwise(F.lit("false")))
        .otherwise(F.lit("null"))
    )
    spec = schema_of("bools", {"v": "boolean"}, {"keep": ["v"], "cast": {"v": "boolean"}})
    return apply_transforms(_json_rows(table(spark, sf_dir, "labels"), ["doc_id"], value), spec)


@query(
    """
    SELECT event_id, epoch_us(ts) // 1000 AS ms, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS logical_s
    FROM events
    """
)
def silver_cast_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch numbers stay numbers; the logical form gives timestamps."""
    columns = {"event_id": "int64", "ms": "timestamp_ms", "s": "timestamp_s"}
    spec = {
        "keep": ["event_id", "ts"],
        "add_columns": [{"name": "ms", "from_column": "ts"}, {"name": "s", "from_column": "ts"}],
        "cast": {"ms": "timestamp_ms", "s": "timestamp_s"},
    }
    plain = apply_transforms(table(spark, sf_dir, "events"), schema_of("epochs", columns, spec))
    again = schema_of("epochs", {**columns, "logical": "timestamp_s"}, {"add_columns": [{"name": "logical", "from_column": "s"}]})
    timed = check_rows(plain, again, logical_types=True).enforced()
    # Rendered from the number of seconds, whatever the time zone of the session.
    seconds = F.timestamp_add("SECOND", F.unix_seconds("logical"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return timed.select(
        "event_id", F.unix_millis("ms").alias("ms"), F.unix_seconds("s").alias("s"),
        F.substring(seconds.cast("string"), 1, 19).alias("logical_s"),
    )


@query(
    """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS dt,
           CASE WHEN event_id % 5 = 0 THEN 'cast:dt' ELSE '' END AS outcome
    FROM events
    """
)
def silver_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates pass as text; the logical form refuses what is not a date."""
    text = F.when(F.col("event_id") % 5 == 0, F.lit("2024-02-30")).otherwise(F.col("ts").cast("date").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("dt"))
    spec = schema_of("dates", {"event_id": "int64", "dt": "date"}, {"cast": {"dt": "date"}})
    flagged = check_rows(rows, spec, logical_types=True).flagged()
    return flagged.select("event_id", F.col("dt").cast("string").alias("dt"), _outcome())


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 1 THEN 'True' WHEN 2 THEN CAST(l_orderkey AS VARCHAR)
                WHEN 3 THEN l_shipmode_text WHEN 4 THEN NULL WHEN 5 THEN CAST(l_orderkey AS VARCHAR) || '.5'
                ELSE '1e-05' END AS v
    FROM (SELECT l_orderkey, l_linenumber, l_returnflag || ' é' AS l_shipmode_text FROM lineitem)
    """
)
def silver_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, key = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    value = (
        F.when(line == 1, F.lit("true"))
        .when(line == 2, key)
        .when(line == 3, F.concat(F.lit('"'), F.col("l_returnflag"), F.lit(' é"')))
        .when(line == 4, F.lit("null"))
        .when(line == 5, F.concat(key, F.lit(".5")))
        .otherwise(F.lit("0.00001"))
    )
    keys = ["l_orderkey", "l_linenumber"]
    spec = schema_of("texts", {"v": "string"}, {"keep": ["v"], "cast": {"v": "string"}})
    return apply_transforms(_json_rows(table(spark, sf_dir, "lineitem"), keys, value), spec)


@query("SELECT p_partkey, p_name, lower(p_brand) AS p_brand, upper(p_type) AS p_type, p_size FROM part")
def silver_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padding with tabs and no-break spaces is stripped; upper wins over lower; numbers are left alone."""
    padded = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("\t  "), F.col("p_name"), F.lit("  \n")).alias("p_name"),
        "p_brand", "p_type", "p_size",
    )
    spec = {"trim": ["p_name", "p_size"], "lower": ["p_brand", "p_type"], "upper": ["p_type"]}
    return apply_transforms(padded, spec)


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey IN (1, 2, 3) THEN NULL ELSE o_orderkey END AS key_or_null, 'new' AS created
    FROM orders
    """
)
def silver_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "keep": ["o_orderkey", "o_orderstatus"],
        "add_columns": [{"name": "key_or_null", "from_column": "o_orderkey"}],
        "null_if": {"o_orderstatus": ["P", 3], "key_or_null": [1, 2.0, 3, "4"]},
        "fillna": {"o_orderstatus": "none", "created": "new"},
    }
    return apply_transforms(table(spark, sf_dir, "orders"), spec)


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines where the value is absent, null, or not a number for some ids."""
    fault = F.col("event_id") % 6
    number = F.col("value").cast("string")
    rest = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"type":"'), F.col("event_type"), F.lit('"'))
    tail = (
        F.when(fault == 0, F.lit("}"))
        .when(fault == 1, F.lit(',"amount":null}'))
        .when(fault == 2, F.lit(',"amount":"a lot"}'))
        .otherwise(F.concat(F.lit(',"amount":'), number, F.lit("}")))
    )
    lines = table(spark, sf_dir, "events").select("event_id", F.concat(rest, tail).alias("value"))
    return parse_lines(lines)


_AMOUNT = {"amount": "float64"}


@query(
    """
    SELECT event_id, CASE WHEN event_id % 6 > 2 THEN value END AS amount,
           CASE event_id % 6 WHEN 0 THEN 'missing:amount' WHEN 2 THEN 'cast:amount' ELSE '' END AS outcome
    FROM events
    """
)
def silver_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required key may be null and must be there."""
    spec = schema_of("required", _AMOUNT, {"keep": ["amount"], "cast": _AMOUNT, "required": ["amount"]})
    return check_rows(_gappy_events(spark, sf_dir), spec).flagged().select("event_id", "amount", _outcome())


@query(
    """
    SELECT CASE event_id % 6 WHEN 2 THEN 'cast:amount' WHEN 0 THEN 'null:amount' WHEN 1 THEN 'null:amount' ELSE '' END
             AS outcome,
           count(*) AS n_rows
    FROM events GROUP BY 1
    """
)
def silver_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = schema_of("non_null", _AMOUNT, {"keep": ["amount"], "cast": _AMOUNT, "non_null": ["amount"]})
    flagged = check_rows(_gappy_events(spark, sf_dir), spec).flagged()
    return flagged.groupBy(_outcome()).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """
    SELECT event_id, '{"amount":"a lot","id":' || event_id || ',"type":"' || event_type || '"}' AS input,
           'cast:amount' AS outcome
    FROM events WHERE event_id % 6 = 2
    """
)
def silver_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows keep their input as text."""
    spec = schema_of("rejected", _AMOUNT, {"keep": ["amount"], "cast": _AMOUNT})
    return check_rows(_gappy_events(spark, sf_dir), spec).rejected().select("event_id", "input", _outcome())


FULL_COLUMNS = {
    "id": "int64", "at_ms": "timestamp_ms", "user": "int64", "kind": "string", "amount": "float64",
    "flagged": "boolean", "channel": "string", "dt": "date", "kind_copy": "string", "note": "string",
}
FULL_TRANSFORMS = {
    "keep": ["i", "T", "t", "u", "k", "v", "f", "junk"],
    "drop": ["junk"],
    "rename": {"i": "id", "T": "at_ms", "u": "user", "k": "kind", "v": "amount", "f": "flagged"},
    "add_columns": [
        {"name": "channel", "literal": "web"},
        {"name": "dt", "from_param": "date"},
        {"name": "kind_copy", "from_column": "kind"},
    ],
    "cast": {
        "id": "int64", "at_ms": "timestamp_ms", "user": "int64", "kind": "string",
        "amount": "float64", "flagged": "boolean", "dt": "date", "kind_copy": "string",
    },
    "trim": ["kind", "kind_copy"],
    "lower": ["kind"],
    "upper": ["kind_copy"],
    "null_if": {"kind": ["error"]},
    "fillna": {"kind": "unknown", "note": "-"},
    "required": ["id", "amount"],
    "non_null": ["id", "at_ms", "amount"],
    "unique_key": ["id"],
}


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines with short, case-distinct keys and some bad values."""
    events = table(spark, sf_dir, "events")
    ms = epoch_ms(F.col("ts"))
    text = F.concat(F.lit(" "), F.initcap("event_type"), F.lit(" "))
    amount = F.when(F.col("event_id") % 20 == 7, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    line = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("i"), ms.alias("T"), F.lit("lower t").alias("t"),
            F.col("user_id").alias("u"), text.alias("k"), amount.alias("v"),
            F.when(F.col("event_id") % 2 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("f"),
            F.col("props").alias("junk"),
        )
    )
    return events.select(F.col("event_type").alias("event_type"), F.col("ts").alias("ts"), line.alias("value"))


@query(
    """
    SELECT event_id AS id, epoch_us(ts) // 1000 AS at_ms, user_id AS "user",
           CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS kind,
           value AS amount, event_id % 2 = 0 AS flagged, 'web' AS channel, '2024-01-05' AS dt,
           upper(event_type) AS kind_copy, '-' AS note
    FROM events WHERE event_id % 20 <> 7
    """
)
def silver_full_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key of the algebra in one plan over JSON lines."""
    rows = parse_lines(event_lines(spark, sf_dir).select("value"))
    spec = schema_of("events", FULL_COLUMNS, FULL_TRANSFORMS)
    return check_rows(rows, spec, {"date": "2024-01-05"}).accepted()


@query(
    """
    SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS n_rows
    FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1
    """
)
def unique_key_violations_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    hour = F.concat_ws(" ", F.col("ts").cast("date").cast("string"), F.lpad(F.hour("ts").cast("string"), 2, "0"))
    return unique_key_violations(events.withColumn("hour", hour), ["user_id", "event_type", "hour"])


@query(
    """
    SELECT event_id, epoch_us(ts) // 1000 AS at_ms, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events
    ) WHERE n = 1
    """
)
def deduplicate_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = deduplicate(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    ms = epoch_ms(F.col("ts"))
    return latest.select("event_id", ms.alias("at_ms"), "user_id", "event_type", "value", "props")


ORDER_COLUMNS = {"key": "int64", "customer": "int64", "status": "string", "total": "float64", "year": "string"}


@query(
    """
    SELECT o_orderkey AS key, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS total,
           strftime(o_orderdate, '%Y') AS year, 'eu' AS region
    FROM orders WHERE o_orderstatus = 'F'
    """
)
def silver_partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by a parameter and two columns, then read from the folders of one status."""
    spec = schema_of(
        "orders", ORDER_COLUMNS,
        {
            "rename": {"o_orderkey": "key", "o_custkey": "customer", "o_orderstatus": "status", "o_totalprice": "total"},
            "cast": {"key": "int64", "customer": "int64", "total": "float64"},
            "non_null": ["key"],
        },
        by_params=["region"], by_columns=["status", "year"],
    )
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("string"))
    base = work_dir(spark, "orders-silver")
    write_silver(apply_transforms(orders, spec), base, spec, {"region": "eu"}, run_id="r1")
    return read_silver(spark, base, spec, status="F").select(*ORDER_COLUMNS, "region")


def _orders_pipeline(spark: SparkSession, sf_dir: str, total: Column | None = None):
    """Orders landed as bronze, one run per status, with the run log saying so."""
    total = F.col("o_totalprice") if total is None else total.alias("o_totalprice")
    spec = schema_of(
        "orders", {"key": "int64", "total": "float64", "status": "string", "dt": "date"},
        {
            "keep": ["o_orderkey", "o_totalprice"],
            "rename": {"o_orderkey": "key", "o_totalprice": "total"},
            "add_columns": [{"name": "status", "from_param": "status"}, {"name": "dt", "from_param": "date"}],
            "cast": {"key": "int64", "total": "float64", "status": "string", "dt": "date"},
            "required": ["key"], "non_null": ["key", "total"], "unique_key": ["key"],
        },
        by_params=["date"],
    )
    base = work_dir(spark, "orders-runs")
    orders = table(spark, sf_dir, "orders")
    run_id = F.concat(F.lit("run-"), F.col("o_orderstatus"))
    landed = orders.select(
        "o_orderkey", total, F.lit("shop").alias("source"), F.lit("orders").alias("entity"),
        F.lit("2024-01-05").alias("ingestion_dt"), F.lit("00").alias("ingestion_hr"), run_id.alias("run_id"),
    )
    write_bronze(landed, f"{base}/bronze", cluster=True)
    params = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("date"), F.lit("2024-01-05"))
    requests = (
        orders.select("o_orderstatus").distinct()
        .select(F.lit("shop").alias("source"), F.lit("orders").alias("entity"), run_id.alias("run_id"), params.alias("params"))
    )
    append_run_log(log_status(requests, "BRONZE_WRITTEN", 1, params="params"), f"{base}/log")
    return spec, base, requests


@query(
    """
    SELECT 'run-' || o_orderstatus AS run_id, o_orderkey AS key, o_totalprice AS total, o_orderstatus AS status,
           '2024-01-05' AS dt
    FROM orders
    """
)
def silver_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, then all runs, then all again by force: every row is there once."""
    spec, base, requests = _orders_pipeline(spark, sf_dir)
    folders = {"bronze_base": f"{base}/bronze", "silver_base": f"{base}/silver", "log_path": f"{base}/log"}
    run_silver(spark, spec, requests.where("run_id <> 'run-F'"), **folders, at_ms=2)
    run_silver(spark, spec, requests, **folders, at_ms=3)
    run_silver(spark, spec, requests, **folders, at_ms=4, force=True)
    return read_silver(spark, f"{base}/silver", spec).select("run_id", *spec.columns)


@query(
    """
    SELECT 'run-' || o_orderstatus AS run_id, 'SILVER_WRITTEN' AS status,
           '{"rows":' || count(*) || ',"empty":false}' AS extra
    FROM orders GROUP BY o_orderstatus
    """
)
def silver_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch of runs leaves in the run log."""
    spec, base, requests = _orders_pipeline(spark, sf_dir)
    run_silver(spark, spec, requests, f"{base}/bronze", f"{base}/silver", f"{base}/log", at_ms=2)
    log = read_run_log(spark, f"{base}/log")
    return log.where("status = 'SILVER_WRITTEN'").select("run_id", "status", "extra")


@query(
    """
    SELECT 'run-' || o_orderstatus AS run_id, 'SILVER_WRITTEN' AS status, o_orderstatus = 'F' AS is_empty,
           CAST(count(*) FILTER (o_orderstatus <> 'F') AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS n_rejected
    FROM orders GROUP BY o_orderstatus
    UNION ALL
    SELECT 'run-none', 'SILVER_WRITTEN', true, CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    """
)
def silver_empty_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose rows are all set aside, a run that landed without rows, and good runs beside them; then nothing is left to do."""
    total = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    spec, base, requests = _orders_pipeline(spark, sf_dir, total)
    none = spark.range(1).select(
        F.lit("shop").alias("source"), F.lit("orders").alias("entity"), F.lit("run-none").alias("run_id"),
        F.create_map(F.lit("status"), F.lit("none"), F.lit("date"), F.lit("2024-01-05")).alias("params"),
    )
    append_run_log(log_status(none, "BRONZE_WRITTEN", 1, params="params"), f"{base}/log")
    for at_ms in (2, 3):
        run_silver(
            spark, spec, requests.unionByName(none), f"{base}/bronze", f"{base}/silver", f"{base}/log",
            on_error="quarantine", quarantine_base=f"{base}/quarantine", at_ms=at_ms,
        )
    kept = spark.read.parquet(f"{base}/quarantine").groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rejected"))
    written = F.get_json_object("extra", "$.skipped").isNull() & (F.col("status") == "SILVER_WRITTEN")
    log = read_run_log(spark, f"{base}/log").where(written).join(kept, "run_id", "left")
    return log.select(
        "run_id", "status", F.get_json_object("extra", "$.empty").cast("boolean").alias("is_empty"),
        F.get_json_object("extra", "$.rows").cast("bigint").alias("n_rows"), F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"),
    )


@query(
    """
    SELECT 'run-' || o_orderstatus AS run_id, o_orderkey AS key, o_totalprice AS total, lower(o_orderstatus) AS status
    FROM orders
    """
)
def silver_forced_new_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs done again by force with a spec that moves their rows to other folders: none stays behind."""
    spec, base, requests = _orders_pipeline(spark, sf_dir)
    old = replace(spec, by_columns=("status",))
    new = replace(old, transforms={**old.transforms, "lower": ["status"]})
    folders = {"bronze_base": f"{base}/bronze", "silver_base": f"{base}/silver", "log_path": f"{base}/log"}
    run_silver(spark, old, requests, **folders, at_ms=2)
    run_silver(spark, new, requests, **folders, at_ms=3, force=True)
    return read_silver(spark, f"{base}/silver", new).select("run_id", "key", "total", "status")


@query(
    """
    SELECT 'run-' || o_orderstatus AS run_id, o_orderkey AS key,
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS total, o_orderstatus AS status
    FROM orders
    """
)
def silver_retry_mended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows set aside for a missing value arrive once after the spec allows it, and quarantine is empty then."""
    total = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    spec, base, requests = _orders_pipeline(spark, sf_dir, total)
    mended = replace(spec, transforms={**spec.transforms, "non_null": ["key"]})
    layers, aside = (f"{base}/bronze", f"{base}/silver", f"{base}/log"), f"{base}/quarantine"
    run_silver(spark, spec, requests, *layers, on_error="quarantine", quarantine_base=aside, at_ms=2)
    for at_ms in (3, 4):
        retry_silver(spark, mended, requests, *layers, aside, f"{base}/dead", at_ms=at_ms)
    return read_silver(spark, f"{base}/silver", mended).select("run_id", "key", "total", "status")


@query(
    """
    SELECT s_suppkey AS key, s_name AS name, CAST(NULL AS DOUBLE) AS balance, 'one' AS run_id FROM supplier
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, 'two' FROM supplier
    """
)
def silver_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run brings a new column; the catalog table reads null for the first."""
    base = work_dir(spark, "suppliers-silver")
    name = "silver_" + base.rsplit("-", 1)[-1]
    suppliers = table(spark, sf_dir, "supplier")
    rename = {"s_suppkey": "key", "s_name": "name", "s_acctbal": "balance"}
    columns = {"key": "int64", "name": "string"}
    old = schema_of("suppliers", columns, {"rename": {k: v for k, v in rename.items() if v in columns}})
    new = schema_of("suppliers", {**columns, "balance": "float64"}, {"rename": rename})
    for spec, run in ((old, "one"), (new, "two")):
        write_silver(apply_transforms(suppliers, spec), base, spec, run_id=run)
        register_silver(spark, base, spec, table=name)
    return spark.table(name).select("key", "name", "balance", "run_id")
