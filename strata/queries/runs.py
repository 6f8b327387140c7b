"""Requests, the run log, and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import text as tx
from strata.functions.times import epoch_ms
from strata.operators import requests as rq
from strata.operators import runs as rn
from strata.plans.pipeline import append_run_log, read_run_log
from strata.plans.spec import datasets_frame, parse_contract
from strata.plans.workspace import work_dir
from strata.queries.registry import query, table
from strata.queries.silver import schema_of
from strata.sinks.layers import write_bronze, write_silver
from strata.sources.files import scan_artifacts


def _contract(entity: str, required: list[str], optional: list[str], query_map: dict[str, str]):
    return parse_contract(
        {
            "version": 1, "id": f"crm_{entity}", "source": "crm", "entity": entity,
            "params": {"required": required, "optional": optional},
            "api": {"base_url": "https://example.com", "endpoint": f"/{entity}", "query": query_map},
        }
    )


def _datasets(spark: SparkSession) -> DataFrame:
    """Contracts for four segments, of which one has no schema."""
    window = {"symbol": "{symbol}", "from": "{start_ms}", "to": "{end_ms}", "limit": "{limit}"}
    contracts = [
        _contract("automobile", ["date", "hour", "symbol", "start_ms", "end_ms"], ["limit"], window),
        _contract("building", ["date", "symbol"], ["limit"], {"symbol": "{symbol}", "limit": "{limit}"}),
        _contract("furniture", ["date", "hour"], [], {"plain": "all"}),
        _contract("machinery", ["symbol"], [], {"symbol": "{symbol}"}),
    ]
    schemas = [schema_of(c.entity, {"x": "string"}, {}) for c in contracts[:3]]
    return datasets_frame(spark, contracts).drop("has_schema").withColumn(
        "has_schema", F.col("entity").isin([s.entity for s in schemas])
    )


def _customer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer; some lack a symbol, some have an empty limit, some an hour 24."""
    key = F.col("c_custkey")
    params = F.create_map(
        F.lit("date"), F.concat(F.lit("2024-01-"), F.lpad((key % 28 + 1).cast("string"), 2, "0")),
        F.lit("hour"), F.lpad((key % 25).cast("string"), 2, "0"),
        F.lit("symbol"), F.when(key % 11 != 0, F.col("c_name")),
        F.lit("limit"), F.when(key % 3 == 0, F.lit("50")).otherwise(F.lit("")),
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("crm").alias("source"), F.lower("c_mktsegment").alias("entity"), params.alias("params")
    )


@query(
    """
    WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS symbol FROM orders),
    h AS (SELECT date, symbol, lpad(CAST(h AS VARCHAR), 2, '0') AS hour, h FROM d, range(24) AS r(h))
    SELECT date || 'T' || hour || '-shop-orders-' || symbol AS run_id, date, hour, symbol,
           epoch_ms(CAST(date AS TIMESTAMP) + h * INTERVAL 1 HOUR) AS start_ms,
           epoch_ms(CAST(date AS TIMESTAMP) + (h + 1) * INTERVAL 1 HOUR) AS end_ms
    FROM h
    """
)
def hourly_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill plan: 24 requests for every order day and status."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("date"), "o_orderstatus").distinct()
    datasets = days.select(
        F.lit("shop").alias("source"), F.lit("orders").alias("entity"), F.lit("orders").alias("endpoint"),
        F.create_map(F.lit("symbol"), F.col("o_orderstatus")).alias("params"), "date",
    )
    planned = rq.plan_hourly(datasets)
    contract = parse_contract(
        {
            "version": 1, "id": "shop_orders", "source": "shop", "entity": "orders",
            "params": {"required": ["date", "hour", "start_ms", "end_ms"], "optional": []},
            "api": {"base_url": "https://example.com", "endpoint": "/orders"},
        }
    )
    accepted, _ = rq.build_requests(planned, datasets_frame(spark, [contract]), "20240101T000000Z")
    params = F.col("params")
    return accepted.select(
        "run_id", *[params[k].alias(k) for k in ("date", "hour", "symbol")],
        *[params[k].cast("bigint").alias(k) for k in ("start_ms", "end_ms")],
    )


_REQUEST_CTE = """
    WITH r AS (
      SELECT c_custkey, lower(c_mktsegment) AS entity,
             '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS date,
             c_custkey % 25 AS h, lpad(CAST(c_custkey % 25 AS VARCHAR), 2, '0') AS hour,
             CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS symbol,
             CASE WHEN c_custkey % 3 = 0 THEN '50' ELSE '' END AS limit_in
      FROM customer)
"""


@query(
    _REQUEST_CTE
    + """
    SELECT c_custkey,
           CASE WHEN limit_in = '' AND entity IN ('automobile', 'building') THEN '1000' ELSE limit_in END AS page_limit,
           CASE WHEN entity = 'automobile' AND h < 24
                THEN CAST(epoch_ms(CAST(date AS TIMESTAMP) + h * INTERVAL 1 HOUR) AS VARCHAR) END AS start_ms,
           CASE WHEN entity = 'automobile' AND h < 24
                THEN CAST(epoch_ms(CAST(date AS TIMESTAMP) + (h + 1) * INTERVAL 1 HOUR) AS VARCHAR) END AS end_ms,
           CASE WHEN symbol IS NULL THEN '20240101T000000Z-crm-' || entity
                ELSE date || 'T' || hour || '-crm-' || entity || '-' || symbol END AS run_id
    FROM r
    """
)
def request_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = rq.requests_with_contract(_customer_requests(spark, sf_dir), _datasets(spark))
    filled = rq.with_run_id(rq.fill_defaults(joined), "20240101T000000Z")
    value = {n: F.try_element_at("params", F.lit(n)) for n in ("limit", "start_ms", "end_ms")}
    return filled.select(
        "c_custkey", value["limit"].alias("page_limit"), value["start_ms"].alias("start_ms"),
        value["end_ms"].alias("end_ms"), "run_id",
    )


@query(
    _REQUEST_CTE
    + """
    SELECT c_custkey, concat_ws(';',
             CASE WHEN entity = 'automobile' AND symbol IS NULL AND h = 24 THEN 'missing required: end_ms,start_ms,symbol'
                  WHEN entity = 'automobile' AND h = 24 THEN 'missing required: end_ms,start_ms'
                  WHEN entity IN ('automobile', 'building', 'machinery') AND symbol IS NULL
                  THEN 'missing required: symbol' END,
             CASE WHEN entity = 'automobile' AND symbol IS NULL AND h = 24
                  THEN 'missing placeholders: end_ms,start_ms,symbol'
                  WHEN entity = 'automobile' AND h = 24 THEN 'missing placeholders: end_ms,start_ms'
                  WHEN entity IN ('automobile', 'building', 'machinery') AND symbol IS NULL
                  THEN 'missing placeholders: symbol' END,
             CASE WHEN entity = 'machinery' THEN 'missing schema'
                  WHEN entity NOT IN ('automobile', 'building', 'furniture') THEN 'missing contract' END,
             CASE WHEN entity = 'automobile' AND h = 24 THEN 'date and hour do not name an hour' END) AS why
    FROM r
    """
)
def request_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = rq.requests_with_contract(_customer_requests(spark, sf_dir), _datasets(spark))
    checked = rq.with_reasons(rq.with_run_id(rq.fill_defaults(joined), "20240101T000000Z"))
    return checked.select("c_custkey", F.array_join("reasons", ";").alias("why"))


@query(
    """
    SELECT p_partkey, replace(replace('{brand}/{{' || p_type || '}}/{size}', '{brand}', p_brand), '{size}', 'None')
             .replace('{{', '{').replace('}}', '}') AS rendered,
           'plain' AS untouched, CAST(NULL AS VARCHAR) AS failed, 'color' AS missing
    FROM part
    """
)
def request_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates with a value, doubled braces, a null value, and a missing name."""
    params = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.lit(None).cast("string"))
    query_map = F.create_map(
        F.lit("a"), F.concat(F.lit("{brand}/{{"), F.col("p_type"), F.lit("}}/{size}")),
        F.lit("b"), F.lit("plain"),
        F.lit("c"), F.lit("{color}-{brand}"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", params.alias("params"), query_map.alias("query"))
    rendered = rq.render_requests(parts)
    return rendered.select(
        "p_partkey", F.col("rendered")["a"].alias("rendered"), F.col("rendered")["b"].alias("untouched"),
        F.col("rendered")["c"].alias("failed"), F.array_join("render_missing", ",").alias("missing"),
    )


@query(
    """
    SELECT p_partkey, 'name,' || lower(p_brand) || ',size' AS found, lower(p_brand) || ',size' AS undeclared FROM part
    """
)
def request_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in a template, and those no parameter list declares."""
    template = F.concat(F.lit("x={ name }&{"), F.lower("p_brand"), F.lit("}&{}&{size}&{name}"))
    found = tx.placeholders(template)
    undeclared = rq.undeclared_placeholders(found, F.array(F.lit("name")), F.array(F.lit("other")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(found, ",").alias("found"), F.array_join(undeclared, ",").alias("undeclared")
    )


def _order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("shop").alias("source"), F.col("o_orderstatus").alias("entity"), F.col("o_orderkey").cast("string").alias("run_id")
    )


def _lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as log events of their order: the line number gives the status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    items = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    line = F.col("l_linenumber")
    status = (
        F.when(line == 1, F.lit("REQUESTED")).when(line == 3, F.lit("BRONZE_WRITTEN"))
        .when(line == 5, F.lit("SILVER_WRITTEN")).when(line == 7, F.lit("FAILED"))
    )
    return items.select(
        F.lit("shop").alias("source"), F.col("o_orderstatus").alias("entity"), F.col("l_orderkey").cast("string").alias("run_id"),
        status.alias("status"), line.cast("bigint").alias("at_ms"), F.lit(None).cast("string").alias("extra"),
    ).where(F.col("status").isNotNull())


_LINE_LOG = """
    WITH log AS (
      SELECT l_orderkey, l_linenumber AS moment, CASE l_linenumber WHEN 1 THEN 'REQUESTED' WHEN 3 THEN 'BRONZE_WRITTEN'
             WHEN 5 THEN 'SILVER_WRITTEN' WHEN 7 THEN 'FAILED' END AS status FROM lineitem WHERE l_linenumber IN (1, 3, 5, 7)),
    state AS (SELECT l_orderkey, max_by(status, moment) AS status FROM log GROUP BY 1)
"""


@query(
    """
    SELECT o_orderstatus AS entity, CAST(o_orderkey AS VARCHAR) AS run_id, 'REQUESTED' AS status,
           CAST(o_orderkey AS BIGINT) AS at_ms, o_orderpriority AS symbol, CAST(NULL AS VARCHAR) AS error
    FROM orders
    UNION ALL
    SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR), 'FAILED', CAST(o_orderkey + 1 AS BIGINT), NULL, 'no "' || o_orderpriority || '"'
    FROM orders WHERE o_orderstatus = 'F'
    """
)
def run_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and failures written to a log and read again."""
    path = work_dir(spark, "run-log")
    priority = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), "o_orderkey", "o_orderpriority")
    runs = _order_requests(spark, sf_dir).join(priority, "run_id").withColumn("params", F.create_map(F.lit("symbol"), "o_orderpriority"))
    append_run_log(rn.log_requested(runs, F.col("o_orderkey")), path)
    error = F.concat(F.lit('no "'), F.col("o_orderpriority"), F.lit('"'))
    append_run_log(rn.log_failed(runs.where("entity = 'F'"), F.col("o_orderkey") + 1, error), path)
    return read_run_log(spark, path).select(
        "entity", "run_id", "status", "at_ms", F.col("params")["symbol"].alias("symbol"), F.get_json_object("extra", "$.error").alias("error")
    )


@query("SELECT o_orderstatus AS entity, count(*) AS n_runs, count(*) AS n_ids, count(*) AS n_well_formed FROM orders GROUP BY 1")
def request_random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids made for requests without one: as many as requests, all in the form of a UUID. Written before they are counted."""
    path = work_dir(spark, "random-ids")
    _order_requests(spark, sf_dir).withColumn("run_id", rq.random_run_id()).write.parquet(path)
    form = F.col("run_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    made = spark.read.schema("source string, entity string, run_id string").parquet(path)
    return made.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_distinct("run_id").alias("n_ids"), F.count_if(form).alias("n_well_formed")
    )


@query(
    """
    SELECT o_orderstatus AS entity, count(*) AS n_runs FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 5)
    GROUP BY 1
    """
)
def pending_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = rn.pending_runs(_order_requests(spark, sf_dir), _lineitem_log(spark, sf_dir), "silver")
    return pending.groupBy("entity").agg(F.count(F.lit(1)).alias("n_runs"))


@query(
    _LINE_LOG
    + """
    SELECT o_orderstatus AS entity, CASE WHEN status = 'BRONZE_WRITTEN' THEN 'transform' ELSE 'ingest' END AS stage,
           CAST(sum(CASE WHEN status = 'REQUESTED' THEN 0 ELSE 1 END) AS BIGINT) AS waiting,
           CAST(sum(CASE WHEN status = 'REQUESTED' THEN 1 ELSE 0 END) AS BIGINT) AS in_flight
    FROM orders LEFT JOIN state ON l_orderkey = o_orderkey
    WHERE status IS NULL OR status IN ('REQUESTED', 'BRONZE_WRITTEN')
    GROUP BY 1, 2
    """
)
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = rn.backlog(_order_requests(spark, sf_dir), _lineitem_log(spark, sf_dir))
    return counts.select("entity", "stage", "waiting", "in_flight")


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per order, as a scan would give them: bronze for cheap orders, silver for cheaper ones."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.lit("shop").alias("source"), F.col("o_orderstatus").alias("entity"), F.col("o_orderkey").cast("string").alias("run_id"),
        F.when(price < 200000, 1).otherwise(0).alias("bronze_files"),
        F.when(price < 100000, 1).otherwise(0).alias("silver_files"),
    )


_RECONCILED = (
    _LINE_LOG
    + """,
    marks AS (SELECT l_orderkey, bool_or(moment IN (3, 5)) AS b, bool_or(moment = 5) AS s FROM log GROUP BY 1),
    joined AS (
      SELECT o_orderkey, o_orderstatus, status,
             coalesce(b, false) AND o_totalprice < 200000 AS bronze_ok,
             coalesce(s, false) AND o_totalprice < 100000 AS silver_ok
      FROM orders LEFT JOIN state ON state.l_orderkey = o_orderkey LEFT JOIN marks ON marks.l_orderkey = o_orderkey),
    verdicts AS (
      SELECT *, coalesce(status = 'SILVER_WRITTEN', false) OR silver_ok AS ok,
             CASE WHEN coalesce(status = 'SILVER_WRITTEN', false) OR silver_ok THEN 'ok'
                  WHEN status = 'FAILED' THEN 'failed' ELSE 'incomplete' END AS verdict
      FROM joined)
    """
)


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _lineitem_log(spark, sf_dir)
    complete = rn.artifact_completeness(_artifacts(spark, sf_dir), log)
    return rn.reconcile_runs(_order_requests(spark, sf_dir), complete, rn.latest_state(log))


@query(_RECONCILED + "SELECT CAST(o_orderkey AS VARCHAR) AS run_id, status, bronze_ok, silver_ok, ok, verdict FROM verdicts")
def run_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir).select("run_id", "status", "bronze_ok", "silver_ok", "ok", "verdict")


@query(
    _RECONCILED
    + """
    SELECT o_orderstatus AS entity, count(*) AS runs, count(*) FILTER (verdict = 'ok') AS ok_runs,
           count(*) FILTER (verdict = 'failed') AS failed_runs, count(*) FILTER (verdict = 'incomplete') AS incomplete_runs,
           bool_and(ok) AS all_ok
    FROM verdicts GROUP BY 1
    """
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rn.verification_summary(_reconciled(spark, sf_dir), ["entity"])


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log: the user is the run, the type gives the status."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "signup", F.lit("REQUESTED")).when(kind == "purchase", F.lit("SILVER_WRITTEN"))
        .when(kind == "error", F.lit("FAILED")).otherwise(F.lit("BRONZE_WRITTEN"))
    )
    return table(spark, sf_dir, "events").select(
        F.lit("web").alias("source"), F.lit("events").alias("entity"), F.col("user_id").cast("string").alias("run_id"),
        status.alias("status"), epoch_ms(F.col("ts")).alias("at_ms"),
        F.when(kind != "click", F.col("props")).alias("extra"), "event_id",
    )


_EVENT_LOG = """
    WITH log AS (
      SELECT CAST(user_id AS VARCHAR) AS run_id, event_id, epoch_us(ts) // 1000 AS at_ms,
             CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 1 END AS rank,
             CASE event_type WHEN 'signup' THEN 'REQUESTED' WHEN 'purchase' THEN 'SILVER_WRITTEN'
                  WHEN 'error' THEN 'FAILED' ELSE 'BRONZE_WRITTEN' END AS status,
             CASE WHEN event_type <> 'click' THEN props END AS extra
      FROM events)
"""


@query(
    _EVENT_LOG
    + """,
    reached AS (SELECT DISTINCT run_id FROM log WHERE status IN ('BRONZE_WRITTEN', 'SILVER_WRITTEN')),
    last AS (
      SELECT run_id, status FROM log
      WHERE status <> 'REQUESTED' OR run_id NOT IN (SELECT run_id FROM reached)
      QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY at_ms DESC, rank DESC) = 1)
    SELECT run_id, any_value(last.status) AS status,
           max(at_ms) FILTER (rank = 0) AS requested_at_ms, max(at_ms) FILTER (rank > 0) AS updated_at_ms,
           CAST(json_extract_string(max_by(extra, at_ms * 4 + rank) FILTER (extra IS NOT NULL), '$.k') AS BIGINT) AS k
    FROM log JOIN last USING (run_id) GROUP BY 1
    """
)
def run_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = rn.latest_state(event_log(spark, sf_dir))
    k = F.try_variant_get(rn.decode_extra(F.col("extra")), "$.k", "bigint").alias("k")
    return state.select("run_id", "status", "requested_at_ms", "updated_at_ms", k)


@query(
    _EVENT_LOG
    + """
    SELECT run_id, r AS requested_at_ms, b AS bronze_at_ms, s AS silver_at_ms,
           b - r AS ingest_ms, s - b AS transform_ms, s - r AS total_ms
    FROM (SELECT run_id, min(at_ms) FILTER (rank = 0) AS r, min(at_ms) FILTER (rank = 1) AS b,
                 min(at_ms) FILTER (rank = 2) AS s FROM log GROUP BY 1)
    """
)
def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rn.run_durations(event_log(spark, sf_dir)).drop("source", "entity")


@query(
    _EVENT_LOG
    + """
    SELECT event_id, run_id, at_ms, lag(status) OVER w AS from_status, status AS to_status,
           CASE WHEN rank = 3 THEN true ELSE rank = coalesce(lag(rank) OVER w + 1, 0) END AS legal
    FROM log WINDOW w AS (PARTITION BY run_id ORDER BY at_ms, rank, event_id)
    """
)
def run_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = rn.run_transitions(event_log(spark, sf_dir), tie_break=["event_id"])
    return steps.select("event_id", "run_id", "at_ms", "from_status", "to_status", "legal")


@query(
    """
    SELECT l_returnflag AS entity, strftime(l_shipdate, '%Y') AS run_id, count(*) AS n_rows
    FROM lineitem GROUP BY 1, 2
    """
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("shop").alias("source"), F.col("l_returnflag").alias("entity"),
        F.year("l_shipdate").cast("string").alias("run_id"),
    )
    return rn.run_metrics(rows).drop("source")


@query(
    """
    SELECT 'run ' || o_orderpriority AS run_id, true AS has_bronze, bool_or(o_orderpriority LIKE '1%') AS has_silver
    FROM orders GROUP BY o_orderpriority
    """
)
def artifact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs named by order priority: all land, one is transformed; found again from the files."""
    base = work_dir(spark, "artifacts")
    run_id = F.concat(F.lit("run "), F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.lit("shop").alias("source"), F.lit("orders").alias("entity"),
        F.lit("2024-01-05").alias("ingestion_dt"), F.lit("00").alias("ingestion_hr"), run_id.alias("run_id"),
    )
    write_bronze(orders, f"{base}/bronze", cluster=True)
    spec = schema_of("orders", {"o_orderkey": "int64"}, {})
    urgent = orders.where(F.col("run_id").startswith("run 1")).select("o_orderkey", "source", "entity", "run_id")
    write_silver(urgent, f"{base}/silver", spec)
    found = scan_artifacts(spark, f"{base}/bronze", f"{base}/silver")
    return found.select(
        "run_id", (F.col("bronze_files") > 0).alias("has_bronze"), (F.col("silver_files") > 0).alias("has_silver")
    )
