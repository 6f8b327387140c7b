"""Gold: aggregates, wide tables, SQL files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import exact_sum, gold_aggregate, gold_bars, gold_denormalise
from strata.plans.gold import run_gold
from strata.plans.workspace import work_dir
from strata.queries.registry import query, table


@query(
    """
    SELECT event_type, strftime(ts, '%Y-%m-%d %H:00:00') AS hour,
           arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
           arg_max(value, (ts, event_id)) AS close, CAST(sum(CAST(value AS DECIMAL(28, 8))) AS DOUBLE) AS volume,
           count(*) AS n_rows
    FROM events GROUP BY 1, 2
    """
)
def gold_bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    hour = "concat(cast(cast(ts as date) as string), ' ', lpad(cast(hour(ts) as string), 2, '0'), ':00:00')"
    return gold_bars(events, ["event_type"], hour, "value", ["ts", "event_id"], "hour")


@query(
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(28, 8))) AS DOUBLE) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(28, 8))) AS DOUBLE) AS price, count(*) AS n_rows,
           max(l_discount) AS top_discount
    FROM lineitem GROUP BY 1, 2
    """
)
def gold_aggregate_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "quantity": exact_sum(F.col("l_quantity")),
        "price": exact_sum(F.col("l_extendedprice")),
        "n_rows": F.count(F.lit(1)),
        "top_discount": F.max("l_discount"),
    }
    return gold_aggregate(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], measures)


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice, c_name, c_mktsegment, n_name, r_name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    """
)
def gold_denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = gold_denormalise(
        table(spark, sf_dir, "orders"),
        (table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}),
        (table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}),
        (table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}),
    )
    return wide.select("o_orderkey", "o_orderstatus", "o_totalprice", "c_name", "c_mktsegment", "n_name", "r_name")


GOLD_SQL = """
SELECT o_orderpriority, year(o_orderdate) AS order_year,
       cast(sum(cast(l_extendedprice * (1 - l_discount) AS decimal(28, 4))) AS double) AS revenue,
       count(*) AS n_items
FROM {items} JOIN {orders} ON l_orderkey = o_orderkey
WHERE l_returnflag = :flag
GROUP BY o_orderpriority, year(o_orderdate)
"""


@query(
    """
    SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28, 4))) AS DOUBLE) AS revenue, count(*) AS n_items
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2
    """
)
def gold_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL text from a file, run with an argument and saved as a table."""
    base = work_dir(spark, "gold")
    tag = base.rsplit("-", 1)[-1]
    views = {name: f"{name}_{tag}" for name in ("items", "orders")}
    table(spark, sf_dir, "lineitem").createOrReplaceTempView(views["items"])
    table(spark, sf_dir, "orders").createOrReplaceTempView(views["orders"])
    text = GOLD_SQL.format(**views)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/sql")
    result = run_gold(spark, f"{base}/sql/*.txt", f"gold_{tag}", f"{base}/table", {"flag": "R"})
    return spark.table(result.table)
