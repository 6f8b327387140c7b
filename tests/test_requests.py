from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from strata.operators import requests as rq
from strata.plans.spec import datasets_frame, parse_contract, parse_schema

DDL = "source string, entity string, params map<string,string>"


def contract(entity="bars", required=("date", "hour", "symbol", "start_ms", "end_ms"), optional=("limit",), query=None):
    query = {"s": "{symbol}", "n": "{limit}", "a": "{start_ms}", "b": "{end_ms}"} if query is None else query
    return parse_contract(
        {
            "version": 1, "id": entity, "source": "market", "entity": entity,
            "params": {"required": list(required), "optional": list(optional)},
            "api": {"base_url": "https://example.com", "endpoint": "/x", "query": query},
        }
    )


def schema(entity):
    return parse_schema(
        {"version": 1, "id": entity, "source": "market", "entity": entity, "silver": {"columns": [{"name": "x", "type": "string"}]}}
    )


def build(spark, *params, contracts=None, entity="bars", schemas=None):
    df = spark.createDataFrame([("market", entity, p) for p in params], DDL).coalesce(1)
    contracts = contracts or [contract()]
    known = datasets_frame(spark, contracts, schemas)
    return rq.build_requests(df, known, "20240101T000000Z")


FULL = {"date": "2023-01-01", "hour": "01", "symbol": "BTC"}


def test_defaults_and_run_id(spark):
    good, bad = build(spark, FULL)
    row = good.first()
    assert row.run_id == "2023-01-01T01-market-bars-BTC"
    assert row.params == {**FULL, "limit": "1000", "start_ms": "1672534800000", "end_ms": "1672538400000"}
    assert bad.count() == 0


@pytest.mark.parametrize(
    ("extra", "want"),
    [
        ({"start_ms": "", "end_ms": None}, ("1672534800000", "1672538400000")),
        ({"start_ms": "5"}, ("5", "1672538400000")),
        ({"start_ms": "5", "end_ms": "6"}, ("5", "6")),
    ],
)
def test_window_fills_only_what_is_empty(spark, extra, want):
    row = build(spark, {**FULL, **extra})[0].first()
    assert (row.params["start_ms"], row.params["end_ms"]) == want


def test_limit_is_kept_or_not_needed(spark):
    assert build(spark, {**FULL, "limit": "7"})[0].first().params["limit"] == "7"
    plain = contract(required=["date"], query={"d": "{date}"})
    row = build(spark, {"date": "2023-01-01"}, contracts=[plain])[0].first()
    assert row.params == {"date": "2023-01-01"}
    assert row.run_id == "20240101T000000Z-market-bars"


def test_endpoint_names_the_run(spark):
    assert build(spark, {**FULL, "endpoint": "x"})[0].first().run_id == "2023-01-01T01-market-x-BTC"


def reasons(spark, params, **options):
    good, bad = build(spark, params, **options)
    assert good.count() == 0
    return bad.first().reasons


def test_rejections(spark):
    assert reasons(spark, {"hour": "01", "symbol": "BTC"}) == [
        "missing required: date,end_ms,start_ms", "missing placeholders: end_ms,start_ms",
    ]
    assert reasons(spark, {**FULL, "hour": "24"})[-1] == "date and hour do not name an hour"
    assert reasons(spark, {**FULL, "": "x"}) == ["empty param key"]
    assert reasons(spark, FULL, entity="other")[-1] == "missing contract"
    assert reasons(spark, FULL, schemas=[schema("other")])[-1] == "missing schema"
    optional = contract(required=["date"], optional=["from_id"], query={"f": "{from_id}"})
    assert reasons(spark, FULL, contracts=[optional]) == ["missing placeholders: from_id"]


@pytest.mark.parametrize("blank", ["", "  ", "\t", None])
def test_blank_names(spark, blank):
    df = spark.createDataFrame([(blank, blank, blank, {"a": "1"})], "source string, entity string, run_id string, params map<string,string>")
    df = df.withColumns({"required": F.array().cast("array<string>"), "placeholders": F.array().cast("array<string>")})
    assert rq.with_reasons(df).first().reasons == ["blank source", "blank entity", "blank run_id"]


def test_hourly(spark):
    base = spark.createDataFrame([("market", "bars", "bars", {"symbol": "A", "hour": "xx"})], "source string, entity string, endpoint string, params map<string,string>")
    rows = rq.plan_hourly(base, ["2023-01-01"], [0, 1]).collect()
    assert [r.params for r in rows] == [
        {"symbol": "A", "date": "2023-01-01", "hour": h, "endpoint": "bars"} for h in ("00", "01")
    ]
    assert rq.plan_hourly(base, ["2023-01-01", "2023-01-02"]).count() == 48
    assert rq.plan_hourly(base, ["2023-01-01"], []).count() == 24


def test_given_run_id_is_kept(spark):
    df = spark.createDataFrame([("s", "e", "", {"a": "1"}), ("s", "e", "mine", {"a": "1"})], "source string, entity string, run_id string, params map<string,string>")
    assert [r.run_id for r in rq.with_run_id(df, "now").collect()] == ["now-s-e", "mine"]
    ids = [r[0] for r in df.select(rq.random_run_id()).collect()]
    assert len(set(ids)) == 2


def test_render(spark):
    good, _ = build(spark, FULL)
    row = rq.render_requests(good).first()
    assert row.rendered == {"s": "BTC", "n": "1000", "a": "1672534800000", "b": "1672538400000"}
    assert row.render_missing == []


def test_datasets_have_a_known_size(spark):
    """The planner may broadcast the datasets because it knows how small they are."""
    plan = datasets_frame(spark, [contract()])._jdf.queryExecution().optimizedPlan()
    assert plan.toString().startswith("LocalRelation")
