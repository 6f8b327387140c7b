from __future__ import annotations

import copy
import json

import pytest
from strata.plans.spec import SpecError, check_transforms, load_dataset, pair, parse_contract, parse_schema

CONTRACT = {
    "version": 1, "id": "m_trades", "source": "market", "entity": "trades",
    "params": {"required": ["date", "symbol"], "optional": ["limit"]},
    "api": {"base_url": "https://example.com", "endpoint": "/trades", "query": {"s": "{symbol}", "n": "{limit}"}},
}
SCHEMA = {
    "version": 1, "id": "m_trades", "source": "market", "entity": "trades",
    "silver": {
        "columns": [{"name": "id", "type": "int64"}, {"name": "price", "type": "float64"}],
        "transforms": {"rename": {"a": "id"}, "cast": {"id": "int64"}, "required": ["id"]},
        "partitioning": {"by_params": ["date"], "by_columns": ["id"]},
    },
}


def changed(base, path, value):
    raw = copy.deepcopy(base)
    node = raw
    for key in path[:-1]:
        node = node[key]
    if value is None:
        node.pop(path[-1])
    else:
        node[path[-1]] = value
    return raw


def test_valid_pair():
    dataset = pair(parse_contract(CONTRACT), parse_schema(SCHEMA))
    assert dataset.contract.placeholders == ("limit", "symbol")
    assert dataset.schema.columns == {"id": "int64", "price": "float64"}
    assert dataset.schema.by_params == ("date",)


@pytest.mark.parametrize(
    ("path", "value"),
    [
        (["version"], None),
        (["id"], None),
        (["api"], None),
        (["api", "base_url"], None),
        (["api", "endpoint"], None),
        (["api", "query"], ["x"]),
        (["api", "query"], {"x": "{undeclared}"}),
        (["params", "required"], "date"),
        (["params", "optional"], [1]),
        (["api", "response_mapping"], {"columns": ["a"]}),
        (["api", "response_mapping"], {"type": "other", "columns": ["a"]}),
        (["api", "response_mapping"], {"type": "array_to_object", "columns": []}),
    ],
)
def test_bad_contract(path, value):
    with pytest.raises(SpecError):
        parse_contract(changed(CONTRACT, path, value))


@pytest.mark.parametrize(
    ("path", "value"),
    [
        (["silver"], None),
        (["silver", "columns"], []),
        (["silver", "columns"], [{"name": "x"}]),
        (["silver", "columns"], [{"name": "x", "type": "decimal"}]),
        (["silver", "columns"], [{"name": "x", "type": "string"}, {"name": "x", "type": "string"}]),
        (["silver", "transforms"], {"explode": ["id"]}),
        (["silver", "transforms"], {"rename": {"a": "id", "b": "id"}}),
        (["silver", "transforms"], {"rename": {"a": "undeclared"}}),
        (["silver", "transforms"], {"cast": {"id": "decimal"}}),
        (["silver", "transforms"], {"cast": {"undeclared": "int64"}}),
        (["silver", "transforms"], {"add_columns": [{"name": "id"}]}),
        (["silver", "transforms"], {"add_columns": [{"name": "id", "literal": 1, "from_param": "x"}]}),
        (["silver", "transforms"], {"add_columns": [{"name": "undeclared", "literal": 1}]}),
        (["silver", "transforms"], {"required": ["undeclared"]}),
        (["silver", "transforms"], {"non_null": ["undeclared"]}),
        (["silver", "transforms"], {"unique_key": ["undeclared"]}),
        (["silver", "transforms"], {"keep": ["a"], "drop": ["a"]}),
        (["silver", "transforms"], {"null_if": {"id": 3}}),
        (["silver", "partitioning"], {"by_columns": ["undeclared"]}),
    ],
)
def test_bad_schema(path, value):
    with pytest.raises(SpecError):
        parse_schema(changed(SCHEMA, path, value))


def test_keep_drop_overlap_is_allowed_when_not_strict():
    raw = changed(SCHEMA, ["silver", "transforms"], {"keep": ["a"], "drop": ["a"]})
    assert parse_schema(raw, strict=False).transforms["drop"] == ["a"]


@pytest.mark.parametrize(("key", "value"), [("version", 2), ("id", "x"), ("source", "x"), ("entity", "x")])
def test_pair_must_agree(key, value):
    with pytest.raises(SpecError, match=key):
        pair(parse_contract({**CONTRACT, key: value}), parse_schema(SCHEMA))


def test_partition_params_must_be_declared():
    raw = changed(SCHEMA, ["silver", "partitioning"], {"by_params": ["region"]})
    with pytest.raises(SpecError, match="region"):
        pair(parse_contract(CONTRACT), parse_schema(raw))


def test_expected_names():
    with pytest.raises(SpecError, match="source"):
        parse_contract(CONTRACT, source="other")
    with pytest.raises(SpecError, match="entity"):
        parse_schema(SCHEMA, entity="other")


def test_bare_transforms():
    check_transforms({"keep": ["anything"], "cast": {"any": "date"}})
    with pytest.raises(SpecError):
        check_transforms({"cast": {"any": "datetime"}})


def test_load_from_files(spark, tmp_path):
    contract, schema = tmp_path / "contract.json", tmp_path / "schema.yaml"
    contract.write_text(json.dumps(CONTRACT))
    schema.write_text(json.dumps(SCHEMA, indent=2))  # JSON is YAML
    dataset = load_dataset(spark, str(contract), str(schema))
    assert (dataset.source, dataset.entity) == ("market", "trades")
