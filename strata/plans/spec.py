"""Dataset specs: how to request a dataset (contract) and how to shape it (schema).

A spec is a plain mapping, as parsed from YAML or JSON. It is checked on the driver before any plan
is built; it never holds data.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.functions.casts import LOGICAL_TYPES

# The transform keys a spec may use.
TRANSFORM_KEYS = (
    "keep", "drop", "rename", "add_columns", "cast", "trim", "lower", "upper",
    "null_if", "fillna", "deduplicate", "required", "non_null", "unique_key",
)
ADD_SOURCES = ("from_param", "literal", "from_column")
MAPPING_TYPE = "array_to_object"

_BRACES = re.compile(r"\{([^}]*)\}")


class SpecError(ValueError):
    """A spec that cannot be turned into a plan."""


def _check(ok: Any, message: str) -> None:
    if not ok:
        raise SpecError(message)


def _names(block: Mapping[str, Any], key: str) -> list[str]:
    value = block.get(key) or []
    ok = isinstance(value, list) and all(isinstance(v, str) and v for v in value)
    _check(ok, f"{key} must be a list of names")
    return list(value)


def _mapping(block: Mapping[str, Any], key: str) -> dict[str, Any]:
    value = block.get(key) or {}
    _check(isinstance(value, Mapping), f"{key} must be a mapping")
    return dict(value)


def _header(raw: Mapping[str, Any], source: str | None, entity: str | None) -> dict[str, Any]:
    for key in ("version", "id", "source", "entity"):
        _check(key in raw, f"missing key: {key}")
    _check(source is None or raw["source"] == source, f"source mismatch: {raw['source']}")
    _check(entity is None or raw["entity"] == entity, f"entity mismatch: {raw['entity']}")
    return {
        "version": int(raw["version"]),
        "id": str(raw["id"]),
        "source": str(raw["source"]),
        "entity": str(raw["entity"]),
    }


@dataclass(frozen=True)
class Contract:
    """How a dataset is requested."""

    version: int
    id: str
    source: str
    entity: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    query: Mapping[str, Any] = field(default_factory=dict)
    mapping_columns: tuple[str, ...] | None = None

    @property
    def placeholders(self) -> tuple[str, ...]:
        found = {n.strip() for v in self.query.values() if isinstance(v, str) for n in _BRACES.findall(v)}
        return tuple(sorted(n for n in found if n))

    @property
    def undeclared_placeholders(self) -> tuple[str, ...]:
        declared = {*self.required, *self.optional}
        return tuple(n for n in self.placeholders if n not in declared)


@dataclass(frozen=True)
class Schema:
    """How a dataset is shaped."""

    version: int
    id: str
    source: str
    entity: str
    columns: Mapping[str, str] = field(default_factory=dict)
    transforms: Mapping[str, Any] = field(default_factory=dict)
    by_params: tuple[str, ...] = ()
    by_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Dataset:
    contract: Contract
    schema: Schema

    @property
    def source(self) -> str:
        return self.schema.source

    @property
    def entity(self) -> str:
        return self.schema.entity


def parse_contract(raw: Mapping[str, Any], source: str | None = None, entity: str | None = None) -> Contract:
    header = _header(raw, source, entity)
    api = raw.get("api")
    _check(isinstance(api, Mapping), "api must be a mapping")
    _check("base_url" in api and "endpoint" in api, "api needs base_url and endpoint")
    params = _mapping(raw, "params")
    columns = None
    mapping = api.get("response_mapping")
    if mapping is not None:
        _check(isinstance(mapping, Mapping), "api.response_mapping must be a mapping")
        _check(mapping.get("type") == MAPPING_TYPE, f"unsupported response mapping: {mapping.get('type')}")
        columns = tuple(_names(mapping, "columns"))
        _check(columns, "api.response_mapping.columns must not be empty")
    contract = Contract(
        **header,
        required=tuple(_names(params, "required")),
        optional=tuple(_names(params, "optional")),
        query=_mapping(api, "query"),
        mapping_columns=columns,
    )
    # A contract without a params block declares nothing, so nothing is checked against it.
    undeclared = contract.undeclared_placeholders if params else ()
    _check(not undeclared, f"placeholders not declared in params: {list(undeclared)}")
    return contract


def parse_schema(
    raw: Mapping[str, Any], source: str | None = None, entity: str | None = None, strict: bool = True
) -> Schema:
    header = _header(raw, source, entity)
    silver = raw.get("silver")
    _check(isinstance(silver, Mapping), "silver must be a mapping")
    declared = silver.get("columns")
    _check(isinstance(declared, list) and declared, "silver.columns must be a non-empty list")
    columns: dict[str, str] = {}
    for column in declared:
        ok = isinstance(column, Mapping) and column.get("name") and column.get("type")
        _check(ok, "each silver column needs a name and a type")
        _check(column["type"] in LOGICAL_TYPES, f"unsupported type: {column['type']}")
        _check(column["name"] not in columns, f"duplicate column: {column['name']}")
        columns[column["name"]] = column["type"]
    transforms = _mapping(silver, "transforms")
    check_transforms(transforms, columns, strict)
    partitioning = _mapping(silver, "partitioning")
    schema = Schema(
        **header,
        columns=columns,
        transforms=transforms,
        by_params=tuple(_names(partitioning, "by_params")),
        by_columns=tuple(_names(partitioning, "by_columns")),
    )
    for name in schema.by_columns:
        _check(name in columns, f"partition column not declared: {name}")
    return schema


def check_transforms(
    transforms: Mapping[str, Any], columns: Mapping[str, str] | None = None, strict: bool = True
) -> None:
    """Check the transform block; with ``columns`` given, also that it only names declared ones."""
    unknown = sorted(set(transforms) - set(TRANSFORM_KEYS))
    _check(not unknown, f"unknown transform keys: {unknown}")

    def declared(names: Any, key: str) -> None:
        for name in names:
            _check(columns is None or name in columns, f"{key}: column not declared: {name}")

    lists = {k: _names(transforms, k) for k in ("keep", "drop", "trim", "lower", "upper")}
    overlap = sorted(set(lists["keep"]) & set(lists["drop"]))
    _check(not (strict and overlap), f"keep and drop overlap: {overlap}")
    for key in ("required", "non_null", "unique_key"):
        declared(_names(transforms, key), key)
    rename = _mapping(transforms, "rename")
    _check(len(set(rename.values())) == len(rename), "rename: two columns share a target")
    declared(rename.values(), "rename")
    cast = _mapping(transforms, "cast")
    for name, logical in cast.items():
        _check(logical in LOGICAL_TYPES, f"cast: unsupported type {logical} for {name}")
    declared(cast, "cast")
    added = transforms.get("add_columns") or []
    _check(isinstance(added, list), "add_columns must be a list")
    for item in added:
        _check(isinstance(item, Mapping) and item.get("name"), "add_columns: each item needs a name")
        _check(sum(k in item for k in ADD_SOURCES) == 1, f"add_columns: {item['name']} needs one of {ADD_SOURCES}")
        declared([item["name"]], "add_columns")
    for key in ("null_if", "fillna"):
        _mapping(transforms, key)
    for name, values in _mapping(transforms, "null_if").items():
        _check(isinstance(values, list), f"null_if: {name} needs a list of values")


def pair(contract: Contract, schema: Schema) -> Dataset:
    for key in ("version", "id", "source", "entity"):
        left, right = getattr(contract, key), getattr(schema, key)
        _check(left == right, f"contract and schema differ in {key}: {left} != {right}")
    declared = {*contract.required, *contract.optional}
    missing = sorted(set(schema.by_params) - declared)
    _check(not missing, f"partition params not declared in the contract: {missing}")
    return Dataset(contract, schema)


def load_mapping(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read one YAML or JSON spec file from any file system Spark can reach."""
    lines = spark.read.text(path, wholetext=True).head(2)
    _check(len(lines) == 1, f"not a single spec file: {path}")
    if path.endswith(".json"):
        raw = json.loads(lines[0][0])
    else:
        try:
            import yaml
        except ImportError as missing:
            raise SpecError("reading YAML specs needs PyYAML; JSON specs do not") from missing
        raw = yaml.safe_load(lines[0][0])
    _check(isinstance(raw, dict), f"spec file must hold a mapping: {path}")
    return raw


def load_dataset(spark: SparkSession, contract_path: str, schema_path: str, strict: bool = True) -> Dataset:
    return pair(
        parse_contract(load_mapping(spark, contract_path)),
        parse_schema(load_mapping(spark, schema_path), strict=strict),
    )


_TEXTS = pa.list_(pa.string())
_DATASETS = pa.schema(
    [
        ("source", pa.string()), ("entity", pa.string()), ("contract_id", pa.string()), ("version", pa.int32()),
        ("required", _TEXTS), ("optional", _TEXTS), ("placeholders", _TEXTS),
        ("query", pa.map_(pa.string(), pa.string())), ("has_schema", pa.bool_()),
    ]
)


def datasets_frame(
    spark: SparkSession, contracts: list[Contract], schemas: list[Schema] | None = None
) -> DataFrame:
    """The known datasets as rows.

    Made from Arrow, so that it is a local relation whose size the join planner knows.
    """
    shaped = None if schemas is None else {(s.source, s.entity) for s in schemas}
    rows = [
        {
            "source": c.source, "entity": c.entity, "contract_id": c.id, "version": c.version,
            "required": sorted(c.required), "optional": sorted(c.optional), "placeholders": list(c.placeholders),
            "query": [(k, None if v is None else str(v)) for k, v in c.query.items()],
            "has_schema": shaped is None or (c.source, c.entity) in shaped,
        }
        for c in contracts
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, _DATASETS))
