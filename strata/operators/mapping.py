"""Positional arrays to named objects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.frames import once
from strata.plans.spec import MAPPING_TYPE, SpecError
from strata.sources.bronze import explode_payload, payload_values

_CELLS = "array<variant>"


def _cells(payload: Column) -> Column:
    """A payload as a list of cell lists, with null for an item that is not a list.

    The first form reads a payload of nothing but lists in one step; it is null for any other,
    which then is taken apart item by item.
    """
    whole = F.from_json(
        F.concat(F.lit("["), payload, F.lit(",[]]")), f"array<array<{_CELLS}>>", {"allowSingleQuotes": "false"}
    )
    fast = F.when(F.size(whole) == 2, F.get(whole, 0))
    by_item = F.transform(payload_values(payload), lambda item: F.try_variant_get(item, "$", _CELLS))
    return F.coalesce(fast, by_item)


def _item_error(item: Column, pos: Column, columns: Sequence[str]) -> Column:
    return F.when(item.isNull(), F.concat(F.lit("not a list: "), pos)).when(
        F.size(item) < len(columns), F.concat(F.lit("too short: "), pos)
    )


def _item_row(item: Column, columns: Sequence[str]) -> Column:
    # For a repeated name the last position counts.
    position = {name: i for i, name in enumerate(columns)}
    cells = [x for name, i in position.items() for x in (F.lit(name), F.get(item, i))]
    return F.to_variant_object(F.named_struct(*cells))


def _listed(df: DataFrame, payload: str, columns: Sequence[str]) -> DataFrame:
    if not columns:
        raise SpecError("array_to_object needs columns")
    return once(df, "_cells", _cells(F.col(payload)))


def mapped_payloads(df: DataFrame, payload: str, columns: Sequence[str]) -> DataFrame:
    """Add ``items``, the objects of a payload of positional arrays, and ``error``, what is wrong with its first bad item."""
    listed = _listed(df, payload, columns)
    errors = F.filter(F.transform("_cells", lambda c, i: _item_error(c, i, columns)), lambda e: e.isNotNull())
    error = F.when(F.col("_cells").isNull(), F.lit("payload is not JSON")).otherwise(F.get(errors, F.lit(0)))
    items = F.when(F.col("error").isNull(), F.transform("_cells", lambda c: _item_row(c, columns)))
    return listed.withColumn("error", error).withColumn("items", items).drop("_cells")


def mapped_items(df: DataFrame, payload: str, columns: Sequence[str]) -> DataFrame:
    """Explode payloads of positional arrays into objects; ``error`` says why an item is none.

    An item needs at least as many values as there are columns; further values are dropped.
    """
    listed = _listed(df, payload, columns)
    none = F.array(F.lit(None).cast(_CELLS))
    items = listed.select(
        *df.columns, F.col("_cells").isNotNull().alias("_json"), F.posexplode(F.coalesce("_cells", none)).alias("pos", "_item")
    )
    item = F.col("_item")
    error = F.when(~F.col("_json"), F.lit("payload is not JSON")).otherwise(_item_error(item, F.col("pos"), columns))
    row = F.when(F.size(item) >= len(columns), _item_row(item, columns))
    return items.withColumns({"row": row, "error": error}).drop("_json", "_item")


def array_to_object(
    df: DataFrame, payload: str, columns: Sequence[str], on_error: str = "fail"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Explode payloads of positional arrays into named rows.

    Fails the job on a bad item, or with ``on_error="quarantine"`` returns rows and rejects.
    """
    mapped = mapped_items(df, payload, columns)
    if on_error == "fail":
        checked = F.when(F.col("error").isNull(), F.col("row")).otherwise(F.raise_error(F.col("error")))
        return once(mapped, "row", checked).drop("error", payload)
    good = mapped.where(F.col("error").isNull()).drop("error", payload)
    return good, mapped.where(F.col("error").isNotNull()).drop("row")


def apply_mapping(df: DataFrame, payload: str, mapping: Mapping[str, Any] | None, on_error: str = "fail"):
    """The response mapping of a contract, or plain payload items where it has none."""
    if mapping is None:
        return explode_payload(df, payload, on_error)
    if mapping.get("type") != MAPPING_TYPE:
        raise SpecError(f"unsupported response mapping: {mapping.get('type')}")
    return array_to_object(df, payload, mapping.get("columns") or [], on_error)
