"""The silver row algebra: one transform block compiled to one DataFrame plan.

The order of the keys is fixed: keep, drop, rename, add_columns, cast, trim, lower, upper, null_if,
fillna, required, non_null. Two kinds of input are taken: a frame with a VARIANT column ``row`` (JSON
rows, where a key may be present in one row and absent in the next), or a plain typed frame.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import casts as ct
from strata.functions import text as tx
from strata.functions.frames import once, texts
from strata.plans.spec import Schema, SpecError, check_transforms

ROW = "row"
# Where a checked row keeps what it was made from.
_INPUT = ("_row", "_line")


@dataclass(frozen=True)
class _Field:
    value: Column
    dtype: T.DataType
    present: Column | None = None  # None: present in every row
    json: ct.Json | None = None  # where the value of a VARIANT field is read from
    origin: ct.Json | None = None  # the JSON value behind a typed field that no cast key names

    @property
    def missing(self) -> Column:
        return self.value.isNull() if self.json is None else self.json.missing


# What was found in the JSON row behind a converted value.
_FOUND, _ABSENT, _NULL, _LOST = 0, 1, 2, 3


def _lookup(value: Column, source: ct.Json) -> Column:
    """A value that was converted needs no second look at the row, and most others are JSON nulls, which one look tells."""
    return (
        F.when(value.isNotNull(), F.lit(_FOUND))
        .when(F.is_variant_null(source.variant), F.lit(_NULL))
        .when(~source.present, F.lit(_ABSENT))
        .otherwise(F.lit(_LOST))
    )


@dataclass(frozen=True)
class Checked:
    """Transformed rows with one flag per check; choose what happens to rows that fail one."""

    df: DataFrame
    columns: tuple[str, ...]
    carry: tuple[str, ...]
    checks: tuple[tuple[str, str], ...]  # (reason, flag column)
    costly: bool = False  # whether filters on the flags must not repeat the conversions

    def bad(self) -> Column:
        return reduce(Column.__or__, [F.col(flag) for _, flag in self.checks], F.lit(False))

    def reasons(self) -> Column:
        if not self.checks:
            return F.array().cast("array<string>")
        return texts(*[F.when(F.col(flag), F.lit(reason)) for reason, flag in self.checks])

    def _output(self) -> list[Column]:
        return [F.col(f"`{c}`") for c in (*self.carry, *self.columns)]

    def settled(self) -> Checked:
        """The same rows, computed in one place."""
        if not (self.costly and self.checks):
            return self
        rest = [c for c in self.df.columns if c not in _INPUT]
        packed = once(self.df, "_out", F.struct(*[F.col(f"`{c}`") for c in rest]))
        return replace(self, df=packed.select(*_INPUT, "_out.*"), costly=False)

    def observed(self, observation: Observation) -> Checked:
        """The same rows, with the number of bad ones left in ``observation`` as ``bad``."""
        settled = self.settled()
        counted = settled.df.observe(observation, F.count_if(self.bad()).alias("bad"))
        return replace(settled, df=counted)

    def enforced(self) -> DataFrame:
        """All rows; the job fails on the first bad one.

        The check sits in the generator that yields the row: in a projected column it would go when
        that column is not used, and in a filter it would come after filters on null-ness.
        """
        if not self.checks:
            return self.df.select(*self._output())
        error = F.raise_error(F.concat(F.lit("rejected row: "), F.array_join(self.reasons(), ", ")))
        row = F.when(self.bad(), error).otherwise(F.struct(*self._output()))
        return once(self.df, "_out", row).select("_out.*")

    def accepted(self) -> DataFrame:
        settled = self.settled()
        return settled.df.where(~self.bad()).select(*self._output())

    def flagged(self) -> DataFrame:
        """All rows, each with its reasons; none for a good row."""
        return self.settled().df.select(*self._output(), self.reasons().alias("reasons"))

    def rejected(self) -> DataFrame:
        """Bad rows: carried columns, the input row as JSON text, and every reason."""
        keep = [F.col(f"`{c}`") for c in self.carry]
        bad = self.settled().df.where(self.bad())
        return bad.select(*keep, self._input().alias("input"), self.reasons().alias("reasons"))

    def _input(self) -> Column:
        """What a row was made from; the line itself where it could not be parsed."""
        return F.coalesce(F.to_json("_row"), F.col("_line")) if "_row" in self.df.columns else F.col("_line")

    def kept(self, save: Callable[[DataFrame], DataFrame]) -> Checked:
        """The same rows as ``save`` gives them back, so that they are parsed and converted once, however often they are used. Of the
        input only that of bad rows is saved."""
        rest = [F.col(f"`{c}`") for c in self.df.columns if c not in _INPUT]
        return replace(self, df=save(self.df.select(F.when(self.bad(), self._input()).alias("_line"), *rest)), costly=False)


def _path(key: str) -> str:
    quote = "'" if '"' in key else '"'
    if quote in key:
        raise SpecError(f"key holds both kinds of quotes: {key}")
    return f"$[{quote}{key}{quote}]"


def _literal(value: Any, declared: str | None = None) -> tuple[Column, T.DataType]:
    if value is None:
        dtype = ct.storage_type(declared) if declared else T.StringType()
        return F.lit(None).cast(dtype), dtype
    for kind, dtype in ((bool, T.BooleanType()), (int, T.LongType()), (float, T.DoubleType()), (str, T.StringType())):
        if isinstance(value, kind):
            return F.lit(value).cast(dtype), dtype
    raise SpecError(f"not a scalar literal: {value!r}")


def _default(value: Any, dtype: T.DataType) -> Column:
    """A fill value of the type of the column it fills."""
    fits = {
        T.StringType: (str,), T.LongType: (int,), T.IntegerType: (int,), T.ShortType: (int,), T.ByteType: (int,),
        T.DoubleType: (int, float), T.FloatType: (int, float), T.DecimalType: (int, float), T.BooleanType: (bool,),
        T.DateType: (str,), T.TimestampType: (str,), T.TimestampNTZType: (str,),
    }
    ok = isinstance(value, fits.get(type(dtype), ())) and isinstance(value, bool) == isinstance(dtype, T.BooleanType)
    if not ok:
        raise SpecError(f"fillna: {value!r} does not fit a {dtype.simpleString()} column")
    return F.lit(value).cast(dtype)


def _numbers(values: Iterable[Any]) -> list[Any]:
    found = [int(v) if isinstance(v, bool) else v for v in values if isinstance(v, (bool, int, float))]
    return [v for v in found if not (isinstance(v, float) and math.isnan(v))]


def _among(column: Column, values: list[Any]) -> Column:
    return column.isin(*values) if values else F.lit(False)


def _equals_any(field: _Field, values: list[Any]) -> Column:
    """Membership where text never equals a number, and booleans equal 0 and 1."""
    texts = [v for v in values if isinstance(v, str)]
    numbers = _numbers(values)
    bools = [bool(v) for v in numbers if v in (0, 1)]
    json_value = field.json or field.origin
    if json_value is not None:
        own_text = isinstance(field.dtype, T.StringType)
        return json_value.among(field.value if own_text else json_value.get("string"), texts, numbers, bools)
    if isinstance(field.dtype, T.StringType):
        return _among(field.value, texts)
    if isinstance(field.dtype, T.NumericType):
        return _among(field.value, numbers)
    if isinstance(field.dtype, T.BooleanType):
        return _among(field.value, bools)
    return F.lit(False)


def _mentioned(transforms: Mapping[str, Any], columns: Mapping[str, str]) -> list[str]:
    """The JSON keys a spec can read."""
    names = list(transforms.get("keep") or [])
    if not names:
        names = [*(transforms.get("rename") or {}), *columns]
    names += [a["from_column"] for a in transforms.get("add_columns") or [] if "from_column" in a]
    return list(dict.fromkeys(names))


class _Compiler:
    def __init__(
        self,
        df: DataFrame,
        transforms: Mapping[str, Any],
        columns: Mapping[str, str],
        params: Mapping[str, Any] | None,
        params_col: str | None,
        carry: tuple[str, ...],
        logical_types: bool,
    ) -> None:
        self.df = df
        self.transforms = transforms
        self.columns = columns
        self.params = params or {}
        self.params_col = params_col
        self.logical_types = logical_types
        self.raw = ROW in df.columns and isinstance(df.schema[ROW].dataType, T.VariantType)
        if self.raw and not columns:
            raise SpecError("JSON rows need declared silver columns")
        self.carry = carry
        self.fields: dict[str, _Field] = {}
        self.checks: list[tuple[str, Column]] = []
        self._stage = 0

    def compute(self, values: dict[str, Column]) -> dict[str, Column]:
        """Compute columns in a stage of their own and return references to them."""
        if not values:
            return {}
        self._stage += 1
        names = {key: f"_s{self._stage}_{i}" for i, key in enumerate(values)}
        self.df = self.df.withColumns({names[key]: value for key, value in values.items()})
        return {key: F.col(name) for key, name in names.items()}

    def settle(self, changed: dict[str, _Field]) -> None:
        for name, value in self.compute({n: f.value for n, f in changed.items()}).items():
            self.fields[name] = replace(changed[name], value=value)

    def list(self, key: str) -> list[Any]:
        return list(self.transforms.get(key) or [])

    def mapping(self, key: str) -> dict[str, Any]:
        return dict(self.transforms.get(key) or {})

    # keep, drop, rename, add_columns: bookkeeping on the driver, nothing is computed per row

    def read(self) -> None:
        keep = self.list("keep")
        if self.raw:
            keys = _mentioned(self.transforms, self.columns)
            self.checks.append(("malformed", F.col(ROW).isNull()))
            found = {k: ct.Json(F.col(ROW), _path(k)) for k in keys if not keep or k in keep}
            self.fields = {k: _Field(v.variant, T.VariantType(), v.present, v) for k, v in found.items()}
        else:
            types = {f.name: f.dataType for f in self.df.schema.fields}
            names = [c for c in self.df.columns if c not in self.carry and c != self.params_col]
            names = [c for c in dict.fromkeys(keep) if c in names] if keep else names
            self.fields = {c: _Field(F.col(f"`{c}`"), types[c]) for c in names}
        for name in self.list("drop"):
            self.fields.pop(name, None)

    def rename(self) -> None:
        for old, new in self.mapping("rename").items():
            if old not in self.fields:
                continue
            moved = self.fields.pop(old)
            kept = self.fields.get(new)
            if kept is not None and moved.present is not None:
                # Only rows that have the old key overwrite the new one.
                present = None if kept.present is None else moved.present | kept.present
                value = F.when(moved.present, moved.value).otherwise(kept.value)
                value = self.compute({new: value})[new]
                moved = _Field(value, T.VariantType(), present, ct.Json(value))
            self.fields[new] = moved

    def add_columns(self) -> None:
        for item in self.list("add_columns"):
            name = item["name"]
            declared = self.columns.get(name)
            if "from_param" in item and self.params_col is not None:
                value = F.try_element_at(F.col(self.params_col), F.lit(item["from_param"]))
                field = _Field(value, T.StringType())
            elif "from_param" in item:
                field = _Field(*_literal(self.params.get(item["from_param"]), declared))
            elif "literal" in item:
                field = _Field(*_literal(item["literal"], declared))
            elif item["from_column"] in self.fields:
                field = replace(self.fields[item["from_column"]], present=None)
            else:
                field = _Field(*_literal(None, declared))
            self.fields[name] = field

    # cast and conform

    def convert(self, targets: Mapping[str, str], reason: str) -> None:
        changed = {}
        sources = {}
        for name, logical in targets.items():
            if name not in self.fields:
                continue
            field = self.fields[name]
            try:
                if field.json is not None:
                    value = ct.cast_json(field.json, logical, self.logical_types)
                else:
                    value = ct.cast_typed(field.value, field.dtype, logical, self.logical_types)
            except TypeError as error:
                raise SpecError(f"{name}: {error}") from error
            sources[name] = field
            dtype = ct.storage_type(logical, self.logical_types)
            changed[name] = _Field(value, dtype, field.present, origin=field.json if reason == "type" else None)
        self.settle(changed)
        looked_up = {n: s for n, s in sources.items() if s.json is not None and self._checked(n, s, targets[n])}
        found = self.compute({n: _lookup(self.fields[n].value, s.json) for n, s in looked_up.items()})
        for name, source in sources.items():
            if name in found:
                if source.present is not None:
                    self.fields[name] = replace(self.fields[name], present=found[name] != _ABSENT)
                lost = found[name] == _LOST
            else:
                lost = self.fields[name].value.isNull() & ~source.missing
            if self._can_fail(source.dtype, targets[name]):
                self.checks.append((f"{reason}:{name}", lost))

    def _checked(self, name: str, source: _Field, logical: str) -> bool:
        asked = (source.present is not None and name in self.list("required")) or name in self.list("non_null")
        return asked or self._can_fail(source.dtype, logical)

    def _can_fail(self, dtype: T.DataType, logical: str) -> bool:
        if logical in ("string", "boolean") or (logical == "date" and not self.logical_types):
            return False
        if logical == "float64":
            return isinstance(dtype, (T.StringType, T.VariantType))
        if logical == "date":
            return not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return not isinstance(dtype, (T.IntegralType, T.BooleanType, T.TimestampType, T.TimestampNTZType))

    # trim, lower, upper, null_if, fillna

    def clean_text(self) -> None:
        changed: dict[str, _Field] = {}
        for key, function in (("trim", tx.strip_ws), ("lower", F.lower), ("upper", F.upper)):
            for name in self.list(key):
                field = changed.get(name, self.fields.get(name))
                if field is None or not isinstance(field.dtype, T.StringType):
                    continue
                value = function(field.value)
                if field.origin is not None:
                    value = F.when(field.origin.is_text, value).otherwise(field.value)
                changed[name] = replace(field, value=value)
        self.settle(changed)

    def nulls(self) -> None:
        changed: dict[str, _Field] = {}
        for name, values in self.mapping("null_if").items():
            field = self.fields.get(name)
            if field is None:
                if None in values:
                    changed[name] = _Field(*_literal(None, self.columns.get(name)))
                continue
            present = None if None in values else field.present
            value = F.when(_equals_any(field, values), F.lit(None)).otherwise(field.value)
            changed[name] = replace(field, value=value, present=present, json=None)
        self.settle(changed)
        changed = {}
        for name, default in self.mapping("fillna").items():
            field = self.fields.get(name)
            if field is None:
                changed[name] = _Field(*_literal(default, self.columns.get(name)))
            elif default is None:
                changed[name] = replace(field, present=None)
            elif isinstance(field.dtype, T.VariantType):
                filler = F.parse_json(F.lit(json.dumps(default)))
                value = F.when(field.missing, filler).otherwise(field.value)
                changed[name] = _Field(value, field.dtype)
            else:
                value = F.coalesce(field.value, _default(default, field.dtype))
                changed[name] = replace(field, value=value, present=None)
        self.settle(changed)

    # required, non_null

    def validate(self) -> None:
        failed = dict(self.checks)
        for name in self.list("required"):
            field = self.fields.get(name)
            if field is None:
                self.checks.append((f"missing:{name}", F.lit(True)))
            elif field.present is not None:
                self.checks.append((f"missing:{name}", ~field.present))
        for name in self.list("non_null"):
            field = self.fields.get(name)
            if field is None:
                bad = F.lit(True)
            else:
                bad = field.missing
            for reason in (f"cast:{name}", f"type:{name}"):
                if reason in failed:
                    bad = bad & ~failed[reason]
            self.checks.append((f"null:{name}", bad))

    def finish(self) -> Checked:
        if self.columns:
            for name, logical in self.columns.items():
                if name not in self.fields:
                    storage = ct.storage_type(logical, self.logical_types)
                    self.fields[name] = _Field(F.lit(None).cast(storage), storage)
            odd = {
                n: t
                for n, t in self.columns.items()
                if self.fields[n].dtype != ct.storage_type(t, self.logical_types)
            }
            self.convert(odd, "type")
            names = list(self.columns)
        else:
            names = list(self.fields)
        clash = sorted({n.lower() for n in names} & {c.lower() for c in self.carry})
        if clash:
            raise SpecError(f"output columns clash with carried columns: {clash}")
        if len({n.lower() for n in names}) != len(names):
            raise SpecError("output columns differ only by case")
        if self.raw:
            source = F.col(ROW)
        else:
            own = [c for c in self.df.columns if not c.startswith("_s") and c not in self.carry and c != self.params_col]
            source = F.struct(*[F.col(f"`{c}`") for c in own])
        line = F.col("value") if self.raw and "value" in self.df.columns else F.lit(None)
        flags = [(reason, f"_bad_{i}") for i, (reason, _) in enumerate(self.checks)]
        df = self.df.select(
            source.alias("_row"),
            line.cast("string").alias("_line"),
            *[F.col(f"`{c}`") for c in self.carry],
            *[self.fields[n].value.alias(n) for n in names],
            *[bad.alias(flag) for (_, bad), (_, flag) in zip(self.checks, flags)],
        )
        return Checked(df, tuple(names), self.carry, tuple(flags), costly=self.raw)


def check_rows(
    df: DataFrame,
    spec: Schema | Mapping[str, Any],
    params: Mapping[str, Any] | None = None,
    *,
    params_col: str | None = None,
    carry: Iterable[str] | None = None,
    logical_types: bool = False,
) -> Checked:
    """Compile a spec over a frame.

    ``spec`` is a :class:`Schema`, or a bare transform block for a typed frame. ``params`` are the
    parameters of one run; for a frame of many runs ``params_col`` names a map column instead.
    ``carry`` columns pass through untouched; for JSON rows these are all columns besides the row.
    """
    if isinstance(spec, Schema):
        transforms, columns = spec.transforms, spec.columns
    else:
        transforms, columns = spec, {}
        check_transforms(transforms, strict=False)
    if carry is None:
        is_raw = ROW in df.columns
        carry = [c for c in df.columns if is_raw and c not in (ROW, "value", params_col)]
    compiler = _Compiler(df, transforms, columns, params, params_col, tuple(carry), logical_types)
    compiler.read()
    compiler.rename()
    compiler.add_columns()
    cast = compiler.mapping("cast")
    compiler.convert(cast, "cast")
    if compiler.raw:
        # Values that no cast names take their declared type here, so that later keys see a type.
        rest = {
            n: t for n, t in columns.items()
            if n in compiler.fields and isinstance(compiler.fields[n].dtype, T.VariantType)
        }
        compiler.convert(rest, "type")
    compiler.clean_text()
    compiler.nulls()
    compiler.validate()
    return compiler.finish()


def apply_transforms(df: DataFrame, spec: Schema | Mapping[str, Any], params: Mapping[str, Any] | None = None, **options: Any) -> DataFrame:
    """Transform every row; a row that fails a check fails the job."""
    return check_rows(df, spec, params, **options).enforced()


def split_valid(
    df: DataFrame, spec: Schema | Mapping[str, Any], params: Mapping[str, Any] | None = None, **options: Any
) -> tuple[DataFrame, DataFrame]:
    """Transform every row into accepted and rejected rows."""
    checked = check_rows(df, spec, params, **options)
    return checked.accepted(), checked.rejected()


def conform(df: DataFrame, columns: Mapping[str, str], logical_types: bool = False, on_error: str = "fail") -> DataFrame:
    """Project to the declared columns and types, in declared order, null where absent."""
    schema = Schema(1, "", "", "", columns=columns)
    checked = check_rows(df, schema, logical_types=logical_types)
    return checked.enforced() if on_error == "fail" else checked.accepted()
