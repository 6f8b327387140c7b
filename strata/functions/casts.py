"""The seven logical types as try-casts over JSON variants and over typed columns.

Every function returns null where the value is null *or* cannot be converted; callers compare with
the null-ness of the input to tell the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import text as tx
from strata.functions import times as tm

# The logical types a dataset spec may name.
LOGICAL_TYPES = ("string", "int64", "float64", "boolean", "timestamp_ms", "timestamp_s", "date")

# Lower-case texts that count as true.
TRUE_TEXTS = ("true", "1", "yes", "y")

# Texts that are a float; keeps out suffixes and hex forms such as 1d and 0x1p3.
_FLOAT_TEXT = r"^(?i)[+-]?(inf|infinity|nan|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)$"


def storage_type(logical: str, logical_types: bool = False) -> T.DataType:
    """The Spark type a logical type is stored as."""
    if logical == "string":
        return T.StringType()
    if logical == "int64":
        return T.LongType()
    if logical == "float64":
        return T.DoubleType()
    if logical == "boolean":
        return T.BooleanType()
    if logical in ("timestamp_ms", "timestamp_s"):
        return T.TimestampType() if logical_types else T.LongType()
    if logical == "date":
        return T.DateType() if logical_types else T.StringType()
    raise ValueError(f"unsupported type: {logical}")

# Codes of the characters a JSON number begins with.
_NUMBER_STARTS = tuple(map(ord, "-0123456789"))


def _as_logical(value: Column, logical: str) -> Column:
    if logical == "timestamp_ms":
        return F.timestamp_millis(value)
    if logical == "timestamp_s":
        return F.timestamp_seconds(value)
    if logical == "date":
        return F.try_to_date(value, "yyyy-MM-dd")
    return value


def _text_to_int(text: Column) -> Column:
    return tx.strip_ws(text).try_cast("bigint")


def _text_to_float(text: Column) -> Column:
    stripped = tx.strip_ws(text)
    return F.when(stripped.rlike(_FLOAT_TEXT), stripped.try_cast("double"))


def _text_to_bool(text: Column) -> Column:
    return F.lower(text).isin(*TRUE_TEXTS)


# ---- JSON variants -------------------------------------------------------------------------


class Json:
    """A value inside a VARIANT column, read by path where it is used.

    The casts below take the common case straight from the row and look at the kind of the value
    only where its text leaves that open: copying a value out and naming its kind costs more than
    the conversion. What remains sits behind ``let``: a lambda is evaluated on its own, so that
    the generated code of a wide spec stays small enough to be compiled.
    """

    def __init__(self, source: Column, path: str = "$") -> None:
        self.source = source
        self.path = path

    def get(self, sql_type: str) -> Column:
        return F.try_variant_get(self.source, self.path, sql_type)

    @property
    def variant(self) -> Column:
        return self.source if self.path == "$" else self.get("variant")

    @property
    def present(self) -> Column:
        return self.variant.isNotNull()

    @property
    def missing(self) -> Column:
        """True for an absent key and for a JSON null."""
        return self.variant.isNull() | F.is_variant_null(self.variant)

    @property
    def kind(self) -> Column:
        return F.schema_of_variant(self.variant)

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"

    @property
    def is_number(self) -> Column:
        return self.kind.isin("BIGINT", "DOUBLE") | self.kind.startswith("DECIMAL")

    def among(self, text: Column, texts: list, numbers: list, bools: list) -> Column:
        """Membership where text never equals a number; ``text`` is the text to compare."""

        def isin(value: Column, values: list) -> Column:
            return value.isin(*values) if values else F.lit(False)

        return (
            (self.is_text & isin(text, texts))
            | (self.is_number & isin(self.get("double"), numbers))
            | ((self.kind == "BOOLEAN") & isin(self.get("boolean"), bools))
        )


def _json_to_text(value: Json) -> Column:
    def by_kind(text: Column) -> Column:
        # A literal with a fraction is a decimal here; an integer beyond 64 bits is one without a scale, of 19 digits or more.
        is_float = (value.kind.startswith("DECIMAL") & ~value.kind.rlike(r"\((19|[23][0-9]),0\)$")) | (value.kind == "DOUBLE")
        return (
            F.when(value.kind == "BOOLEAN", F.initcap(text))
            .when(is_float, tx.float_text(value.get("double")))
            .otherwise(text)
        )

    text = value.get("string")
    open_kind = text.rlike("^(-?[0-9]|true$|false$|Infinity|-Infinity|NaN)")
    return F.when(open_kind, tx.let(text, by_kind)).otherwise(text)


def _json_to_int(value: Json) -> Column:
    stripped = tx.let(value.get("string"), lambda text: F.when(value.is_text, _text_to_int(text)))
    return F.coalesce(value.get("bigint"), stripped)


def _json_to_float(value: Json) -> Column:
    # The JSON text of a number begins with a digit or a sign, that of a text with a quote.
    as_json = F.to_json(value.variant)
    number = F.when(F.ascii(as_json).isin(*_NUMBER_STARTS), as_json.try_cast("double"))
    # A text of nothing but digits and signs is converted as it is.
    plain = value.get("string")
    direct = F.when(~plain.rlike("[^0-9.+eE-]"), plain.try_cast("double"))
    by_kind = tx.let(
        value.get("string"),
        lambda text: F.when(value.is_text, _text_to_float(text)).otherwise(value.get("double")),
    )
    # A null has no text, and no kind to look at.
    return F.coalesce(number, direct, F.when(plain.isNotNull(), by_kind))


def _json_to_bool(value: Json) -> Column:
    text = value.get("string")
    # A text is not tried as a number: a failed try costs far more than the look at its kind.
    by_kind = tx.let(
        value.kind,
        lambda kind: F.when(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), value.get("double") != 0),
    )
    return (
        F.when(text.isNull(), F.lit(None).cast("boolean"))
        .when(text == "false", F.lit(False))
        .when(_text_to_bool(text), F.lit(True))
        .otherwise(F.coalesce(by_kind, F.lit(False)))
    )


def cast_json(value: Json, logical: str, logical_types: bool = False) -> Column:
    """Convert a JSON value to a logical type, by the kind of value found."""
    if logical in ("string", "date"):
        result = _json_to_text(value)
    elif logical in ("int64", "timestamp_ms", "timestamp_s"):
        result = _json_to_int(value)
    elif logical == "float64":
        result = _json_to_float(value)
    elif logical == "boolean":
        result = _json_to_bool(value)
    else:
        raise ValueError(f"unsupported type: {logical}")
    return _as_logical(result, logical) if logical_types else result


# ---- typed columns -------------------------------------------------------------------------


def _typed_to_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return tx.bool_text(value)
    if isinstance(dtype, T.FractionalType):
        return tx.float_text(value.cast("double"))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def _typed_to_int(value: Column, dtype: T.DataType, logical: str) -> Column:
    if isinstance(dtype, T.StringType):
        return _text_to_int(value)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return value.try_cast("bigint")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) and logical != "int64":
        ntz = tm.utc_ntz(value, dtype)
        return tm.epoch_ms(ntz) if logical == "timestamp_ms" else tm.epoch_s(ntz)
    if isinstance(dtype, T.NullType):
        return value.cast("bigint")
    raise TypeError(f"cannot cast {dtype.simpleString()} to {logical}")


def cast_typed(value: Column, dtype: T.DataType, logical: str, logical_types: bool = False) -> Column:
    """Convert a column of a known Spark type to a logical type."""
    if isinstance(dtype, T.VariantType):
        return cast_json(Json(value), logical, logical_types)
    if logical == "string":
        result = _typed_to_text(value, dtype)
    elif logical in ("int64", "timestamp_ms", "timestamp_s"):
        if logical_types and isinstance(dtype, T.TimestampType) and logical != "int64":
            return value
        result = _typed_to_int(value, dtype, logical)
    elif logical == "float64":
        if isinstance(dtype, T.StringType):
            result = _text_to_float(value)
        elif isinstance(dtype, (T.NumericType, T.BooleanType, T.NullType)):
            result = value.cast("double")
        else:
            raise TypeError(f"cannot cast {dtype.simpleString()} to {logical}")
    elif logical == "boolean":
        if isinstance(dtype, (T.BooleanType, T.NullType)):
            result = value.cast("boolean")
        elif isinstance(dtype, T.NumericType):
            result = value != 0
        else:
            result = _text_to_bool(_typed_to_text(value, dtype))
    elif logical == "date":
        if isinstance(dtype, T.DateType) and logical_types:
            return value
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            result = tm.day_text(tm.utc_ntz(value, dtype))
        else:
            result = _typed_to_text(value, dtype)
    else:
        raise ValueError(f"unsupported type: {logical}")
    return _as_logical(result, logical) if logical_types else result
