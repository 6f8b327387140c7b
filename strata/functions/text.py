"""Text expressions: whitespace, float text, digests, templates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character for which Python's str.isspace() is true.
WHITESPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085  "
    "           "
    "    　"
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times in an expression and compute it once."""
    return F.get(F.transform(F.array(value), use), 0)


def strip_ws(text: Column) -> Column:
    """Strip all Unicode whitespace (Spark's one-argument trim only strips spaces)."""
    return F.trim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.length(strip_ws(F.coalesce(text, F.lit("")))) == 0


def bool_text(value: Column) -> Column:
    return F.when(value, F.lit("True")).when(~value, F.lit("False"))


def float_text(value: Column) -> Column:
    """A double as its repr text: ``10000000.0`` and ``1e+16``, not ``1.0E7`` and ``1.0E16``."""
    java = value.cast("string")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).cast("int")
    # 38 digits hold every exponent of the plain range: 16 before and 20 after the point.
    plain = F.rtrim(java.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(java == "Infinity", F.lit("inf"))
        .when(java == "-Infinity", F.lit("-inf"))
        .when(~java.contains("E"), java)
        .when(exponent.between(-4, 15), plain)
        .otherwise(scientific)
    )


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def byte_length(content: Column) -> Column:
    return F.octet_length(content)


def zero_pad(value: Column, width: int = 2) -> Column:
    """Left-pad with zeros without ever cutting a longer text."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def is_template(text: Column) -> Column:
    return text.contains("{") & text.contains("}")


def placeholders(template: Column) -> Column:
    """Distinct non-empty names between braces, trimmed, in order of appearance."""
    names = F.transform(F.regexp_extract_all(template, F.lit(r"\{([^}]*)\}"), F.lit(1)), strip_ws)
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def query_placeholders(query: Column) -> Column:
    """Sorted distinct placeholder names over all values of a query map."""
    per_value = F.transform(F.map_values(query), lambda v: placeholders(F.coalesce(v, F.lit(""))))
    return F.array_sort(F.array_distinct(F.flatten(per_value)))


def _template_parts(template: Column) -> Column:
    return F.regexp_extract_all(template, F.lit(r"(\{\{|\}\}|\{[^{}]*\}|[^{}]+)"), F.lit(1))


def _is_slot(part: Column) -> Column:
    return part.startswith("{") & (part != "{{")


def _slot_name(part: Column) -> Column:
    return F.substring(part, F.lit(2), F.length(part) - 2)


def missing_template_values(template: Column, params: Column) -> Column:
    """Names a template uses that ``params`` lacks, sorted; empty for a non-template."""
    slots = F.transform(F.filter(_template_parts(template), _is_slot), _slot_name)
    absent = F.filter(slots, lambda n: ~F.map_contains_key(params, n))
    return F.when(is_template(template), F.array_sort(F.array_distinct(absent))).otherwise(
        F.array().cast("array<string>")
    )


def render_template(template: Column, params: Column) -> Column:
    """Fill ``{name}`` from a map in one pass, so that filled-in values are never filled again.

    A text without both braces passes through, a null value shows as ``None``, doubled braces are
    literal ones, and a missing name or a stray brace gives null.
    """
    parts = _template_parts(template)
    filled = F.transform(
        parts,
        lambda p: F.when(p == "{{", F.lit("{"))
        .when(p == "}}", F.lit("}"))
        .when(_is_slot(p), F.coalesce(F.try_element_at(params, _slot_name(p)), F.lit("None")))
        .otherwise(p),
    )
    whole = F.length(F.array_join(parts, "")) == F.length(template)
    complete = F.size(missing_template_values(template, params)) == 0
    return F.when(~is_template(template), template).when(whole & complete, F.array_join(filled, ""))
